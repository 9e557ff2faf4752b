"""Operators for language-model training data. Nothing else in foliospark imports this subpackage."""
