"""sources of foliospark."""
