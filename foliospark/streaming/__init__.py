"""streaming of foliospark."""
