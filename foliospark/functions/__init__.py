"""functions of foliospark."""
