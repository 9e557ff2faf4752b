"""plans of foliospark."""
