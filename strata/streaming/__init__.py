"""Following landed runs as they arrive."""
