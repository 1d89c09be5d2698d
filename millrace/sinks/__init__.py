"""Writing logs and tables."""
