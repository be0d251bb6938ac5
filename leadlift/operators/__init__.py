"""DataFrame steps."""
