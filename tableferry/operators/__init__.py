"""DataFrame to DataFrame steps."""
