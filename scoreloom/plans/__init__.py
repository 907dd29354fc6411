"""Dataset jobs and the named queries."""
