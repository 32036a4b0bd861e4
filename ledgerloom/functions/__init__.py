"""Column-level helpers and grouped statistics."""
