"""Column- and header-level helpers."""
