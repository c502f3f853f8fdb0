"""Writing frames to tables and files."""
