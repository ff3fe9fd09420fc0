"""Event time and lateness of streams."""
