"""File-arrival streams."""
