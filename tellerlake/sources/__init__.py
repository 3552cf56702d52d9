"""File readers, the lake tables and the shared working folder."""
