"""Reading source tables and writing result tables."""
