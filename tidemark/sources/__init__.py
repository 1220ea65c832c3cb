"""Reading and writing flow tables."""
