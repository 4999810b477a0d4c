"""Reading and writing the eight tables."""
