"""Reading and writing Ion."""
