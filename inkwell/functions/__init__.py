"""inkwell functions."""
