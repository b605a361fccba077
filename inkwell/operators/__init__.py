"""inkwell operators."""
