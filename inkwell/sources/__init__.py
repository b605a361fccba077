"""inkwell sources."""
