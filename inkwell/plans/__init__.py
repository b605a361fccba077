"""inkwell plans."""
