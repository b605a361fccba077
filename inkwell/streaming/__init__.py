"""inkwell streaming."""
