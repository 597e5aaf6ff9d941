"""Part of fieldloom."""
