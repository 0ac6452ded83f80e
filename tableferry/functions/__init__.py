"""Column expressions: nested values and JSON text, type mapping, row size, repeatable draws."""
