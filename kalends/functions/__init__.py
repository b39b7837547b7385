"""Column functions: text, months, classes and numbers."""
