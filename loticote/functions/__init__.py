"""Column functions: text, numbers and labels."""
