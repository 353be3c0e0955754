"""Fixed values, column expressions and small statistical building blocks."""
