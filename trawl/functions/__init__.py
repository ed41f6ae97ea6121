"""Column functions: distances, text analysis, hash embedding."""
