"""Column functions. All accept a column or a column name."""
