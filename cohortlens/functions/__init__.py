"""Column functions: they take and return `Column`s and touch no table."""
