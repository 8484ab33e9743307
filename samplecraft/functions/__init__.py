"""Column functions: text dialects, scalars, maps and variants."""
