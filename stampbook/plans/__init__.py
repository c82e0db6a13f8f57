"""Reports, one function each, grouped by subject."""
