"""Column functions: calendar parts, guarded ratios and keys."""
