"""Column functions and small reusable DataFrame helpers."""
