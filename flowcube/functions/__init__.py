"""Column-level functions: text/list handling and exact time arithmetic."""
