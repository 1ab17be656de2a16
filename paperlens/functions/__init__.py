"""Column expressions. Every function takes and returns Columns and stays inside codegen."""
