"""Column expressions shared by the plans; all built-in, no UDFs."""
