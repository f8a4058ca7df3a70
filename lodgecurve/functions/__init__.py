"""Column expressions: values in, values out, no jobs."""
