"""Column functions: plain expressions that stay inside generated code."""
