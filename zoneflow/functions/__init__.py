"""Column expressions. All are built-in functions, so they stay inside whole-stage codegen."""
