"""Column-level helpers (pure built-in expressions, stay inside whole-stage codegen)."""
