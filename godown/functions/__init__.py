"""Column-level helpers: built-in Spark expressions only, so they stay inside whole-stage codegen."""
