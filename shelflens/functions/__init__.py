"""Column expressions: all built from JVM-side functions."""
