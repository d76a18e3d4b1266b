"""Column expressions (JVM-side)."""
