"""Column-expression helpers (JVM built-ins only)."""
