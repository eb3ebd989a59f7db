"""Column-level building blocks (pure JVM expressions, no Python UDFs)."""
