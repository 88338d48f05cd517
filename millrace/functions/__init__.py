"""Column expressions. They run inside the JVM and hold no state."""
