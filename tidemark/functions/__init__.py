"""Column expressions. All run inside the JVM; none starts a Python worker."""
