"""Column expressions: everything here stays in the JVM, no Python per row."""
