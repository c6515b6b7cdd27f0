"""Column expressions: text in, text out, all evaluated inside the JVM."""
