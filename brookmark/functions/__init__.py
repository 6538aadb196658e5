"""Column helpers: thin names over built-in expressions, nothing leaves the JVM."""
