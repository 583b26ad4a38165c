"""Column expressions: JVM-side only, except the exact conversion of numbers beyond 38 digits."""
