"""Column expressions; everything stays inside JVM code generation."""
