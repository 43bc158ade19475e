"""Column expressions: pure functions from Column to Column, evaluated in the JVM."""
