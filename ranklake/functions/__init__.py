"""Column expressions. All of them stay in generated JVM code; none is a Python UDF."""
