"""Column expressions (JVM-side ``pyspark.sql.functions`` compositions)."""
