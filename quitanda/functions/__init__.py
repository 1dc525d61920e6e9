"""Column expressions, all built from pyspark.sql.functions."""
