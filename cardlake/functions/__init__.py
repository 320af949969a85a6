"""Column expressions. All are built-in Spark SQL functions; there is no Python UDF."""
