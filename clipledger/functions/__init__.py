"""Column expressions. All are compositions of Spark built-ins; none is a UDF."""
