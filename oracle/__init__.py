"""Expected results as DuckDB SQL over the sample tables, written apart from the Spark code."""
