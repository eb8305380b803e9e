"""DuckDB SQL equivalents of the Spark queries, used as the correctness oracle."""
