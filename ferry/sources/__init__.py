"""Table-set readers: Parquet folders, the session catalogue, JDBC."""
