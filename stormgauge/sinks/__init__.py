"""Writers: partitioned Parquet, catalog tables, JDBC, keyed changelog."""
