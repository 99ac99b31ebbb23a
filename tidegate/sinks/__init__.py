"""Writers: inventories, work tables, logs, partitioned Parquet, replacement."""
