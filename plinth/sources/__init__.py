"""Reading and writing: delimited file drops, bucketed tables, the given parquet tables."""
