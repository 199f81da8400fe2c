"""plinth: warehouse operators for PySpark (ingest, clean, merge, SCD-2, star facts, KPIs)."""
