"""Sources: Parquet tables, access logs (text or derived from events), CSV."""
