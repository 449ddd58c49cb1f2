"""Sources: raw CSV files, the driver's parquet tables, the fixture adapter."""
