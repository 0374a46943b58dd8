"""Sources: landing-folder discovery, CSV header probe and scan, tables (Parquet or JDBC)."""
