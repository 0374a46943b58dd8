"""Sinks: Parquet (plain, partitioned, snapshots), CSV export, JDBC."""
