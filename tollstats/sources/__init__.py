"""Readers and writers: CSV files, JDBC tables, parquet stores, line items."""
