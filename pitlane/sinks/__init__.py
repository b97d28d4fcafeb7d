"""Sinks: chunked Parquet / CSV, single-file extracts, JDBC."""
