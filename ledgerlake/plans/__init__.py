"""Composite jobs (`jobs`), test-table proxies (`proxies`), the query registry
(`catalog`) and its DuckDB oracle (`oracle`)."""
