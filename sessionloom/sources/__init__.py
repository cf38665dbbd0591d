"""Sources and sinks: the events adapter, catalog / parquet tables, CSV."""
