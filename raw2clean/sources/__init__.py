"""Sources and sinks: CSV, JSON, Parquet; header promotion; year from file path."""
