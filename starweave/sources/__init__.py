"""Sources and sinks: CSV, Parquet, JDBC, landed pages."""
