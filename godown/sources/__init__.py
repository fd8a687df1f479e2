"""Sources and sinks: CSV exports, the driver-table adapter, parquet/CSV writers."""
