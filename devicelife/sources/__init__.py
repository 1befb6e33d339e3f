"""Sources and sinks: report files (CSV), parquet tables, model bundles."""
