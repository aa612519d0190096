"""Market-bar analytics on PySpark: ingest, clean, resample, report, watch."""
