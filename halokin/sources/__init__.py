"""Sources and sinks: fixtures, ingest, scans, writers."""
