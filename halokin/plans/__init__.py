"""End-to-end jobs, query registry and SQL oracle."""
