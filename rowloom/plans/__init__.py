"""End-to-end jobs: loading keyed tables and exporting rows."""
