"""Scans and sinks: supplied parquet tables, the flight-shaped view, CSV/JSON/parquet artefacts."""
