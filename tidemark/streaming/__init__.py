"""Directory streams and idempotent ingest."""
