"""The per-record plans over Structured Streaming sources."""
