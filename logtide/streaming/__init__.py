"""Streaming jobs. Positions live in the query's checkpoint; sinks are idempotent by batch id."""
