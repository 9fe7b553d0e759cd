"""Streaming.

The reference is batch only (one CSV read per run); it has no watermarks,
windows over event time or state. The incremental ingest in
:mod:`gridloom.streaming.ingest` applies the *same* batch classification to
files as they arrive, so no new semantics are introduced.
"""
