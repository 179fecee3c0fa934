"""Streaming: intentionally empty.

The reference has no streaming sources, watermarks, windows over event time or
stateful operators; every stage is a batch job over files. Nothing is added here beyond
what the reference does. Incremental re-runs of keyed outputs are covered in batch by
``sources.io.pending_keys`` (which keys have no output yet) and
``sources.io.write_partitioned`` (dynamic partition overwrite).
"""
