"""Streaming.

Intentionally empty: the reference has no streaming, watermark, window-state
or late-data semantics, so there is nothing to rebuild here.  The batch
operators are plain DataFrame functions and can be applied inside
``foreachBatch`` if a caller feeds them incrementally.
"""
