"""Incremental versions of the batch queue analyses (K-11, K-12) on Structured Streaming.

The reference has no streams; these run the same aggregates over visit
records as they arrive, so a dashboard can be kept current without
re-scanning history.  No new operator is introduced.
"""
