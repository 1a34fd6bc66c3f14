"""shopstream — Spark-native analytics over online-shop events.

JSON-line events (clicks, cart actions, delivery updates) are decoded into a
typed table, bad lines are quarantined, and click / sales / per-product totals
are computed in batch and as Structured Streaming queries.  Batch and
streaming share the same Column-level operator definitions.
"""

from shopstream.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]
