"""streamfold: keyed fan-in pipelines on Spark.

Decode JSON topics against a declared schema, align every source to a sink's
columns, and fold many sources into one result under a sink-specific rule
(latest non-null per column, last row wins, or append).  Also: backward as-of
enrichment, windowed activity metrics and run/log analytics.  Every operator
is a plain DataFrame transformation, so the same code serves batch reads and
Structured Streaming.
"""

from streamfold.session import get_session, shared_checkpoint_dir

__all__ = ["get_session", "shared_checkpoint_dir"]
