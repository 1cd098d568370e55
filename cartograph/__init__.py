"""cartograph — retail customer analytics as lazy Spark DataFrame operators.

Every operator takes DataFrames (plus column names and dates as keyword
parameters) and returns a lazy DataFrame built from built-in Spark
expressions, so Catalyst can prune, push down and fuse the whole plan.

Sub-packages
------------
sources    schemas, CSV/Parquet readers, fixture adapters, writers
functions  scalar column helpers, distributed ranking, bounded joins
operators  quality, cleaning, features, analytics, cohorts, ML, metrics
plans      end-to-end compositions and the query/oracle registry
streaming  the daily activity operator over a streaming transaction source
"""

from cartograph.session import ensure_checkpoint_dir, get_session

__all__ = ["get_session", "ensure_checkpoint_dir"]
