"""rillet: stream and batch analytics operators on PySpark.

Every operator is a function ``op(df, ..., *, keys, time_col, durations,
thresholds) -> DataFrame`` built from DataFrame / SQL primitives, so Catalyst
plans it and the same code runs on fixtures and user data.  Streaming forms
live in :mod:`rillet.streaming`.
"""

from rillet.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
