"""Spark-native cleaning, conforming and aggregation of monthly regional statistics.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's own
expressions, joins, aggregates and windows.  Domain jobs (power and climate
layers) live in :mod:`regiostat.plans`; they take column names as parameters.
"""

from regiostat.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
