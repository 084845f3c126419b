"""shelfcast: retail demand analytics as Spark DataFrame jobs.

Every public operator is a plain function ``DataFrame -> DataFrame`` (or a
small fitted-model wrapper for the ``pyspark.ml`` stages), so a whole
pipeline stays one lazy plan that Catalyst optimises end to end.
"""

from shelfcast.session import build_session, materialize, scratch_dir

__all__ = ["build_session", "materialize", "scratch_dir"]
