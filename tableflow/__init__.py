"""tableflow: DataFrame-in, DataFrame-out ETL operators on PySpark.

Every public operator takes a ``DataFrame`` (or a ``SparkSession`` for
sources) plus plain option dicts and returns a lazily planned
``DataFrame``; Catalyst chooses the physical plan.
"""

from tableflow.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
__version__ = "0.1.0"
