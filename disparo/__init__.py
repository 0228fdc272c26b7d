"""disparo: labelled-event enrichment, outcome modelling and disparity analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions and Spark ML stages.  Sub-packages:

* ``functions`` - pure ``Column`` builders (no DataFrame access)
* ``operators`` - parameterised DataFrame transforms (cleaning, features,
  joins, buckets, fairness, ranking, modelling)
* ``sources``   - readers and writers (CSV, partitioned Parquet, JSON metrics,
  reference payloads, models, read-or-build)
* ``plans``     - composite jobs and the adapters that map the driver's tables
  onto the event schema
* ``streaming`` - incremental enrichment of landed raw files
"""

from disparo.config import EventConfig

__all__ = ["EventConfig"]
__version__ = "0.1.0"
