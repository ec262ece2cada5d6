"""flowcube: work-flow telemetry and OLAP analytics as Spark DataFrame functions.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects and
expresses its work with Spark SQL built-ins so that Catalyst and AQE plan it.
"""

__all__ = ["session"]
