"""rivulet: stream and batch analytics written against the Spark DataFrame API.

Every operator is a function from DataFrame(s) to a DataFrame, so the same code
runs on a batch table and, where Spark allows it, on a streaming DataFrame.
"""

from rivulet.session import get_spark, scratch_path, table

__all__ = ["get_spark", "scratch_path", "table"]
