"""Small tables from the caller's own values."""
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    """Rows the caller holds, as a table whose size Spark knows.

    ``createDataFrame`` on a list gives a scan of unknown size, and a join might then shuffle or
    broadcast the large side.  Rows given as VALUES have exact statistics, so the join is a
    broadcast of this side for as long as it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    if not rows:
        return spark.createDataFrame([], schema)
    # every value goes in as text, as an inline table wants one type per column up front
    named = {f"r{i}c{j}": None if v is None else str(v)
             for i, row in enumerate(rows) for j, v in enumerate(row)}
    marks = ", ".join("(" + ", ".join(f":r{i}c{j}" for j in range(len(schema.fields))) + ")"
                      for i in range(len(rows)))
    names = ", ".join(f"`{f.name}`" for f in schema.fields)
    df = spark.sql(f"SELECT * FROM VALUES {marks} AS t({names})", args=named)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
