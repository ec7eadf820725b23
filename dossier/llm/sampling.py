"""Bounded samples of labelled rows."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Ranges of hashes that rows are counted in.
RANGES = 4096


def bounded_sample(rows: DataFrame, group: str, most: int, key: str = "doc_id") -> DataFrame:
    """The ``most`` rows of every value of ``group`` whose keys have the smallest hashes.

    ``group`` is a label with few values.  Rows are counted by group and range of hashes; all of the
    lower ranges belong to the sample, and only the one range in which it ends is ranked, so no
    large class is sorted and no task ranks more than about one row in RANGES of it.
    """
    at = F.shiftright(F.xxhash64(key), 52) + RANGES // 2
    counts: dict = {}
    for value, place, n in rows.groupBy(group, at.alias("place")).count().collect():
        counts.setdefault(value, {})[place] = n
    last, room = F.lit(RANGES), F.lit(0)
    for value, by_range in counts.items():
        before = 0
        for place in sorted(by_range):
            if before + by_range[place] > most:
                mine = F.col(group).eqNullSafe(F.lit(value))
                last, room = F.when(mine, place).otherwise(last), F.when(mine, most - before).otherwise(room)
                break
            before += by_range[place]
    placed = rows.withColumns({"_at": at, "_last": last, "_room": room})
    ranked = (placed.filter("_at = _last")
              .withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(F.xxhash64(key), key)))
              .filter("_rank <= _room").drop("_rank"))
    return placed.filter("_at < _last").unionByName(ranked).drop("_at", "_last", "_room")
