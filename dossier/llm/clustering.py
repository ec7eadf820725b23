"""Lloyd's clustering with the dimensions dealt out: exact integer distances, summed over blocks of columns."""
from __future__ import annotations

import hashlib
import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.checkpoints import freeze, run_folder
from dossier.llm.tables import table

#: Components are counted in so many parts of one.
UNITS = 1024
#: Columns of a block, and rows of a tile; a tile is one block of the columns of so many rows.
BLOCK_COLUMNS, TILE_ROWS = 16, 1024
#: The block that holds the ids of a tile's rows.
IDS = -1


def _limit(dim: int) -> int:
    """Largest component whose squared distances, summed over ``dim``, fit 64 bits."""
    return math.isqrt((1 << 62) // dim) // 2


def _components(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are vectors of ``dim`` finite components, and their components in parts of one."""
    sized = pc.fill_null(pc.equal(pc.list_value_length(column), dim), False)
    flat = pc.list_flatten(column.filter(sized)).cast(pa.float64())
    x = flat.to_numpy(zero_copy_only=False).reshape(-1, dim)  # nulls come as NaN
    finite = np.isfinite(x).all(axis=1)
    rows = np.flatnonzero(sized.to_numpy(zero_copy_only=False))[finite]
    top = float(_limit(dim))
    return rows, np.clip(np.floor(UNITS * x[finite]), -top, top).astype("<i8")


def _tiles(batches, dim: int, columns: int, most: int):
    part, tile = TaskContext.get().partitionId(), 0
    for batch in batches:
        rows, x = _components(batch.column("embedding"), dim)
        ids = batch.column("vec_id").take(pa.array(rows))
        for at in range(0, len(rows), most):
            some, own = x[at:at + most], ids.slice(at, most)
            raw = [some[:, b:b + columns].astype("<i4").tobytes() for b in range(0, dim, columns)]
            n = len(raw) + 1
            lists = pa.ListArray.from_arrays(pa.array([0, *[len(own)] * n], pa.int32()), own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + tile] * n, pa.int64()), pa.array([IDS, *range(len(raw))], pa.int32()),
                 pa.array([len(own)] * n, pa.int32()), pa.array([None, *raw], pa.binary()), lists],
                ["tile", "block", "n", "cells", "ids"])
            tile += 1


def _matrix(raw: bytes, n: int, width: int) -> np.ndarray:
    return np.frombuffer(raw, "<i4").reshape(n, width).astype(np.int64)


def _partial_distances(batches, slices):
    """The share of every block in the squared distances of a tile's rows from all centroids."""
    for batch in batches:
        out = []
        for block, n, raw in zip(*(batch.column(c).to_pylist() for c in ("block", "n", "cells"))):
            centroids = slices[block].value
            x = _matrix(raw, n, centroids.shape[1])
            far = np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)
            out.append(far.astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("tile"), batch.column("n"), pa.array(out, pa.binary())],
                                         ["tile", "n", "far"])


def _nearest(parts: pa.Table) -> pa.Table:
    """Add the blocks of one tile and take the nearest centroid of each row, the first of equal ones."""
    n = parts.column("n")[0].as_py()
    far = sum(np.frombuffer(raw, "<i8") for raw in parts.column("far").to_pylist()).reshape(n, -1)
    cluster = far.argmin(axis=1)
    lists = pa.array([0, n], pa.int32())
    return pa.table({"tile": parts.column("tile").slice(0, 1),
                     "cluster": pa.ListArray.from_arrays(lists, pa.array(cluster, pa.int32())),
                     "distance": pa.ListArray.from_arrays(lists, pa.array(far[np.arange(n), cluster], pa.int64()))})


def _sums(batches, k: int, width: dict[int, int]):
    """Of every block in a task: the components summed by cluster and column, and the clusters' rows."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, n, raw, cluster in zip(*(batch.column(c).to_pylist() for c in ("block", "n", "cells", "cluster"))):
            x, at = _matrix(raw, n, width[block]), np.array(cluster)
            x = np.column_stack([np.ones(n, np.int64), x])[order := np.argsort(at, kind="stable")]
            present, first = np.unique(at[order], return_index=True)
            total.setdefault(block, np.zeros((k, width[block] + 1), np.int64))[present] += np.add.reduceat(x, first)
    for block, sums in total.items():
        of, column = np.nonzero(np.broadcast_to(sums[:, :1] > 0, sums[:, 1:].shape))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(of), block), pa.int32()), pa.array(of, pa.int32()), pa.array(column, pa.int32()),
             pa.array(sums[of, 0]), pa.array(sums[of, column + 1])], ["block", "cluster", "column", "n", "total"])


def _assigned(tiles: DataFrame, centroids: np.ndarray, columns: int) -> DataFrame:
    """``tile, cluster, distance``: every tile's rows with their nearest centroids.

    A task needs the slices of its own blocks only; each is shipped by itself.
    """
    sc = tiles.sparkSession.sparkContext
    slices = [sc.broadcast(centroids[:, b:b + columns]) for b in range(0, centroids.shape[1], columns)]
    far = tiles.select("tile", "block", "n", "cells").mapInArrow(
        lambda batches: _partial_distances(batches, slices), "tile bigint, n int, far binary")
    return far.groupBy("tile").applyInArrow(_nearest, "tile bigint, cluster array<int>, distance array<bigint>")


def _moved(tiles: DataFrame, centroids: np.ndarray, columns: int) -> np.ndarray:
    """The centroids after one round; every block of columns is updated from its own tiles."""
    k, dim = centroids.shape
    width = {b: min(columns, dim - at) for b, at in enumerate(range(0, dim, columns))}
    nearest = (_assigned(tiles, centroids, columns)
               .select("tile", "cluster", F.explode(F.array(*map(F.lit, width))).alias("block")))
    slices = (tiles.join(nearest, ["block", "tile"]).select("block", "n", "cells", "cluster")
              .mapInArrow(lambda batches: _sums(batches, k, width),
                          "block int, cluster int, column int, n bigint, total bigint")
              .groupBy("block", "cluster", "column").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
              .select("block", "cluster", "column", F.expr("(total - pmod(total, n)) div n").alias("at")))
    moved = centroids.copy()
    for r in slices.collect():  # k times dim numbers
        moved[r["cluster"], r["block"] * columns + r["column"]] = r["at"]
    return moved


def first_centroids(vectors: DataFrame, k: int, seed: str, dim: int) -> np.ndarray:
    """The ``k`` kept vectors whose ids have the smallest hashes; of equal ids the smaller vector first."""
    kept = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("x")).filter(
        (F.size("x") == dim) & F.forall("x", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False))))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    top = float(_limit(dim))
    whole = F.transform("x", lambda v: F.floor(F.greatest(F.least(v * UNITS, F.lit(top)), F.lit(-top))))
    rows = kept.select(digest.alias("digest"), whole.alias("x")).orderBy("digest", "x").limit(k).collect()
    return np.array([r["x"] for r in rows]).astype(np.int64).reshape(-1, dim)


def lloyd(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, seed: str = "3",
          vec_id: str = "vec_id", embedding: str = "embedding", columns: int = BLOCK_COLUMNS,
          tile_rows: int = TILE_ROWS) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector.

    Vectors of another length and those that are null or hold a null, NaN or infinite component
    are left out.  Components are whole numbers of 1/1024, so all distances and means are exact;
    a component beyond the range in which squared distances fit 64 bits (131,072 for 64
    dimensions) counts as the end of that range.  An inertia that does not fit 64 bits is null.
    Repeated rows count as often as they appear, and so do rows without an id, whose hash is that
    of the seed alone.  With fewer than ``k`` vectors every one starts a cluster; an empty table
    gives an empty table.  Other columns are not read.

    The vectors are cut into tiles once and laid out in buckets by (block of columns, tile).  A
    round sends one partial distance per block, row and centroid to the tile's key, where blocks
    are added and the nearest centroid is taken, and the numbers of the clusters back to the blocks, whose tiles do
    not move.  Only ``k * dim`` components come to the driver.
    """
    spark = vectors.sparkSession
    source = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
    kind = source.schema["vec_id"].dataType.simpleString()
    cut = freeze(source.mapInArrow(lambda batches: _tiles(batches, dim, columns, tile_rows),
                                   f"tile bigint, block int, n int, cells binary, ids array<{kind}>"))
    centroids = first_centroids(source, k, seed, dim)
    name = f"tiles_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (cut.filter(F.col("block") != IDS).select("tile", "block", "n", "cells").repartition(buckets, "block", "tile")
     .write.bucketBy(buckets, "block", "tile").sortBy("block", "tile").option("path", run_folder(spark, "tiles"))
     .saveAsTable(name))
    try:
        tiles = spark.table(name)
        for _ in range(rounds if len(centroids) else 0):
            centroids = _moved(tiles, centroids, columns)
        last = freeze(_assigned(tiles, centroids, columns))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    found = (cut.filter(F.col("block") == IDS).select("tile", "ids").join(last, "tile")
             .select(F.inline(F.arrays_zip("ids", "cluster", "distance")))
             .toDF("vec_id", "cluster", "distance"))
    inertia = dict(last.select(F.inline(F.arrays_zip("cluster", "distance"))).groupBy("cluster")
                   .agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    fits = lambda x: int(x) if x < 1 << 63 else None
    whole = fits(sum(inertia.values(), 0))
    about = spark.createDataFrame(
        [(c, fits(x), whole, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
         for c, x in inertia.items()], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia",
                                                            "inertia", "centroid_sha256")


def op11_centroid_clustering(spark, sf_dir):
    return lloyd(table(spark, sf_dir, "embeddings"))


def _sql(k: int = 8, rounds: int = 10, dim: int = 64, seed: str = "3") -> str:
    steps = [f"""v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id,
        list_transform(embedding, lambda e: CAST(floor({UNITS} * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
        WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dim}),
    flat AS MATERIALIZED (SELECT r, unnest(range(1, {dim} + 1)) AS i, unnest(x) AS x FROM v),
    c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, x FROM (
        SELECT sha256('{seed}:' || CAST(vec_id AS VARCHAR)) AS h, x FROM v ORDER BY h LIMIT {k}))"""]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (SELECT r, c, d FROM (
            SELECT r, c, d, row_number() OVER (PARTITION BY r ORDER BY d, c) AS place FROM (
                SELECT v.r, k.c, list_sum(list_transform(list_zip(v.x, k.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
                FROM v CROSS JOIN c{n} k)) WHERE place = 1)""")
        if n < rounds:
            steps.append(f"""c{n + 1} AS MATERIALIZED (SELECT k.c, coalesce(m.x, k.x) AS x FROM c{n} k LEFT JOIN (
                SELECT c, list(m ORDER BY i) AS x FROM (
                    SELECT c, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
                    FROM a{n} JOIN flat USING (r) GROUP BY c, i) GROUP BY c) m ON m.c = k.c)""")
    return f"""WITH {", ".join(steps)}
    SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
        CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(k.x, ',')) AS centroid_sha256
    FROM a{rounds} a JOIN v USING (r) JOIN c{rounds} k ON k.c = a.c"""


SQL = _sql()
