"""Embedding near-dedup: a pivot-permutation index finds candidates, cosines in double precision decide."""
from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dossier.checkpoints import freeze
from dossier.llm.components import connected
from dossier.llm.tables import table

#: Cosine from which two vectors are linked.
LINKED = 0.95
#: Reference points that describe a vector, nearest first; two vectors meet if they share SHARED of them.
PREFIX, SHARED = 8, 2
#: Reference points for so many vectors of one length: PER_ROOT times the root of their number, in these bounds.
PER_ROOT, FEWEST, MOST, PIVOT_BYTES = 8, 14, 32768, 32 << 20
#: Reference points are no nearer to each other than this cosine, so that dense regions do not draw them all.
SPREAD = 0.8
#: Vectors of one cell or list that are looked at one by one; denser ones are looked at by balls and blocks.
CROWD, BLOCK = 512, 256
#: Balls looked for in a crowded cell.
PEAKS = 4


def _halved(linked: float) -> float:
    """Cosine of half the largest angle of a link: all vectors so near to one point are linked with each other."""
    return math.sqrt((1 + linked) / 2) + 1e-9


def _vectors(batches):
    """``vec_id, dim, digest, vec``: unit vectors as 64-bit numbers; no digest for what links with nothing."""
    for batch in batches:
        column, digests, units, dims = batch.column("embedding"), [], [], []
        flat = pc.list_flatten(column).cast(pa.float64()).to_numpy(zero_copy_only=False)
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        for n, end in zip(sizes.tolist(), ends.tolist()):
            x = flat[end - n:end]
            top = np.abs(x).max(initial=0.0)
            if not (0 < top < np.inf):  # NaN, and so null, fails both
                digests.append(None)
                units.append(None)
                dims.append(n)
                continue
            x = x / top
            raw = (x / math.sqrt(float(x @ x)) + 0.0).tobytes()
            digests.append(hashlib.blake2b(raw, digest_size=16).digest())
            units.append(raw)
            dims.append(n)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(dims, pa.int32()), pa.array(digests, pa.binary()),
             pa.array(units, pa.binary())], ["vec_id", "dim", "digest", "vec"])


def _spread(candidates: np.ndarray, n: int) -> np.ndarray:
    """At most ``n`` of the candidates, in order, none within SPREAD of an earlier one, unless they are too few."""
    chosen, near = np.empty((n, candidates.shape[1])), []
    found = 0
    for x in candidates:
        if found == n:
            break
        if found and (chosen[:found] @ x).max() > SPREAD:
            near.append(x)
            continue
        chosen[found] = x
        found += 1
    for x in near[:max(0, min(FEWEST, n) - found)]:
        chosen[found] = x
        found += 1
    return chosen[:found]


def reference_points(classes: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """For every length of vectors: the number of its first reference point, and the points.

    A sample by hash, twice as many as are wanted and so at most ``2 * MOST`` vectors of a length or
    ``2 * PIVOT_BYTES``, comes to the driver.
    """
    wanted, share = {}, F.lit(0.0)
    for dim, n in classes.groupBy("dim").count().collect():
        wanted[dim] = min(n, max(FEWEST, min(int(PER_ROOT * math.sqrt(n)), MOST, PIVOT_BYTES // (8 * dim))))
        share = F.when(F.col("dim") == dim, min(1.0, 8.0 * (wanted[dim] + FEWEST) / n)).otherwise(share)
    at = F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    most = F.lit(0)
    for dim, n in wanted.items():
        most = F.when(F.col("dim") == dim, 2 * n).otherwise(most)
    drawn = (classes.filter(at < share).select("dim", "digest", "vec")
             .withColumn("at", F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("digest"), "digest")))
             .filter(F.col("at") <= most).select("dim", "at", "vec").toPandas())
    points, first = {}, 0
    for dim, rows in drawn.groupby("dim"):
        rows = rows.sort_values("at")
        chosen = _spread(np.frombuffer(b"".join(rows["vec"]), "<f8").reshape(-1, dim), wanted[dim])
        points[dim] = (first, chosen)
        first += len(chosen)
    return points


def _described(batches, points):
    """Adds ``pivots``: the numbers of the nearest reference points, nearest first."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        order = np.argsort(dims, kind="stable")
        out = [None] * len(dims)
        for at in np.split(order, np.flatnonzero(np.diff(dims[order])) + 1) if len(dims) else []:
            first, pivots = points.value[dims[at[0]]]
            m = min(PREFIX, len(pivots))
            for lo in range(0, len(at), BLOCK):
                some = at[lo:lo + BLOCK]
                x = np.frombuffer(b"".join(batch.column("vec").take(pa.array(some)).to_pylist()), "<f8")
                near = x.reshape(len(some), -1) @ pivots.T
                best = np.argpartition(-near, m - 1, axis=1)[:, :m]
                rank = np.lexsort((best, -np.take_along_axis(near, best, 1)), axis=1)
                for i, row in zip(some, np.take_along_axis(best, rank, 1) + first):
                    out[i] = row
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(out, pa.list_(pa.int32()))], [*batch.schema.names, "pivots"])


def _dense_places(frame: pd.DataFrame, near: float) -> pd.DataFrame:
    """Centres of balls of a crowded cell: where most of its sampled vectors are near one of them."""
    x = np.frombuffer(b"".join(frame["vec"]), "<f8").reshape(len(frame), -1)
    close, left, found = x @ x.T >= near, np.ones(len(x), bool), []
    for _ in range(PEAKS):
        within = (close & left).sum(axis=1) * left
        peak = int(within.argmax())
        if within[peak] < 3:
            break
        members = close[peak] & left
        centre = x[members].mean(axis=0)
        found.append((centre / np.linalg.norm(centre)).tobytes())
        left &= ~members
    return pd.DataFrame({"cell": int(frame["cell"].iloc[0]), "centre": found})


def _in_balls(batches, balls, near: float):
    """Adds ``ball``: the ball of its cell that a vector is nearest to, if it lies inside; else -1."""
    for batch in batches:
        ball = np.full(batch.num_rows, -1, np.int64)
        cells = pc.list_element(batch.column("pivots"), 0).to_numpy()
        for cell in np.unique(cells[np.isin(cells, list(balls.value))]).tolist():
            at = np.flatnonzero(cells == cell)
            x = np.frombuffer(b"".join(batch.column("vec").take(pa.array(at)).to_pylist()), "<f8").reshape(len(at), -1)
            to = x @ balls.value[cell].T
            best = to.argmax(axis=1)
            ball[at] = np.where(to[np.arange(len(at)), best] >= near, cell * PEAKS + best, -1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ball)], [*batch.schema.names, "ball"])


def _canonical(pivots: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The key under which a pair is looked at, that of its two smallest shared reference points, and how many it shares."""
    far = np.iinfo(np.int64).max >> 32
    shared = np.sort(np.where((pivots[a][:, :, None] == pivots[b][:, None, :]).any(axis=2), pivots[a], far), axis=1)
    return (shared[:, 0] << 32) + shared[:, 1], (shared < far).sum(axis=1)


def _compare(run: np.ndarray, crossed: np.ndarray, side: np.ndarray, x: np.ndarray, linked: float):
    """Pairs of rows of one run (rows are sorted by run) whose cosine is ``linked`` or more.

    Rows of a crossed run are compared with those of the other side, else with each other.
    """
    begins = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    size = np.diff(np.append(begins, len(run)))
    left, right = [], []
    for n in np.unique(size[size > 1]).tolist():
        first = begins[size == n]
        step = max(1, (1 << 22) // (n * max(n, x.shape[1])))
        for lo in range(0, len(first), step):
            rows = first[lo:lo + step, None] + np.arange(n)
            some = x[rows]
            r, i, j = np.nonzero(np.matmul(some, some.transpose(0, 2, 1)) >= linked)
            a, b = rows[r, i], rows[r, j]
            ok = (i < j) & (~crossed[a] | (side[a] != side[b]))
            left.append(a[ok])
            right.append(b[ok])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, int),) * 2


def _lowest(n: int, a: np.ndarray, b: np.ndarray, name: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the smallest name that pairs lead to."""
    low, before = name.copy(), None
    while before is None or (low != before).any():
        before = low.copy()
        np.minimum.at(low, a, before[b])
        np.minimum.at(low, b, before[a])
    return low


def _verified(batches, linked: float):
    """``c, links, low``: for the vectors of whole runs of one key, what each is linked with there.

    Rows come sorted by (key, cell), so a run is complete once the next begins; it has at most CROWD rows.
    """
    def settle(rows: pa.Table):
        number = {c: rows.column(c).to_numpy() for c in ("c", "weight", "ball", "key", "i", "j", "side", "dim")}
        where = np.stack([number["key"], number["i"], number["j"]])
        run = np.cumsum(np.concatenate([[False], (where[:, 1:] != where[:, :-1]).any(axis=0)]))
        dim = int(number["dim"].max(initial=1))
        x = np.zeros((len(run), dim))
        vec = rows.column("vec").to_pylist()
        for d in np.unique(number["dim"]).tolist():  # vectors of one run are of one length
            at = np.flatnonzero(number["dim"] == d)
            x[at, :d] = np.frombuffer(b"".join(vec[k] for k in at), "<f8").reshape(len(at), d)
        a, b = _compare(run, number["i"] != number["j"], number["side"], x, linked)
        width = pc.list_value_length(rows.column("pivots")).to_numpy()
        pivots = np.full((len(run), PREFIX), -1, np.int64)
        pivots[np.arange(PREFIX) < width[:, None]] = pc.list_flatten(rows.column("pivots")).to_numpy()
        pivots[pivots < 0] = -1 - np.arange((pivots < 0).sum())  # what fills up short descriptions is shared by none
        key, shared = _canonical(pivots, a, b)
        own = (shared >= SHARED) & (key == number["key"][a])
        own &= (number["ball"][a] != number["ball"][b]) | (number["ball"][a] < 0)
        a, b = a[own], b[own]
        links = np.zeros(len(run), np.int64)
        np.add.at(links, a, number["weight"][b])
        np.add.at(links, b, number["weight"][a])
        low = _lowest(len(run), a, b, number["c"])
        out = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(number["c"][out]), pa.array(links[out]), pa.array(low[out])],
                                          ["c", "links", "low"])
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        if held.num_rows < 2:
            continue
        where = np.stack([held.column(c).to_numpy() for c in ("key", "i", "j")])
        last = np.flatnonzero((where != where[:, -1:]).any(axis=0))
        done = int(last[-1]) + 1 if len(last) else 0
        for at in range(0, done, done or 1):
            yield settle(held.slice(at, done).combine_chunks())
        held = held.slice(done)
    if held is not None and held.num_rows:
        yield settle(held.combine_chunks())


def _lists(described: DataFrame) -> DataFrame:
    """The inverted lists: every vector under each pair of reference points among its nearest."""
    pairs = F.expr(f"""flatten(transform(sequence(0, {PREFIX - 2}), i -> transform(
        filter(sequence(1, {PREFIX - 1}), j -> j > i AND j < size(pivots)),
        j -> shiftleft(cast(least(pivots[i], pivots[j]) AS bigint), 32) + greatest(pivots[i], pivots[j]))))""")
    return described.select("c", "ball", F.explode(pairs).alias("key"))


def _cells(lists: DataFrame) -> DataFrame:
    """``key, ball, slots, i, j, side, slot``: which blocks of which list are compared with which.

    A short list is one cell.  A long one is cut into blocks of about BLOCK vectors of one ball or
    of none, and every two blocks meet in a cell, but for blocks of one ball, whose links are known.
    """
    parts = freeze(lists.groupBy("key", "ball").agg(F.count("*").alias("n")))
    whole = parts.groupBy("key").agg(F.sum("n").alias("total"), F.count("*").alias("balls"),
                                     F.min("ball").alias("low")).filter("total > 1 AND (balls > 1 OR low < 0)")
    short = (parts.join(whole.filter(F.col("total") <= CROWD), "key")
             .select("key", "ball", F.lit(1).cast("bigint").alias("slots"), F.lit(0).cast("bigint").alias("slot"),
                     F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side")))
    blocks = freeze(parts.join(whole.filter(F.col("total") > CROWD), "key")
                    .withColumn("slots", F.ceil(F.col("n") / BLOCK))
                    .select("key", "ball", "slots", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slots") - 1))
                            .alias("slot"))
                    .withColumn("i", F.xxhash64("ball", "slot")))
    other = blocks.select("key", F.col("ball").alias("other_ball"), F.col("i").alias("j"))
    met = blocks.join(other, "key").filter((F.col("i") != F.col("j")) & ((F.col("ball") != F.col("other_ball"))
                                                                         | (F.col("ball") < 0)))
    long_ = (met.select("key", "ball", "slots", "slot", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"),
                        (F.col("i") > F.col("j")).cast("int").alias("side"))
             .unionByName(blocks.filter("ball < 0").select("key", "ball", "slots", "slot", "i", F.col("i").alias("j"),
                                                           F.lit(0).alias("side"))))
    return short.withColumn("i", F.col("i").cast("bigint")).withColumn("j", F.col("j").cast("bigint")).unionByName(long_)


def near_duplicate_vectors(vectors: DataFrame, linked: float = LINKED, vec_id: str = "vec_id",
                           embedding: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Vectors of equal direction are one class; links are counted between all their rows.  Every class
    is described by its PREFIX nearest reference points and looked up in lists by pairs of them, so
    that classes meet which share two points or more; each pair is compared under one list only.
    Vectors within half the angle of a link from one point, a ball, are linked with each other without a
    comparison, which keeps dense regions linear; everything else in a long list is compared in
    blocks of bounded size.

    A vector that is null, empty or zero or holds a null, NaN or infinite component, and vectors of
    different lengths, are not linked.  ``component_id`` is the smallest id that links lead to
    (rows without an id do not count; null if there is none), and ``kept`` marks the rows of that
    id: rows that repeat an id are rows of their own and may both be kept.  Other columns are
    not read; an empty table gives an empty table.
    """
    spark, near = vectors.sparkSession, _halved(linked)
    source = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
    kind = source.schema["vec_id"].dataType.simpleString()
    rows = freeze(source.mapInArrow(_vectors, f"vec_id {kind}, dim int, digest binary, vec binary"))
    classes = freeze(rows.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min("vec_id").alias("v"), F.count("*").alias("weight"), F.first("dim").alias("dim"),
        F.first("vec").alias("vec")).withColumn("c", F.monotonically_increasing_id()))
    points = spark.sparkContext.broadcast(reference_points(classes))
    shape = f"digest binary, v {kind}, weight bigint, dim int, vec binary, c bigint, pivots array<int>"
    described = freeze(classes.mapInArrow(lambda batches: _described(batches, points), shape))

    cells = described.withColumn("cell", F.col("pivots")[0])
    crowded = cells.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD)
    drawn = cells.join(crowded, "cell").filter(
        F.pmod(F.xxhash64("digest", F.lit(1)), F.col("n")) < CROWD).select("cell", "vec")
    centres: dict[int, list[bytes]] = {}
    for r in drawn.groupBy("cell").applyInPandas(lambda frame: _dense_places(frame, near),
                                                 "cell int, centre binary").collect():  # PEAKS a reference point
        centres.setdefault(r["cell"], []).append(r["centre"])
    balls = spark.sparkContext.broadcast(
        {cell: np.frombuffer(b"".join(sorted(raw)), "<f8").reshape(len(raw), -1) for cell, raw in centres.items()})
    described = freeze(described.mapInArrow(lambda batches: _in_balls(batches, balls, near), shape + ", ball bigint"))

    of_ball = freeze(described.filter("ball >= 0").groupBy("ball").agg(
        F.sum("weight").alias("in_ball"), F.min("c").alias("low")))
    inside = described.filter("ball >= 0").select("c", "weight", "ball").join(of_ball, "ball").select(
        "c", (F.col("in_ball") - F.col("weight")).alias("links"), "low")
    lists = freeze(_lists(described))
    places = freeze(_cells(lists))
    slots = places.groupBy("key", "ball").agg(F.max("slots").alias("slots"))
    dealt = (lists.join(slots, ["key", "ball"])
             .withColumn("slot", F.pmod(F.xxhash64("c"), F.col("slots"))).drop("slots")
             .join(places.drop("slots"), ["key", "ball", "slot"]).select("key", "i", "j", "side", "c")
             .join(described.select("c", "weight", "ball", "dim", "vec", "pivots"), "c"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = (dealt.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
           .mapInArrow(lambda batches: _verified(batches, linked), "c bigint, links bigint, low bigint"))
    found = freeze(met.unionByName(inside))
    components = connected(found.select(F.col("c").alias("a"), F.col("low").alias("b"))).withColumnRenamed("v", "c")
    counted = found.groupBy("c").agg(F.sum("links").alias("links"))
    of_class = (classes.select("digest", "c", "v", "weight").join(components, "c", "left").join(counted, "c", "left")
                .withColumn("component", F.coalesce("component", "c")))
    smallest = of_class.groupBy("component").agg(F.min("v").alias("component_id"))
    of_class = of_class.join(smallest, "component").select(
        "digest", "component_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return (rows.select("vec_id", "digest").join(of_class, "digest", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
                    F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
                    .alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def op13_embedding_dedup(spark, sf_dir):
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


SQL = f"""
WITH RECURSIVE x AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda e: CAST(e AS DOUBLE)) AS x FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = len(embedding)
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
u AS MATERIALIZED (SELECT vec_id, len(x) AS n, list_transform(x, lambda e: e / sqrt(list_sum(list_transform(x, lambda f: f * f)))) AS x
    FROM x),
link AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.n = b.n AND a.vec_id <> b.vec_id
    WHERE list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) >= {LINKED}),
reached(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN link l ON l.a = r.b),
low AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT e.vec_id, (SELECT count(*) FROM link WHERE a = e.vec_id) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN low USING (vec_id)"""
