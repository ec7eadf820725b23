"""Near duplicates: an LSH forest of minhash signatures proposes clusters, full sets decide."""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.checkpoints import freeze
from dossier.llm.components import connected
from dossier.llm.tables import table
from dossier.llm.wordsets import mix, shingle_sets

WIDTH = 5
#: Documents are linked when 100 * |A and B| >= SIMILAR * |A or B|.
SIMILAR = 80
#: Sorted orders of the signatures; labels of an order; labels that neighbours share at least.
TREES, DEPTH, LEAST = 32, 8, 3
#: Rows of a region of an order that are all paired; in larger ones a row is paired with so many
#: neighbours on either side, which share its longest prefixes, and with the region's hub.
REGION, NEIGHBOURS = 12, 3
#: A pair found in small regions is a candidate when so many orders found it.
VOTES = 4
#: Documents of a cluster that one task compares with one another.
CLUSTER = 512
#: Boundary rows that are sorted by one task; more of them are dealt out again.
BOUNDARY = 100_000
_HASHES = TREES * LEAST
_FACTORS = mix(np.arange(1, _HASHES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def _labels(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each non-empty set and order, DEPTH labels of 16 bits as two 64-bit numbers."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    whole = np.concatenate(sets)
    least = np.empty((len(sets), _HASHES), np.uint64)
    for k, factor in enumerate(_FACTORS):
        least[:, k] = np.minimum.reduceat(whole * factor, starts)
    label = mix(least) & np.uint64(0xFFFF)
    hi, lo = (np.zeros((len(sets), TREES), np.uint64) for _ in range(2))
    for tree in range(TREES):
        for depth in range(DEPTH):
            at = label[:, (tree * LEAST + depth) % _HASHES]
            half = hi if depth < DEPTH // 2 else lo
            half[:, tree] = (half[:, tree] << np.uint64(16)) | at
    return hi.view(np.int64), lo.view(np.int64)


def _sketched(batches, width: int):
    """Size and 128-bit identity of each text's shingle set, and its labels in all orders."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            sets = list(shingle_sets(rows.column("text").to_pylist(), width))
            n = np.array([len(s) for s in sets], np.int64)
            k1 = np.array([int(mix(s).sum()) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
            k2 = np.array([int(np.bitwise_xor.reduce(mix(~s))) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
            hi, lo = np.zeros((2, len(sets), TREES), np.int64)
            full = np.flatnonzero(n)
            if len(full):
                hi[full], lo[full] = _labels([sets[i] for i in full])
            lists = [pa.ListArray.from_arrays(np.arange(0, x.size + 1, TREES, dtype=np.int32), pa.array(x.ravel()))
                     for x in (hi, lo)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(n), pa.array(k1), pa.array(k2), *lists],
                ["doc_id", "n", "k1", "k2", "hi", "lo"])


def _found(batches):
    """Pairs, rows of crowded regions and boundary rows of one stretch of the sorted orders.

    kind 0: ``x, y`` is a pair of a small region; 1: of neighbours in a crowded one; 2: ``x`` is
    in the crowded region (``tree``, ``hi``), and ``y`` tells whether it is on the region's most
    common path; 3: a row at the end of the stretch, which is compared again with what follows.
    """
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    rows = pa.Table.from_batches(batches)
    tree, hi, lo, v = (rows.column(c).to_numpy() for c in ("tree", "hi", "lo", "v"))
    n = len(v)
    top = hi >> 16 * (DEPTH // 2 - LEAST)
    head = np.ones(n, bool)
    head[1:] = (tree[1:] != tree[:-1]) | (top[1:] != top[:-1])
    starts = np.flatnonzero(head)
    region = np.cumsum(head) - 1
    sizes = np.diff(np.append(starts, n))
    crowded = (sizes > REGION)[region]

    def give(kind, at, other):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), kind, np.int32)), pa.array(tree[at]), pa.array(hi[at] if kind == 3 else top[at]),
             pa.array(lo[at]), pa.array(v[at]), pa.array(other)], ["kind", "tree", "hi", "lo", "x", "y"])

    for k in range(1, min(REGION, int(sizes.max()))):
        at = np.flatnonzero(region[k:] == region[:-k])
        for kind, here in ((0, at[~crowded[at]]), (1, at[crowded[at]] if k <= NEIGHBOURS else at[:0])):
            if len(here):
                yield give(kind, here, v[here + k])
    for r in np.flatnonzero(sizes > REGION):
        at = np.arange(starts[r], starts[r] + sizes[r])
        common = np.ones(len(at), bool)
        for depth in range(LEAST, DEPTH):
            half = hi if depth < DEPTH // 2 else lo
            label = (half[at] >> 16 * (DEPTH // 2 - 1 - depth % (DEPTH // 2))) & 0xFFFF
            common &= label == np.bincount(label[common], minlength=1).argmax()
        yield give(2, at, common.astype(np.int64))
    for r in {0, len(starts) - 1}:
        at = np.arange(starts[r], starts[r] + sizes[r])
        at = np.unique(np.concatenate([at[:REGION], at[-REGION:]]))
        yield give(3, at, np.zeros(len(at), np.int64))


_FOUND = "kind int, tree int, hi bigint, lo bigint, x bigint, y bigint"


def forest_pairs(classes: DataFrame) -> DataFrame:
    """Candidate pairs ``a, b`` of ``classes`` (``v, hi, lo``) from the sorted orders."""
    rows = classes.select("v", F.posexplode(F.arrays_zip("hi", "lo")).alias("tree", "at")).select(
        "tree", "at.hi", "at.lo", "v")
    order, found, last = ["tree", "hi", "lo", "v"], [], False
    dealt = rows.repartitionByRange(*order)
    while True:
        found.append(freeze(dealt.sortWithinPartitions(*order).mapInArrow(_found, _FOUND)))
        if last:
            break
        # at most 4 * REGION rows of each partition, so every level is far smaller than the one before
        boundary = found[-1].filter("kind = 3")
        last = boundary.count() <= BOUNDARY
        boundary = boundary.select("tree", "hi", "lo", F.col("x").alias("v"))
        dealt = boundary.repartition(1) if last else boundary.repartitionByRange(*order)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    pair = [F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")]
    near = (out.filter("kind = 0").select("tree", *pair).distinct().groupBy("a", "b").count()
            .filter(F.col("count") >= VOTES).select("a", "b"))
    crowd = out.filter("kind = 2").groupBy("tree", "hi", "x").agg(F.max("y").alias("y"))
    # the text a family was copied from keeps the common labels in most orders
    votes = crowd.groupBy("x").agg(F.sum("y").alias("votes"))
    hubs = (crowd.join(votes, "x").groupBy("tree", "hi")
            .agg(F.max(F.struct("votes", (-F.col("x")).alias("rank"))).alias("hub"))
            .select("tree", "hi", (-F.col("hub.rank")).alias("y")))
    with_hub = crowd.drop("y").join(hubs, ["tree", "hi"]).select(*pair)
    return (near.unionByName(out.filter("kind = 1").select(*pair)).unionByName(with_hub)
            .filter("a <> b").distinct())


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``left`` with all of ``right``."""
    sets = left + right
    tokens, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    by_token = np.argsort(place, kind="stable")
    place, owner = place[by_token], owner[by_token]
    out = np.zeros((len(left), len(right)), np.float32)
    step = 4096
    cuts = np.searchsorted(place, np.arange(0, len(tokens) + step, step))
    for first, (begin, end) in enumerate(zip(cuts[:-1], cuts[1:])):
        block = np.zeros((len(sets), step), np.float32)
        block[owner[begin:end], place[begin:end] - first * step] = 1
        out += block[:len(left)] @ block[len(left):].T
    return out


def _linked(left: list[np.ndarray], right: list[np.ndarray], similar: int) -> np.ndarray:
    common = _common(left, right).astype(np.int64)
    sizes = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None]
    return 100 * common >= similar * (sizes - common)


def _sets(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column]


def _small_cluster(frame: pd.DataFrame, similar: int) -> pd.DataFrame:
    """The components of one cluster by full comparison."""
    v, sets = frame["v"].to_numpy(), _sets(frame["shingles"])
    link = _linked(sets, sets, similar) | (v[:, None] == v[None])
    np.fill_diagonal(link, True)
    label, before = v, None
    while before is None or (label != before).any():
        before = label
        label = np.where(link, label[None], np.iinfo(np.int64).max).min(axis=1)
    return pd.DataFrame({"v": v, "component": label})


def _against_hub(frames, similar: int):
    """Whether each member is linked with its hub, and its shingles that the hub has not."""
    for f in frames:
        sets, hubs = _sets(f["shingles"]), _sets(f["hub_shingles"])
        own = [np.setdiff1d(x, y, assume_unique=True) for x, y in zip(sets, hubs)]
        common = np.array([len(x) - len(o) for x, o in zip(sets, own)], np.int64)
        sizes = np.array([len(x) + len(y) for x, y in zip(sets, hubs)], np.int64)
        yield pd.DataFrame({"cluster": f["cluster"], "a": f["hub"], "b": f["v"],
                            "linked": 100 * common >= similar * (sizes - common), "others": [o.tobytes() for o in own]})


def _grid_cell(frame: pd.DataFrame, similar: int) -> pd.DataFrame:
    """What the links between the asked documents of a cell and its members connect: at most one edge a document."""
    asked, rest = frame[frame["asked"]], frame[~frame["asked"]]
    if asked.empty or rest.empty:
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    link = _linked(_sets(asked["shingles"]), _sets(rest["shingles"]), similar)
    far = np.iinfo(np.int64).max
    left, right, before = asked["v"].to_numpy(), rest["v"].to_numpy(), None
    low_left, low_right = left, right
    while before is None or (low_left != before).any():
        before = low_left
        low_right = np.minimum(low_right, np.where(link, low_left[:, None], far).min(axis=0))
        low_left = np.minimum(low_left, np.where(link, low_right[None], far).min(axis=1))
    return pd.DataFrame({"a": np.concatenate([left, right]), "b": np.concatenate([low_left, low_right])})


def _tokens(batches):
    for batch in batches:
        for cluster, v, raw in zip(*(batch.column(c).to_pylist() for c in ("cluster", "b", "others"))):
            token = pa.array(np.frombuffer(raw, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(token), x)) for x in (cluster, v)] + [token], ["cluster", "v", "token"])


def _large_clusters(members: DataFrame, edges: DataFrame, similar: int) -> DataFrame:
    """Components of the clusters of more than CLUSTER documents, ``members``: ``cluster, v, n, shingles``.

    Every member is compared with the cluster's hub, the document of the most candidates.  Those
    not linked with it are compared with all members, in cells of bounded size, unless too many
    of their shingles are in no other member: a link needs ``|A and B| >= s * (|A| + |B|) /
    (100 + s)`` with ``|B| >= s * |A| / 100`` and no smaller than the smallest member.
    """
    slim = members.select("cluster", "v")
    degrees = (edges.select(F.col("a").alias("v")).unionByName(edges.select(F.col("b").alias("v")))
               .groupBy("v").agg(F.count("*").alias("degree")))
    hubs = (slim.join(degrees, "v").groupBy("cluster")
            .agg(F.max(F.struct("degree", (-F.col("v")).alias("rank"))).alias("hub"),
                 F.countDistinct("v").alias("size")).select("cluster", "size", (-F.col("hub.rank")).alias("hub")))
    hub_sets = hubs.join(members.select(F.col("v").alias("hub"), F.col("shingles").alias("hub_shingles")), "hub")
    star = freeze(members.join(hub_sets.select("cluster", "hub", "hub_shingles"), "cluster")
                  .select("cluster", "hub", "v", "shingles", "hub_shingles")
                  .mapInPandas(lambda frames: _against_hub(frames, similar),
                               "cluster bigint, a bigint, b bigint, linked boolean, others binary"))
    links = star.filter("linked").select("a", "b")
    away = star.filter("NOT linked").select(F.col("b").alias("v"))
    tokens = star.select("cluster", "b", "others").mapInArrow(_tokens, "cluster bigint, v bigint, token bigint")
    own = (tokens.groupBy("cluster", "token").agg(F.count("*").alias("df"), F.min("v").alias("v"))
           .filter("df = 1").groupBy("v").agg(F.count("*").alias("own")))
    least = members.groupBy("cluster").agg(F.min("n").alias("least"))
    need = similar * (F.col("n") + F.greatest("least", F.ceil(F.lit(similar) * F.col("n") / 100))) / (100 + similar)
    asked = freeze(members.join(away, "v").join(least, "cluster").join(own, "v", "left")
                   .filter(F.col("n") - F.coalesce("own", F.lit(0)) >= need).select("cluster", "v", "shingles"))
    counts = asked.groupBy("cluster").agg(F.count("*").alias("n_asked"))
    cells = freeze(hubs.join(counts, "cluster").select(
        "cluster", F.ceil(F.col("n_asked") / CLUSTER).alias("rows"), F.ceil(F.col("size") / CLUSTER).alias("columns")))

    def dealt(docs, own_side, other_side, flag):
        mine = F.pmod(F.xxhash64("v"), F.col(own_side)).alias(own_side[0])
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other_side) - 1)).alias(other_side[0])
        return docs.join(cells, "cluster").select("cluster", "v", "shingles", F.lit(flag).alias("asked"), mine, every)

    cell = dealt(asked, "rows", "columns", True).unionByName(
        dealt(members.select("cluster", "v", "shingles"), "columns", "rows", False))
    more = cell.groupBy("cluster", "r", "c").applyInPandas(
        lambda frame: _grid_cell(frame, similar), "a bigint, b bigint")
    return connected(links.unionByName(more))


def near_duplicates(docs: DataFrame, width: int = WIDTH, similar: int = SIMILAR, text: str = "text",
                    doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    A document's set holds its runs of ``width`` words; a text with fewer words is one run, and a
    text without words has the empty set and is linked with nothing.  Documents of equal sets
    are one class.  Classes that meet in the sorted orders form clusters, in which full sets are
    compared, so every link inside a cluster is found and no other is; two classes of just
    ``similar`` percent fail to meet with a probability of about one in a million.
    ``component_id`` is the smallest id that links lead to, and ``kept`` marks that document.
    Rows that repeat an id are one document, so their components are one; rows without an id
    are compared with nothing, have no component and are kept.  Other columns are not read; an
    empty table gives an empty table.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketches = freeze(source.mapInArrow(
        lambda batches: _sketched(batches, width),
        "doc_id bigint, n bigint, k1 bigint, k2 bigint, hi array<bigint>, lo array<bigint>"))
    real = sketches.filter("doc_id IS NOT NULL AND n > 0")
    classes = freeze(real.groupBy("n", "k1", "k2").agg(F.min(F.struct("doc_id", "hi", "lo")).alias("r"))
                     .select("n", "k1", "k2", F.col("r.doc_id").alias("v"), "r.hi", "r.lo"))
    edges = freeze(forest_pairs(classes))
    clusters = freeze(connected(edges).withColumnRenamed("component", "cluster"))
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("size"))
    # texts are dealt out, not sorted; whether the other side is small must not change the plan
    wanted = clusters.join(sizes, "cluster").hint("shuffle_hash")
    members = freeze(source.join(wanted, source["doc_id"] == wanted["v"]).select("cluster", "size", "v", "text")
                     .mapInArrow(lambda batches: _with_sets(batches, width),
                                 "cluster bigint, size bigint, v bigint, n bigint, shingles binary"))
    found = members.filter(F.col("size") <= CLUSTER).groupBy("cluster").applyInPandas(
        lambda frame: _small_cluster(frame, similar), "v bigint, component bigint")
    large = members.filter(F.col("size") > CLUSTER)
    if not large.isEmpty():
        found = found.unionByName(_large_clusters(large.drop("size"), edges, similar))
    # equal ids of several sets are one document
    found = freeze(found.groupBy("v").agg(F.min("component").alias("component")))
    of_class = classes.select("n", "k1", "k2", "v").join(found, "v", "left").select(
        "n", "k1", "k2", F.coalesce("component", "v").alias("component"))
    return (sketches.select("doc_id", "n", "k1", "k2").join(of_class, ["n", "k1", "k2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))))


def _with_sets(batches, width: int):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            sets = list(shingle_sets(rows.column("text").to_pylist(), width))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in ("cluster", "size", "v")), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["cluster", "size", "v", "n", "shingles"])


def op1_minhash_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), width=4)
