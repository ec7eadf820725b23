"""Repeated lines, found in one sorted pass over line hashes and removed by bitmaps."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from dossier.checkpoints import freeze
from dossier.llm.tables import ascii_lower, ascii_strip, table

#: A line goes when its key has at least so many code points and is found in so many documents.
MIN_CHARS, MIN_DOCS = 1, 10


def line_key(line: Column) -> Column:
    return ascii_lower(ascii_strip(line))


def lines_of(text: Column) -> Column:
    """Split at line feeds only; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _identity(doc_id: Column, text: Column) -> list[Column]:
    """128 bits that name a document.  Rows that repeat id and text are one document."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(doc_id, text).alias("d1"), F.xxhash64(F.lit(7), doc_id, text).alias("d2")]


def _marked(batches, min_docs: int, keep_first: bool):
    """Of rows sorted by hash, document and position, those whose line goes.

    A run of equal hashes is decided as soon as ``min_docs`` documents are seen, so no more
    documents than that are held.  The first and the last run of a partition may go on in the
    next one: of those, the first row (``decided``), or all rows while they are fewer, are marked
    as boundary rows (``edge``), on which the caller decides.
    """
    schema, held, open_key, first_key = None, None, None, None

    def give(rows: pa.Table, edge: np.ndarray, decided: np.ndarray):
        if rows.num_rows:
            rows = rows.append_column("edge", pa.array(edge)).append_column("decided", pa.array(decided))
            yield from rows.combine_chunks().to_batches()

    for batch in batches:
        schema = batch.schema
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows, held = pa.concat_tables([held, rows]).combine_chunks(), None
        if not rows.num_rows:
            continue
        h1, h2, d1, d2 = (rows.column(c).to_numpy() for c in ("h1", "h2", "d1", "d2"))
        head = np.ones(len(h1), bool)
        head[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new_doc = head.copy()
        new_doc[1:] |= (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])
        starts = np.flatnonzero(head)
        run = np.cumsum(head) - 1
        decided = np.add.reduceat(new_doc.astype(np.int64), starts) >= min_docs
        first_key = first_key or (h1[0], h2[0])
        edge = np.zeros(len(starts), bool)
        edge[0] = (h1[0], h2[0]) == first_key
        if open_key == (h1[0], h2[0]):  # the rest of a run that is already decided
            decided[0], head[0] = True, False
        edge[-1] = True
        if decided[-1]:
            open_key = (h1[-1], h2[-1])
        else:
            open_key, held = None, rows.slice(starts[-1])
            rows = rows.slice(0, starts[-1])
            head, run = head[:starts[-1]], run[:starts[-1]]
        gone = decided[run] & (~head | edge[run] | (not keep_first))
        asked = gone | (edge[run] & ~decided[run])
        is_edge = edge[run] & (head | ~decided[run])
        yield from give(rows.filter(pa.array(asked)), is_edge[asked], decided[run][asked])
    if held is not None:
        n = held.num_rows
        yield from give(held, np.ones(n, bool), np.zeros(n, bool))


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                   keep_first: bool = False, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``d1, d2, pos`` of every line that goes.

    Line hashes are dealt out by range of (hash, document, position), so a line that fills many
    documents spans many partitions, and every partition is streamed once.
    """
    rows = (docs.select(F.col(doc_id).alias("doc_id"), *_identity(F.col(doc_id), F.col(text)),
                        F.posexplode(lines_of(F.col(text))).alias("pos", "line"))
            .withColumn("line", line_key(F.col("line"))).filter(F.length("line") >= min_chars)
            .select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"),
                    "doc_id", "d1", "d2", "pos"))
    order = ["h1", "h2", "doc_id", "d1", "d2", "pos"]
    kind = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    found = freeze(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        lambda batches: _marked(batches, min_docs, keep_first), f"{kind}, edge boolean, decided boolean"))
    edges = found.filter("edge")
    # at most two runs a partition, of fewer than min_docs documents each
    settled = (edges.groupBy("h1", "h2")
               .agg(F.max("decided").alias("any"), F.count_distinct("d1", "d2").alias("n_docs"),
                    F.min(F.struct("doc_id", "d1", "d2", "pos")).alias("first"))
               .filter(F.col("any") | (F.col("n_docs") >= min_docs)).select("h1", "h2", "first"))
    late = edges.join(settled, ["h1", "h2"])
    if keep_first:
        late = late.filter(~F.struct("doc_id", "d1", "d2", "pos").eqNullSafe(F.col("first")))
    return found.filter("NOT edge").select("d1", "d2", "pos").unionByName(late.select("d1", "d2", "pos"))


@F.pandas_udf(ArrayType(LongType()))
def _bitmap(positions):
    """Bit i of word i // 64 is set where line i goes; words behind the last such line are left out."""
    import pandas as pd

    def words(at):
        bits = np.zeros((int(at.max()) // 64 + 1) * 64, np.uint8)
        bits[at] = 1
        return np.packbits(bits, bitorder="little").view("<i8")
    return pd.Series([words(np.asarray(p)) for p in positions])


def line_bitmaps(docs: DataFrame, **options) -> DataFrame:
    """Per document that loses lines: ``d1, d2``, the bitmap ``gone`` and ``n_dropped``."""
    return (repeated_lines(docs, **options).distinct().groupBy("d1", "d2")
            .agg(F.collect_list("pos").alias("at"), F.count("*").alias("n_dropped"))
            .select("d1", "d2", _bitmap("at").alias("gone"), "n_dropped"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                        keep_first: bool = False, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All rows and columns of ``docs``, with shorter texts and ``n_lines, n_dropped`` beside them.

    A line's key is the line without white space at its ends and with A-Z as a-z.  Keys of at
    least ``min_chars`` code points in at least ``min_docs`` documents lose all their lines, or,
    with ``keep_first``, all but the first by document id and position.  The other lines stay,
    joined by line feeds.  A null text is one empty line and becomes the empty text; a text that
    loses all its lines becomes empty and its row stays.  Rows that repeat a document's id and
    text count as one document and get the same result; documents without an id are told apart
    by their texts.  An empty table gives an empty table.  Columns of ``docs`` named like the two
    new ones are replaced.
    """
    d1, d2 = _identity(F.col(doc_id), F.col(text))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")])
    bitmaps = line_bitmaps(docs, min_chars=min_chars, min_docs=min_docs, keep_first=keep_first,
                           text=text, doc_id=doc_id)
    joined = docs.select(whole.alias("row"), d1, d2).join(bitmaps, ["d1", "d2"], "left")
    lines = lines_of(F.col("row")[text])
    stays = F.filter(lines, lambda _, i: F.coalesce(
        F.getbit(F.get("gone", F.floor(i / 64).cast("int")), i % 64).cast("int"), F.lit(0)) == 0)
    kept = F.when(F.col("gone").isNull(), F.coalesce(F.col("row")[text], F.lit(""))).otherwise(
        F.array_join(stays, "\n"))
    return joined.select(*[kept.alias(c) if c == text else F.col("row")[c].alias(c)
                           for c in docs.columns if c not in ("n_lines", "n_dropped")],
                         F.size(lines).cast("long").alias("n_lines"),
                         F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"))


def op2_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_lines(docs).select("doc_id", "n_lines", "n_dropped",
                                            F.sha2("text", 256).alias("kept_sha256"))


SQL = rf"""WITH lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
gone AS (SELECT k FROM keyed WHERE length(k) >= {MIN_CHARS} GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS})
SELECT doc_id, count(*) AS n_lines, count(gone.k) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (gone.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN gone ON keyed.k = gone.k GROUP BY doc_id"""
