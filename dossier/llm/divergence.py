"""Source divergence audit: which sources of a language use words unlike the others, and which words."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dossier.checkpoints import freeze
from dossier.llm.tables import table

#: Documents of a language that must hold a term, terms listed of a group, and the size of a whole.
MIN_DOCS, TOP_TERMS, WHOLE = 10, 10, 1_000_000_000
#: Bytes of text whose pointers are sorted together; a longer text is sorted in pieces.
SLICE_BYTES = 4 << 20
#: Bytes of a term up to which it is compared eight at a time; longer terms are ranked by their ends.
DEEP = 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of terms: letters of ASCII, and all bytes of characters beyond it.
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True


def _chunk(windows: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes from ``depth`` of every term as a number, zeros behind its end (no term holds a zero)."""
    raw = windows[np.minimum(starts + depth, len(windows) - 1)].view(">u8").ravel().astype(np.uint64)
    spare = np.clip(8 - (lengths - depth), 0, 8).astype(np.uint64)
    mask = np.where(spare == 8, np.uint64(0), np.uint64(0xFFFFFFFFFFFFFFFF) << (np.uint64(8) * np.minimum(spare, 7)))
    return raw & mask


def sorted_terms(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pointers ``starts`` in the order of their terms, and where a run of equal terms begins.

    Multikey quicksort with eight bytes as one character: pointers are sorted by the first eight bytes,
    then every slice of pointers equal so far by the next eight, as long as a slice holds more
    than one pointer and a longer term.  All slices of one depth are sorted together.
    """
    windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)
    key = _chunk(windows, starts, lengths, 0)
    order = np.argsort(key)
    key = key[order]
    begins = np.concatenate([[True], key[1:] != key[:-1]])[:len(order)]
    depth = 8
    while len(order):
        run = np.cumsum(begins) - 1
        open_ = (np.bincount(run) > 1) & (np.bincount(run, lengths[order] > depth) > 0)
        at = np.flatnonzero(open_[run])
        if not len(at):
            break
        those, run = order[at], run[at]
        if depth < DEEP:
            key = _chunk(windows, starts[those], lengths[those], depth)
        else:
            ends = [data[s + depth:s + n].tobytes() for s, n in zip(starts[those], lengths[those])]
            ranks = {end: rank for rank, end in enumerate(sorted(set(ends)))}
            key = np.array([ranks[end] for end in ends], np.uint64)
        within = np.lexsort((key, run))
        order[at], key = those[within], key[within]
        begins[at] |= np.concatenate([[True], (key[1:] != key[:-1]) | (run[1:] != run[:-1])])
        if depth >= DEEP:
            break
        depth += 8
    return order, begins


def _terms_of(data: np.ndarray, ends: np.ndarray, group: np.ndarray):
    """``term, group, n, docs`` of a slice: ``ends`` of its documents in ``data``, and their groups."""
    data = _LOWER[data]
    letter = _LETTER[data]
    first = np.zeros(len(data) + 1, bool)
    first[np.concatenate([[0], ends])] = True  # where a document begins, and the end
    starts = np.flatnonzero(letter & (first[:-1] | ~np.concatenate([[False], letter[:-1]])))
    lengths = np.flatnonzero(letter & (first[1:] | ~np.concatenate([letter[1:], [False]]))) + 1 - starts
    order, begins = sorted_terms(data, starts, lengths)
    run = np.cumsum(begins) - 1
    doc = np.searchsorted(ends, starts[order], side="right")
    # runs of (term, document), then of (term, group)
    each, n = np.unique(run * len(ends) + doc, return_counts=True)
    pair, of = np.unique(each // max(len(ends), 1) * (group.max(initial=0) + 1) + group[each % max(len(ends), 1)],
                         return_inverse=True)
    lead = order[begins]
    size = lengths[lead]
    stop = np.cumsum(size)
    letters = data[np.arange(size.sum()) + np.repeat(starts[lead] - (stop - size), size)]
    terms = pa.LargeStringArray.from_buffers(
        len(lead), pa.py_buffer(np.concatenate([[0], stop]).astype(np.int64).tobytes()), pa.py_buffer(letters.tobytes()))
    term, group = np.divmod(pair, group.max(initial=0) + 1)
    return (terms.take(pa.array(term)), group, np.bincount(of, n, len(pair)).astype(np.int64),
            np.bincount(of, minlength=len(pair)))


def _pieces(data: np.ndarray, most: int):
    """A long text in pieces that cut no term."""
    at = 0
    while at < len(data):
        stop = min(at + most, len(data))
        while stop < len(data) and _LETTER[_LOWER[data[stop]]]:
            stop += 1
        yield data[at:stop]
        at = stop


def _long_text(data: np.ndarray, most: int):
    """As :func:`_terms_of` for one long text; its pieces are one document."""
    found = None
    for piece in _pieces(data, most):
        terms, _, n, _ = _terms_of(piece, np.array([len(piece)]), np.zeros(1, np.int64))
        more = pa.table({"term": terms, "n": n})
        found = more if found is None else pa.concat_tables([found, more]).group_by("term").aggregate(
            [("n", "sum")]).rename_columns(["term", "n"])
    n = found.column("n").to_numpy()
    return found.column("term").combine_chunks(), np.zeros(len(n), np.int64), n, np.ones(len(n), np.int64)


def _slices(ends: np.ndarray, most: int):
    """Ranges of documents of ``most`` bytes together, or of one document."""
    at = 0
    while at < len(ends) - 1:
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
        yield at, stop
        at = stop


def _counted(batches, most: int):
    for batch in batches:
        text = batch.column("text").cast(pa.large_string())
        if not len(text):
            continue
        _, offsets, values = text.buffers()
        ends = np.frombuffer(offsets, np.int64)[text.offset:text.offset + len(text) + 1]
        data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
        lang, source = batch.column("lang").dictionary_encode(), batch.column("source").dictionary_encode()
        n_sources = len(source.dictionary)
        group = lang.indices.to_numpy().astype(np.int64) * n_sources + source.indices.to_numpy()
        for at, stop in _slices(ends, most):
            here = data[ends[at]:ends[stop]]
            names, own = np.unique(group[at:stop], return_inverse=True)
            found = (_long_text(here, most) if len(here) > most
                     else _terms_of(here, ends[at + 1:stop + 1] - ends[at], own.astype(np.int64)))
            name = names[found[1]]
            yield pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(name // n_sources)), source.dictionary.take(pa.array(name % n_sources)),
                 found[0].cast(pa.string()), pa.array(found[2]), pa.array(found[3].astype(np.int64))],
                ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of every term in every group, and the documents that hold it.

    Each task sorts pointers to the word starts of a few megabytes of text at a time; runs of equal terms
    are counted there, and only these counts are shuffled.
    """
    counted = docs.mapInArrow(lambda batches: _counted(batches, slice_bytes),
                              "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column | str, of: Column | str, terms: Column | str) -> Column:
    """``1 + floor(WHOLE * (n + 2) / (of + 2 * terms))``; null without terms.  In decimals, as counts may be large."""
    n, of, terms = (F.col(c).cast("decimal(20,0)") if isinstance(c, str) else c for c in (n, of, terms))
    total = of + terms + terms
    return F.when(total > 0, 1 + F.call_function("div", (n + 2) * F.lit(WHOLE).cast("decimal(10,0)"), total))


def _apart(p: str, q: str) -> Column:
    """``floor((p - q)^2 / (p + q))`` of positive numbers up to WHOLE + 1."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, text: str = "text",
                      lang: str = "lang", source: str = "source", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far every source of a language is from its others.

    Terms are runs of letters (ASCII letters, lower-cased, and all characters beyond ASCII) that at least
    ``min_docs`` documents of the language hold.  A null text, language or source counts as empty; a language
    without such terms has pairs of value 0 and no terms; one with one source has no pairs; an empty
    table gives an empty table.  Repeated rows count as often as they appear; other columns are not read.

    Part ``pair`` has every other source, part ``term`` the ``top_terms`` terms that the source uses more
    than its language.  A pair's sum is put together from what no source uses, what one of both uses and
    what both use, so that only terms of a source are ever looked at and no term is paired with sources
    that lack it.
    """
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(to)
                         for c, to in ((lang, "lang"), (source, "source"), (text, "text"))))
    counts = freeze(term_counts(docs, slice_bytes))
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang")).filter(
        F.col("docs") >= min_docs).drop("docs")
    cells = freeze(counts.drop("docs").join(kept, ["lang", "term"]))
    of_lang = cells.groupBy("lang", "term").agg(F.max("n_lang").alias("n")).groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("n").alias("in_lang"))
    of_group = cells.groupBy("lang", "source").agg(F.sum("n").alias("in_group"))
    groups = freeze(docs.select("lang", "source").distinct()
                    .join(of_lang, "lang", "left").join(of_group, ["lang", "source"], "left")
                    .na.fill(0, ["terms", "in_lang", "in_group"])
                    .withColumn("none", _share(F.lit(0).cast("decimal(20,0)"), "in_group", "terms")))
    used = freeze(cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "none", _share("n", "in_group", "terms").alias("p"),
        _share("n_lang", "in_lang", "terms").alias("q")))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    top = (used.filter("p > q").select("lang", "source", F.col("term").alias("item"), _apart("p", "q").alias("value"))
           .withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top_terms))

    one = groups.select("lang", F.col("source").alias("a"), F.col("none").alias("none_a"), "terms")
    other = groups.select("lang", F.col("source").alias("b"), F.col("none").alias("none_b"))
    neither = one.join(other, "lang").filter("a <> b").select(
        "lang", "a", "b", (F.col("terms") * F.coalesce(_apart("none_a", "none_b"), F.lit(0))).alias("value"))
    alike = used.groupBy("lang", F.col("source").alias("a"), "p", F.col("none").alias("none_a")).agg(
        F.count("*").alias("m"))
    single = freeze(alike.join(other, "lang").filter("a <> b").groupBy("lang", "a", "b").agg(
        F.sum(F.col("m") * (_apart("p", "none_b") - _apart("none_a", "none_b"))).alias("value")))
    x = used.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("p_a"), F.col("none").alias("none_a"))
    y = used.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("p_b"), F.col("none").alias("none_b"))
    both = freeze(x.join(y, ["lang", "term"]).filter("a < b").groupBy("lang", "a", "b").agg(
        F.sum(_apart("p_a", "p_b") - _apart("p_a", "none_b") - _apart("none_a", "p_b") + _apart("none_a", "none_b"))
        .alias("value")))
    turned = [part.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value") for part in (single, both)]
    pairs = (neither.unionByName(single).unionByName(both).unionByName(turned[0]).unionByName(turned[1])
             .groupBy("lang", F.col("a").alias("source"), F.col("b").alias("item")).agg(F.sum("value").alias("value"))
             .withColumn("rank", F.row_number().over(by_value)))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("part", F.lit("pair")).select(*columns)
            .unionByName(top.withColumn("part", F.lit("term")).select(*columns)))


def op12_source_divergence(spark, sf_dir):
    return source_divergence(table(spark, sf_dir, "documents"))


_APART = "(({0} - {1}) * ({0} - {1})) // ({0} + {1})"
SQL = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
t AS MATERIALIZED (SELECT lang, source, term, r, count(*) AS n FROM (SELECT lang, source, r, unnest(terms) AS term FROM d)
    GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term, sum(n) AS n_lang FROM t GROUP BY lang, term HAVING count(*) >= {MIN_DOCS}),
size AS (SELECT lang, count(*) AS v, sum(n_lang) AS in_lang FROM kept GROUP BY lang),
cell AS MATERIALIZED (SELECT lang, source, term, sum(n) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
grp AS MATERIALIZED (SELECT g.lang, g.source, coalesce(c.n, 0) AS in_group
    FROM (SELECT DISTINCT lang, source FROM d) g
    LEFT JOIN (SELECT lang, source, sum(n) AS n FROM cell GROUP BY ALL) c ON c.lang = g.lang AND c.source = g.source),
share AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        CAST(1 + ({WHOLE} * (coalesce(c.n, 0) + 2)) // (g.in_group + 2 * s.v) AS BIGINT) AS p,
        CAST(1 + ({WHOLE} * (k.n_lang + 2)) // (s.in_lang + 2 * s.v) AS BIGINT) AS q
    FROM grp g JOIN kept k ON k.lang = g.lang JOIN size s ON s.lang = g.lang
    LEFT JOIN cell c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
summed AS (SELECT x.lang, x.source, y.source AS item, sum({_APART.format('x.p', 'y.p')}) AS value
    FROM share x JOIN share y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, CAST({_APART.format('p', 'q')} AS BIGINT) FROM share WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
