"""Benchmark leaks: every passage is searched in a BM25 index of the test items, then compared."""
from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.checkpoints import freeze
from dossier.llm.tables import table
from dossier.llm.wordsets import shingles, words

#: Passages are windows of two strides.  Items are indexed in segments of a stride at most, so
#: every segment that a text holds lies in one of its passages.
STRIDE = 64
#: A passage hits a segment when its score is at least this share of the segment's own.
SCORE = 0.5
#: Shares of the question's shingles, and of the answer's words, that the passage must hold.
SHINGLE, QUESTION, ANSWER = 5, 0.8, 0.8
#: Constants of BM25.
K1, B = 1.2, 0.75
#: Segments of an index block, whose highest scores bound what its segments can reach.
BLOCK = 8
#: Items whose index is held at once, and texts searched at once, in bytes.
ITEMS, TEXT_BYTES = 5000, 1 << 20


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item that has one text: the last sentence is the answer."""
    parts = re.split(r"(?<=[.!?])\s+", text.strip())
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, text)


@dataclass
class Index:
    """Impacts of the terms of all segments, as shares of each segment's own score."""

    items: list  # ids
    question: list[np.ndarray]  # shingles
    answer: list[np.ndarray]  # words
    widths: np.ndarray  # of the question's shingles
    lengths: np.ndarray  # words
    terms: np.ndarray  # sorted hashes
    segment_item: np.ndarray
    cell: np.ndarray  # sorted term * blocks + block, a row for each segment
    segment: np.ndarray  # of each row
    impact: np.ndarray
    rest: np.ndarray  # per block, the most that frequent terms can add
    first: np.ndarray  # per term, where its block postings begin; none for frequent terms
    post_block: np.ndarray
    post_impact: np.ndarray


@dataclass
class Corpus:
    """What BM25 counts over all items, whichever of them an index holds."""

    segments: int
    words: int
    terms: np.ndarray  # sorted hashes
    held: np.ndarray  # segments that hold each term


def _split_words(items: list[tuple[str, str]]) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Words of the questions, of the answers, and of whole items."""
    q = list(words([x[0].lower() for x in items], punctuation=False))
    a = list(words([x[1].lower() for x in items], punctuation=False))
    return q, a, [np.concatenate([x, y]) if raw[0] != raw[1] else x for x, y, raw in zip(q, a, items)]


def build_index(items: list[tuple[object, str, str]], corpus: Corpus | None = None) -> Index | None:
    """Index ``(id, question, answer)``; items without words are left out.

    ``corpus`` counts the items of all indexes; without it these are all.  An item of fewer than
    SHINGLE words has its whole word sequence as its one shingle.
    """
    q, a, whole = _split_words([x[1:] for x in items])
    keep = [i for i, w in enumerate(whole) if len(w)]
    asked = [w if len(w) < SHINGLE else x for x, w in zip(q, whole)]
    if not keep:
        return None
    segments = [(k, part) for k, i in enumerate(keep) for part in _segments(whole[i])]
    terms, place = np.unique(np.concatenate([p for _, p in segments]), return_inverse=True)
    owner = np.repeat(np.arange(len(segments)), [len(p) for _, p in segments])
    cell, tf = np.unique(owner * len(terms) + place, return_counts=True)
    segment, term = cell // len(terms), cell % len(terms)
    size = np.bincount(owner, minlength=len(segments))
    df = np.bincount(term, minlength=len(terms))
    if corpus is None:
        corpus = Corpus(len(segments), int(size.sum()), terms, df)
    held = corpus.held[np.searchsorted(corpus.terms, terms)]
    idf = np.log(1 + (corpus.segments - held + 0.5) / (held + 0.5))
    impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[segment] * corpus.segments / corpus.words))
    impact = impact / np.bincount(segment, impact)[segment]
    # frequent terms are looked up only where rarer ones have found half of what is needed
    frequent, added = np.zeros(len(terms), bool), np.zeros(len(segments))
    by_term = np.argsort(term, kind="stable")
    cuts = np.searchsorted(term[by_term], np.arange(len(terms) + 1))
    for t in np.argsort(-df, kind="stable"):
        at = by_term[cuts[t]:cuts[t + 1]]
        if df[t] < 2 or (added[segment[at]] + impact[at]).max() > SCORE / 2:
            break
        added[segment[at]] += impact[at]
        frequent[t] = True
    block = segment // BLOCK
    n_blocks = int(block.max()) + 1
    rest = np.zeros(n_blocks)
    np.maximum.at(rest, np.arange(len(segments)) // BLOCK, added)
    cells = term * n_blocks + block
    order = np.argsort(cells, kind="stable")
    rare = ~frequent[term]
    pair, back = np.unique(cells[rare], return_inverse=True)
    high = np.zeros(len(pair))
    np.maximum.at(high, back, impact[rare])
    return Index([items[i][0] for i in keep], [np.unique(shingles(asked[i], SHINGLE)) for i in keep],
                 [np.unique(a[i]) for i in keep], np.array([max(1, min(SHINGLE, len(asked[i]))) for i in keep]),
                 np.array([len(whole[i]) for i in keep]), terms,
                 np.array([k for k, _ in segments]),
                 cells[order], segment[order], impact[order], rest,
                 np.searchsorted(pair // n_blocks, np.arange(len(terms) + 1)), pair % n_blocks, high)


def _segments(w: np.ndarray) -> list[np.ndarray]:
    return np.array_split(w, -(-len(w) // STRIDE))


def _hits(index: Index, texts: list[np.ndarray]):
    """(text, item, passage, score) of all passages that reach SCORE, the best passage first."""
    lengths = np.array([len(t) for t in texts])
    strides = -(-lengths // STRIDE)
    first_stride = np.cumsum(strides) - strides
    flat = np.concatenate(texts) if len(texts) else np.zeros(0, np.uint64)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    stride = np.repeat(first_stride, lengths) + place // STRIDE
    at = np.minimum(np.searchsorted(index.terms, flat), len(index.terms) - 1)
    known = index.terms[at] == flat
    # every stride's distinct terms, in order
    cell = np.unique(stride[known] * len(index.terms) + at[known])
    stride, term = cell // len(index.terms), cell % len(index.terms)
    row, post = _expand(index.first[term], index.first[term + 1])
    n_blocks = len(index.rest)
    pair, back = np.unique(stride[row] * n_blocks + index.post_block[post], return_inverse=True)
    bound = np.bincount(back, index.post_impact[post], minlength=len(pair))
    # a passage is a stride and the next one of the same text
    text_of = np.repeat(np.arange(len(texts)), strides)
    before = pair[np.isin(pair // n_blocks, first_stride, invert=True)] - n_blocks
    passages = np.unique(np.concatenate([pair, before]))

    def of(key):
        i = np.minimum(np.searchsorted(pair, key), max(len(pair) - 1, 0))
        return np.where(pair[i] == key, bound[i], 0) if len(pair) else np.zeros(len(key))
    begin = passages // n_blocks
    follows = np.append(text_of, -1)[begin + 1] == text_of[begin] if len(begin) else np.zeros(0, bool)
    bounds = of(passages) + np.where(follows, of(passages + n_blocks), 0) + index.rest[passages % n_blocks]
    asked = passages[bounds >= SCORE]
    begin, block = asked // n_blocks, asked % n_blocks
    follows = np.append(text_of, -1)[begin + 1] == text_of[begin]
    cuts = np.searchsorted(stride, np.arange(len(text_of) + 2))
    row, held = _expand(cuts[begin], cuts[np.where(follows, begin + 2, begin + 1)])
    row, held = np.divmod(np.unique(row * len(index.terms) + term[held]), len(index.terms))
    cell = held * n_blocks + block[row]
    at, post = _expand(np.searchsorted(index.cell, cell), np.searchsorted(index.cell, cell, "right"))
    key, back = np.unique(row[at] * len(index.segment_item) + index.segment[post], return_inverse=True)
    score = np.bincount(back, index.impact[post], minlength=len(key))
    row, segment = np.divmod(key[score >= SCORE], len(index.segment_item))
    text = text_of[begin[row]]
    hits = zip(text, index.segment_item[segment], begin[row] - first_stride[text], score[score >= SCORE])
    return sorted(hits, key=lambda h: (h[0], h[1], -h[3]))


def _expand(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For all ranges, the number of the range and every place in it."""
    n = end - begin
    return (np.repeat(np.arange(len(n)), n),
            np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))


def leaks_of(index: Index, texts: list[str | None]):
    """``(text, item, score, question share, answer share)`` of the verified leaks, one for a text and item."""
    found, size, begin, raws = [], 0, 0, []
    for k, text in enumerate(texts):
        raws.append((text or "").lower())
        size += len(raws[-1])
        if size >= TEXT_BYTES or k == len(texts) - 1:
            split = list(words(raws, punctuation=False))
            done = set()
            for t, item, passage, score in _hits(index, split):
                if (t, item) in done:
                    continue
                room = int(index.lengths[item])
                w = split[t][max(0, passage * STRIDE - room):(passage + 2) * STRIDE + room]
                q = np.isin(index.question[item], shingles(w, int(index.widths[item]))).mean() if len(index.question[item]) else 1.0
                a = np.isin(index.answer[item], w).mean() if len(index.answer[item]) else 1.0
                if q >= QUESTION and a >= ANSWER:
                    done.add((t, item))
                    found.append((begin + int(t), int(item), float(score), float(q), float(a)))
            begin, raws, size = k + 1, [], 0
    return found


def _counted_items(frames):
    """Question and answer of each item, its segments and words, and in how many segments each term is."""
    for frame in frames:
        if "text" in frame:
            pairs = [split_item(t or "") for t in frame["text"]]
        else:
            pairs = [(q or "", a or "") for q, a in zip(frame["question"], frame["answer"])]
        whole = _split_words(pairs)[2]
        parts = [_segments(w) if len(w) else [] for w in whole]
        held = [np.unique(np.concatenate([np.unique(p) for p in x] or [np.zeros(0, np.uint64)]), return_counts=True)
                for x in parts]
        yield pd.DataFrame({"item_id": frame["item_id"], "block": frame["block"],
                            "question": [q for q, _ in pairs], "answer": [a for _, a in pairs],
                            "segments": [len(x) for x in parts], "words": [len(w) for w in whole],
                            "terms": [t.view(np.int64) for t, _ in held], "held": [n for _, n in held]})


def _item_blocks(benchmark: DataFrame, most: int):
    """Indexes of ``most`` items or fewer each, all with the counts of the whole benchmark.

    One block of items, and the terms they hold, is on the driver at a time.
    """
    given = ["question", "answer"] if {"question", "answer"} <= set(benchmark.columns) else ["text"]
    whole = benchmark.filter("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), *given)
    total = whole.count()
    blocks = -(-2 * total // most) if total > most else 1
    items = freeze(whole.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")).mapInPandas(
        _counted_items, "item_id string, block int, question string, answer string, segments bigint, words bigint, "
                        "terms array<bigint>, held array<bigint>"))
    cells = items.select("block", F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("held").alias("held"))))
    cells = cells.toDF("block", "term", "held")
    terms = freeze(cells.groupBy("term").agg(F.sum("held").alias("held")))
    segments, n_words = items.agg(F.sum("segments"), F.sum("words")).first()
    for k in range(blocks):
        part = items.filter(F.col("block") == k)
        rows = part.select("item_id", "question", "answer").orderBy("item_id", "question", "answer").collect()
        of = terms.join(cells.filter(F.col("block") == k).select("term"), "term", "left_semi").toPandas()
        own = of["term"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(own)
        index = build_index([tuple(r) for r in rows], Corpus(
            segments or 0, n_words or 0, own[order], of["held"].to_numpy(np.int64)[order]))
        if index is not None:
            yield index


def find_leaks(docs: DataFrame, benchmark: DataFrame, most: int = ITEMS) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap`` of every leak.

    Every passage of every whole text is a query.  An item leaks into a document when a passage
    reaches the BM25 threshold of one of its segments, and the passage with its surroundings
    holds QUESTION of the question's word shingles and ANSWER of the answer's words.  Items are
    ``text``, whose last sentence is taken for the answer, or ``question, answer``.  Words are
    compared in lower case, without ASCII punctuation.  Of an item of fewer than SHINGLE words the
    passage must hold all words in a row.  Null and empty texts hold nothing; items without
    words, or without an id, are not searched for; repeated rows answer alike.  Ids may be of any
    type that casts to text and back.

    A benchmark of more than ``most`` items is searched for in blocks, a pass over the texts each.
    Frequencies and lengths are those of all items, so the blocks change no score.  The leaks of a
    block are written before the next one is indexed, and one index is broadcast at a time.
    """
    kind, item_kind = (df.schema[c].dataType.simpleString() for df, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {kind}, item_id string, score double, question_overlap double, answer_overlap double"
    out = docs.sparkSession.createDataFrame([], schema)
    for index in _item_blocks(benchmark, most):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def search(batches, shared=shared):
            for batch in batches:
                found = leaks_of(shared.value, batch.column("text").to_pylist())
                text, item, *rest = (list(x) for x in zip(*found)) if found else ([], [], [], [], [])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(text, pa.int64())),
                     pa.array([shared.value.items[i] for i in item], pa.string()), *[pa.array(x, pa.float64()) for x in rest]],
                    ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])
        out = out.unionByName(freeze(docs.select("doc_id", "text").mapInArrow(search, schema)))
        shared.unpersist()
    return out.withColumn("item_id", F.col("item_id").cast(item_kind))


def without_leaks(docs: DataFrame, benchmark: DataFrame, most: int = ITEMS) -> DataFrame:
    """The rows of ``docs``, with all their columns, into which no item leaks; nothing is shuffled.

    What leaks, null and empty texts, repeated rows and awkward items are as in :func:`find_leaks`;
    rows that repeat an id are judged each by its own text.  The blocks of a large benchmark are
    passed one after the other, and their indexes are broadcast until the result is read.
    """
    for index in _item_blocks(benchmark, most):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def clean(batches, shared=shared):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[x[0] for x in leaks_of(shared.value, batch.column("text").to_pylist())]] = False
                yield batch.filter(pa.array(keep))
        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def op10_decontamination(spark, sf_dir):
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
