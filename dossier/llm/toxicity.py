"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.checkpoints import freeze
from dossier.llm.sampling import bounded_sample
from dossier.llm.tables import held_out, table
from dossier.llm.wordsets import mix

#: Lengths of the n-grams, and bits of their hash.
LENGTHS, BITS = (3, 4, 5, 6), 18
#: Labelled documents of each class that are learned from, at most.
PER_CLASS = 4000
#: n-grams that get a weight: those whose ratio says most.
WEIGHTED = 16384
#: Steps, their size, and the penalty on squared weights.
STEPS, RATE, PENALTY = 250, 0.05, 3e-4
#: n-grams count per so many of the text's.
SCALE = 1000.0
#: Cells, one of a text and n-gram, that a step looks at in one go.
BLOCK_CELLS = 1 << 20
#: Code points hashed in one go.
BLOCK_CHARS = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _grams(text: str):
    """Hashes of all n-grams of ``text``, an array for each length and block of the text."""
    chars = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    for begin in range(0, len(chars), BLOCK_CHARS):
        # a block owns the n-grams that begin in it
        block = mix(chars[begin:begin + BLOCK_CHARS + max(LENGTHS) - 1].astype(np.uint64) * _BASE + np.uint64(1))
        hashes = block
        for n in range(2, max(LENGTHS) + 1):
            if len(block) < n:
                break
            hashes = hashes[:len(block) - n + 1] * _BASE + block[n - 1:]
            if n in LENGTHS:
                yield (mix(hashes[:BLOCK_CHARS] + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass
class ToxicityModel:
    """``weights`` by n-gram, already scaled by the ratios, and the ``bias``."""

    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        total, n = 0.0, 0
        for grams in _grams(text or ""):
            total += float(self.weights[grams].sum(dtype=np.float64))
            n += len(grams)
        return float(1 / (1 + np.exp(-np.clip(self.bias + SCALE * total / max(n, 1), -40, 40))))


def _counted(frames):
    """Distinct n-grams of each text with their counts, a few texts at a time."""
    for frame in frames:
        for at in range(0, len(frame), 32):
            part = frame.iloc[at:at + 32]
            rows = []
            for text in part["text"]:
                grams = list(_grams(text or ""))
                rows.append(np.unique(np.concatenate(grams or [np.zeros(0, np.int32)]), return_counts=True))
            yield pd.DataFrame({"row": part["row"].to_numpy(), "label": part["label"].to_numpy(),
                                "weight": part["weight"].to_numpy(),
                                "total": [int(n.sum()) for _, n in rows], "grams": [g for g, _ in rows],
                                "n": [n.astype(np.int32) for _, n in rows]})


def fit(labelled: DataFrame) -> ToxicityModel | None:
    """Learn from a bounded sample ``doc_id, text, label, weight``; None unless both labels are there.

    ``weight`` is how many labelled documents a row stands for.  Sparse counts of the sample are
    written once; Spark sums them by class, the weighted ones are fitted in one task, and only
    sums and weights of n-grams come to the driver.
    """
    texts = labelled.select(F.monotonically_increasing_id().alias("row"), F.col("label").cast("int"), "weight", "text")
    counted = freeze(texts.mapInPandas(
        _counted, "row bigint, label int, weight double, total bigint, grams array<int>, n array<int>"))
    n_docs = {r["label"]: r["count"] for r in counted.groupBy("label").count().collect()}
    if set(n_docs) != {0, 1}:
        return None
    by_gram = (counted.select("label", F.explode("grams").alias("gram")).groupBy("gram")
               .agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")).toPandas())
    seen = np.ones((2, 1 << BITS))
    seen[1, by_gram["gram"]] += by_gram["pos"]
    seen[0, by_gram["gram"]] += by_gram["neg"]
    ratio = np.log(seen[1] / (n_docs[1] + 2)) - np.log(seen[0] / (n_docs[0] + 2))
    said = np.abs(ratio) * np.sqrt(np.minimum(seen.sum(axis=0), 200))
    chosen = np.sort(np.argsort(-said, kind="stable")[:WEIGHTED])
    place = np.full(1 << BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    shared = counted.sparkSession.sparkContext.broadcast((place, ratio[chosen].astype(np.float32)))
    rows = freeze(counted.mapInArrow(
        lambda batches: _weighted(batches, shared), "label int, weight double, cells int, places binary, values binary"))
    n, cells, share = rows.agg(F.count("*"), F.sum("cells"), F.sum("weight")).first()
    # the sample is bounded, and so are its weighted cells: one row a text, fitted where all texts are
    fitted = (rows.coalesce(1).mapInArrow(lambda batches: _fitted(batches, n, cells, share, len(chosen)),
                                          "place int, weight double").toPandas().sort_values("place"))
    weights = fitted["weight"].to_numpy()
    out = np.zeros(1 << BITS, np.float32)
    out[chosen] = weights[1:] * ratio[chosen]
    return ToxicityModel(out, float(weights[0]))


def _weighted(batches, shared):
    """One row a text: places and scaled values of those of its n-grams that get a weight."""
    place, ratio = shared.value
    for batch in batches:
        at, grams, counts = batch.column("grams"), batch.column("grams").flatten(), batch.column("n").flatten()
        size = pc.list_value_length(at).to_numpy()
        found = place[grams.to_numpy()]
        value = counts.to_numpy() / np.repeat(np.maximum(batch.column("total").to_numpy(), 1), size)
        known = found >= 0
        cells = np.diff(np.concatenate([[0], np.cumsum(known)])[np.concatenate([[0], np.cumsum(size)])])
        places = found[known]
        values = (SCALE * value[known] * ratio[places]).astype("<f4")
        ends = pa.py_buffer(np.concatenate([[0], 4 * np.cumsum(cells)]).astype(np.int32))
        raw = [pa.BinaryArray.from_buffers(pa.binary(), len(cells), [None, ends, pa.py_buffer(x)])
               for x in (places.astype("<i4"), values)]
        yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("weight"), pa.array(cells, pa.int32()), *raw],
                                         ["label", "weight", "cells", "places", "values"])


def _fitted(batches, n: int, cells: int, share: float, width: int):
    """The bias, at place -1, and the weight of every n-gram."""
    places, values = np.empty(cells, np.int32), np.empty(cells, np.float32)
    ends, label, weight, row, at = np.zeros(n + 1, np.int64), np.empty(n), np.empty(n), 0, 0
    for batch in batches:
        for own, of, raw, value in zip(*(batch.column(c).to_pylist() for c in ("label", "weight", "places", "values"))):
            size = len(raw) // 4
            places[at:at + size] = np.frombuffer(raw, "<i4")
            values[at:at + size] = np.frombuffer(value, "<f4")
            label[row], weight[row] = own, of
            row, at = row + 1, at + size
            ends[row] = at
    weights, bias = _descend(ends, places, values, label, weight / share, width)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, width), pa.int32()), pa.array(np.append(bias, weights))],
                                     ["place", "weight"])


def _blocks(ends: np.ndarray):
    """Ranges of texts of about BLOCK_CELLS cells, and of their cells."""
    at = 0
    while at < len(ends) - 1:
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + BLOCK_CELLS, side="right")) - 1)
        yield slice(at, stop), slice(int(ends[at]), int(ends[stop]))
        at = stop


def _descend(ends, column, value, label, share, width):
    """Logistic regression by gradient steps with running moments, over a bounded part of the cells at a time."""
    blocks = [(texts, cells, np.repeat(np.arange(texts.stop - texts.start), np.diff(ends[texts.start:texts.stop + 1])))
              for texts, cells in _blocks(ends)]
    w, first, second = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        g = np.append(PENALTY * w[:-1], 0.0)
        for texts, cells, row in blocks:
            z = np.bincount(row, value[cells] * w[column[cells]], minlength=texts.stop - texts.start) + w[-1]
            slope = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label[texts]) * share[texts]
            g[:-1] += np.bincount(column[cells], value[cells] * slope[row], minlength=width)
            g[-1] += slope.sum()
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w = w - RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return w[:-1], w[-1]


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id, text, label, weight`` of a bounded sample of the labelled documents that are not held out.

    A document labelled twice counts as toxic if one label says so; labels other than 0 and 1 are
    left out.  The sample is drawn from the labels, so only its ids, 2 * per_class at most, are
    broadcast.
    """
    known = (labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("label")))
    sample = bounded_sample(known, "label", per_class).withColumn("weight", F.lit(1.0))
    for value, n in known.groupBy("label").count().collect():
        sample = sample.withColumn("weight", F.when(F.col("label") == value, max(1.0, n / per_class))
                                   .otherwise(F.col("weight")))
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")


def score_toxicity(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """All rows and columns of ``docs`` with ``score`` (0 to 1, higher: likelier toxic).

    Every whole text is scored by the mean weight of its n-grams.  A null or empty text has the
    n-grams of two spaces, that is none, and the score of the bias.  Without a model the score
    is 0.  Repeated rows are scored alike; a column of the same name is replaced.
    """
    if model is None:
        return docs.withColumn("score", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype=float)

    return docs.withColumn("score", score("text"))


def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(training_rows(docs, table(spark, sf_dir, "labels")))
    return score_toxicity(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
