"""Language by prediction by partial matching: the shortest code over byte context trees."""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.llm.sampling import bounded_sample
from dossier.llm.tables import held_out, table

#: Bytes of the longest context.
ORDER = 3
#: Labelled documents of each language that are learned from, at most.
PER_LANGUAGE = 1000
#: Bytes of text that are coded in one go, for up to 8 languages.
BLOCK_BYTES = 1 << 19
#: Stands before the text, where there is no context yet.
START = b"\n" * ORDER


def _raw(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def _runs(raw: bytes) -> np.ndarray:
    """All runs of ORDER + 1 bytes as numbers, the first byte highest."""
    a = np.frombuffer(raw, np.uint8).astype(np.uint32)
    gram = a[:-ORDER].copy()
    for k in range(1, ORDER + 1):
        gram = (gram << np.uint32(8)) | a[k:len(a) - ORDER + k]
    return gram


@dataclass
class Sparse:
    """Bits by key and language, only where there are any: the rows of a key begin at ``first``."""

    keys: np.ndarray  # sorted
    first: np.ndarray
    lang: np.ndarray
    bits: np.ndarray

    @staticmethod
    def of(cell: np.ndarray, count: int, bits: np.ndarray) -> Sparse:
        """From sorted ``key * count + language``."""
        keys, first = np.unique(cell // count, return_index=True)
        return Sparse(keys, np.append(first, len(cell)), (cell % count).astype(np.int32), bits.astype(np.float32))

    def find(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number of the asked key, language and bits of all rows of ``asked``."""
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == asked)
        begin, n = self.first[at[hit]], np.diff(self.first)[at[hit]]
        rows = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(hit, n), self.lang[rows], self.bits[rows]


@dataclass
class LanguageModel:
    """Code lengths in bits, under frozen counts, of every seen symbol and of the escape.

    For each order, ``symbols`` has the bytes seen after a context (key: both) and ``escapes`` one
    row for a context and language.  Nothing is left out, and no language takes another's room.
    """

    languages: list[str]
    symbols: list[Sparse]
    escapes: list[Sparse]

    def code_lengths(self, texts: list[str | None]) -> np.ndarray:
        """Bits of each text under each language."""
        out = np.zeros((len(texts), len(self.languages)))
        most = max(ORDER + 1, BLOCK_BYTES * 8 // max(8, len(self.languages)))
        block, size = [], 0
        for k, text in enumerate(texts):
            raw = START + _raw(text)
            for at in range(ORDER, max(len(raw), ORDER + 1), most):
                part = raw[at - ORDER:at + most]
                if len(part) > ORDER:
                    block.append((k, part))
                    size += len(part)
                if size >= most:
                    self._add(block, out)
                    block, size = [], 0
        if block:
            self._add(block, out)
        return out

    def _costs(self, gram: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each run after those before it, under each language."""
        costs = np.full((len(gram), len(self.languages)), 8.0)  # order -1 gives each byte 8 bits
        for order in range(ORDER + 1):
            key = gram & ((1 << 8 * (order + 1)) - 1)
            row, lang, bits = self.escapes[order].find(key >> 8)
            costs[row, lang] += bits
            row, lang, bits = self.symbols[order].find(key)
            costs[row, lang] = bits
        return costs.astype(np.float32)

    def _add(self, block, out) -> None:
        gram, at = np.unique(_runs(b"".join(p for _, p in block)), return_inverse=True)
        costs = self._costs(gram.astype(np.int64))[at]
        lengths = np.array([len(p) for _, p in block])
        starts = np.cumsum(lengths) - lengths
        # the bytes between two texts, which are the next one's context, are not coded
        edges = np.ravel(np.column_stack([starts, starts + lengths - ORDER]))[:-1]
        sums = np.add.reduceat(costs, edges, axis=0, dtype=np.float64)[::2]
        np.add.at(out, [k for k, _ in block], sums)


def _grams(frames):
    """Counts of the runs of ORDER + 1 bytes per language."""
    for frame in frames:
        for lang, texts in frame.groupby("lang")["text"]:
            gram, n = np.unique(np.concatenate([_runs(START + _raw(t)) for t in texts]), return_counts=True)
            yield pd.DataFrame({"lang": lang, "gram": gram.astype(np.int64), "n": n})


def fit(labelled: DataFrame) -> LanguageModel | None:
    """Learn from ``text, lang``; None without a labelled text.

    ``labelled`` is a bounded sample, and so is the number of its grams that reach the driver.
    """
    grams = (labelled.mapInPandas(_grams, "lang string, gram bigint, n bigint")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    if grams.empty:
        return None
    languages = sorted(grams["lang"].unique())
    count = len(languages)
    lang = grams["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(np.int64)
    gram, n = grams["gram"].to_numpy(), grams["n"].to_numpy(float)
    symbols, escapes = [], []
    for order in range(ORDER + 1):
        cell, back = np.unique((gram & ((1 << 8 * (order + 1)) - 1)) * count + lang, return_inverse=True)
        seen = np.bincount(back, n)
        node, back = np.unique((cell // count >> 8) * count + cell % count, return_inverse=True)
        kinds = np.bincount(back)
        whole = np.bincount(back, seen) + kinds
        symbols.append(Sparse.of(cell, count, np.log2(whole[back] / seen)))
        escapes.append(Sparse.of(node, count, np.log2(whole / kinds)))
    return LanguageModel(languages, symbols, escapes)


def training_rows(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``text, lang`` of a bounded sample of the documents that are not held out; of rows, not of ids.

    Ids and languages alone are counted; texts are read once, for the rows that are drawn.
    """
    known = docs.select("doc_id", "lang", "text").filter("lang IS NOT NULL AND doc_id IS NOT NULL").filter(
        ~held_out(F.col("doc_id")))
    return bounded_sample(known, "lang", per_language).select("text", "lang")


def identify_languages(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred`` and ``score``.

    The language under which the whole text's code is shortest, and its posterior probability
    for equal priors; of equally short ones the first by name.  A null text, and a text without
    a letter, is ``und`` with score 0; so is every text without a model.  Repeated rows get the
    same answer; columns of the two names are replaced, all others are kept whatever their names.
    """
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        bits = m.code_lengths(list(texts))
        best = bits.argmin(axis=1) if len(bits) else np.zeros(0, int)
        odds = np.exp2(np.clip(bits.min(axis=1, keepdims=True) - bits, -1000, 0)).sum(axis=1)
        return pd.DataFrame({"lang": [m.languages[b] for b in best], "score": 1 / odds})

    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("lang_pred", "score")]
    found = docs.select(F.struct(*docs.columns).alias("row"), has_letter.alias("letters"), guess("text").alias("guess"))
    return found.select(*kept, F.when(F.col("letters"), F.col("guess.lang")).otherwise("und").alias("lang_pred"),
                        F.when(F.col("letters"), F.col("guess.score")).otherwise(0.0).alias("score"))


def op8_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(training_rows(docs))
    return identify_languages(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
