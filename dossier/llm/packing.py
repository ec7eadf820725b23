"""Concatenate and cut: documents end to end as tokens, cut into sequences of fixed length."""
from __future__ import annotations

import re
import unicodedata
from array import array
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dossier.checkpoints import freeze
from dossier.llm.tables import table

SEQUENCE_TOKENS, END_ID = 2048, 1
#: Words a task remembers, and as many of those before them.
CACHE_WORDS = 150_000
#: Bytes of text whose chunks are looked up together, and chunks whose ids are laid out in one go.
TEXT_BYTES, BLOCK_CHUNKS = 16 << 20, 1 << 20
#: What is one token sequence of its own wherever it follows letters.
PUNCTUATION = ".,;:!?#$%&*()+=/-"
_MARKS = re.escape(PUNCTUATION)
_SIMPLE, _PARTS = re.compile(f"[A-Za-z0-9{_MARKS}]+"), re.compile(f"[a-z]+|[0-9]|[{_MARKS}]+")
#: Sequences handed on at once, those of one document apart.
BATCH_SEQUENCES = 256
#: Rows of per-partition totals (16 bytes each) up to which they are broadcast.
BROADCAST_TOTALS = 500_000


def _byte_characters() -> dict[int, str]:
    """How byte-level vocabularies spell bytes: printable Latin-1 as it is, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordTokenizer:
    """Ids of texts by a byte-level tokenizer that lowers case and drops white space.

    No token spans white space, so a text's ids are those of its chunks between ASCII white
    space, and each chunk is tokenized once and remembered.  A chunk of letters and
    PUNCTUATION behind them needs the tokenizer's vocabulary only; all others pass through the
    whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        n = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if n <= 1 << 16 else "<u4")
        self.code = "HI"[self.kind.itemsize == 4]
        self.characters = _byte_characters()
        self.forget()

    def _whole(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, self.kind).tobytes()

    def _word(self, low: str) -> bytes:
        """Ids of a lower-case word of letters, of a digit or of a run of punctuation."""
        found = self.older.get(low)
        if found is None:
            spelt = low if low.isascii() else low.encode().decode("latin-1").translate(self.characters)
            found = array(self.code, [t.id for t in self.tokenizer.model.tokenize(spelt)]).tobytes()
        return found

    def _chunk(self, chunk: str) -> bytes:
        if _SIMPLE.fullmatch(chunk):
            return b"".join(map(self.known.__getitem__, _PARTS.findall(chunk.lower())))
        if not chunk.isascii():
            core = chunk.rstrip(PUNCTUATION)
            low = unicodedata.normalize("NFC", core).lower()
            # capital sigma is lowered by its neighbours in Python only
            if core.isalpha() and low.isalpha() and "\u03a3" not in core:
                tail = chunk[len(core):]
                return self.known[low] + self.known[tail] if tail else self.known[low]
        return self._whole(chunk)

    def forget(self) -> None:
        """Let go of the remembered words, as a worker may do other work next."""
        self.older: dict[str, bytes] = {}
        self.known = _Known(self._word)

    def ids(self, texts: pa.Array, end_id: int) -> tuple[pa.LargeBinaryArray, np.ndarray]:
        """Little-endian ids of each text with ``end_id`` behind them, and how many there are.

        Equal chunks of the texts are found by Arrow, so each is looked up once; their ids are laid
        out by position, a bounded number of chunks at a time.
        """
        if len(self.known) > CACHE_WORDS:
            self.older = dict(self.known)
            self.known = _Known(self._word)
        split = pc.ascii_split_whitespace(texts)
        chunks = split.flatten().dictionary_encode()
        found = [*map(self._chunk, chunks.dictionary.to_pylist()), np.array([end_id], self.kind).tobytes()]
        pool = np.frombuffer(b"".join(found), self.kind)
        length = np.array([len(f) for f in found], np.int64) // self.kind.itemsize
        first = np.cumsum(length) - length
        size = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.insert(chunks.indices.to_numpy(zero_copy_only=False), np.cumsum(size), len(found) - 1)
        n = np.add.reduceat(length[at], np.cumsum(size + 1) - size - 1) if len(at) else np.zeros(0, np.int64)
        out, done = np.empty(int(n.sum()), self.kind), 0
        for begin in range(0, len(at), BLOCK_CHUNKS):
            some = at[begin:begin + BLOCK_CHUNKS]
            lengths = length[some]
            stop = np.cumsum(lengths)
            total = int(lengths.sum())
            out[done:done + total] = pool[np.arange(total) + np.repeat(first[some] - (stop - lengths), lengths)]
            done += total
        offsets = np.concatenate([[0], np.cumsum(n)]) * self.kind.itemsize
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(n), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)]), n


class _Known(dict):
    """What is looked up for the first time is asked for and remembered."""

    def __init__(self, ask):
        self.ask = ask

    def __missing__(self, chunk):
        found = self[chunk] = self.ask(chunk)
        return found


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    """One per Python worker."""
    return WordTokenizer(path)


def _shares(texts: pa.Array, most: int):
    """Slices of ``texts`` of about ``most`` bytes, or of one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, stop - at
        at = stop


def _tokenized(batches, path: str, end_id: int):
    words, start, part = tokenizer(path), 0, TaskContext.get().partitionId()
    try:
        for batch in batches:
            for at, rows in _shares(batch.column("text"), TEXT_BYTES):
                ids, n = words.ids(batch.column("text").slice(at, rows), end_id)
                before = start + np.cumsum(n) - n
                start += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, rows), ids.cast(pa.binary()), pa.array(n), pa.array(before),
                     pa.array(np.full(len(n), part))], ["doc_id", "ids", "n", "before", "part"])
    finally:
        words.forget()


def positions(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, text: str = "text",
              doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, ids, n, at``: every document's ids, and how many ids of others come before.

    The first pass writes each partition's ids with a running total; the second adds the prefix
    sum of the partitions' totals, one row a partition.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    found = freeze(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        lambda batches: _tokenized(batches, tokenizer_path, end_id),
        f"doc_id {kind}, ids binary, n bigint, before bigint, part bigint"))
    totals = found.groupBy("part").agg(F.sum("n").alias("total"))
    bases = freeze(totals.select("part", (F.sum("total").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("total")).alias("base")))
    small = bases.count() <= BROADCAST_TOTALS
    return found.join(F.broadcast(bases) if small else bases, "part").select(
        "doc_id", "ids", "n", (F.col("base") + F.col("before")).alias("at"))


def _width(ids: bytes, n: int) -> str:
    return "<u2" if len(ids) == 2 * n else "<u4"


def _windows(batches, size: int):
    """Whole sequences of one contiguous stretch of rows, and boundary records for the others.

    Each record lists the pieces that lie in it, in order.
    """
    held, length, at, docs = [], 0, None, deque()

    def cut(final: bool):
        nonlocal held, length, at
        ids, done = np.concatenate(held) if held else np.zeros(0, "<u4"), 0
        while done < len(ids):
            sequence, offset = divmod(at, size)
            n = min(size - offset, len(ids) - done)
            if offset + n < size and not final:
                break
            yield sequence, offset, ids[done:done + n].tobytes(), n == size, pieces(at, at + n)
            done, at = done + n, at + n
        held, length = [ids[done:]], len(ids) - done

    def pieces(begin: int, end: int):
        found = []
        while docs and docs[0][2] < end:
            doc_id, n, first = docs[0]
            start, stop = max(begin, first), min(end, first + n)
            found.append((doc_id, start - first, stop - start, n, start % size))
            if first + n > end:
                break
            docs.popleft()
        return found

    def batch_of(rows, kind):
        seq, off, ids, whole, parts = zip(*rows)
        columns = list(zip(*(p for ps in parts for p in ps)))
        ends = np.cumsum([0] + [len(ps) for ps in parts])
        of = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, [kind] + [pa.int64()] * 4)],
                                        ["doc_id", "start", "length", "doc_tokens", "offset"])
        return pa.RecordBatch.from_arrays(
            [pa.array(seq, pa.int64()), pa.array(off, pa.int64()), pa.array(ids, pa.binary()), pa.array(whole),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), of)],
            ["sequence_id", "offset", "ids", "whole", "pieces"])
    kind = None
    for batch in batches:
        rows, kind = [], batch.schema.field("doc_id").type
        for doc_id, ids, n, begin in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "n", "at"))):
            if at is None or begin != at + length:
                rows += cut(True)
                at = begin
            held.append(np.frombuffer(ids, _width(ids, n)).astype("<u4"))
            docs.append((doc_id, n, begin))
            length += n
            if length >= size:
                rows += cut(False)
            if len(rows) >= BATCH_SEQUENCES:
                yield batch_of(rows, kind)
                rows = []
        if rows:
            yield batch_of(rows, kind)
    if rows := list(cut(True)):
        yield batch_of(rows, kind)


def _written(docs: DataFrame, tokenizer_path: str, size: int, end_id: int, text: str, doc_id: str) -> DataFrame:
    """``sequence_id, ids, pieces`` of every sequence, cut from the documents' ids and written.

    Sequences inside a partition are cut where they are; only the boundary records between
    partitions, one sequence each, are shuffled together.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    cut = freeze(positions(docs, tokenizer_path, end_id, text, doc_id).mapInArrow(
        lambda batches: _windows(batches, size),
        "sequence_id bigint, offset bigint, ids binary, whole boolean, pieces array<struct<"
        f"doc_id: {kind}, start: bigint, length: bigint, doc_tokens: bigint, offset: bigint>>"))
    rest = (cut.filter("NOT whole").groupBy("sequence_id")
            .agg(F.array_sort(F.collect_list(F.struct("offset", "ids", "pieces"))).alias("parts"))
            .select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
                    F.flatten("parts.pieces").alias("pieces")))
    return cut.filter("whole").select("sequence_id", "ids", "pieces").unionByName(rest)


def sequences(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE_TOKENS, end_id: int = END_ID,
              text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``sequence_id, ids`` (little-endian 32-bit) of every sequence; the last may be shorter."""
    return _written(docs, tokenizer_path, size, end_id, text, doc_id).select("sequence_id", "ids")


def pack(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE_TOKENS, end_id: int = END_ID,
         with_ids: bool = False, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The pieces of all documents, each within one written sequence of ``size`` ids.

    Only the last sequence has room left, so padding is less than ``size`` ids in all.  A null or
    empty text is its end id alone.  Every row is packed, repeated ids and null ids too; an empty
    table has no pieces.  Other columns are not read.  Returns ``doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset`` and, with ``with_ids``, the piece's ids as
    little-endian 32-bit numbers; checksums and ids are those of the sequence at that place.
    """
    pieces = (_written(docs, tokenizer_path, size, end_id, text, doc_id)
              .select("sequence_id", "ids", F.explode("pieces").alias("p"))
              .select("sequence_id", "p.*", F.expr(
                  "substring(ids, cast(4 * p.offset + 1 AS int), cast(4 * p.length AS int))").alias("ids")))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", *(["ids"] if with_ids else []))


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op7_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), default_tokenizer())
