"""Extendible hashing: shards under a byte limit, split bit by bit only where they are too large."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.checkpoints import freeze
from dossier.llm.tables import table

SHARD_BYTES = 64 << 20
#: A limit that tables of a few megabytes pass many times over.
SMALL_SHARD_BYTES = 64 << 10
#: Bits of the hash that one page of the directory tells apart, as hexadecimal digits of 4 bits.
PAGE_DIGITS = 3
PAGE_BITS = 4 * PAGE_DIGITS
#: Digits of the key: the hash of the id, then that of the row's number, which no rows share.
KEY_DIGITS = 63


def _bits(digits: Column) -> Column:
    """The hexadecimal digits of a page as PAGE_BITS binary ones."""
    return F.lpad(F.conv(digits, 16, 2), PAGE_BITS, "0")


def directory_page(rows: DataFrame, page: int, limit: int) -> DataFrame:
    """For every key prefix of ``page + 1`` pages, the shard it points to; null where none is small enough.

    A shard is the shortest run of bits whose rows have at most ``limit`` bytes, or which is one
    row.  Sums of the prefixes of all lengths come from the sums of the longest.
    """
    at = page * PAGE_DIGITS
    leaves = (rows.groupBy(F.substring("key", 1, at + PAGE_DIGITS).alias("prefix"))
              .agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows")))
    paths = leaves.select("prefix", "bytes", "rows", F.explode(F.sequence(F.lit(0), F.lit(PAGE_BITS))).alias("depth"),
                          F.substring("prefix", 1, at).alias("head"),
                          _bits(F.substring("prefix", at + 1, PAGE_DIGITS)).alias("bits"))
    paths = paths.withColumn("bits", F.expr("substring(bits, 1, depth)"))
    buckets = (paths.groupBy("head", "bits").agg(F.sum("bytes").alias("all_bytes"), F.sum("rows").alias("all_rows"))
               .filter((F.col("all_bytes") <= limit) | (F.col("all_rows") == 1)))
    found = (paths.join(buckets, ["head", "bits"]).groupBy("prefix")
             .agg(F.min(F.struct("depth", "bits", "all_bytes")).alias("b")))
    return leaves.join(found, "prefix", "left").select(
        "prefix", F.col("b.bits").alias("bits"), F.col("b.all_bytes").alias("shard_bytes"))


def assign_shards(docs: DataFrame, limit: int = SHARD_BYTES, text: str = "text",
                  doc_id: str = "doc_id") -> DataFrame:
    """The shard of every row: a bit string, the prefix of its hash in the directory.

    Sizes are UTF-8 bytes of the text; a null text has none.  A row larger than the limit gets a
    shard of its own.  The key is a hash of the id, so that shards do not depend on the order of
    rows; rows that share an id, or have none, are told apart by a row number after that.  An
    empty table gives an empty table, and a table under the limit one shard, the empty prefix.
    Returns ``doc_id, shard, shard_bytes, n_bytes``.
    """
    numbered = docs.select(F.col(doc_id).alias("doc_id"),
                           F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"),
                           F.monotonically_increasing_id().alias("row"))
    slim = freeze(numbered.select("doc_id", "n_bytes", F.substring(F.concat(
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")),
        F.md5(F.col("row").cast("string").cast("binary"))), 1, KEY_DIGITS).alias("key")))
    out, rows = None, slim
    for page in range(KEY_DIGITS // PAGE_DIGITS):
        at = page * PAGE_DIGITS
        pages = freeze(directory_page(rows, page, limit))
        prefix = F.substring("key", 1, at + PAGE_DIGITS)
        # the first page has 16 ** PAGE_DIGITS rows at most; Spark sees to the size of the others
        entries = F.broadcast(pages) if page == 0 else pages
        joined = rows.withColumn("prefix", prefix).join(entries, "prefix")
        whole = _bits_of_key(page)
        done = joined.filter("bits IS NOT NULL").select(
            "doc_id", F.concat(whole, F.col("bits")).alias("shard"), "shard_bytes", "n_bytes")
        out = done if out is None else out.unionByName(done)
        if pages.filter("bits IS NULL").isEmpty():
            break
        rows = joined.filter("bits IS NULL").select("doc_id", "n_bytes", "key")
    return out


def _bits_of_key(page: int) -> Column:
    """The bits of all pages before this one."""
    parts = [_bits(F.substring("key", p * PAGE_DIGITS + 1, PAGE_DIGITS)) for p in range(page)]
    return F.concat(*parts) if parts else F.lit("")


def op5_sharding(spark, sf_dir):
    return assign_shards(table(spark, sf_dir, "documents"))


def sharding_small_limit(spark, sf_dir):
    """The same with a limit at which small tables split too."""
    return assign_shards(table(spark, sf_dir, "documents"), SMALL_SHARD_BYTES)


def shard_sql(limit: int) -> str:
    return f"""WITH d AS (SELECT doc_id, coalesce(strlen(text), 0)::bigint AS n_bytes,
    lpad(bin(('0x' || substr(md5(doc_id::varchar), 1, 12))::ubigint), 48, '0') AS key FROM documents),
p AS (SELECT d.*, depth, substr(key, 1, depth) AS bits FROM d, range(0, 41) t(depth)),
b AS (SELECT bits, depth, sum(n_bytes)::bigint AS shard_bytes, count(*) AS rows FROM p GROUP BY 1, 2),
s AS (SELECT p.doc_id, p.n_bytes, min(p.depth) AS depth FROM p JOIN b USING (bits, depth)
  WHERE shard_bytes <= {limit} OR rows = 1 GROUP BY 1, 2)
SELECT s.doc_id, substr(d.key, 1, s.depth) AS shard, b.shard_bytes, s.n_bytes
FROM s JOIN d USING (doc_id) JOIN b ON b.depth = s.depth AND b.bits = substr(d.key, 1, s.depth)"""


SQL, SMALL_SQL = shard_sql(SHARD_BYTES), shard_sql(SMALL_SHARD_BYTES)
