"""What the operators share: scans, the characters that count as white space, frozen steps."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters of ``[\x20\x09-\x0D]``.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z as a-z; every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def ascii_strip(text: Column) -> Column:
    """Without the white space of WHITE at both ends."""
    return F.trim(text, F.lit(WHITE))


def held_out(doc_id: Column) -> Column:
    """One document in five, by the checksum of its id; labels are learned from the others."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0
