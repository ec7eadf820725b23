"""Writing tables and documents.

Appends add files and never rewrite; a rewrite goes to a new path, which the caller swaps in.
Documents are lines of text files that Spark splits and writes in parallel, one line per
document, with the document's own name beside it.
"""
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.functions.sections import stored_sections
from dossier.operators.metrics import run_totals
from dossier.schemas import PROFILE_VERSIONS
from dossier.sinks.builders import contact_report


def append_run_log(rows: DataFrame, dst: str) -> None:
    """Append log rows, partitioned by the status that J1 filters on."""
    rows.write.mode("append").partitionBy("processing_status").parquet(dst)


def storage_profiles(rows: DataFrame, now: datetime | None = None) -> DataFrame:
    """Profile versions as :data:`dossier.schemas.PROFILE_VERSIONS` stores them.

    ``sections`` become ``insights``; what is not given is NULL, but for the two times, which are
    ``now``.
    """
    def stored(field):
        name, kind = field.name, field.dataType
        if name == "insights" and "sections" in rows.columns:
            return F.col("sections").alias(name)
        value = F.col(name) if name in rows.columns else F.lit(None)
        if name in ("created_at", "updated_at") and now is not None:
            value = F.coalesce(value, F.lit(now))
        return value.cast(kind).alias(name)

    if "sections" in rows.columns:
        rows = stored_sections(rows)
    return rows.select(*[stored(f) for f in PROFILE_VERSIONS])


def append_profiles(rows: DataFrame, dst: str, now: datetime | None = None) -> None:
    """Append profile versions, in the form that ``read_profiles`` reads."""
    storage_profiles(rows, now).write.mode("append").partitionBy("generator").parquet(dst)


def rewrite(df: DataFrame, dst: str) -> None:
    """The whole new content of a table, to a path that must not exist yet."""
    df.write.mode("errorifexists").parquet(dst)


def write_profile_json(docs: DataFrame, dst: str) -> None:
    """Documents as NDJSON of (name, doc); ``doc`` is the document's text."""
    docs.select("name", "doc").write.mode("errorifexists").json(dst)


def write_documents(docs: DataFrame, dst: str, text: str, overwrite: bool = True) -> DataFrame:
    """Append (name, text) documents; without ``overwrite`` existing names are left alone.

    The newest row of a name is the current one, see :func:`current_documents`.  Returns the
    rows written.
    """
    rows = docs.select("name", F.col(text).alias("text"), "written_at")
    if not overwrite:
        spark = docs.sparkSession
        rows = rows.join(spark.read.parquet(dst).select("name").distinct(), "name", "left_anti")
    rows.write.mode("append").parquet(dst)
    return rows


def current_documents(stored: DataFrame) -> DataFrame:
    """The newest text of each document name."""
    return stored.groupBy("name").agg(F.max_by("text", "written_at").alias("text"))


def append_events(rows: DataFrame, dst: str) -> None:
    """Append run events as NDJSON."""
    rows.write.mode("append").json(dst)


def write_run_report(results: DataFrame, dst: str) -> None:
    """Contact results as one document per line, and the totals beside them."""
    results.select(contact_report(results).alias("value")).write.text(f"{dst}/contacts")
    run_totals(results).write.json(f"{dst}/totals")
