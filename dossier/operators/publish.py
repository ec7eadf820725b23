"""Publication: search, recency, sync plan, master records, outbox."""
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.functions.sections import display_markdown, note_content
from dossier.operators.selection import in_list, last_n
from dossier.operators.versions import latest_versions
from dossier.schemas import DEFAULT_GENERATOR, SECTIONS


def search_profiles(df: DataFrame, term: str, fields: list[str] | None = None,
                    limit: int | None = None) -> DataFrame:
    """P10: profiles with the term in any chosen section, whatever its case.

    Plain containment, so ``%`` and ``_`` in the term stand for themselves.
    """
    hit = F.lit(False)
    for name in fields or SECTIONS:
        hit = hit | F.coalesce(F.contains(F.lower(F.col("sections")[name]),
                                          F.lit(term.lower())), F.lit(False))
    found = df.filter(hit)
    if limit is None:
        return found
    return found.orderBy(F.desc_nulls_last("updated_at"), "contact_id", "version").limit(limit)


def recent_profiles(df: DataFrame, cutoff: datetime, n: int) -> DataFrame:
    """Of the ``n`` newest profiles those updated since the cut-off."""
    newest = (df.filter(F.col("updated_at") >= F.lit(cutoff))
              .orderBy(F.desc("updated_at"), "contact_id", "version"))
    return newest.limit(n)


def sync_plan(df: DataFrame, now: datetime, force: bool = False) -> DataFrame:
    """``skip`` what was updated less than an hour ago unless forced, else ``sync``."""
    fresh = F.lit(now).cast("timestamp") - F.col("updated_at") < F.expr("INTERVAL '1' HOUR")
    skip = F.coalesce(fresh, F.lit(False)) & F.lit(not force)
    return df.withColumn("action", F.when(skip, "skip").otherwise("sync"))


def publish_rows(df: DataFrame) -> DataFrame:
    """Sections with a nested metadata struct."""
    meta = ["contact_id", "eni_id", "member_name", "generated_at", "version", "record_count",
            "total_eni_ids"]
    return df.select(
        "contact_id", *[F.col("sections")[s].alias(s) for s in SECTIONS],
        F.struct(*[c for c in meta if c in df.columns]).alias("metadata"))


def with_master(df: DataFrame, master: DataFrame) -> DataFrame:
    """Link each row to its contact's master record.

    Duplicate master rows give the first record id; without one the row gets ``sync_error``.
    """
    first = master.groupBy("contact_id").agg(F.min("record_id").alias("master_record_id"))
    error = F.when(F.col("master_record_id").isNull(),
                   F.concat(F.lit("no master record for contact "), "contact_id"))
    return df.join(first, "contact_id", "left").withColumn("sync_error", error)


def build_outbox(profiles: DataFrame, master: DataFrame,
                 note_type: str = "profile") -> DataFrame:
    """One record per contact, ready to send; sections that are missing stay NULL."""
    s = F.col("sections")

    def shown(name: str):
        return F.when(F.length(s[name]) > 0, display_markdown(s[name]))

    return with_master(profiles, master).select(
        "contact_id", "master_record_id", F.lit(note_type).alias("note_type"),
        note_content(s).alias("note_content"), shown("deals").alias("deals"),
        shown("introductions").alias("introductions"), "sync_error")


def deliver(outbox: DataFrame, send_partition) -> None:
    """Hand the sendable records to the caller's function, one call per partition."""
    outbox.filter(F.col("sync_error").isNull()).foreachPartition(send_partition)


def republish(versions: DataFrame, master: DataFrame, ids: DataFrame | None = None,
              generator: str = DEFAULT_GENERATOR) -> DataFrame:
    """M8: the outbox of every completed profile, or of the listed contacts; latest only."""
    done = versions.filter(F.col("processing_status") == "completed")
    latest = latest_versions(done, generator)
    if ids is not None:
        latest = in_list(latest, ids)
    return build_outbox(latest, master)


def sync_results(outbox: DataFrame) -> DataFrame:
    """Result rows of a publication whose sendable records were all created."""
    ok = F.col("sync_error").isNull()
    return outbox.select("contact_id", ok.alias("success"),
                         F.when(ok, "created").otherwise("failed").alias("action"),
                         F.col("sync_error").alias("error_message"))


def sync_summary(results: DataFrame, *more: Column) -> DataFrame:
    """A10: counts per outcome and the success rate (0 when there are no results).

    ``more`` adds aggregates of the caller's own to the same pass.
    """
    total, ok = F.count(F.lit(1)), F.count_if(F.col("success"))

    def acted(name: str):
        return F.count_if(F.col("action") == name).alias(name)

    return results.agg(
        total.alias("total"), ok.alias("successful"), (total - ok).alias("failed"),
        acted("created"), acted("updated"), acted("skipped"),
        F.when(total > 0, F.round(ok / total, 6)).otherwise(F.lit(0.0)).alias("success_rate"),
        *more)


def sync_stats(results: DataFrame, order: list[str], n: int = 100) -> DataFrame:
    """The summary of all results and of the last ``n``, each with its last sync time.

    The last time of all is among the last ``n`` when ``order`` starts with ``synced_at``.
    """
    def part(df: DataFrame, scope: str) -> DataFrame:
        return sync_summary(df, F.max("synced_at").alias("last_sync_time")).select(
            F.lit(scope).alias("scope"), "*")

    return part(results, "overall").unionByName(part(last_n(results, order, n), "recent"))
