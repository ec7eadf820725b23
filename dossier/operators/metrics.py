"""Run figures (A4, A9, A12-A14, A18, A21, F24, S17 totals).

Totals are single-row aggregates with partial results per task.  Lists that grow with the run,
such as error messages, stay rows and are never gathered into one cell.
"""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rate(part: Column, whole: Column, digits: int = 6) -> Column:
    return F.when(whole > 0, F.round(part / whole, digits)).otherwise(F.lit(0.0))


def log_stats(log: DataFrame, contact: str | None = None) -> DataFrame:
    """A4: per status count, mean duration, first and last time; the total has no status."""
    if contact is not None:
        log = log.filter(F.col("contact_id") == contact)
    stats = log.rollup("processing_status").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("processing_duration_ms"), 4).alias("avg_duration_ms"),
        F.min("processed_at").alias("earliest"), F.max("processed_at").alias("latest"),
        F.grouping("processing_status").alias("_total"))
    return stats.select(F.when(F.col("_total") == 1, "total").otherwise("status").alias("scope"),
                        "processing_status", "n", "avg_duration_ms", "earliest", "latest")


def result_status(success: Column, errors: Column) -> Column:
    """``success``; else ``skipped_claim`` when an error says so; else ``failed``."""
    claimed = F.exists(errors, lambda e: F.contains(e, F.lit("skipped_due_to_claim")))
    return (F.when(F.coalesce(success, F.lit(False)), "success")
            .when(F.coalesce(claimed, F.lit(False)), "skipped_claim").otherwise("failed"))


def run_totals(results: DataFrame) -> DataFrame:
    """One row of totals over contact results.

    A contact with a skip among its errors counts as skipped only; what succeeded contacts did
    is summed; other contacts are failed.
    """
    skipped = F.exists("errors", lambda e: F.contains(e, F.lit("skipped")))
    skip = F.coalesce(skipped, F.lit(False))
    ok = ~skip & F.coalesce("success", F.lit(False))

    def total(col: str) -> Column:
        return F.coalesce(F.sum(F.when(ok, F.col(col))), F.lit(0)).cast("long").alias(col)

    return results.agg(
        F.count(F.lit(1)).alias("total_scheduled"),
        F.count_if(ok).alias("total_completed_success"),
        F.count_if(skip).alias("total_skipped_claim"),
        F.count_if(~skip & ~ok).alias("total_failed"),
        *[total(c) for c in ("notes_processed", "files_created", "records_published",
                             "token_loss_events", "token_loss_groups_skipped",
                             "token_loss_records_skipped")],
        F.coalesce(F.sum(F.when(~skip & ~ok, F.size("errors"))), F.lit(0)).cast("long")
        .alias("error_count"))


def run_errors(results: DataFrame) -> DataFrame:
    """The errors of failed contacts, one row each."""
    skip = F.coalesce(F.exists("errors", lambda e: F.contains(e, F.lit("skipped"))), F.lit(False))
    failed = results.filter(~skip & ~F.coalesce("success", F.lit(False)))
    return failed.select("contact_id", F.explode("errors").alias("error"))


def write_summary(results: DataFrame, elapsed_seconds: float) -> DataFrame:
    """Processed, created, updated and failed writes and their rate."""
    ok = F.coalesce("success", F.lit(False))
    done = F.count_if(ok)
    return results.agg(
        done.alias("total_processed"),
        F.count_if(ok & F.col("was_created")).alias("total_created"),
        F.count_if(ok & ~F.col("was_created")).alias("total_updated"),
        F.count_if(~ok).alias("total_failed"),
        F.lit(float(elapsed_seconds)).alias("elapsed_seconds"),
        F.round(done / F.lit(max(float(elapsed_seconds), 1.0)), 6).alias("processing_rate"))


def legacy_stats(rows: DataFrame) -> DataFrame:
    """Processed ids per contact and in total, from legacy log rows."""
    per = rows.groupBy("contact_id").agg(F.count("eni_id").alias("n"))
    total = per.agg(F.count(F.lit(1)).alias("contacts"), F.sum("n").alias("n"))
    return (per.select(F.lit("contact").alias("scope"), "contact_id",
                       F.lit(1).cast("long").alias("contacts"), "n")
            .unionByName(total.select(F.lit("total").alias("scope"),
                                      F.lit(None).cast("string").alias("contact_id"),
                                      "contacts", F.coalesce("n", F.lit(0)).alias("n"))))


# The stages a run event may belong to.
STAGES = ("contact", "group", "call", "file", "publish", "error", "filter")


def stage_metrics(events: DataFrame, by: list[Column] | None = None) -> DataFrame:
    """Counters and rates over run events, for the whole run or per key in ``by``.

    Events have (stage, success, records, seconds).  ``records`` of a filter event is the
    number of notes left out.
    """
    stage, ok = F.col("stage"), F.coalesce("success", F.lit(False))

    def n(name: str, when: Column | None = None) -> Column:
        return F.count_if((stage == name) & when if when is not None else stage == name)

    def total(name: str, col: str) -> Column:
        return F.coalesce(F.sum(F.when(stage == name, F.col(col))), F.lit(0))

    contacts, calls, good = n("contact", ok), n("call"), n("call", ok)
    records = total("group", "records").cast("long")
    grouped = events.groupBy(*by) if by else events
    return grouped.agg(
        contacts.alias("contacts_processed"), n("group").alias("groups_processed"),
        calls.alias("calls_made"), good.alias("calls_successful"),
        (calls - good).alias("calls_failed"), n("file").alias("files_created"),
        n("publish").alias("records_published"), n("error").alias("errors_encountered"),
        records.alias("records_processed"),
        total("filter", "records").cast("long").alias("records_filtered"),
        _rate(good * 100, calls, 4).alias("call_success_percent"),
        F.round(records / F.greatest(F.lit(1), contacts), 4).alias("avg_records_per_contact"))


def group_timings(events: DataFrame) -> DataFrame:
    """Records, outcome and time of the group events of each (contact, type, subtype)."""
    rows = events.filter(F.col("stage") == "group")
    return rows.groupBy("contact_id", "eni_source_type", "subtype").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("records").alias("records"),
        F.count_if("success").alias("successful"),
        F.round(F.sum("seconds"), 4).alias("seconds"))


def migration_summary(report: DataFrame) -> DataFrame:
    """Documents found, migrated, failed and skipped, and the success rate."""
    def n(name: str) -> Column:
        return F.count_if(F.col("outcome") == name)

    tried = F.greatest(F.lit(1), n("migrated") + n("failed"))
    return report.agg(F.count(F.lit(1)).alias("total_discovered"),
                      n("migrated").alias("migrated"), n("failed").alias("failed"),
                      n("skipped").alias("skipped"),
                      F.round(n("migrated") / tried, 6).alias("success_rate"))


def system_stats(notes: DataFrame, log: DataFrame) -> DataFrame:
    """Contacts, type pairs, and log totals as (metric, value) rows."""
    def one(df: DataFrame, name: str, value: Column) -> DataFrame:
        return df.agg(value.cast("long").alias("value")).select(F.lit(name).alias("metric"),
                                                                "value")

    contacts = notes.select("contact_id").filter("contact_id IS NOT NULL").distinct()
    pairs = (notes.filter("eni_source_type IS NOT NULL")
             .select("eni_source_type", "eni_source_subtype").distinct())
    rows = F.count(F.lit(1))
    return (one(contacts, "contacts", rows)
            .unionByName(one(pairs, "type_pairs", rows))
            .unionByName(one(log, "log_rows", rows))
            .unionByName(one(log.select("contact_id").distinct(), "log_contacts", rows)))
