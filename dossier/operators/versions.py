"""Profile versions: numbering, latest, upsert, migration, log upkeep.

Rows: W2, W3, M1-M7, U4, U5, J8, P9, P15, P16, A5.  Tables are append-only or rewritten as a
whole to a new path by the sinks; these functions only say what the new content is.
"""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.functions.responses import extra_sections, normalize_records, once
from dossier.functions.text import whole_json
from dossier.operators.ordering import number_within
from dossier.schemas import DEFAULT_GENERATOR, JSON_KEYS, SECTIONS

KEY = ["contact_id", "generator"]


def assign_versions(new: DataFrame, existing: DataFrame, order: str = "ord") -> DataFrame:
    """Number new rows from the highest existing version of their key, 1 where none.

    ``order`` is an integer column, unique within the key.
    """
    top = existing.groupBy(*KEY).agg(F.max("version").alias("_top"))
    numbered = number_within(new, KEY, order, "_nth")
    return (numbered.join(top, KEY, "left")
            .withColumn("version", (F.coalesce("_top", F.lit(0)) + F.col("_nth")).cast("int"))
            .drop("_top", "_nth"))


def with_latest(versions: DataFrame) -> DataFrame:
    """``is_latest`` is true for the newest version of each key.

    The newest version is found by a grouped maximum and joined back, so a key with very many
    versions is never sorted in one task.
    """
    top = versions.groupBy(*KEY).agg(F.max("version").alias("_top"))
    return (versions.join(top, KEY, "left")
            .withColumn("is_latest", F.col("version") == F.col("_top")).drop("_top"))


def latest_versions(versions: DataFrame, generator: str | None = None) -> DataFrame:
    """The newest version of each key, by a grouped maximum with partial results."""
    if generator is not None:
        versions = versions.filter(F.col("generator") == generator)
    row = F.struct(*[F.col(c) for c in versions.columns])
    return versions.groupBy(*KEY).agg(F.max_by(row, "version").alias("_r")).select("_r.*")


def append_versions(new: DataFrame, existing: DataFrame, order: str = "ord") -> DataFrame:
    """M1: existing versions plus one new version per accepted row, in order.

    The arrays of a new version hold only what that iteration read.
    """
    rows = assign_versions(new, existing, order)
    return existing.unionByName(rows.select(*existing.columns))


def match_existing(new: DataFrame, old: DataFrame, missing: str = "MISSING") -> DataFrame:
    """Mark rows of ``new`` whose (contact, eni id) exists; no id is looked up as ``missing``."""
    keys = old.select("contact_id", F.col("eni_id").alias("_key"),
                      F.lit(True).alias("is_existing")).distinct()
    return (new.withColumn("_key", F.coalesce("eni_id", F.lit(missing)))
            .join(keys, ["contact_id", "_key"], "left")
            .withColumn("is_existing", F.coalesce("is_existing", F.lit(False)))
            .drop("_key"))


def upsert(new: DataFrame, old: DataFrame, order: str = "ord",
           missing: str = "MISSING") -> DataFrame:
    """M2: the table after writing ``new`` over ``old`` by (contact, eni id), with ``action``.

    A matched row takes the values that are given and counts its version up; others are
    inserted.  Several new rows of one key count as writes one after the other: the last given
    value of each column wins and every write counts.
    """
    values = [c for c in old.columns if c not in ("contact_id", "eni_id", "version")]
    given = [c for c in values if c in new.columns]
    last = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_new_{c}")
            for c in given]
    first_version = (F.min_by("version", order) if "version" in new.columns else F.lit(1))
    incoming = (new.withColumn("_key", F.coalesce("eni_id", F.lit(missing)))
                .groupBy("contact_id", "_key")
                .agg(F.count(F.lit(1)).alias("_writes"), F.min_by("eni_id", order).alias("_id"),
                     first_version.alias("_first"), *last))
    current = old.withColumnsRenamed({c: f"_old_{c}" for c in values}).select(
        "contact_id", F.col("eni_id").alias("_key"), F.col("version").alias("_version"),
        F.lit(True).alias("_was"), *[f"_old_{c}" for c in values])
    both = current.join(incoming, ["contact_id", "_key"], "full_outer")
    was, writes = F.col("_was").isNotNull(), F.col("_writes")
    cols = {
        "contact_id": F.col("contact_id"),
        "eni_id": F.when(was, F.col("_key")).otherwise(F.col("_id")),
        "version": F.when(writes.isNull(), F.col("_version"))
        .when(was, F.col("_version") + writes)
        .otherwise(F.coalesce("_first", F.lit(1)) + writes - 1).cast("int"),
    }
    for c in values:
        cols[c] = F.coalesce(f"_new_{c}", f"_old_{c}") if c in given else F.col(f"_old_{c}")
    action = F.when(writes.isNull(), "kept").when(was, "updated").otherwise("created")
    return both.select(*[cols[c].alias(c) for c in old.columns], action.alias("action"))


def split_records(raw: DataFrame, doc: str = "doc") -> tuple[DataFrame, DataFrame]:
    """Normalised good records and the failed ones with their message."""
    rows = normalize_records(raw, doc)
    return (rows.filter(F.col("record_error").isNull()).drop("record_error"),
            rows.filter(F.col("record_error").isNotNull()))


def batch_upsert(raw: DataFrame, old: DataFrame, order: str = "ord",
                 doc: str = "doc") -> tuple[DataFrame, DataFrame]:
    """M3: upsert JSON records; bad ones are set aside with a message and stop nothing."""
    good, bad = split_records(raw, doc)
    return upsert(good, old, order), bad


def delete_ids(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """M4: the table without the listed ids."""
    return df.join(ids.select(key).distinct(), key, "left_anti")


def migrate(docs: DataFrame, old: DataFrame, force: bool = False, order: str = "ord",
            doc: str = "doc") -> tuple[DataFrame, DataFrame]:
    """M5: bring stored documents in; existing ones are skipped unless forced.

    Returns the new table and a report with one ``outcome`` per document.
    """
    rows = normalize_records(docs, doc)
    marked = match_existing(rows, old, "UNKNOWN")
    outcome = (F.when(F.col("record_error").isNotNull(), "failed")
               .when(F.col("is_existing") & F.lit(not force), "skipped").otherwise("migrated"))
    marked = marked.withColumn("outcome", outcome)
    table = upsert(marked.filter(F.col("outcome") == "migrated"), old, order, "UNKNOWN")
    report = marked.select(order, "contact_id", "eni_id", "outcome", "record_error")
    return table, report


def clear_log(log: DataFrame, contact: str | None = None) -> DataFrame:
    """M6: the log without one contact's rows, or empty."""
    if contact is None:
        return log.limit(0)
    return log.filter(~F.col("contact_id").eqNullSafe(F.lit(contact)))


def backfill_arrays(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """M7: move single-value columns into their arrays; a value already there is not repeated."""
    for single, many in pairs.items():
        arr = F.coalesce(F.col(many), F.array().cast("array<string>"))
        add = F.col(single).isNotNull() & ~F.array_contains(arr, F.col(single))
        df = df.withColumn(many, F.when(add, F.concat(arr, F.array(single))).otherwise(arr))
    return df


def merge_processed(old: DataFrame, new: DataFrame) -> DataFrame:
    """U4: the processed set with the unseen pairs of ``new`` added."""
    keys = ["contact_id", "eni_id"]
    unseen = new.select(*keys).distinct().join(old, keys, "left_anti")
    return old.select(*keys).unionByName(unseen)


def cumulative_sources(versions: DataFrame) -> DataFrame:
    """Types and subtypes that ever contributed to a contact, with summed counts.

    Values are made distinct before they are gathered, so the lists grow with the number of
    different sources and not with the number of versions.
    """
    def seen(col: str) -> DataFrame:
        pairs = versions.select(*KEY, F.explode(col).alias("v")).distinct()
        return pairs.groupBy(*KEY).agg(F.array_sort(F.collect_list("v")).alias(col))

    sums = versions.groupBy(*KEY).agg(
        F.sum(F.col("record_count").cast("long")).alias("record_count"),
        F.sum(F.col("total_eni_ids").cast("long")).alias("total_eni_ids"))
    return (sums.join(seen("eni_source_types"), KEY, "left")
            .join(seen("eni_source_subtypes"), KEY, "left"))


# ---- reading and shaping versions -------------------------------------------------------

def profile_filter(df: DataFrame, contacts: list[str] | None = None,
                   source_types: list[str] | None = None,
                   status: str | None = None) -> DataFrame:
    """Optional filters on contact, contributing source type and status."""
    if contacts:
        df = df.filter(F.col("contact_id").isin(contacts))
    if source_types:
        wanted = F.array(*[F.lit(t) for t in source_types])
        df = df.filter(F.arrays_overlap("eni_source_types", wanted))
    if status:
        df = df.filter(F.col("processing_status") == status)
    return df


def profile_count(df: DataFrame, **filters) -> DataFrame:
    """A5: number of profiles that pass the filters."""
    return profile_filter(df, **filters).agg(F.count(F.lit(1)).alias("n"))


METRICS = ("est_input_tokens", "est_insights_tokens", "generation_time_seconds")


def to_rows(df: DataFrame) -> DataFrame:
    """Flat storage row per profile; sections as one JSON text, further keys behind the six."""
    sections = F.to_json(F.struct(*[F.col("sections")[s].alias(s) for s in SECTIONS]),
                         {"ignoreNullFields": "false"})
    if "extra" in df.schema["sections"].dataType.names:
        extra = F.col("sections.extra")
        both = F.concat(F.substring(sections, F.lit(1), F.length(sections) - 1), F.lit(","),
                        F.substr(F.to_json(extra, {"ignoreNullFields": "false"}), F.lit(2)))
        sections = F.when(F.size(extra) > 0, both).otherwise(sections)
    return df.select(*[c for c in df.columns if c != "sections"], sections.alias("insights"))


def from_rows(df: DataFrame) -> DataFrame:
    """Typed profile from a flat storage row, with defaults for what is missing.

    The network section is read under either of its spellings; keys beside the six are in
    ``sections.extra``.
    """
    df = once(df, _v=whole_json(F.col("insights")))
    v = F.col("_v")

    def text(i: int) -> Column:
        name, key = SECTIONS[i], JSON_KEYS[i]
        return F.coalesce(F.try_variant_get(v, f"$['{key}']", "string"),
                          F.try_variant_get(v, f"$['{name}']", "string"))

    defaults = {"generator": F.lit(DEFAULT_GENERATOR), "record_count": F.lit(1),
                "total_eni_ids": F.lit(1), "processing_status": F.lit("completed"),
                "version": F.lit(1)}
    kept = [F.coalesce(F.col(c), defaults[c]).alias(c) if c in defaults else F.col(c)
            for c in df.columns if c not in ("insights", "_v")]
    return df.select(*kept, F.struct(*[text(i).alias(s) for i, s in enumerate(SECTIONS)],
                                     F.expr(extra_sections("_v")).alias("extra")).alias("sections"))
