"""Source rules: filters, group assignment, statistics, reconciliation.

Rows: S8, P3, P4, J4, J9, A6-A8, U2, U3, V1, W5.  The rule table comes from a caller's mapping,
so Spark knows its size and broadcasts it by its own size check; no hint is given here.
"""
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from dossier.checkpoints import freeze
from dossier.functions.text import norm_subtype
from dossier.schemas import NULL_SUBTYPE, RULES
from dossier.sources.local import local_frame


def rules_frame(spark: SparkSession, rules: Mapping[str, object]) -> DataFrame:
    """Rule rows from a mapping type -> list of subtypes, or nothing.

    Every type starts with its ``null`` row; a value that is not a list adds no more rows.
    """
    rows = []
    for source_type, listed in rules.items():
        extra = [s for s in listed if s != NULL_SUBTYPE] if isinstance(listed, list) else []
        for subtype in dict.fromkeys([NULL_SUBTYPE, *extra]):
            rows.append((source_type, subtype, len(rows)))
    return local_frame(spark, rows, RULES)


def with_subtype(notes: DataFrame) -> DataFrame:
    """Add the normalised subtype as ``subtype``."""
    return notes.withColumn("subtype", norm_subtype(F.col("eni_source_subtype")))


def rule_filter(notes: DataFrame, rules: DataFrame) -> DataFrame:
    """Notes whose type is configured and whose subtype is null or listed."""
    keys = rules.select("eni_source_type", "subtype")
    return (with_subtype(notes).join(keys, ["eni_source_type", "subtype"], "left_semi")
            .select(*notes.columns))


def rule_split(notes: DataFrame, rules: DataFrame) -> DataFrame:
    """Every note with ``kept``, in one pass."""
    marks = rules.select("eni_source_type", "subtype", F.lit(True).alias("kept"))
    return (with_subtype(notes).join(marks, ["eni_source_type", "subtype"], "left")
            .select(*notes.columns, F.coalesce("kept", F.lit(False)).alias("kept")))


def assign_groups(notes: DataFrame, combos: DataFrame) -> DataFrame:
    """Each note with the (type, subtype) group it belongs to and the group's order."""
    return with_subtype(notes).join(combos, ["eni_source_type", "subtype"])


def group_ordinal(groups: DataFrame) -> DataFrame:
    """Number of each group within its contact, in rule order.

    Needs one row per (contact, type, subtype): a contact has at most as many as there are
    rules, so the window is small for every contact.
    """
    order = Window.partitionBy("contact_id").orderBy("ord")
    return groups.withColumn("ordinal", F.row_number().over(order))


def union_groups(*frames: DataFrame) -> DataFrame:
    """Frames of several groups put together by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def key_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys only in the first, only in the second, or in both, as ``side``."""
    keys = a.columns
    tagged = (a.distinct().select(*keys, F.lit(1).alias("m"))
              .unionByName(b.select(*keys).distinct().select(*keys, F.lit(2).alias("m"))))
    side = (F.when(F.col("m") == 1, "first").when(F.col("m") == 2, "second").otherwise("both"))
    return tagged.groupBy(*keys).agg(F.sum("m").alias("m")).select(*keys, side.alias("side"))


def reconcile_rules(notes: DataFrame, rules: DataFrame) -> DataFrame:
    """Types on one side only, and listed subtypes missing from the data of a shared type.

    A rule's own ``null`` row stands for the type, not for a listed subtype.
    """
    # a handful of rows, read three times
    data = freeze(with_subtype(notes).select("eni_source_type", "subtype").distinct())
    types = key_diff(data.select("eni_source_type"), rules.select("eni_source_type"))
    one_sided = types.filter(F.col("side") != "both").select(
        F.when(F.col("side") == "first", "not_configured").otherwise("not_in_data").alias("finding"),
        "eni_source_type", F.lit(None).cast("string").alias("subtype"))
    listed = rules.filter(F.col("subtype") != NULL_SUBTYPE).select("eni_source_type", "subtype")
    missing = (listed.join(types.filter(F.col("side") == "both"), "eni_source_type", "left_semi")
               .join(data, ["eni_source_type", "subtype"], "left_anti")
               .select(F.lit("subtype_not_in_data").alias("finding"),
                       "eni_source_type", "subtype"))
    return one_sided.unionByName(missing)


def rule_findings(notes: DataFrame, rules: DataFrame) -> DataFrame:
    """V1: J9 as readable findings."""
    text = (F.when(F.col("finding") == "not_configured",
                   F.concat(F.lit("type without a rule: "), F.coalesce("eni_source_type", F.lit("(no type)"))))
            .when(F.col("finding") == "not_in_data",
                  F.concat(F.lit("type of a rule without notes: "), "eni_source_type"))
            .otherwise(F.concat(F.lit("subtype of a rule without notes: "),
                                "eni_source_type", F.lit("/"), "subtype")))
    return reconcile_rules(notes, rules).select(F.lit("warning").alias("level"), "finding",
                                                text.alias("message"))


def filter_stats(notes: DataFrame, rules: DataFrame) -> DataFrame:
    """One row with notes in, kept and skipped, and the percentage kept (0 when empty)."""
    kept = F.count_if(F.col("kept"))
    total = F.count(F.lit(1))
    return rule_split(notes, rules).agg(
        total.alias("original_count"), kept.alias("filtered_count"),
        (total - kept).alias("skipped_count"),
        F.when(total > 0, F.round(kept * 100 / total, 4)).otherwise(F.lit(0.0))
        .alias("filter_efficiency"))


def skipped_breakdown(notes: DataFrame, rules: DataFrame, n: int = 10) -> DataFrame:
    """Skipped notes per type and subtype, the ``n`` largest."""
    skipped = rule_split(notes, rules).filter(~F.col("kept"))
    return (skipped.groupBy("eni_source_type", "eni_source_subtype")
            .agg(F.count(F.lit(1)).alias("skipped"))
            .orderBy(F.desc("skipped"), F.asc_nulls_last("eni_source_type"),
                     F.asc_nulls_last("eni_source_subtype")).limit(n))


def rule_coverage(notes: DataFrame, rules: DataFrame) -> DataFrame:
    """How many of the types in the data are configured."""
    types = key_diff(notes.select("eni_source_type").filter("eni_source_type IS NOT NULL"),
                     rules.select("eni_source_type"))
    both = F.count_if(F.col("side") == "both")
    in_data = F.count_if(F.col("side") != "second")
    return types.agg(
        F.when(in_data > 0, F.round(both * 100 / in_data, 4)).otherwise(F.lit(0.0))
        .alias("filter_coverage_percent"),
        F.count_if(F.col("side") != "first").alias("configured_types_count"),
        in_data.alias("data_types_count"))
