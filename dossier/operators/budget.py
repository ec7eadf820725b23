"""Token budget, group statistics and prompt context.

A group is (contact, type, subtype).  It may hold any share of all notes, so no step sorts or
collects a whole group: counts and token sums per day decide most rows, and only the day on
which the budget runs out is looked at row by row, in slices.
"""
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.checkpoints import freeze
from dossier.functions.prompts import token_stats
from dossier.functions.sections import profile_json
from dossier.functions.text import (estimate_tokens, note_entry, ordered_join, render)
from dossier.schemas import NULL_SUBTYPE

GROUP = ["contact_id", "eni_source_type", "subtype"]

# notes of one slice of a day grow with the square root of the day's notes
SLICE_ROOT = 64


def with_entries(grouped: DataFrame) -> DataFrame:
    """Add the prompt entry of each note and its token count."""
    entry = note_entry(F.col("description"), F.col("logged_date"), F.col("eni_id"),
                       F.col("eni_source_type"))
    return grouped.withColumn("entry", entry).withColumn("tokens", estimate_tokens(F.col("entry")))


def budget_cut(notes: DataFrame, budget: int | DataFrame, keys: list[str] = GROUP,
               carry: list[str] | None = None) -> DataFrame:
    """Newest first, the notes of each group up to the first that exceeds the budget.

    ``notes`` has ``keys``, ``logged_date``, ``eni_id``, ``tokens`` (1 or more per note) and the
    columns of ``carry``.  ``budget`` is one number, or a table of ``keys`` and ``budget``; notes of
    a group that has no row there are left out.
    Returns ``keys``, ``logged_date``, ``eni_id``, ``tokens``, ``carry`` and ``used_before``, the
    tokens of the group's earlier notes.

    1. Tokens per (group, day) are summed map-side; a window over the days of a group, a number
       bounded by the calendar, gives the tokens of all newer days.  Days that start past the
       budget are dropped before any note is sorted.
    2. On the one day per group where the budget ends, notes are spread over slices by a hash of
       their id.  A slice keeps its notes up to and with the first that takes the slice alone over
       budget: that one must stay, as it ends the group for all notes behind it, and what follows
       it in the slice cannot fit in the group either.
    3. What is left of a group, its whole days and its shrunk slices, is ranked exactly.

    The notes are written once, so what they come from is evaluated once; the cut reads their
    ids, days and tokens, and ``carry`` is read for the notes that fit.
    """
    carry = carry or []
    frozen = freeze(notes.select(*keys, "logged_date", "eni_id", "tokens", *carry)
                    .withColumn("_row", F.monotonically_increasing_id()))
    kept = cut_written(frozen.drop(*carry), budget, keys)
    if carry:
        kept = kept.join(frozen.select("_row", *carry), "_row")
    return kept.select(*keys, "logged_date", "eni_id", "tokens", *carry, "used_before")


def cut_written(slim: DataFrame, budget: int | str | DataFrame, keys: list[str] = GROUP) -> DataFrame:
    """The cut of :func:`budget_cut` over a written table of ids, days and tokens.

    ``budget`` may also name a column of ``slim`` that is the same in all rows of a group.  Further
    columns stay, and go through every shuffle of the cut: they should be small.
    """
    newer = (Window.partitionBy(*keys).orderBy(F.desc_nulls_last("logged_date"))
             .rowsBetween(Window.unboundedPreceding, -1))
    room = [F.any_value(budget).alias("_room")] if isinstance(budget, str) else []
    days = (slim.groupBy(*keys, "logged_date")
            .agg(F.sum("tokens").alias("_sum"), F.count(F.lit(1)).alias("_n"), *room)
            .withColumn("_before", F.coalesce(F.sum("_sum").over(newer), F.lit(0))))
    if isinstance(budget, DataFrame):
        days = _null_safe_join(days, budget.select(*keys, F.col("budget").alias("_room")), keys)
    elif isinstance(budget, int):
        days = days.withColumn("_room", F.lit(budget))
    slices = F.greatest(F.lit(1), F.floor(F.sqrt("_n") / SLICE_ROOT)).cast("int")
    fits_whole = F.col("_before") + F.col("_sum") <= F.col("_room")
    reached_days = days.filter(F.col("_before") < F.col("_room")).select(
        *keys, "logged_date", "_before", "_room", F.when(~fits_whole, slices).alias("_slices"))
    reached = _null_safe_join(slim, reached_days, [*keys, "logged_date"])

    # the slice of a note on a day that fits whole is -1, and nothing is dropped there
    sliced = reached.withColumn(
        "_slice", F.expr("coalesce(pmod(xxhash64(eni_id), _slices), -1)"))
    to_here = Window.orderBy(F.desc_nulls_last("logged_date"), "eni_id").rowsBetween(
        Window.unboundedPreceding, 0)

    def running(by: list[str]) -> Column:
        return F.sum("tokens").over(to_here.partitionBy(*by))

    shrunk = (sliced.withColumn("_in_slice", running([*keys, "_slice"]))
              .filter((F.col("_slice") < 0)
                      | (F.col("_before") + F.col("_in_slice") - F.col("tokens")
                         <= F.col("_room"))))
    ranked = (shrunk.withColumn("_to_here", running(keys))
              .filter(F.col("_to_here") <= F.col("_room")))
    return ranked.withColumn("used_before", F.col("_to_here") - F.col("tokens"))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which NULL keys match, with the keys of ``left``."""
    renamed = right.withColumnsRenamed({c: f"_k_{c}" for c in keys})
    match = F.lit(True)
    for c in keys:
        match = match & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return left.join(renamed, match).drop(*[f"_k_{c}" for c in keys])


def group_totals(grouped: DataFrame, keys: list[str] = GROUP) -> DataFrame:
    """Notes per group before the cut."""
    return grouped.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_total"))


def group_stats(grouped: DataFrame, budget: int, keys: list[str] = GROUP) -> DataFrame:
    """Notes in and used, tokens used and available, and the ids used, per group.

    The id list is that of the notes that fit, which the budget bounds.
    """
    sized = grouped if "tokens" in grouped.columns else with_entries(grouped)
    slim = freeze(sized.select(*keys, "logged_date", "eni_id", "tokens"))
    kept = cut_written(slim, budget, keys)
    used = kept.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows_used"), F.sum("tokens").alias("tokens_used"),
        F.array_sort(F.collect_list("eni_id")).alias("used_ids"))
    return (group_totals(slim, keys).join(used, keys, "left")
            .select(*keys, "rows_total",
                    F.coalesce("rows_used", F.lit(0)).alias("rows_used"),
                    F.coalesce("tokens_used", F.lit(0)).alias("tokens_used"),
                    F.lit(budget).alias("tokens_available"),
                    F.coalesce("used_ids", F.array().cast("array<string>")).alias("used_ids")))


def contact_sources(grouped: DataFrame) -> DataFrame:
    """A15, per contact: distinct types and subtypes, sorted; the rules bound both lists."""
    pairs = grouped.select("contact_id", "eni_source_type", "subtype").distinct()
    return pairs.groupBy("contact_id").agg(
        F.array_sort(F.collect_set("eni_source_type")).alias("eni_source_types"),
        F.array_sort(F.collect_set("subtype")).alias("eni_source_subtypes"))


def group_blocks(kept: DataFrame, keys: list[str] = GROUP, entry: str = "entry") -> DataFrame:
    """the notes of each group that fit, joined newest first into one text, and their ids.

    Takes rows of :func:`budget_cut`, so a group is never larger than the budget.
    """
    # array_sort puts smaller structs first: days count down, no date comes last
    newest = F.coalesce(-F.unix_date("logged_date"), F.lit(2147483647))
    return kept.groupBy(*keys).agg(
        ordered_join([newest, F.col("eni_id")], F.col(entry)).alias("new_data"),
        F.count(F.lit(1)).alias("rows_used"), F.sum("tokens").alias("tokens_used"),
        F.array_sort(F.collect_list("eni_id")).alias("used_ids"))


def with_context(groups: DataFrame, context: DataFrame) -> DataFrame:
    """Type text and, for a real subtype, subtype text of each group.

    ``context`` has (type, subtype, content); the type text is the row with subtype
    ``default``.  Missing text is empty.
    """
    types = context.filter(F.col("subtype") == "default").select(
        F.col("type").alias("eni_source_type"), F.col("content").alias("type_context"))
    subs = context.filter(~F.col("subtype").isin("default", NULL_SUBTYPE)).select(
        F.col("type").alias("eni_source_type"), "subtype",
        F.col("content").alias("subtype_context"))
    return (groups.join(types, "eni_source_type", "left")
            .join(subs, ["eni_source_type", "subtype"], "left")
            .withColumn("type_context", F.coalesce("type_context", F.lit("")))
            .withColumn("subtype_context", F.coalesce("subtype_context", F.lit(""))))


def with_context_fallback(groups: DataFrame, context: DataFrame) -> DataFrame:
    """J5, one-text form: the exact text, else the type's default, else none."""
    exact = context.select(F.col("type").alias("eni_source_type"), "subtype",
                           F.col("content").alias("_exact"))
    default = context.filter(F.col("subtype") == "default").select(
        F.col("type").alias("eni_source_type"), F.col("content").alias("_default"))
    return (groups.join(exact, ["eni_source_type", "subtype"], "left")
            .join(default, "eni_source_type", "left")
            .withColumn("context", F.coalesce("_exact", "_default"))
            .drop("_exact", "_default"))


def context_paths(groups: DataFrame, context: DataFrame) -> DataFrame:
    """J5, path form: the type's default path, and the group's own path unless it is the same."""
    own = context.select(F.col("type").alias("eni_source_type"), "subtype",
                         F.col("path").alias("_own"))
    default = context.filter(F.col("subtype") == "default").select(
        F.col("type").alias("eni_source_type"), F.col("path").alias("default_path"))
    return (groups.join(own, ["eni_source_type", "subtype"], "left")
            .join(default, "eni_source_type", "left")
            .withColumn("subtype_path", F.when(
                ~F.col("_own").eqNullSafe(F.col("default_path")), F.col("_own")))
            .drop("_own"))


def with_profile(groups: DataFrame, latest: DataFrame) -> DataFrame:
    """The contact's current profile as JSON text, six empty sections when there is none."""
    current = latest.select("contact_id", profile_json(F.col("sections")).alias("profile_json"))
    return groups.join(current, "contact_id", "left").withColumn(
        "profile_json", F.coalesce("profile_json", profile_json(None)))


PROMPT_KEYS = ("current_structured_insight", "eni_source_type_context",
               "eni_source_subtype_context", "new_data_to_process")


def _values(new_data: Column) -> list[tuple[str, Column]]:
    return list(zip(PROMPT_KEYS, [F.col("profile_json"), F.col("type_context"),
                                  F.col("subtype_context"), new_data]))


def with_base_tokens(groups: DataFrame, template: str) -> DataFrame:
    """Tokens of each group's prompt before any note is added."""
    return groups.withColumn("base_tokens", estimate_tokens(
        render(F.lit(template), _values(F.lit("")))))


def with_prompt(groups: DataFrame, template: str, window: int, reserve: int,
                cap: int) -> DataFrame:
    """Rendered prompt and token statistics of each group."""
    full = groups.withColumn("prompt", render(F.lit(template), _values(F.col("new_data"))))
    return full.withColumn("token_stats", token_stats(
        F.col("base_tokens"), F.col("new_data"), F.col("profile_json"), F.col("type_context"),
        F.col("subtype_context"), F.lit(template), F.col("prompt"), window, reserve, cap))


def combine_groups(groups: DataFrame) -> DataFrame:
    """One text per contact from the blocks of its groups, in the order of the groups.

    A contact has at most as many groups as there are rules, each cut to the budget.
    """
    kind, sub = F.col("eni_source_type"), F.col("subtype")
    header = F.concat(F.lit("<<< "), kind, F.lit("/"), sub, F.lit(": "),
                      F.col("rows_total").cast("string"), F.lit(" notes waiting >>>\n"))
    type_block = F.when(F.length("type_context") > 0, F.concat(
        F.lit("About notes of type "), kind, F.lit(":\n"), "type_context", F.lit("\n\n")))
    sub_block = F.when(F.length("subtype_context") > 0, F.concat(
        F.lit("About the subtype "), sub, F.lit(":\n"), "subtype_context",
        F.lit("\n\n")))
    data = F.concat(F.lit("Notes to work in ("), F.col("rows_used").cast("string"),
                    F.lit("):\n"), "new_data", F.lit("\n"))
    block = F.concat(header, F.coalesce(type_block, F.lit("")),
                     F.coalesce(sub_block, F.lit("")), data)
    return groups.groupBy("contact_id").agg(
        ordered_join([kind, sub], block, "\n\n").alias("combined"),
        F.sum("rows_total").alias("rows_total"), F.sum("rows_used").alias("rows_used"))


def preview(groups: DataFrame, budget: int) -> DataFrame:
    """One row per would-be call, numbered per contact, with its token figures.

    Takes groups with ``ord`` and the columns of :func:`group_blocks` and
    :func:`with_base_tokens`; a contact has at most as many groups as there are rules.
    """
    call = F.row_number().over(Window.partitionBy("contact_id").orderBy("ord"))
    return groups.select(
        "contact_id", call.alias("call"), "eni_source_type", "subtype", "base_tokens",
        "rows_total", "rows_used", (F.lit(budget) - F.col("tokens_used")).alias("remaining"),
        (F.col("base_tokens") + estimate_tokens(F.col("new_data"))).alias("rendered_tokens"))


def build_trace(groups: DataFrame, responses: DataFrame) -> DataFrame:
    """Request, token figures and response of each call as ordered titled sections."""
    name = F.concat("eni_source_type", F.lit("/"), "subtype")
    joined = groups.join(responses, GROUP, "left")
    tokens = F.concat(F.lit("base: "), F.col("base_tokens").cast("string"),
                      F.lit("\nused: "), F.col("tokens_used").cast("string"))
    parts = F.array(
        F.struct(F.concat(F.lit("Request: "), name).alias("title"),
                 F.col("prompt").alias("content")),
        F.struct(F.concat(F.lit("Token Stats: "), name).alias("title"),
                 tokens.alias("content")),
        F.struct(F.concat(F.lit("Response: "), name).alias("title"),
                 F.col("response").alias("content")))
    return (joined.select("contact_id", "ord", F.posexplode(parts).alias("part", "s"))
            .filter(F.col("s.content").isNotNull())
            .select("contact_id", "ord", "part", F.col("s.title").alias("title"),
                    F.col("s.content").alias("content")))


def trace_text(trace: DataFrame) -> DataFrame:
    """The trace of each contact as one text; three sections per group, so it is bounded."""
    section = F.concat(F.lit("\n## "), "title", F.lit("\n\n"), "content", F.lit("\n"))
    return trace.groupBy("contact_id").agg(
        ordered_join([F.col("ord"), F.col("part")], section).alias("body")).select(
        "contact_id", F.concat(F.lit("Trace - Contact "), "contact_id", F.lit("\n\n"),
                               "body").alias("trace"))
