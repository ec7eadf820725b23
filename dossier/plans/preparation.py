"""From notes and run log to prompts: the batch run up to generation."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.checkpoints import freeze
from dossier.functions.prompts import available_tokens
from dossier.operators.budget import (GROUP, cut_written, group_blocks, group_stats,
                                      with_base_tokens, with_context, with_entries, with_profile,
                                      with_prompt)
from dossier.operators.rules import assign_groups
from dossier.operators.selection import non_null, unprocessed, usable_notes

#: The number of a pending note's row, which tells rows of one id apart.
NOTE_ROW = "note_row"
#: The tokens of a pending note's entry, worked out where the note was written.
NOTE_TOKENS = "note_tokens"


def pending_notes(notes: DataFrame, log: DataFrame, rules: DataFrame,
                  types: list[str] | None = None) -> DataFrame:
    """Usable, unprocessed notes of a contact, with their group.

    The only shuffle is the anti-join with the log.  Spark moves an anti-join below the join
    with the rules, so give ``types``, the configured types, where the caller has them: that is
    a plain filter, which reaches the scan and keeps notes of other types out of the shuffle.
    """
    usable = non_null(usable_notes(notes), "contact_id")
    if types is not None:
        usable = usable.filter(F.col("eni_source_type").isin(types))
    return unprocessed(assign_groups(usable, rules), log)


def budget_plan(notes: DataFrame, log: DataFrame, rules: DataFrame, budget: int,
                types: list[str] | None = None) -> DataFrame:
    """For every contact and source group: how many unprocessed notes fit the budget."""
    return group_stats(with_entries(pending_notes(notes, log, rules, types)), budget)


def group_frame(pending: DataFrame) -> DataFrame:
    """One row per (contact, type, subtype) with its rule order and number of notes."""
    return pending.groupBy(*GROUP).agg(F.min("ord").alias("ord"),
                                       F.count(F.lit(1)).alias("rows_total"))


def with_room(groups: DataFrame, context: DataFrame, latest: DataFrame, template: str, window: int,
              reserve: int, cap: int) -> DataFrame:
    """Groups with the parts of their prompt and ``budget``, the room it leaves for notes."""
    dressed = with_base_tokens(with_profile(with_context(groups, context), latest), template)
    return dressed.withColumn("budget", available_tokens(F.col("base_tokens"), window, reserve, cap))


def written_notes(pending: DataFrame) -> DataFrame:
    """The pending notes, written once with a number for each row and the tokens of its entry."""
    sized = with_entries(pending).withColumnRenamed("tokens", NOTE_TOKENS)
    return freeze(sized.select(*pending.columns, NOTE_TOKENS).withColumn(NOTE_ROW, F.monotonically_increasing_id()))


def _sized(pending: DataFrame, dressed: DataFrame) -> DataFrame:
    """Ids, days and tokens of the notes beside their group's room; no text."""
    number = [NOTE_ROW] if NOTE_ROW in pending.columns else []
    tokens = pending.withColumn("tokens", F.col(NOTE_TOKENS)) if NOTE_TOKENS in pending.columns else with_entries(pending)
    slim = tokens.select(*GROUP, "logged_date", "eni_id", "tokens", *number)
    return slim.join(dressed.select(*GROUP, "budget"), GROUP)


def _larger(sized: DataFrame) -> DataFrame:
    return sized.filter(F.col("tokens") > F.col("budget")).drop(NOTE_ROW)


def oversized_notes(pending: DataFrame, dressed: DataFrame) -> DataFrame:
    """Notes that are larger than their group's whole room, and so can never be in a prompt."""
    return _larger(_sized(pending, dressed))


def prepare_prompts(pending: DataFrame, dressed: DataFrame, template: str, window: int, reserve: int,
                    cap: int) -> DataFrame:
    """Prompts of the groups of :func:`with_room`, with the ids of the notes that went into them.

    ``pending`` holds the notes of those groups, with the number NOTE_ROW of each row where they
    are written already; else they are numbered and written here.  The cut looks at ids and tokens
    only; the texts of the notes that fit, which the budget bounds, are joined back by that
    number, so rows that repeat an id, or have none, are notes of their own.  A note that is
    larger than the room is passed over, see :func:`oversized_notes`, so that it does not keep
    the notes behind it waiting.
    """
    return prompts_and_oversized(pending, dressed, template, window, reserve, cap)[0]


def prompts_and_oversized(pending: DataFrame, dressed: DataFrame, template: str, window: int, reserve: int,
                          cap: int) -> tuple[DataFrame, DataFrame]:
    """:func:`prepare_prompts` and :func:`oversized_notes`, for which the notes meet their group's room one time."""
    if NOTE_ROW not in pending.columns:
        pending = written_notes(pending)
    sized = freeze(_sized(pending, dressed))
    kept = cut_written(sized.filter(F.col("tokens") <= F.col("budget")), "budget")
    texts = with_entries(pending).select(NOTE_ROW, "entry")
    blocks = group_blocks(kept.join(texts, NOTE_ROW))
    full = (dressed.drop("budget").join(blocks, GROUP, "left")
            .withColumns({"new_data": F.coalesce("new_data", F.lit("")),
                          "rows_used": F.coalesce("rows_used", F.lit(0)),
                          "tokens_used": F.coalesce("tokens_used", F.lit(0))}))
    return with_prompt(full, template, window, reserve, cap), _larger(sized)
