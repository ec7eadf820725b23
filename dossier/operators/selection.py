"""Choosing notes and contacts: predicates, joins against the run log, orders and pages.

Rows of the inventory: P1, P2, P5-P8, P13, P14, J1-J3, A1-A3, W4, W6, W7, O1-O5, U1, S11.
"""
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.operators.ordering import with_position
from dossier.schemas import DEFAULT_GENERATOR, NULL_SUBTYPE


# ---- predicates -------------------------------------------------------------------------

def usable_notes(notes: DataFrame) -> DataFrame:
    """Notes whose description holds something other than white space."""
    return notes.filter(F.col("description").rlike(r"\S"))


def by_type(notes: DataFrame, source_type: str, subtype: str | None = None) -> DataFrame:
    """Strict match on type and subtype; ``null`` asks for a real NULL subtype."""
    out = notes.filter(F.col("eni_source_type") == source_type)
    if subtype is None:
        return out
    sub = F.col("eni_source_subtype")
    return out.filter(sub.isNull() if subtype == NULL_SUBTYPE else sub == subtype)


def processed_ids(log: DataFrame, statuses: tuple[str, ...] = ("completed", "skipped"),
                  contact: str | None = None) -> DataFrame:
    """P5: distinct ids of logged notes in one of the given states."""
    out = log.filter(F.col("processing_status").isin(*statuses))
    if contact is not None:
        out = out.filter(F.col("contact_id") == contact)
    return out.select("eni_id").distinct()


def log_for(log: DataFrame, prompt_key: str, generator: str) -> DataFrame:
    """Log rows of one prompt and generator."""
    return log.filter((F.col("processor_system_prompt_key") == prompt_key)
                      & (F.col("processor_generator") == generator))


def due(df: DataFrame, cutoff: datetime) -> DataFrame:
    """Never processed, or last processed before the cut-off."""
    last = F.col("last_processed_at")
    return df.filter(last.isNull() | (last < F.lit(cutoff)))


def due_in_list(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Listed contacts that were never processed."""
    return in_list(df.filter(F.col("last_processed_at").isNull()), ids)


def valid_contact_id(c: Column) -> Column:
    """``CNT-`` and at least six letters or digits; NULL is not valid."""
    return F.coalesce(c.rlike(r"^CNT-[A-Za-z0-9]{6,}$"), F.lit(False))


def non_null(df: DataFrame, key: str) -> DataFrame:
    """Rows that have the key."""
    return df.filter(F.col(key).isNotNull())


# ---- joins ------------------------------------------------------------------------------

def unprocessed(notes: DataFrame, log: DataFrame) -> DataFrame:
    """Notes without a ``completed`` log row for their id.

    The log side is reduced to its distinct ids first, so a note that was logged many times
    costs one row in the shuffle.  NULL ids never match and stay.
    """
    return notes.join(processed_ids(log, ("completed",)), "eni_id", "left_anti")


def last_processed(log: DataFrame, prompt_key: str | None = None, generator: str | None = None,
                   statuses: tuple[str, ...] = ("completed",)) -> DataFrame:
    """A3: time of the last log row per contact, of the given states, prompt and generator."""
    rows = log.filter(F.col("processing_status").isin(*statuses))
    if prompt_key is not None:
        rows = log_for(rows, prompt_key, generator or DEFAULT_GENERATOR)
    return rows.groupBy("contact_id").agg(F.max("processed_at").alias("last_processed_at"))


def contact_last_processed(notes: DataFrame, log: DataFrame, prompt_key: str | None = None,
                           generator: str | None = None) -> DataFrame:
    """Contacts with usable notes and when they were last processed."""
    contacts = distinct_keys(non_null(usable_notes(notes), "contact_id"), ["contact_id"])
    return contacts.join(last_processed(log, prompt_key, generator), "contact_id", "left")


def prioritized_contacts(notes: DataFrame, log: DataFrame, cutoff: datetime, prompt_key: str,
                         generator: str = DEFAULT_GENERATOR, limit: int | None = None,
                         offset: int = 0) -> DataFrame:
    """J2, P7, O2 and O3 in one: contacts that are due, in selection order, or a page of them."""
    waiting = due(contact_last_processed(notes, log, prompt_key, generator), cutoff)
    return selection_page(waiting, limit, offset)


def in_list(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose contact is in the list."""
    return df.join(ids.select("contact_id"), "contact_id", "left_semi")


def distinct_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct combinations of the given columns."""
    return df.select(*cols).distinct()


# ---- counts -----------------------------------------------------------------------------

def contact_counts(notes: DataFrame, n: int) -> DataFrame:
    """A1: contacts with the most usable notes, ties by id."""
    counts = (non_null(usable_notes(notes), "contact_id").groupBy("contact_id")
              .agg(F.count(F.lit(1)).alias("record_count")))
    return counts.orderBy(F.desc("record_count"), "contact_id").limit(n)


def type_counts(notes: DataFrame) -> DataFrame:
    """A2: notes per type and subtype; a NULL subtype is a group of its own."""
    return (non_null(notes, "eni_source_type").groupBy("eni_source_type", "eni_source_subtype")
            .agg(F.count(F.lit(1)).alias("record_count")))


# ---- orders, pages, waves ---------------------------------------------------------------

def newest_first(notes: DataFrame) -> DataFrame:
    """O1: newest first, notes without a date last, ties by id."""
    return notes.orderBy(F.desc_nulls_last("logged_date"), "eni_id")


def selection_order(df: DataFrame) -> DataFrame:
    """O2: never processed first, then the longest ago, then by id; frozen, with ``pos``."""
    return with_position(df, [F.asc_nulls_first("last_processed_at"), F.asc("contact_id")])


def selection_page(df: DataFrame, limit: int | None = None, offset: int = 0) -> DataFrame:
    """O2 + O3: one page of the selection order, without numbering the whole table."""
    ordered = df.orderBy(F.asc_nulls_first("last_processed_at"), "contact_id")
    return page(ordered, limit, offset)


def page(df: DataFrame, limit: int | None = None, offset: int | None = None) -> DataFrame:
    """O3: LIMIT and OFFSET over rows that already have a total order.

    With a limit this is a top-k per task.  An offset alone would pull all rows through one
    task, so there the rows are numbered by partition and filtered.
    """
    if limit is not None:
        return (df.offset(offset) if offset else df).limit(limit)
    if offset:
        return with_position(df, name="_pos").filter(F.col("_pos") > offset).drop("_pos")
    return df


def list_page(df: DataFrame, column: str, ascending: bool, limit: int | None,
              offset: int = 0, tie: tuple[str, ...] = ("contact_id",)) -> DataFrame:
    """A page in the caller's order; ``tie`` makes the order total."""
    first = F.asc_nulls_last(column) if ascending else F.desc_nulls_last(column)
    return page(df.orderBy(first, *tie), limit, offset)


def most_recent(df: DataFrame, key: str = "contact_id", time: str = "updated_at",
                tie: str = "version") -> DataFrame:
    """The row with the latest time per key.

    An aggregate, not a window: partial results are merged before the shuffle, so a key with
    very many rows sends one row per task.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    best = F.max_by(row, F.struct(F.col(time), F.col(tie)))
    return df.groupBy(key).agg(best.alias("_r")).select("_r.*")


def dedup_ordered(df: DataFrame, key: str = "contact_id", pos: str = "pos") -> DataFrame:
    """First occurrence of each key, at the position it had."""
    return df.groupBy(key).agg(F.min(pos).alias(pos))


def last_n(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The last ``n`` rows in the given order (a top-n, never a full sort in one task)."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def waves(selection: DataFrame, size: int) -> DataFrame:
    """Batches of ``size`` contacts over one frozen selection (``pos`` starts at 1)."""
    return selection.withColumn("wave", F.floor((F.col("pos") - 1) / size))


def select_contacts_sql(spark: SparkSession, sql: str, variables: dict[str, str],
                        limit: int | None = None, offset: int | None = None) -> DataFrame:
    """Contacts chosen by the caller's SQL, which names its variables as ``:name``.

    LIMIT and OFFSET are added to the text where its outermost query has none; those of inner
    queries do not count.  So a text with LIMIT and an ``offset`` skip first and limit then.
    Ids become text, empty ones are dropped and the first occurrence of each keeps its place.
    The position is that of the result: where the SQL ends in ORDER BY its rows come as one
    range-sorted table.
    """
    text = sql.strip().rstrip(";")
    own = _own_bounds(spark, text)
    behind = [f"LIMIT {int(limit)}"] if limit is not None and not own else []
    behind += [f"OFFSET {int(offset)}"] if offset and "Offset" not in own else []
    chosen = spark.sql("\n".join([text, *behind]), args=variables).select(F.col("contact_id").cast("string"))
    if limit is not None and own == {"Offset"}:  # SQL takes no LIMIT behind an OFFSET
        chosen = chosen.limit(limit)
    # partitions of a sorted result follow its order, so this id does too
    placed = chosen.withColumn("pos", F.monotonically_increasing_id())
    return dedup_ordered(placed.filter(F.col("contact_id") != ""))


def _own_bounds(spark: SparkSession, sql: str) -> set[str]:
    """Which of Limit and Offset the outermost query of a text has, as Spark parses it."""
    node, found = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql), set()
    while (kind := node.getClass().getSimpleName()) in ("UnresolvedWith", "GlobalLimit", "LocalLimit", "Offset"):
        if kind != "UnresolvedWith":
            found.add(kind.removeprefix("Global").removeprefix("Local"))
        node = node.child()
    return found
