"""Registry of queries and their DuckDB oracles."""
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.bindings import cte

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, tables: str = "", sql: str | None = None,
          more: str = "") -> Callable[[Query], Query]:
    """Register a query; ``tables`` names the bindings its oracle reads, ``more`` adds CTEs."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            head = cte(*tables.split()) if tables else ""
            if more:
                head = f"{head},\n{more}" if head else f"WITH {more}"
            ORACLES[name] = f"{head}\n{sql}".strip()
        return fn

    return add


# ---- fragments of oracle SQL ------------------------------------------------------------

SECTIONS = ("personal", "business", "investing", "three_i", "deals", "introductions")
HEADINGS = ("Personal", "Business", "Investing", "3i", "Deals", "Introductions")


def ns(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR NOT regexp_matches({x}, '\\S') OR lower({x}) IN "
            f"('none', 'nan', 'nat') THEN 'null' ELSE {x} END")


def tok(x: str) -> str:
    return (f"CASE WHEN coalesce(length({x}), 0) = 0 THEN 0 "
            f"ELSE greatest(1, length({x}) // 4) END")


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


ENTRY = (f"concat('- ', {strip('description')}, chr(10), '  * [', "
         "coalesce(CAST(logged_date AS varchar), 'N/A'), ',', eni_id, ',', eni_source_type, ']', "
         "chr(10))")

PENDING = f"""pending AS (
  SELECT n.eni_id, n.contact_id, n.eni_source_type, r.subtype, r.ord, n.description, n.logged_date,
         {ENTRY.replace('eni_id', 'n.eni_id').replace('eni_source_type', 'n.eni_source_type')} AS entry
  FROM notes n JOIN rules r ON r.eni_source_type = n.eni_source_type
   AND r.subtype = {ns('n.eni_source_subtype')}
  LEFT JOIN (SELECT DISTINCT eni_id FROM run_log WHERE processing_status = 'completed') l
    ON l.eni_id = n.eni_id
  WHERE l.eni_id IS NULL AND regexp_matches(n.description, '\\S'))"""


def cut(source: str, budget: str, name: str = "kept") -> str:
    """CTEs ``sized`` and ``kept``: the greedy cut as one running sum."""
    return f"""sized AS (SELECT *, {tok('entry')} AS tokens FROM {source}),
ranked AS (SELECT *, sum(tokens) OVER (PARTITION BY contact_id, eni_source_type, subtype
    ORDER BY logged_date DESC NULLS LAST, eni_id ROWS UNBOUNDED PRECEDING) AS upto FROM sized),
{name} AS (SELECT * FROM ranked WHERE upto <= {budget})"""


def heading(x: str, name: str) -> str:
    found = f"regexp_extract(concat(chr(10), {x}), '\\n## {name}\\n((?s:.*?))(?:\\n## |$)', 1)"
    return strip(found)


def headings(x: str) -> list[str]:
    return [heading(x, h) for h in HEADINGS]


def quoted(x: str) -> str:
    return f"CAST(to_json({x}) AS varchar)"


def profile_json(cols: list[str]) -> str:
    keys = ("personal", "business", "investing", "3i", "deals", "introductions")
    parts = [f"'{'{' if i == 0 else ','}', chr(10), '  \"{k}\": ', {quoted(c)}"
             for i, (k, c) in enumerate(zip(keys, cols))]
    return "concat(" + ", ".join(parts) + ", chr(10), '}')"
