"""The logical tables of this package, derived from the given tables.

Every binding is one list of expressions that Spark and DuckDB both read, so a query and its
oracle see the same rows.  Bindings derive values; they never leave rows or parts of texts out.
"""
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from dossier.operators.rules import rules_frame
from dossier.sources.local import local_frame
from dossier.sources.tables import read_table

NL = "chr(10)"
TICKS = "'```'"


def pad(x: str, n: int) -> str:
    return f"lpad(cast({x} AS varchar(20)), {n}, '0')"


def cnt(x: str) -> str:
    return f"concat('CNT-', {pad(x, 6)})"


def eni(x: str) -> str:
    return f"concat('ENI-', {pad(x, 8)})"


def esc(x: str) -> str:
    """A text as it stands between the quotes of a JSON string."""
    b = "chr(92)"
    return (f"replace(replace(replace({x}, {b}, concat({b}, {b})), '\"', concat({b}, '\"')), "
            f"chr(10), concat({b}, 'n'))")


def at(seconds: str) -> str:
    return f"(TIMESTAMP '2024-01-01 00:00:00' + ({seconds}) * INTERVAL '1' SECOND)"


_PERSONAL = (f"CASE role WHEN 'user' THEN concat('- ', text, {NL}, '  * [N/A,', {eni('conv_id')}, "
             f"',click]', {NL}) WHEN 'assistant' THEN '' END")
_RESPONSE = f"""CASE doc_id % 11
  WHEN 0 THEN concat({TICKS}, 'json', {NL}, '{{"personal": "', {esc('text')}, '", "3i": "x"}}', {NL}, {TICKS})
  WHEN 1 THEN concat('{{"business": "', {esc('text')}, '", "deals": null, "other": 1}}')
  WHEN 2 THEN concat('Here it is:', {NL}, {TICKS}, {NL}, '{{"investing": "', {esc('text')}, '"}}', {NL}, {TICKS})
  WHEN 3 THEN concat('## Personal', {NL}, text, {NL}, {NL}, '## 3i', {NL}, '- x', {NL}, '## Deals', {NL}, lang)
  WHEN 4 THEN concat({TICKS}, 'json', {NL}, '{{"personal": ', text, {NL}, {TICKS})
  WHEN 5 THEN concat('{{"existing_member_summary": "## Business', chr(92), 'n', {esc('text')}, '"}}')
  WHEN 6 THEN text
  WHEN 7 THEN concat('["', {esc('text')}, '"]')
  WHEN 8 THEN concat('{{"personal": ', cast(n_chars AS varchar(20)), '}}')
  WHEN 9 THEN concat('{{"personal": "  "}}', {NL})
  ELSE '' END"""

_DOC = f"""CASE doc_id % 9
  WHEN 0 THEN concat('{{"metadata": {{"contact_id": "', {cnt('doc_id')}, '", "eni_id": "', {eni('doc_id')}, '", "generator": "g1", "record_count": 3, "eni_source_types": ["click", "view"]}}, "insights": {{"personal": "', {esc('text')}, '"}}}}')
  WHEN 1 THEN concat('{{"contactId": "', {cnt('doc_id')}, '", "content": {{"deals": "', {esc('text')}, '", "3i": "n"}}, "record_count": 0, "metadata": {{"record_count": 7, "version": 4}}}}')
  WHEN 2 THEN concat('{{"Contact_ID": "', {cnt('doc_id')}, '", "personal": "', {esc('text')}, '", "member_name": "', lang, '", "eni_id": "", "metadata": {{"eni_id": "', {eni('doc_id')}, '"}}}}')
  WHEN 3 THEN concat('{{"insights": {{"personal": "', {esc('text')}, '"}}}}')
  WHEN 4 THEN concat('{{"contact_id": "', {cnt('doc_id')}, '", "insights": ', text)
  WHEN 5 THEN concat('{{"contact_id": "X', cast(doc_id AS varchar(20)), '", "eni_id": "', {eni('doc_id')}, '", "insights": {{"three_i": "', {esc('text')}, '"}}, "total_eni_ids": 0, "metadata": {{"total_eni_ids": 0}}}}')
  WHEN 6 THEN concat('{{"contact_id": "', {cnt('doc_id')}, '", "insights": {{"personal": 4}}}}')
  WHEN 7 THEN concat('{{"metadata": {{"contact_id": "', {cnt('doc_id')}, '", "processing_status": "odd", "generated_at": "2024-01-01"}}, "insights": {{"raw_content": "', {esc('text')}, '"}}}}')
  ELSE concat('["', {esc('text')}, '"]') END"""

# name -> (given table, expressions)
BINDINGS: dict[str, tuple[str, list[str]]] = {
    "notes": ("events", [
        f"{eni('event_id')} AS eni_id", f"{cnt('user_id')} AS contact_id",
        "event_type AS eni_source_type",
        "CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN 'NaN' "
        "WHEN 4 THEN 'other' WHEN 5 THEN 'biography' ELSE 'sector' END AS eni_source_subtype",
        "CASE event_id % 11 WHEN 0 THEN NULL WHEN 1 THEN '   ' ELSE concat('note ', props) END "
        "AS description",
        "CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS logged_date"]),
    "run_log": ("orders", [
        f"{eni('o_orderkey')} AS eni_id", f"{cnt('o_custkey')} AS contact_id",
        "CAST(o_orderdate AS timestamp) AS processed_at",
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed' ELSE 'skipped' END "
        "AS processing_status",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'structured_insight' ELSE 'member_summary' END "
        "AS processor_system_prompt_key",
        "'structured_insight' AS processor_generator",
        "CAST(floor(o_totalprice) AS bigint) AS processing_duration_ms",
        "o_orderkey AS pos"]),
    # long texts without a date: the whole group falls on one "day"
    "doc_notes": ("documents", [
        f"{eni('doc_id')} AS eni_id",
        "concat('CNT-', lpad(substr(source, 4), 6, '0')) AS contact_id", "'view' AS eni_source_type",
        "lang AS subtype", "text AS description", "CAST(NULL AS date) AS logged_date"]),
    "profiles": ("conversations", [
        f"{cnt('conv_id')} AS contact_id",
        f"concat('COMBINED-', {cnt('conv_id')}, '-ALL') AS eni_id",
        "CASE WHEN conv_id % 5 = 0 THEN 'member_summary' ELSE 'structured_insight' END AS generator",
        "CAST(turn + 1 AS int) AS version",
        "CASE role WHEN 'system' THEN 'failed' ELSE 'completed' END AS processing_status",
        "CASE role WHEN 'user' THEN 'click' WHEN 'assistant' THEN 'view' ELSE 'purchase' END "
        "AS source_type",
        "CASE turn % 3 WHEN 0 THEN 'null' WHEN 1 THEN 'biography' ELSE 'sector' END AS source_subtype",
        "CAST(turn + 1 AS int) AS record_count", "CAST(turn % 2 + 1 AS int) AS total_eni_ids",
        f"{at('conv_id * 60 + turn * 3600')} AS updated_at",
        f"{_PERSONAL} AS personal",
        "CASE role WHEN 'assistant' THEN concat('- ', text) END AS business",
        f"CASE role WHEN 'system' THEN concat(text, {NL}, '  * [2024-01-01,ENI-1,view]', {NL}, "
        f"'  * [2024-02-01, ENI-2 ]', {NL}, '  * [open') END AS investing",
        f"CASE WHEN turn % 2 = 1 THEN concat('  * plain sub bullet', {NL}, text) END AS three_i",
        "CASE role WHEN 'user' THEN '' WHEN 'assistant' THEN text END AS deals",
        f"CASE WHEN turn % 3 = 0 THEN concat('  * [N/A,ENI-3]', {NL}, text) END AS introductions"]),
    "responses": ("documents", [
        f"{cnt('doc_id')} AS contact_id", "doc_id AS ord", f"{_RESPONSE} AS response"]),
    "docs": ("documents", [
        "doc_id AS ord", f"concat({cnt('doc_id')}, '_', {eni('doc_id')}, '.json') AS name",
        f"{_DOC} AS doc"]),
    "master": ("customer", [
        f"{cnt('c_custkey')} AS contact_id",
        f"CASE WHEN c_acctbal >= 0 THEN concat('rec', {pad('c_custkey', 9)}) END AS record_id"]),
    "results": ("orders", [
        f"{cnt('o_custkey')} AS contact_id", "o_orderkey AS ord", "o_orderstatus <> 'O' AS success",
        "CASE o_orderstatus WHEN 'F' THEN 'created' WHEN 'P' THEN 'skipped' ELSE 'failed' END "
        "AS action", "o_orderkey % 3 = 0 AS was_created",
        "CAST(o_orderdate AS timestamp) AS synced_at",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'skipped_due_to_claim' WHEN '2-HIGH' THEN "
        "'no data, skipped' WHEN '3-MEDIUM' THEN 'failed call' END AS error",
        "o_orderkey % 10 AS notes_processed", "o_orderkey % 3 AS files_created",
        "o_orderkey % 2 AS records_published", "o_orderkey % 4 AS token_loss_events",
        "o_orderkey % 5 AS token_loss_groups_skipped",
        "o_orderkey % 6 AS token_loss_records_skipped"]),
    "run_events": ("events", [
        f"{cnt('user_id')} AS contact_id",
        "CASE event_type WHEN 'click' THEN 'group' WHEN 'view' THEN 'call' WHEN 'purchase' THEN "
        "'contact' WHEN 'error' THEN 'error' ELSE CASE event_id % 3 WHEN 0 THEN 'file' WHEN 1 THEN "
        "'publish' ELSE 'filter' END END AS stage",
        "event_id % 4 <> 0 AS success", "event_id % 10 AS records", "value AS seconds",
        "event_type AS eni_source_type",
        "CASE event_id % 2 WHEN 0 THEN 'null' ELSE 'biography' END AS subtype",
        "ts AS happened_at", "event_id AS event_id"]),
    "legacy": ("lineitem", [
        f"{cnt('l_suppkey')} AS contact_id", f"{eni('l_orderkey')} AS eni_id"]),
    "ids": ("documents", [
        "doc_id AS ord",
        "CASE doc_id % 6 WHEN 0 THEN " + cnt("doc_id") + " WHEN 1 THEN 'CNT-' WHEN 2 THEN "
        "concat('cnt-', lang) WHEN 3 THEN '' WHEN 4 THEN NULL ELSE concat('CNT-aB', source, 'xyz') "
        "END AS contact_id"]),
}

# Rules and context of the checks: settings, as a caller would give them.
RULE_MAP = {"click": ["biography", "sector"], "view": None, "purchase": ["sector"],
            "refund": ["late"]}
RULE_ROWS = [("click", "null", 0), ("click", "biography", 1), ("click", "sector", 2),
             ("view", "null", 3), ("purchase", "null", 4), ("purchase", "sector", 5),
             ("refund", "null", 6), ("refund", "late", 7)]
CONTEXT_ROWS = [("click", "default", "c/click/default.md", "Clicks made by the contact."),
                ("click", "biography", "c/click/biography.md", "Clicks on biography pages."),
                ("click", "sector", "c/click/default.md", "Clicks on sector pages."),
                ("view", "default", "c/view/default.md", "Pages seen."),
                ("view", "null", "c/view/plain.md", "Plain views."),
                ("purchase", "sector", "c/purchase/sector.md", "Bought by sector.")]

CONTEXT = StructType([StructField(c, StringType()) for c in ("type", "subtype", "path", "content")])


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet")


def frame(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A logical table as a DataFrame."""
    if name == "rules":
        return rules_frame(spark, RULE_MAP)
    if name == "context":
        return local_frame(spark, CONTEXT_ROWS, CONTEXT)
    source, exprs = BINDINGS[name]
    return table(spark, sf, source).selectExpr(*exprs)


def _values(rows: list[tuple], cols: str) -> str:
    def lit(v: object) -> str:
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({cols}))"


def cte(*names: str) -> str:
    """The same logical tables as the start of a WITH clause."""
    parts = []
    for name in names:
        if name == "rules":
            body = _values(RULE_ROWS, "eni_source_type, subtype, ord")
        elif name == "context":
            body = _values(CONTEXT_ROWS, "type, subtype, path, content")
        else:
            source, exprs = BINDINGS[name]
            body = f"(SELECT {', '.join(exprs)} FROM {source})"
        parts.append(f"{name} AS {body}")
    return "WITH " + ",\n".join(parts)
