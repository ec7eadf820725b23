"""Text functions over whole texts."""
from pyspark.sql import functions as F

from checks import grouping
from checks.bindings import frame, table
from checks.registry import (PENDING, SECTIONS, check, cut, headings, ns, profile_json,
                             quoted, strip, tok)
from dossier.functions import prompts, responses, sections, text
from dossier.operators import budget
from dossier.operators.budget import GROUP
from dossier.plans import preparation
from dossier.sinks import builders
from dossier.sources.files import split_front_matter

NAMES = ", ".join(SECTIONS)


def profiles(spark, sf):
    return frame(spark, sf, "profiles").withColumn("sections", F.struct(*SECTIONS))


@check("f1_estimate_tokens", "", f"SELECT doc_id, {tok('text')} AS tokens FROM documents")
def f1(spark, sf):
    """F1"""
    return table(spark, sf, "documents").select(
        "doc_id", text.estimate_tokens(F.col("text")).alias("tokens"))


@check("f2_render_nested", "",
       "SELECT conv_id, turn, concat('[', text, '|', role, '|', text, '|', role, '-', text, ']') AS out "
       "FROM conversations")
def f2(spark, sf):
    """a value with a later placeholder is expanded, one with an earlier one is not."""
    nested = F.concat(F.lit("{{b}}-"), "text")
    out = text.render(F.lit("[{{c}}|{{b}}|{{c}}|{{a}}]"),
                      [("a", nested), ("b", F.col("role")), ("c", F.col("text")),
                       ("d", F.lit(None).cast("string"))])
    return table(spark, sf, "conversations").select("conv_id", "turn", out.alias("out"))


@check("f3_norm_subtype", "notes", f"SELECT eni_id, {ns('eni_source_subtype')} AS subtype FROM notes")
def f3(spark, sf):
    """F3"""
    return frame(spark, sf, "notes").select(
        "eni_id", text.norm_subtype(F.col("eni_source_subtype")).alias("subtype"))


@check("f4_date_text", "notes",
       "SELECT eni_id, coalesce(CAST(logged_date AS varchar), 'N/A') AS shown, CASE WHEN eni_source_subtype IS NULL OR "
       "trim(eni_source_subtype) = '' OR lower(trim(eni_source_subtype)) IN ('nan', 'nat', 'none', 'null') THEN 'N/A' "
       "ELSE trim(eni_source_subtype) END AS from_text FROM notes")
def f4(spark, sf):
    """F4 on dates, and on text with the missing spellings"""
    return frame(spark, sf, "notes").select(
        "eni_id", text.date_text(F.col("logged_date")).alias("shown"),
        text.date_text(F.col("eni_source_subtype")).alias("from_text"))


LONG = "concat_ws(chr(10), " + ", ".join(SECTIONS) + ")"


@check("f7_citations", "profiles",
       "SELECT contact_id, version, nullif(trim(d), 'N/A') AS cited_date, trim(split_part(r, ',', 1)) AS eni_id, "
       "nullif(trim(split_part(r, ',', 2)), '') AS source_type FROM (SELECT contact_id, version, "
       f"unnest(regexp_extract_all({LONG}, '\\[([^,\\]]+),([^\\]]+)\\]', 1)) AS d, "
       f"unnest(regexp_extract_all({LONG}, '\\[([^,\\]]+),([^\\]]+)\\]', 2)) AS r FROM profiles)")
def f7(spark, sf):
    """two- and three-part citations"""
    c = sections.citations(F.concat_ws("\n", *SECTIONS))
    return frame(spark, sf, "profiles").select("contact_id", "version", F.explode(c).alias("c")).select(
        "contact_id", "version", "c.*")


# ---- responses --------------------------------------------------------------------------

def json_sections(v: str) -> list[str]:
    out = []
    for s in SECTIONS:
        if s == "three_i":
            out.append(f"coalesce(json_extract_string({v}, '$.\"3i\"'), json_extract_string({v}, '$.three_i'))")
        else:
            out.append(f"json_extract_string({v}, '$.{s}')")
    return out


def all_text(v: str) -> str:
    keys = [*SECTIONS, '"3i"']
    return " AND ".join(f"coalesce(json_type({v}, '$.{k}'), 'NULL') IN ('VARCHAR', 'NULL')" for k in keys)


def accepted(v: str) -> list[str]:
    wrap = f"json_extract_string({v}, '$.existing_member_summary')"
    kind = f"coalesce(json_type({v}, '$.existing_member_summary'), '-')"
    plain = f"json_type({v}) = 'OBJECT' AND {all_text(v)}"
    return [f"CASE WHEN {kind} IN ('VARCHAR', 'NULL') THEN coalesce({h}, '') WHEN {kind} = '-' AND {plain} "
            f"THEN {j} END" for h, j in zip(headings(wrap), json_sections(v))]


def readable(v: str) -> str:
    kind = f"coalesce(json_type({v}, '$.existing_member_summary'), '-')"
    return (f"coalesce({v} IS NOT NULL AND json_type({v}) = 'OBJECT' AND ({kind} IN ('VARCHAR', 'NULL') OR "
            f"({kind} = '-' AND {all_text(v)})), false)")


def _cols(exprs: list[str], prefix: str) -> str:
    return ", ".join(f"{e} AS {prefix}{s}" for e, s in zip(exprs, SECTIONS))


def _pick(prefix: str) -> list[str]:
    return [prefix + s for s in SECTIONS]


def _blank(cols: list[str]) -> str:
    return " AND ".join(f"coalesce(trim({c}, concat(' ', chr(10), chr(9))), '') = ''" for c in cols)


F8_SQL = f"""fences AS (SELECT *, regexp_matches(response, '(?s)```json\\s*(.*?)\\s*```') AS fenced,
  regexp_extract(response, '(?s)```json\\s*(.*?)\\s*```', 1) AS inner_json,
  regexp_extract(response, '(?s)```\\s*(.*?)\\s*```', 1) AS inner_any FROM responses),
tries AS (SELECT *, TRY_CAST(CASE WHEN fenced THEN inner_json ELSE response END AS json) AS v1,
  TRY_CAST(CASE WHEN NOT fenced THEN inner_any END AS json) AS v2 FROM fences),
read AS (SELECT *, {readable('v1')} AS ok1, {readable('v2')} AS ok2, {_cols(accepted('v1'), 'a_')},
  {_cols(accepted('v2'), 'b_')}, {_cols(headings('response'), 'h_')} FROM tries),
first AS (SELECT *, CASE WHEN ok1 THEN 'a' WHEN fenced THEN NULL WHEN ok2 THEN 'b' ELSE 'h' END AS way FROM read),
retry AS (SELECT *, CASE WHEN way = 'a' AND ({_blank(_pick('a_'))}) AND NOT ({_blank(_pick('h_'))}) THEN 'h'
  WHEN way = 'b' AND ({_blank(_pick('b_'))}) AND NOT ({_blank(_pick('h_'))}) THEN 'h' ELSE way END AS final FROM first),
parsed AS (SELECT contact_id, ord, response, CAST(response <> '' AND final IS NOT NULL AS int) AS readable, {", ".join(
    f"CASE WHEN response = '' THEN NULL WHEN final = 'a' THEN a_{s} WHEN final = 'b' THEN b_{s} WHEN final = 'h' THEN h_{s} END AS {s}"
    for s in SECTIONS)} FROM retry)"""


@check("f8_parse_response", "responses", f"SELECT ord, readable, {NAMES} FROM parsed", F8_SQL)
def f8(spark, sf):
    """F8 over all response shapes"""
    df = responses.parse_response(frame(spark, sf, "responses"))
    return df.select("ord", F.col("sections").isNotNull().cast("int").alias("readable"), *[F.col("sections")[s].alias(s) for s in SECTIONS])


def _simple(tail: str) -> str:
    v = "coalesce(CASE WHEN CAST(vb AS varchar) NOT IN ('{}', '[]') THEN vb END, vw)" if tail == "raw" else \
        "CASE WHEN fenced THEN vb ELSE vw END"
    pick = {"raw": "''", "error": "NULL", "blank": "''"}[tail]
    ok = f"(coalesce(json_type(v) = 'OBJECT', false) AND {all_text('v')})"
    if tail == "blank":
        cols = ", ".join(f"CASE WHEN {ok} THEN {j} ELSE '' END AS {s}" for j, s in zip(json_sections("v"), SECTIONS))
        extra = ""
    else:
        cols = ", ".join(f"CASE WHEN v IS NULL THEN {pick} WHEN {ok} THEN {j} END AS {s}"
                         for j, s in zip(json_sections("v"), SECTIONS))
        extra = ", CASE WHEN v IS NULL THEN response END AS raw_content"
    return (f"SELECT ord, {cols}{extra} FROM (SELECT *, {v} AS v FROM (SELECT *, TRY_CAST(CASE WHEN fenced THEN "
            "inner_json END AS json) AS vb, TRY_CAST(response AS json) AS vw FROM fences))")


FENCES = F8_SQL[:F8_SQL.index(",\ntries AS")]


def _simple_query(tail: str):
    def run(spark, sf):
        df = responses.parse_response_simple(frame(spark, sf, "responses"), tail=tail)
        extra = [] if tail == "blank" else ["raw_content"]
        return df.select("ord", *[F.col("sections")[s].alias(s) for s in SECTIONS], *extra)

    run.__doc__ = f"F9, {tail}"
    return run


for _tail in ("raw", "error", "blank"):
    check(f"f9_parse_simple_{_tail}", "responses", _simple(_tail), FENCES)(_simple_query(_tail))


@check("f10_heading_sections", "",
       "SELECT doc_id, " + ", ".join(f"{e} AS {s}" for e, s in zip(headings("md"), SECTIONS)) + " FROM md",
       "md AS (SELECT doc_id, concat('## Personal', chr(10), text, chr(10), '## Deals', chr(10), '## Business', chr(10), "
       "text, chr(10), '## 3i', chr(10), '  ', lang, chr(10), chr(10)) AS md FROM documents)")
def f10(spark, sf):
    """F10 over whole documents, some of which hold headings of their own"""
    md = F.concat(F.lit("## Personal\n"), "text", F.lit("\n## Deals\n## Business\n"), "text",
                  F.lit("\n## 3i\n  "), "lang", F.lit("\n\n"))
    return table(spark, sf, "documents").select("doc_id", md.alias("md")).select(
        "doc_id", sections.heading_sections("md").alias("s")).select("doc_id", "s.*")


@check("f11_profile_json", "profiles",
       f"SELECT contact_id, version, {profile_json([f'coalesce({s}, {chr(39) * 2})' for s in SECTIONS])} AS doc FROM profiles")
def f11(spark, sf):
    """F11"""
    return profiles(spark, sf).select("contact_id", "version",
                                      sections.profile_json(F.col("sections")).alias("doc"))


@check("f12_all_empty", "profiles",
       f"SELECT contact_id, version, CAST({_blank(list(SECTIONS))} AS int) AS nothing FROM profiles")
def f12(spark, sf):
    """F12"""
    return profiles(spark, sf).select("contact_id", "version", sections.all_empty(
        F.col("sections")).cast("int").alias("nothing"))


# ---- records ----------------------------------------------------------------------------

def _top(name: str) -> str:
    return f"coalesce(nullif(json_extract_string(v, '$.{name}'), ''), json_extract_string(v, '$.metadata.{name}'))"


def _id(p: str) -> str:
    return "coalesce(" + ", ".join(f"json_extract_string(v, '$.{p}{k}')" for k in
                                   ("contact_id", "contactId", "Contact_ID")) + ")"


def _count(name: str) -> str:
    return (f"coalesce(nullif(CAST(json_extract(v, '$.{name}') AS int), 0), "
            f"CAST(json_extract(v, '$.metadata.{name}') AS int), 1)")


RECORDS = f"""loaded AS (SELECT *, TRY_CAST(doc AS json) AS v FROM docs),
body AS (SELECT *, CASE WHEN json_type(v, '$.insights') = 'OBJECT' THEN json_extract(v, '$.insights')
  WHEN json_type(v, '$.content') = 'OBJECT' THEN json_extract(v, '$.content') ELSE v END AS b FROM loaded),
norm AS (SELECT ord, name, doc, coalesce(nullif({_id('')}, ''), {_id('metadata.')}) AS contact_id, {_top('eni_id')} AS eni_id,
  {_top('member_name')} AS member_name, coalesce({_top('generator')}, 'structured_insight') AS generator,
  {_count('record_count')} AS record_count, {_count('total_eni_ids')} AS total_eni_ids,
  coalesce(json_extract_string(v, '$.metadata.processing_status'), 'completed') AS processing_status,
  coalesce(CAST(json_extract(v, '$.metadata.version') AS int), 1) AS version,
  array_to_string(CAST(json_extract(v, '$.metadata.eni_source_types') AS varchar[]), ',') AS types,
  {", ".join(f"CASE WHEN json_type(b) = 'OBJECT' AND {all_text('b')} THEN {j} END AS {s}" for j, s in zip(json_sections('b'), SECTIONS))},
  CASE WHEN v IS NULL OR json_type(v) <> 'OBJECT' THEN 'Invalid JSON'
   WHEN coalesce(coalesce(nullif({_id('')}, ''), {_id('metadata.')}), '') = '' THEN 'Missing contact_id'
   WHEN NOT (json_type(b) = 'OBJECT' AND {all_text('b')}) THEN 'Invalid content format' END AS record_error FROM body)"""


@check("f13_normalize_records", "docs", "SELECT * EXCLUDE (doc, name) FROM norm", RECORDS)
def f13(spark, sf):
    """F13"""
    df = responses.normalize_records(frame(spark, sf, "docs"))
    return df.select("ord", "contact_id", "eni_id", "member_name", "generator", "record_count",
                     "total_eni_ids", "processing_status", "version",
                     F.array_join("eni_source_types", ",").alias("types"), *[F.col("sections")[s].alias(s) for s in SECTIONS], "record_error")


DISPLAY = """array_to_string(list_transform(string_split({x}, chr(10)), lambda l: CASE WHEN starts_with(l, '  * [') THEN
  concat('    ', substr(l, 5)) WHEN starts_with(l, '  *') THEN concat('    • ', substr(l, 5)) ELSE l END), chr(10))"""


def display(x: str) -> str:
    return DISPLAY.replace("{x}", x)


def note_content(prefix: str = "") -> str:
    parts = [f"CASE WHEN {prefix}{s} <> '' THEN concat('**{t}:**', chr(10), {display(prefix + s)}) END"
             for s, t in zip(SECTIONS[:4], ("Personal", "Business", "Investing", "3I"))]
    return "concat_ws(concat(chr(10), chr(10)), " + ", ".join(parts) + ")"


@check("f14_display_markdown", "profiles",
       f"SELECT contact_id, version, {display('investing')} AS a, {display('three_i')} AS b FROM profiles")
def f14(spark, sf):
    """F14"""
    return frame(spark, sf, "profiles").select(
        "contact_id", "version", sections.display_markdown(F.col("investing")).alias("a"),
        sections.display_markdown(F.col("three_i")).alias("b"))


@check("f15_note_content", "profiles", f"SELECT contact_id, version, {note_content()} AS note FROM profiles")
def f15(spark, sf):
    """F15"""
    return profiles(spark, sf).select("contact_id", "version",
                                      sections.note_content(F.col("sections")).alias("note"))


@check("f16_composite_ids", "notes run_log rules",
       "SELECT contact_id, eni_source_type, subtype, concat('COMBINED-', eni_source_type, '-', subtype, '-', contact_id, "
       "'-', n, 'ENI') AS group_id, concat('COMBINED-', contact_id, '-ALL') AS all_id, concat('COMBINED-', contact_id, '-', "
       "n, 'ENI') AS count_id, concat('BATCH-', contact_id) AS batch_id FROM (SELECT contact_id, eni_source_type, subtype, "
       "count(*) AS n FROM pending GROUP BY ALL)", PENDING)
def f16(spark, sf):
    """F16"""
    pending = grouping.pending(spark, sf)
    c, n = F.col("contact_id"), F.col("rows_total")
    return preparation.group_frame(pending).select(
        *GROUP, text.group_id(F.col("eni_source_type"), F.col("subtype"), c, n).alias("group_id"),
        text.contact_all_id(c).alias("all_id"), text.contact_count_id(c, n).alias("count_id"),
        text.batch_id(c).alias("batch_id"))


def matter(rows: list[tuple[str, str, str]], fences: bool = True) -> str:
    out = ["'---'"] if fences else []
    for key, x, kind in rows:
        if kind == "number":
            out.append(f"CASE WHEN {x} IS NULL THEN '{key}: null' ELSE concat('{key}: ', {x}) END")
        else:
            out.append(f"CASE WHEN {x} IS NULL THEN '{key}: null' WHEN contains({x}, chr(10)) OR contains({x}, '\"') OR "
                       f"contains({x}, '''') THEN concat('{key}: |', chr(10), '  ', replace({x}, chr(10), concat(chr(10), "
                       f"'  '))) ELSE concat('{key}: \"', {x}, '\"') END")
    return "concat_ws(chr(10), " + ", ".join(out) + (", '---', '')" if fences else ", '')")


MATTER = [("contact_id", "contact_id", "text"), ("eni_id", "eni_id", "text"),
          ("note", "investing", "text"), ("version", "version", "number")]


def fields():
    return [(k, F.col(c), kind) for k, c, kind in MATTER]


@check("f17_front_matter", "profiles", f"SELECT contact_id, version, {matter(MATTER)} AS head FROM profiles")
def f17(spark, sf):
    """F17"""
    return frame(spark, sf, "profiles").select("contact_id", "version",
                                               prompts.front_matter(fields()).alias("head"))


@check("f18_safe_name", "",
       "SELECT page_id, concat(replace(replace(url, '/', '_'), chr(92), '_'), '_', 'a_b', '.md') AS name, "
       "split_part(replace(replace(url, '/', '_'), chr(92), '_'), '_', 1) AS contact_id FROM pages")
def f18(spark, sf):
    """F18"""
    name = text.safe_name(F.col("url"), F.lit("a\\b"))
    return table(spark, sf, "pages").select("page_id", name.alias("name"),
                                            text.contact_from_name(name).alias("contact_id"))


def _row_json(null_as: str) -> str:
    cols = ("eni_id", "description", "logged_date")
    parts = [f"'{'  {' if i == 0 else ','}', chr(10), '    \"{c}\": ', coalesce({quoted(f'CAST({c} AS varchar)')}, '{null_as}')"
             for i, c in enumerate(cols)]
    return "concat(" + ", ".join(parts) + ", chr(10), '  }')"


def _rows_sql(null_as: str) -> str:
    return (f"SELECT contact_id, eni_source_type, subtype, concat('[', chr(10), string_agg({_row_json(null_as)}, concat(',', "
            "chr(10)) ORDER BY eni_id), chr(10), ']') AS rows FROM kept GROUP BY contact_id, eni_source_type, subtype")


def kept(spark, sf, carry):
    pending = grouping.pending(spark, sf)
    return budget.budget_cut(budget.with_entries(pending), 90, GROUP, carry)


@check("f19_rows_json_null", "notes run_log rules", _rows_sql("null"), PENDING + ",\n" + cut("pending", "90"))
def f19(spark, sf):
    """F19 with null"""
    cols = ["eni_id", "description", "logged_date"]
    return kept(spark, sf, ["description"]).groupBy(*GROUP).agg(
        prompts.rows_json(cols, [F.col("eni_id")]).alias("rows"))


@check("f19_rows_json_na", "notes run_log rules", _rows_sql('"N/A"'), PENDING + ",\n" + cut("pending", "90"))
def f19b(spark, sf):
    """F19 with N/A"""
    cols = ["eni_id", "description", "logged_date"]
    return kept(spark, sf, ["description"]).groupBy(*GROUP).agg(
        prompts.rows_json(cols, [F.col("eni_id")], "N/A").alias("rows"))


@check("f20_rows_text", "notes run_log rules",
       "SELECT contact_id, eni_source_type, subtype, concat('=== ', upper(eni_source_type), CASE WHEN subtype <> 'null' THEN "
       "concat(' / ', upper(subtype)) ELSE '' END, ' ===', chr(10), string_agg(concat('note = ', eni_id, chr(10), 'on = ', "
       "coalesce(CAST(logged_date AS varchar), '?'), chr(10), 'says = ', description), concat(chr(10), chr(10)) "
       "ORDER BY eni_id)) AS body FROM kept GROUP BY contact_id, eni_source_type, subtype",
       PENDING + ",\n" + cut("pending", "90"))
def f20(spark, sf):
    """F20"""
    row = prompts.row_text(F.col("eni_id"), F.col("logged_date"), None, F.col("description"))
    body = text.ordered_join([F.col("eni_id")], row, "\n\n")
    return kept(spark, sf, ["description"]).groupBy(*GROUP).agg(body.alias("b")).select(
        *GROUP, F.concat(prompts.group_header(F.col("eni_source_type"), F.col("subtype")),
                         F.lit("\n"), "b").alias("body"))


_SEP = "concat(chr(10), chr(10))"
_PROMPT_SQL = {
    "numbered": f"concat_ws({_SEP}, concat('SYSTEM PROMPT:', chr(10), role), concat(chr(10), 'CONTEXT INFORMATION:', chr(10), "
                "coalesce(ctx, '')), CASE WHEN role = 'user' THEN concat(chr(10), 'ADDITIONAL CONTEXT:', chr(10), role) END, "
                "concat(chr(10), 'MEMBER DATA:', chr(10), text), concat(chr(10), 'Answer from the information above.'))",
    "plain": f"concat_ws({_SEP}, role, concat('Context Information:', chr(10), coalesce(ctx, '')), concat('Member Data:', chr(10), "
             "text), 'Summarise the member from the prompt, context and data above.')",
    "banner": f"concat_ws({_SEP}, role, CASE WHEN ctx <> '' THEN concat('=== CONTEXT ===', chr(10), ctx) END, "
              "concat('=== MEMBER DATA ===', chr(10), text), 'Answer in the format asked for, using the data above.')",
}


@check("f21_assemble_prompt", "",
       "SELECT conv_id, turn, " + ", ".join(f"{v} AS {k}" for k, v in _PROMPT_SQL.items()) + " FROM (SELECT *, CASE WHEN turn % 2 "
       "= 0 THEN 'context' END AS ctx FROM conversations)")
def f21(spark, sf):
    """F21 in three layouts"""
    df = table(spark, sf, "conversations")
    ctx = F.when(F.col("turn") % 2 == 0, F.lit("context"))
    extra = F.when(F.col("role") == "user", F.col("role"))
    return df.select("conv_id", "turn", *[
        prompts.assemble_prompt(F.col("role"), ctx, F.col("text"), k, extra).alias(k)
        for k in ("numbered", "plain", "banner")])


def _skeleton_sql(x: str) -> str:
    return "'" + x.replace("\n", "' || chr(10) || '") + "'"


@check("f22_with_skeleton", "profiles",
       "SELECT contact_id, version, " + ", ".join(
           f"CASE WHEN coalesce({s}, '') = '' THEN {_skeleton_sql(d)} ELSE {s} END AS {s}" for s, d in zip(
               SECTIONS, ("", "", "", "", sections.DEALS_SKELETON, sections.INTRODUCTIONS_SKELETON))) + " FROM profiles")
def f22(spark, sf):
    """F22"""
    return profiles(spark, sf).select("contact_id", "version", sections.with_skeleton(
        F.col("sections")).alias("s")).select("contact_id", "version", "s.*")


@check("s15_summary_document", "profiles",
       f"SELECT contact_id, version, concat({matter(MATTER)}, chr(10), coalesce(business, '')) AS doc, concat({matter(MATTER)}, "
       "chr(10), coalesce(business, ''), chr(10), chr(10), '## Later', chr(10), chr(10), role_text) AS longer, "
       "business IS NOT NULL AS has FROM (SELECT *, processing_status AS role_text FROM profiles)")
def s15(spark, sf):
    """Document text and the append form"""
    doc = builders.summary_document(fields(), F.col("business"))
    return frame(spark, sf, "profiles").select(
        "contact_id", "version", doc.alias("doc"),
        builders.appended_summary(doc, F.col("processing_status"), F.lit("Later")).alias("longer"),
        F.col("business").isNotNull().alias("has"))


@check("s5_front_matter_split", "profiles",
       f"SELECT contact_id, version, {matter(MATTER, False)} AS front, coalesce({strip('business')}, '') AS body FROM profiles")
def s5_split(spark, sf):
    """S5 over documents in a column: what F17 and S15 wrote is split again"""
    front, body = split_front_matter(builders.summary_document(fields(), F.col("business")))
    return frame(spark, sf, "profiles").select(
        "contact_id", "version", front.alias("front"), body.alias("body"))
