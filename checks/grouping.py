"""Rules, groups, budget, context and prompts."""
from pyspark.sql import functions as F

from checks.bindings import RULE_MAP, frame
from checks.registry import ENTRY, PENDING, check, cut, ns, profile_json, tok
from dossier.checkpoints import freeze
from dossier.functions.text import estimate_tokens, note_entry
from dossier.operators import budget, rules, selection
from dossier.operators.budget import GROUP
from dossier.operators.versions import latest_versions
from dossier.plans import preparation
from dossier.schemas import SECTIONS

BUDGET = 60
WINDOW, RESERVE, CAP = 1000, 100, 150
# own wording
TEMPLATE = ("Profile so far:\n{{current_structured_insight}}\n\nSource: {{eni_source_type_context}}\n"
            "Kind: {{eni_source_subtype_context}}\n\nNotes:\n{{new_data_to_process}}\nUpdate the profile.")
TEMPLATE_SQL = "'" + TEMPLATE.replace("\n", "' || chr(10) || '") + "'"


def parts(spark, sf):
    return [frame(spark, sf, n) for n in ("notes", "run_log", "rules")]


def with_sections(df):
    return df.withColumn("sections", F.struct(*SECTIONS))


def latest(spark, sf):
    df = with_sections(frame(spark, sf, "profiles"))
    return latest_versions(df, "structured_insight").select("contact_id", "sections")


def pending(spark, sf):
    return preparation.pending_notes(*parts(spark, sf), list(RULE_MAP))


@check("p4_rule_split", "notes rules",
       f"SELECT n.eni_id, CAST(r.ord IS NOT NULL AS int) AS kept FROM notes n LEFT JOIN rules r ON "
       f"r.eni_source_type = n.eni_source_type AND r.subtype = {ns('n.eni_source_subtype')}")
def p4(spark, sf):
    """P4"""
    return rules.rule_split(frame(spark, sf, "notes"), frame(spark, sf, "rules")).select(
        "eni_id", F.col("kept").cast("int").alias("kept"))


@check("j4_assign_groups", "notes rules",
       f"SELECT n.eni_id, n.eni_source_type, r.subtype, r.ord FROM notes n JOIN rules r ON "
       f"r.eni_source_type = n.eni_source_type AND r.subtype = {ns('n.eni_source_subtype')}")
def j4(spark, sf):
    """J4"""
    return rules.assign_groups(frame(spark, sf, "notes"), frame(spark, sf, "rules")).select(
        "eni_id", "eni_source_type", "subtype", "ord")


@check("u2_union_groups", "notes",
       "SELECT eni_id, eni_source_type FROM notes WHERE eni_source_type = 'click' AND eni_source_subtype IS NULL "
       "UNION ALL SELECT eni_id, eni_source_type FROM notes WHERE eni_source_type = 'view' AND "
       "eni_source_subtype = 'biography' UNION ALL SELECT eni_id, eni_source_type FROM notes WHERE "
       "eni_source_type = 'purchase' AND eni_source_subtype = 'sector'")
def u2(spark, sf):
    """U2"""
    n = frame(spark, sf, "notes")
    picks = [("click", "null"), ("view", "biography"), ("purchase", "sector")]
    return rules.union_groups(*[
        selection.by_type(n, t, s).select("eni_id", "eni_source_type") for t, s in picks])


TYPES = f"""data AS (SELECT DISTINCT eni_source_type, {ns('eni_source_subtype')} AS subtype FROM notes),
dt AS (SELECT DISTINCT eni_source_type FROM data), rt AS (SELECT DISTINCT eni_source_type FROM rules),
found AS (SELECT 'not_configured' AS finding, eni_source_type, NULL AS subtype FROM dt WHERE eni_source_type NOT IN
    (SELECT eni_source_type FROM rt)
  UNION ALL SELECT 'not_in_data', eni_source_type, NULL FROM rt WHERE eni_source_type NOT IN
    (SELECT eni_source_type FROM dt)
  UNION ALL SELECT 'subtype_not_in_data', eni_source_type, subtype FROM rules r WHERE subtype <> 'null' AND
    eni_source_type IN (SELECT eni_source_type FROM dt) AND NOT EXISTS (SELECT 1 FROM data d WHERE
    d.eni_source_type = r.eni_source_type AND d.subtype = r.subtype))"""


@check("u3_key_diff", "notes rules",
       "SELECT coalesce(dt.eni_source_type, rt.eni_source_type) AS eni_source_type, CASE WHEN rt.eni_source_type "
       "IS NULL THEN 'first' WHEN dt.eni_source_type IS NULL THEN 'second' ELSE 'both' END AS side "
       "FROM dt FULL JOIN rt ON dt.eni_source_type = rt.eni_source_type", TYPES)
def u3(spark, sf):
    """U3"""
    return rules.key_diff(frame(spark, sf, "notes").select("eni_source_type"),
                          frame(spark, sf, "rules").select("eni_source_type"))


@check("j9_reconcile_rules", "notes rules", "SELECT * FROM found", TYPES)
def j9(spark, sf):
    """J9"""
    return rules.reconcile_rules(frame(spark, sf, "notes"), frame(spark, sf, "rules"))


@check("v1_rule_findings", "notes rules",
       "SELECT 'warning' AS level, finding, CASE finding WHEN 'not_configured' THEN concat('type without a rule: "
       "', eni_source_type) WHEN 'not_in_data' THEN concat('type of a rule without notes: ', "
       "eni_source_type) ELSE concat('subtype of a rule without notes: ', eni_source_type, '/', subtype) END "
       "AS message FROM found", TYPES)
def v1(spark, sf):
    """V1"""
    return rules.rule_findings(frame(spark, sf, "notes"), frame(spark, sf, "rules"))


SPLIT = f"""split AS (SELECT n.*, r.ord IS NOT NULL AS kept FROM notes n LEFT JOIN rules r ON
  r.eni_source_type = n.eni_source_type AND r.subtype = {ns('n.eni_source_subtype')})"""


@check("a6_filter_stats", "notes rules",
       "SELECT count(*) AS original_count, count(*) FILTER (kept) AS filtered_count, count(*) FILTER (NOT kept) "
       "AS skipped_count, round(count(*) FILTER (kept) * 100 / count(*), 4) AS filter_efficiency FROM split", SPLIT)
def a6(spark, sf):
    """A6"""
    return rules.filter_stats(frame(spark, sf, "notes"), frame(spark, sf, "rules"))


@check("a7_skipped_breakdown", "notes rules",
       "SELECT eni_source_type, eni_source_subtype, count(*) AS skipped FROM split WHERE NOT kept GROUP BY 1, 2 "
       "ORDER BY skipped DESC, eni_source_type NULLS LAST, eni_source_subtype NULLS LAST LIMIT 10", SPLIT)
def a7(spark, sf):
    """A7"""
    return rules.skipped_breakdown(frame(spark, sf, "notes"), frame(spark, sf, "rules"))


@check("a8_rule_coverage", "notes rules",
       "SELECT round((SELECT count(*) FROM dt WHERE eni_source_type IN (SELECT eni_source_type FROM rt)) * 100 / "
       "(SELECT count(*) FROM dt), 4) AS filter_coverage_percent, (SELECT count(*) FROM rt) AS "
       "configured_types_count, (SELECT count(*) FROM dt) AS data_types_count", TYPES)
def a8(spark, sf):
    """A8"""
    return rules.rule_coverage(frame(spark, sf, "notes"), frame(spark, sf, "rules"))


@check("w5_group_ordinal", "notes run_log rules",
       "SELECT contact_id, eni_source_type, subtype, row_number() OVER (PARTITION BY contact_id ORDER BY ord) AS "
       "ordinal FROM (SELECT DISTINCT contact_id, eni_source_type, subtype, ord FROM pending)", PENDING)
def w5(spark, sf):
    """W5"""
    groups = preparation.group_frame(pending(spark, sf))
    return rules.group_ordinal(groups).select(*GROUP, "ordinal")


# ---- budget -----------------------------------------------------------------------------

@check("w1_budget_cut", "notes run_log rules",
       "SELECT contact_id, eni_source_type, subtype, eni_id, tokens, upto - tokens AS used_before FROM kept",
       PENDING + ",\n" + cut("pending", str(BUDGET)))
def w1(spark, sf):
    """W1"""
    sized = budget.with_entries(pending(spark, sf))
    return budget.budget_cut(sized, BUDGET).select(*GROUP, "eni_id", "tokens", "used_before")


@check("w1_budget_cut_long_texts", "doc_notes",
       "SELECT contact_id, subtype, eni_id, tokens FROM kept",
       f"entries AS (SELECT *, {ENTRY} AS entry FROM doc_notes),\n" + cut("entries", "4000"))
def w1_long(spark, sf):
    """W1 where no note has a date, so that a whole group falls on one day."""
    sized = budget.with_entries(frame(spark, sf, "doc_notes"))
    return budget.budget_cut(sized, 4000).select("contact_id", "subtype", "eni_id", "tokens")


GROUP_SQL = f"""totals AS (SELECT contact_id, eni_source_type, subtype, count(*) AS rows_total FROM pending GROUP BY ALL),
used AS (SELECT contact_id, eni_source_type, subtype, count(*) AS rows_used, sum(tokens) AS tokens_used,
  string_agg(eni_id, ',' ORDER BY eni_id) AS ids FROM kept GROUP BY ALL)"""
A15_SQL = f"""SELECT t.contact_id, t.eni_source_type, t.subtype, t.rows_total,
  CAST(coalesce(u.rows_used, 0) AS bigint) AS rows_used, CAST(coalesce(u.tokens_used, 0) AS bigint) AS tokens_used,
  CAST({BUDGET} AS int) AS tokens_available, coalesce(u.ids, '') AS used_ids FROM totals t LEFT JOIN used u
  ON u.contact_id = t.contact_id AND u.eni_source_type = t.eni_source_type AND u.subtype = t.subtype"""


@check("a15_group_stats", "notes run_log rules", A15_SQL,
       PENDING + ",\n" + cut("pending", str(BUDGET)) + ",\n" + GROUP_SQL)
def a15(spark, sf):
    """A15, the flagship: for each contact and source group, how many unprocessed notes fit."""
    stats = preparation.budget_plan(*parts(spark, sf), BUDGET, list(RULE_MAP))
    return stats.withColumn("used_ids", F.array_join("used_ids", ","))


@check("a15_contact_sources", "notes run_log rules",
       "SELECT contact_id, string_agg(DISTINCT eni_source_type, ',' ORDER BY eni_source_type) AS types, "
       "string_agg(DISTINCT subtype, ',' ORDER BY subtype) AS subtypes FROM pending GROUP BY contact_id", PENDING)
def a15b(spark, sf):
    """A15 per contact"""
    df = budget.contact_sources(pending(spark, sf))
    return df.select("contact_id", F.array_join("eni_source_types", ",").alias("types"),
                     F.array_join("eni_source_subtypes", ",").alias("subtypes"))


BLOCKS = """blocks AS (SELECT contact_id, eni_source_type, subtype, string_agg(entry, '' ORDER BY logged_date DESC
  NULLS LAST, eni_id) AS new_data, count(*) AS rows_used, CAST(sum(tokens) AS bigint) AS tokens_used FROM kept GROUP BY ALL)"""


@check("f6_group_blocks", "notes run_log rules",
       f"SELECT *, {tok('new_data')} AS block_tokens FROM blocks",
       PENDING + ",\n" + cut("pending", str(BUDGET)) + ",\n" + BLOCKS)
def f6(spark, sf):
    """F6, with both token figures: the sum over notes and that of the joined text."""
    kept = budget.budget_cut(budget.with_entries(pending(spark, sf)), BUDGET, GROUP, ["entry"])
    return budget.group_blocks(kept).drop("used_ids").withColumn(
        "block_tokens", estimate_tokens(F.col("new_data")))


ANY_ENTRY = f"CASE WHEN description IS NOT NULL THEN {ENTRY} END"


@check("f5_note_entry", "notes", f"SELECT eni_id, {ANY_ENTRY} AS entry, {tok(ANY_ENTRY)} AS tokens FROM notes")
def f5(spark, sf):
    """F4, F5 and F1"""
    n = frame(spark, sf, "notes")
    e = note_entry(F.col("description"), F.col("logged_date"), F.col("eni_id"), F.col("eni_source_type"))
    return n.select("eni_id", e.alias("entry"), estimate_tokens(e).alias("tokens"))


# ---- context ----------------------------------------------------------------------------

GROUPS = "groups AS (SELECT contact_id, eni_source_type, subtype, min(ord) AS ord, count(*) AS rows_total FROM pending GROUP BY 1, 2, 3)"
DRESSED = f"""{GROUPS},
ctx AS (SELECT g.*, coalesce(d.content, '') AS type_context, coalesce(s.content, '') AS subtype_context
  FROM groups g LEFT JOIN context d ON d.type = g.eni_source_type AND d.subtype = 'default'
  LEFT JOIN context s ON s.type = g.eni_source_type AND s.subtype = g.subtype AND g.subtype <> 'null')"""
CURRENT = f"""current AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY version DESC) AS rn
  FROM profiles WHERE generator = 'structured_insight') WHERE rn = 1),
prof AS (SELECT c.*, {profile_json([f"coalesce({'p.' + s}, '')" for s in SECTIONS])} AS profile_json FROM ctx c
  LEFT JOIN current p ON p.contact_id = c.contact_id)"""


def groups(spark, sf):
    return preparation.group_frame(pending(spark, sf))


@check("j5_with_context", "notes run_log rules context",
       "SELECT contact_id, eni_source_type, subtype, type_context, subtype_context FROM ctx",
       PENDING + ",\n" + DRESSED)
def j5(spark, sf):
    """J5"""
    return budget.with_context(groups(spark, sf), frame(spark, sf, "context")).select(
        *GROUP, "type_context", "subtype_context")


@check("j5_context_fallback", "notes run_log rules context",
       "SELECT g.contact_id, g.eni_source_type, g.subtype, coalesce(s.content, d.content) AS context FROM groups g "
       "LEFT JOIN context s ON s.type = g.eni_source_type AND s.subtype = g.subtype LEFT JOIN context d ON "
       "d.type = g.eni_source_type AND d.subtype = 'default'", PENDING + ",\n" + GROUPS)
def j5b(spark, sf):
    """J5, one-text form"""
    return budget.with_context_fallback(groups(spark, sf), frame(spark, sf, "context")).select(
        *GROUP, "context")


@check("j5_context_paths", "notes run_log rules context",
       "SELECT g.contact_id, g.eni_source_type, g.subtype, d.path AS default_path, CASE WHEN s.path IS DISTINCT FROM "
       "d.path THEN s.path END AS subtype_path FROM groups g LEFT JOIN context s ON s.type = g.eni_source_type AND "
       "s.subtype = g.subtype LEFT JOIN context d ON d.type = g.eni_source_type AND d.subtype = 'default'",
       PENDING + ",\n" + GROUPS)
def j5c(spark, sf):
    """J5, path form"""
    return budget.context_paths(groups(spark, sf), frame(spark, sf, "context")).select(
        *GROUP, "default_path", "subtype_path")


@check("j6_with_profile", "notes run_log rules context profiles",
       "SELECT contact_id, eni_source_type, subtype, profile_json FROM prof",
       PENDING + ",\n" + DRESSED + ",\n" + CURRENT)
def j6(spark, sf):
    """J6 and F11"""
    return budget.with_profile(groups(spark, sf), latest(spark, sf)).select(*GROUP, "profile_json")


def rendered(data: str) -> str:
    out = TEMPLATE_SQL
    for key, value in (("current_structured_insight", "profile_json"),
                       ("eni_source_type_context", "type_context"),
                       ("eni_source_subtype_context", "subtype_context"),
                       ("new_data_to_process", data)):
        out = f"replace({out}, '{{{{{key}}}}}', {value})"
    return out


PROMPTS = f"""base AS (SELECT *, {tok(rendered("''"))} AS base_tokens FROM prof),
room AS (SELECT *, least({CAP}, greatest(0, {WINDOW} - {RESERVE} - base_tokens - 500)) AS available FROM base),
fed AS (SELECT p.*, r.available FROM pending p JOIN room r ON r.contact_id = p.contact_id AND
  r.eni_source_type = p.eni_source_type AND r.subtype = p.subtype),
{cut('fed', 'available')},
{BLOCKS},
full_groups AS (SELECT r.*, coalesce(b.new_data, '') AS new_data, coalesce(b.rows_used, 0) AS rows_used,
  coalesce(b.tokens_used, 0) AS tokens_used FROM room r LEFT JOIN blocks b ON b.contact_id = r.contact_id AND
  b.eni_source_type = r.eni_source_type AND b.subtype = r.subtype),
prompts AS (SELECT *, {rendered('new_data')} AS prompt FROM full_groups)"""
ALL_SQL = ",\n".join([PENDING, DRESSED, CURRENT, PROMPTS])
ALL_TABLES = "notes run_log rules context profiles"


def prompts(spark, sf):
    p = freeze(pending(spark, sf))
    dressed = preparation.with_room(freeze(preparation.group_frame(p)), frame(spark, sf, "context"),
                                    latest(spark, sf), TEMPLATE, WINDOW, RESERVE, CAP)
    return preparation.prepare_prompts(p, dressed, TEMPLATE, WINDOW, RESERVE, CAP)


@check("f2_render_prompts", ALL_TABLES,
       "SELECT contact_id, eni_source_type, subtype, prompt FROM prompts", ALL_SQL)
def f2(spark, sf):
    """F2 over J5, J6, W1 and F6: the prompts of a run"""
    return prompts(spark, sf).select(*GROUP, "prompt")


@check("f23_token_stats", ALL_TABLES,
       f"SELECT contact_id, eni_source_type, subtype, {WINDOW} AS context_window_tokens, {RESERVE} AS "
       "reserve_output_tokens, base_tokens, 500 AS overhead_tokens, available AS available_for_new_data, "
       f"{tok('new_data')} AS new_data_tokens_used, base_tokens + {tok('new_data')} AS total_rendered_tokens, "
       f"{tok('profile_json')} AS existing_summary_tokens, {tok('type_context')} AS type_context_tokens, "
       f"{tok('subtype_context')} AS subtype_context_tokens, {tok(TEMPLATE_SQL)} AS system_prompt_tokens, "
       f"{tok('prompt')} AS rendered_full_tokens FROM prompts", ALL_SQL)
def f23(spark, sf):
    """F23"""
    return prompts(spark, sf).select(*GROUP, "token_stats.*")


@check("a22_preview", ALL_TABLES,
       f"SELECT contact_id, row_number() OVER (PARTITION BY contact_id ORDER BY ord) AS call, eni_source_type, subtype, "
       f"base_tokens, rows_total, rows_used, {CAP} - tokens_used AS remaining, base_tokens + {tok('new_data')} AS "
       "rendered_tokens FROM prompts", ALL_SQL)
def a22(spark, sf):
    """A22"""
    return budget.preview(prompts(spark, sf), CAP)


BLOCK_SQL = """concat('<<< ', eni_source_type, '/', subtype, ': ', rows_total, ' notes waiting >>>', chr(10),
  CASE WHEN type_context <> '' THEN concat('About notes of type ', eni_source_type, ':', chr(10), type_context, chr(10), chr(10)) ELSE '' END,
  CASE WHEN subtype_context <> '' THEN concat('About the subtype ', subtype, ':', chr(10), subtype_context, chr(10), chr(10)) ELSE '' END,
  'Notes to work in (', rows_used, '):', chr(10), new_data, chr(10))"""


@check("a17_combine_groups", ALL_TABLES,
       f"SELECT contact_id, string_agg({BLOCK_SQL}, concat(chr(10), chr(10)) ORDER BY eni_source_type, subtype) AS combined, "
       "CAST(sum(rows_total) AS bigint) AS rows_total, CAST(sum(rows_used) AS bigint) AS rows_used FROM prompts "
       "GROUP BY contact_id", ALL_SQL)
def a17(spark, sf):
    """A17"""
    return budget.combine_groups(prompts(spark, sf))


TRACE_SQL = """answers AS (SELECT contact_id, eni_source_type, subtype, CASE WHEN subtype <> 'sector' THEN
  concat('Answer for ', contact_id) END AS response FROM groups),
sections AS (
  SELECT p.contact_id, ord, 0 AS part, concat('Request: ', p.eni_source_type, '/', p.subtype) AS title, prompt AS content FROM prompts p
  UNION ALL SELECT p.contact_id, ord, 1, concat('Token Stats: ', p.eni_source_type, '/', p.subtype),
    concat('base: ', base_tokens, chr(10), 'used: ', tokens_used) FROM prompts p
  UNION ALL SELECT p.contact_id, ord, 2, concat('Response: ', p.eni_source_type, '/', p.subtype), a.response FROM prompts p
    JOIN answers a ON a.contact_id = p.contact_id AND a.eni_source_type = p.eni_source_type AND a.subtype = p.subtype
    WHERE a.response IS NOT NULL)"""


def trace(spark, sf):
    g = groups(spark, sf)
    answers = g.select(*GROUP, F.when(F.col("subtype") != "sector", F.concat(
        F.lit("Answer for "), "contact_id")).alias("response"))
    return budget.build_trace(prompts(spark, sf), answers)


@check("s19_build_trace", ALL_TABLES, "SELECT * FROM sections", ALL_SQL + ",\n" + TRACE_SQL)
def s19(spark, sf):
    """S19 as rows"""
    return trace(spark, sf)


@check("s19_trace_text", ALL_TABLES,
       "SELECT contact_id, concat('Trace - Contact ', contact_id, chr(10), chr(10), string_agg(concat(chr(10), '## ', "
       "title, chr(10), chr(10), content, chr(10)), '' ORDER BY ord, part)) AS trace FROM sections GROUP BY contact_id",
       ALL_SQL + ",\n" + TRACE_SQL)
def s19b(spark, sf):
    """S19 as one text per contact"""
    return budget.trace_text(trace(spark, sf))
