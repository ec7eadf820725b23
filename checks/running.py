"""Generation, run figures and whole runs."""
import re
from datetime import datetime

from pyspark.sql import functions as F

from checks.bindings import RULE_MAP, RULE_ROWS, frame, table
from checks.grouping import (ALL_SQL, ALL_TABLES, BLOCKS, CURRENT, DRESSED, TEMPLATE, latest, pending, prompts, rendered,
                             with_sections)
from checks.registry import PENDING, SECTIONS, check, cut, profile_json, tok
from checks.selection import stamp, stamp_sql
from checks.storing import results
from dossier.checkpoints import freeze, run_folder
from dossier.functions.responses import normalize_records
from dossier.functions.text import estimate_tokens
from dossier.operators import budget, generation, metrics, publish, quality, rules, versions
from dossier.operators.budget import GROUP
from dossier.plans import preparation
from dossier.plans.publication import publish_latest
from dossier.plans.run import contact_results, run_combined, run_profiles
from dossier.sinks import writers
from dossier.sources.tables import read_profiles

# own choice: the section that notes of each source type go to
SECTION_OF = {"click": "personal", "view": "business", "purchase": "deals"}
SECTION_SQL = "CASE eni_source_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in SECTION_OF.items()) + " END"


def count_clients(limit: int):
    """Clients that answer with the length of the prompt, and with nothing for long ones.

    The returned function is a closure, so that it travels to the workers by value.
    """
    def make():
        def call(text):
            return f"## Personal\n{len(text)} characters" if len(text) < limit else ""

        return call

    return make


@check("x1_generate", ALL_TABLES,
       "SELECT contact_id, eni_source_type, subtype, CASE WHEN length(prompt) < 700 THEN concat('## Personal', chr(10), "
       "length(prompt), ' characters') END AS response, CASE WHEN length(prompt) >= 700 THEN 'empty response' END AS error, "
       "CASE WHEN length(prompt) < 700 THEN 1 ELSE 2 END AS attempts FROM prompts", ALL_SQL)
def x1(spark, sf):
    """X1 with X2 and X3"""
    df = prompts(spark, sf).select(*GROUP, "prompt")
    return generation.generate(df, count_clients(700), attempts=2, base_delay=0.0, concurrency=8).drop("prompt", "seconds")


@check("x1_ledger", ALL_TABLES,
       "SELECT contact_id, eni_source_type, subtype, CASE WHEN length(prompt) % 2 = 0 THEN '## Deals' WHEN length(prompt) < 700 THEN "
       "concat('## Personal', chr(10), length(prompt), ' characters') END AS response, CASE WHEN length(prompt) % 2 = 1 AND "
       "length(prompt) >= 700 THEN 'empty response' END AS error, CASE WHEN length(prompt) % 2 = 1 AND length(prompt) >= 700 THEN 2 "
       "ELSE 1 END AS attempts FROM prompts", ALL_SQL)
def x1_ledger(spark, sf):
    """Prompts that a stopped run has asked already are answered from its ledger, the others are asked in chunks"""
    df, ledger = freeze(prompts(spark, sf).select(*GROUP, "prompt")), run_folder(spark, "ledger")
    asked = df.filter(F.length("prompt") % 2 == 0)
    generation.generate_once(asked, lambda: lambda text: "## Deals", ledger, "run 1", 40)
    generation.generate_once(df, lambda: lambda text: "## Other", ledger, "run 2", 10 ** 6)
    out = generation.generate_once(df, count_clients(700), ledger, "run 1", 40, attempts=2, base_delay=0.0)
    return out.drop("prompt", "seconds")


NORM = "lower(regexp_replace(regexp_replace({}, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g'))"
BULLET_SQL = f"""latest AS MATERIALIZED (SELECT p.* FROM profiles p JOIN (SELECT contact_id, max(version) AS version FROM profiles
  WHERE generator = 'structured_insight' GROUP BY 1) t ON t.contact_id = p.contact_id AND t.version = p.version
  WHERE p.generator = 'structured_insight'),
texts AS MATERIALIZED ({" UNION ALL ".join(f"SELECT contact_id, '{s}' AS section, {s} AS text FROM latest" for s in SECTIONS)}),
seen AS MATERIALIZED (SELECT contact_id, section, {NORM.format('b')} AS norm FROM (SELECT contact_id, section, unnest(string_split(
  replace(text, concat(chr(10), '- '), concat(chr(1), '- ')), chr(1))) AS b FROM texts) WHERE regexp_matches(b, '\\S'))"""


def merge_sql(source: str) -> str:
    """Existing texts with the unseen bullets of (contact_id, section, o1, o2, bullet) appended."""
    return f"""met AS MATERIALIZED (SELECT contact_id, section, norm, max(old) AS old, min(struct_pack(o1 := o1, o2 := o2, bullet := bullet))
    AS first FROM (SELECT contact_id, section, {NORM.format('bullet')} AS norm, 0 AS old, o1, o2, bullet FROM {source}
    UNION ALL SELECT contact_id, section, norm, 1, NULL, NULL, NULL FROM seen) GROUP BY 1, 2, 3),
added AS MATERIALIZED (SELECT contact_id, section, string_agg(first.bullet, '' ORDER BY first.o1, first.o2) AS added FROM met
    WHERE old = 0 GROUP BY 1, 2),
merged AS (SELECT contact_id, section, CASE WHEN added IS NULL THEN text ELSE concat(coalesce(text, ''), CASE WHEN text <> '' AND
  NOT ends_with(text, chr(10)) THEN chr(10) ELSE '' END, added) END AS text FROM (SELECT contact_id, section, max(text) AS text,
  max(added) AS added FROM (SELECT contact_id, section, text, NULL AS added FROM texts UNION ALL SELECT contact_id, section, NULL,
  added FROM added) GROUP BY 1, 2))"""


def section_texts(spark, sf):
    return generation.section_rows(latest(spark, sf))


# Turns of the conversations as bullets: the latest one is in the profile already, with other
# spacing, and many texts occur in several conversations.
TURNS_SQL = """turns AS (SELECT concat('CNT-', lpad(CAST(conv_id AS varchar(20)), 6, '0')) AS contact_id, CASE role WHEN 'user' THEN
  'personal' ELSE 'business' END AS section, turn AS o1, 0 AS o2, concat('-  ', text, chr(10)) AS bullet FROM conversations)"""


@check("x5_append_merge", "profiles", "SELECT contact_id, section, text FROM merged",
       BULLET_SQL + ",\n" + TURNS_SQL + ",\n" + merge_sql("turns"))
def x5(spark, sf):
    """X5"""
    new = table(spark, sf, "conversations").selectExpr(
        "concat('CNT-', lpad(CAST(conv_id AS varchar(20)), 6, '0')) AS contact_id",
        "CASE role WHEN 'user' THEN 'personal' ELSE 'business' END AS section",
        "named_struct('a', turn, 'b', 0) AS ord", "concat('-  ', text, chr(10)) AS bullet")
    return generation.append_merge(section_texts(spark, sf), new)


FOLD_SQL = f"""bound AS (SELECT contact_id, {SECTION_SQL} AS section, ord AS o1, row_number() OVER (PARTITION BY contact_id,
  eni_source_type, subtype ORDER BY logged_date DESC NULLS LAST, eni_id) AS o2, entry AS bullet FROM kept)"""


@check("x4_fold_groups", "notes run_log rules profiles", "SELECT contact_id, section, text FROM merged",
       ",\n".join([PENDING, cut("pending", "60"), BULLET_SQL, FOLD_SQL, merge_sql("bound")]))
def x4(spark, sf):
    """X4 with X5 as its step: the groups of a contact one after the other, all contacts at once."""
    sized = budget.with_entries(pending(spark, sf))
    kept = freeze(budget.budget_cut(sized, 60, GROUP, ["entry", "ord"]))
    groups = rules.group_ordinal(kept.select(*GROUP, "ord").distinct())
    section = F.create_map(*[F.lit(x) for kv in SECTION_OF.items() for x in kv])
    bullets = kept.join(groups.select(*GROUP, "ordinal"), GROUP).select(
        "contact_id", "ordinal", section[F.col("eni_source_type")].alias("section"),
        F.struct(F.coalesce(-F.unix_date("logged_date"), F.lit(2147483647)).alias("day"),
                 "eni_id").alias("ord"), F.col("entry").alias("bullet"))

    def step(wave, state):
        return generation.append_merge(state, wave)

    return generation.fold_groups(bullets, section_texts(spark, sf), step)


@check("v6_token_loss", "responses profiles",
       f"SELECT ord, version, {tok('existing')} AS existing_tokens, {tok('response')} AS response_tokens, CAST({tok('existing')} > 0 AND "
       f"{tok('response')} < {tok('existing')} AS int) AS is_loss, greatest(0, {tok('existing')} - {tok('response')}) AS lost_tokens "
       "FROM (SELECT r.ord, p.version, r.response, p.business AS existing FROM responses r LEFT JOIN profiles p "
       "ON p.contact_id = r.contact_id)")
def v6(spark, sf):
    """V6"""
    old = frame(spark, sf, "profiles").select("contact_id", "version", F.col("business").alias("existing"))
    df = generation.token_loss(frame(spark, sf, "responses").join(old, "contact_id", "left"))
    return df.select("ord", "version", "existing_tokens", "response_tokens", F.col("is_loss").cast("int").alias("is_loss"),
                     "lost_tokens")


@check("a16_contact_tokens", "profiles",
       f"SELECT contact_id, CAST(sum({tok('deals')}) AS bigint) AS est_input_tokens, arg_max({tok('business')}, version) AS "
       "est_insights_tokens, CAST(sum(version) AS bigint) AS generation_time_seconds FROM profiles "
       "GROUP BY contact_id")
def a16(spark, sf):
    """A16"""
    it = frame(spark, sf, "profiles").select(
        "contact_id", F.col("version").alias("ordinal"), F.col("version").alias("seconds"),
        estimate_tokens(F.col("deals")).alias("input_tokens"),
        estimate_tokens(F.col("business")).alias("output_tokens"))
    return generation.contact_tokens(it)


# ---- figures ----------------------------------------------------------------------------

@check("a4_log_stats", "run_log",
       "SELECT CASE WHEN grouping(processing_status) = 1 THEN 'total' ELSE 'status' END AS scope, processing_status, count(*) AS n, "
       f"round(avg(processing_duration_ms), 4) AS avg_duration_ms, {stamp_sql('min(processed_at)')} AS earliest, "
       f"{stamp_sql('max(processed_at)')} AS latest FROM run_log GROUP BY ROLLUP (processing_status)")
def a4(spark, sf):
    """A4"""
    return metrics.log_stats(frame(spark, sf, "run_log")).withColumns(
        {"earliest": stamp("earliest"), "latest": stamp("latest")})


@check("f24_result_status", "results",
       "SELECT ord, CASE WHEN success THEN 'success' WHEN contains(error, 'skipped_due_to_claim') THEN 'skipped_claim' ELSE "
       "'failed' END AS status FROM results")
def f24(spark, sf):
    """F24"""
    return results(spark, sf).select("ord", metrics.result_status(
        F.col("success"), F.col("errors")).alias("status"))


SKIP = "coalesce(contains(error, 'skipped'), false)"
OK = f"NOT {SKIP} AND success"


@check("a9_run_totals", "results",
       f"SELECT count(*) AS total_scheduled, count(*) FILTER ({OK}) AS total_completed_success, count(*) FILTER ({SKIP}) AS "
       f"total_skipped_claim, count(*) FILTER (NOT {SKIP} AND NOT success) AS total_failed, " + ", ".join(
           f"CAST(sum({c}) FILTER ({OK}) AS bigint) AS {c}" for c in (
               "notes_processed", "files_created", "records_published", "token_loss_events", "token_loss_groups_skipped",
               "token_loss_records_skipped"))
       + f", count(error) FILTER (NOT {SKIP} AND NOT success) AS error_count FROM results")
def a9(spark, sf):
    """A9"""
    return metrics.run_totals(results(spark, sf))


@check("a9_run_errors", "results",
       f"SELECT contact_id, error FROM results WHERE NOT {SKIP} AND NOT success AND error IS NOT NULL")
def a9b(spark, sf):
    """The error list as rows"""
    return metrics.run_errors(results(spark, sf))


SUMMARY = ("count(*) AS total, count(*) FILTER (success) AS successful, count(*) FILTER (NOT success) AS failed, count(*) FILTER "
           "(action = 'created') AS created, count(*) FILTER (action = 'updated') AS updated, count(*) FILTER (action = 'skipped') "
           "AS skipped, round(count(*) FILTER (success) / count(*), 6) AS success_rate")


@check("a10_sync_summary", "results", f"SELECT {SUMMARY} FROM results")
def a10(spark, sf):
    """A10"""
    return publish.sync_summary(frame(spark, sf, "results"))


@check("a11_sync_stats", "results",
       f"SELECT 'overall' AS scope, {SUMMARY}, {stamp_sql('max(synced_at)')} AS last_sync_time FROM results UNION ALL SELECT "
       f"'recent', {SUMMARY}, {stamp_sql('max(synced_at)')} FROM (SELECT * FROM results ORDER BY synced_at DESC, ord DESC LIMIT 100)")
def a11(spark, sf):
    """A11 over W6"""
    return publish.sync_stats(frame(spark, sf, "results"), ["synced_at", "ord"]).withColumn(
        "last_sync_time", stamp("last_sync_time"))


@check("a12_write_summary", "results",
       "SELECT count(*) FILTER (success) AS total_processed, count(*) FILTER (success AND was_created) AS total_created, count(*) "
       "FILTER (success AND NOT was_created) AS total_updated, count(*) FILTER (NOT success) AS total_failed, CAST(40.5 AS double) AS "
       "elapsed_seconds, round(count(*) FILTER (success) / CAST(40.5 AS double), 6) AS processing_rate FROM results")
def a12(spark, sf):
    """A12"""
    return metrics.write_summary(frame(spark, sf, "results"), 40.5)


@check("a13_legacy_stats", "legacy",
       "SELECT 'contact' AS scope, contact_id, 1 AS contacts, count(*) AS n FROM legacy GROUP BY contact_id UNION ALL SELECT 'total', "
       "NULL, count(DISTINCT contact_id), count(*) FROM legacy")
def a13(spark, sf):
    """A13"""
    return metrics.legacy_stats(frame(spark, sf, "legacy"))


def stage_sql(group: str = "") -> str:
    def n(s: str, more: str = "") -> str:
        return f"count(*) FILTER (stage = '{s}'{more})"

    ok = " AND success"
    recs = "CAST(coalesce(sum(records) FILTER (stage = 'group'), 0) AS bigint)"
    return (f"{n('contact', ok)} AS contacts_processed, {n('group')} AS groups_processed, {n('call')} AS calls_made, {n('call', ok)} AS "
            f"calls_successful, {n('call')} - {n('call', ok)} AS calls_failed, {n('file')} AS files_created, {n('publish')} AS "
            f"records_published, {n('error')} AS errors_encountered, {recs} AS records_processed, CAST(coalesce(sum(records) FILTER "
            f"(stage = 'filter'), 0) AS bigint) AS records_filtered, CASE WHEN {n('call')} > 0 THEN round({n('call', ok)} * 100 / "
            f"{n('call')}, 4) ELSE 0 END AS call_success_percent, round({recs} / greatest(1, {n('contact', ok)}), 4) AS "
            "avg_records_per_contact")


@check("a14_stage_metrics", "run_events", f"SELECT {stage_sql()} FROM run_events")
def a14(spark, sf):
    """A14"""
    return metrics.stage_metrics(frame(spark, sf, "run_events"))


@check("a14_contact_report", "run_events", f"SELECT contact_id, {stage_sql()} FROM run_events GROUP BY contact_id")
def a14b(spark, sf):
    """A14, the report per contact"""
    return metrics.stage_metrics(frame(spark, sf, "run_events"), [F.col("contact_id")])


@check("a14_group_timings", "run_events",
       "SELECT contact_id, eni_source_type, subtype, count(*) AS runs, CAST(sum(records) AS bigint) AS records, count(*) FILTER "
       "(success) AS successful, round(sum(seconds), 4) AS seconds FROM run_events WHERE stage = 'group' GROUP BY 1, 2, 3")
def a14c(spark, sf):
    """A14, timings per group"""
    return metrics.group_timings(frame(spark, sf, "run_events"))


@check("a19_corpus_stats", "doc_notes",
       "SELECT unnest(['total_files', 'empty_files', 'large_files', 'undecodable_files', 'total_types', 'types_without_files']) AS "
       "metric, unnest([count(*), count(*) FILTER (strlen(description) = 0), count(*) FILTER (strlen(description) > 102400), count(*) "
       "FILTER (contains(description, '�')), (SELECT count(DISTINCT lang) FROM documents) + 1, 1]) AS value FROM doc_notes")
def a19(spark, sf):
    """A19, documents as the files and their languages as the types"""
    files = frame(spark, sf, "doc_notes").select(
        F.col("subtype").alias("type"), F.octet_length("description").alias("length"),
        F.col("description").alias("content"))
    extra = files.select("type").distinct().agg(F.concat(F.lit("no-"), F.min("type")).alias("type"))
    return quality.corpus_stats(files, files.select("type").unionByName(extra))


@check("a21_system_stats", "notes run_log",
       "SELECT 'contacts' AS metric, count(DISTINCT contact_id) AS value FROM notes UNION ALL SELECT 'type_pairs', count(*) FROM "
       "(SELECT DISTINCT eni_source_type, eni_source_subtype FROM notes) UNION ALL SELECT 'log_rows', count(*) FROM run_log UNION ALL "
       "SELECT 'log_contacts', count(DISTINCT contact_id) FROM run_log")
def a21(spark, sf):
    """A21"""
    return metrics.system_stats(frame(spark, sf, "notes"), frame(spark, sf, "run_log"))


# ---- a whole run ------------------------------------------------------------------------

def echo_clients(broken: str):
    """Clients whose answer depends on the whole prompt, the current profile included."""
    def make():
        import hashlib

        def call(text):
            digest = hashlib.md5(text.encode("utf-8")).hexdigest()
            if digest[0] in broken:
                return "```json\n{broken\n```"
            return f"## Personal\n{digest}\n## Deals\n{text.count(chr(10))} lines\n"

        return call

    return make


def json_clients():
    def make():
        def call(text):
            return f'```json\n{{"personal": "{len(text)} characters"}}\n```'

        return call

    return make


def whole_run(spark, sf, cap=150, contacts=None):
    return run_profiles(
        frame(spark, sf, "notes"), frame(spark, sf, "run_log"), frame(spark, sf, "rules"),
        frame(spark, sf, "context"), with_sections(frame(spark, sf, "profiles")), latest(spark, sf), TEMPLATE,
        echo_clients("01"), datetime(2024, 2, 1), window=1200, reserve=100, cap=cap, contacts=contacts,
        types=list(RULE_MAP), attempts=1, base_delay=0.0)


@check("w1_oversized_head", ALL_TABLES,
       "SELECT p.contact_id, p.eni_source_type, p.subtype, count(*) AS fitting, max(length(p.eni_id)) AS longest FROM pending p "
       f"WHERE {tok('entry')} <= 18 GROUP BY 1, 2, 3", PENDING)
def w1_oversized(spark, sf):
    """W1 in a prompt: notes larger than the room do not keep the others of their group waiting"""
    p = freeze(pending(spark, sf))
    wide = preparation.with_room(freeze(preparation.group_frame(p)), frame(spark, sf, "context"), latest(spark, sf),
                                 TEMPLATE, 10 ** 6, 100, 10 ** 6)
    large = preparation.oversized_notes(p, wide.withColumn("budget", F.lit(18)))
    rest = p.join(large.select("eni_id"), "eni_id", "left_anti")
    out = preparation.prepare_prompts(rest, wide, TEMPLATE, 10 ** 6, 100, 10 ** 6).filter("rows_used > 0")
    return out.select(*GROUP, F.col("rows_used").alias("fitting"),
                      F.array_max(F.transform("used_ids", F.length)).alias("longest"))


@check("w1_repeated_ids", ALL_TABLES,
       "SELECT contact_id, eni_source_type, subtype, CAST(min(n) AS bigint) AS rows_total, count(*) AS rows_used, "
       "CAST(sum(tokens) AS bigint) AS tokens_used FROM kept GROUP BY 1, 2, 3",
       PENDING + f""", doubled AS (SELECT *, count(*) OVER (PARTITION BY contact_id, eni_source_type, subtype) AS n FROM
  (SELECT * FROM pending UNION ALL SELECT * FROM pending WHERE eni_source_type <> 'view')),
fitting AS (SELECT * FROM doubled WHERE {tok('entry')} <= 45), """ + cut("fitting", "45"))
def w1_repeated(spark, sf):
    """W1 in a prompt: rows that repeat an id are notes of their own, and none counts twice"""
    p = pending(spark, sf)
    p = freeze(p.unionByName(p.filter("eni_source_type <> 'view'")))
    room = preparation.with_room(freeze(preparation.group_frame(p)), frame(spark, sf, "context"), latest(spark, sf),
                                 TEMPLATE, 10 ** 6, 100, 45)
    out = preparation.prepare_prompts(p, room, TEMPLATE, 10 ** 6, 100, 45).filter("rows_used > 0")
    return out.select(*GROUP, "rows_total", "rows_used", "tokens_used")


@check("run_combined", "notes run_log rules", "SELECT eni_id, 1 AS n, true AS one_version FROM pending", PENDING)
def combined(spark, sf):
    """A run of one call per contact: every pending note is logged or deferred, a contact gets one version"""
    out = run_combined(
        frame(spark, sf, "notes"), frame(spark, sf, "run_log"), frame(spark, sf, "rules"), frame(spark, sf, "context"),
        with_sections(frame(spark, sf, "profiles")), latest(spark, sf), TEMPLATE, json_clients(), datetime(2024, 2, 1),
        window=1200, reserve=100, cap=150, types=list(RULE_MAP), attempts=1, base_delay=0.0)
    done = F.col("processing_status") == "completed"
    seen = out.log.select("eni_id", "contact_id", done.alias("done")).unionByName(
        out.deferred.select("eni_id", "contact_id", F.lit(False).alias("done")))
    versions = out.versions.filter("sections.personal > ''").groupBy("contact_id").agg(F.count(F.lit(1)).alias("made"))
    return seen.join(versions, "contact_id", "left").groupBy("eni_id").agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.bool_and(
            F.when(F.col("done"), F.coalesce(F.col("made") == 1, F.lit(False))).otherwise(True)).alias("one_version"))


@check("x4_run_oversized", "notes run_log rules", "SELECT eni_id, 1 AS n FROM pending", PENDING)
def run_oversized(spark, sf):
    """Every pending note of a run is logged, or deferred with a reason, once"""
    out = whole_run(spark, sf, cap=19)
    seen = out.log.select("eni_id").unionByName(out.deferred.filter("reason IS NOT NULL").select("eni_id"))
    return seen.groupBy("eni_id").agg(F.count(F.lit(1)).cast("int").alias("n"))


@check("run_selected", "notes run_log rules",
       "SELECT eni_id, 1 AS n FROM pending WHERE contact_id IN (SELECT contact_id FROM notes GROUP BY 1 HAVING count(*) > 2)", PENDING)
def run_selected(spark, sf):
    """A run over chosen contacts only"""
    notes = frame(spark, sf, "notes")
    chosen = notes.groupBy("contact_id").count().filter("count > 2")
    out = whole_run(spark, sf, contacts=chosen)
    seen = out.log.select("eni_id").unionByName(out.deferred.select("eni_id"))
    return seen.groupBy("eni_id").agg(F.count(F.lit(1)).cast("int").alias("n"))


# The whole run of ``whole_run`` in SQL: wave k reads the profiles that wave k - 1 left.
RUN_EMPTY = profile_json(["''"] * len(SECTIONS))
RUN_WAVE = f"""room AS MATERIALIZED (SELECT *, least(150, greatest(0, 1200 - 100 - {tok(rendered("''"))} - 500)) AS available FROM (
    SELECT n.*, coalesce(b.profile_json, {RUN_EMPTY}) AS profile_json FROM ordered n LEFT JOIN before b ON b.contact_id = n.contact_id
    WHERE n.ordinal = NUMBER)),
fed AS MATERIALIZED (SELECT n.*, r.available FROM named n JOIN room r ON r.contact_id = n.contact_id AND
    r.eni_source_type = n.eni_source_type AND r.subtype = n.subtype),
fitting AS (SELECT * FROM fed WHERE {tok('entry')} <= available),
{cut('fitting', 'available')},
{BLOCKS},
asked AS MATERIALIZED (SELECT r.contact_id, r.eni_source_type, r.subtype, b.rows_used, {tok('r.profile_json')} AS existing_tokens,
    {rendered('new_data')} AS prompt FROM room r JOIN blocks b ON b.contact_id = r.contact_id AND
    b.eni_source_type = r.eni_source_type AND b.subtype = r.subtype),
answered AS MATERIALIZED (SELECT *, left(digest, 1) NOT IN ('0', '1') AS readable,
    concat('## Personal', chr(10), digest, chr(10), '## Deals', chr(10), deals, chr(10)) AS response FROM (SELECT *, md5(prompt) AS digest,
    concat(length(prompt) - length(replace(prompt, chr(10), '')), ' lines') AS deals FROM asked)),
after AS MATERIALIZED (SELECT * FROM before WHERE contact_id NOT IN (SELECT contact_id FROM answered WHERE readable) UNION ALL
    SELECT contact_id, {profile_json(["digest", "''", "''", "''", "deals", "''"])} FROM answered WHERE readable)"""


def run_wave(k: int) -> str:
    names = re.sub(r"\b(room|fed|fitting|sized|ranked|kept|blocks|asked|answered)\b", rf"\1_{k}", RUN_WAVE)
    return names.replace("before", f"state_{k - 1}").replace("after", f"state_{k}").replace("NUMBER", str(k))


WAVES = range(1, len(RULE_ROWS) + 1)
RUN_SQL = ",\n".join([
    PENDING, "named AS MATERIALIZED (SELECT * FROM pending WHERE eni_id IS NOT NULL)", DRESSED.replace("FROM pending", "FROM named"), CURRENT,
    "ordered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY ord) AS ordinal FROM ctx)",
    f"state_0 AS MATERIALIZED (SELECT contact_id, {profile_json([f"coalesce({s}, '')" for s in SECTIONS])} AS profile_json FROM current)",
    *[run_wave(k) for k in WAVES],
    "calls AS (" + " UNION ALL ".join(f"SELECT * FROM answered_{k}" for k in WAVES) + ")",
    f"left_out AS (SELECT contact_id, eni_source_type, subtype FROM pending WHERE eni_id IS NULL GROUP BY ALL UNION ALL "
    "SELECT contact_id, eni_source_type, subtype FROM (" + " UNION ALL ".join(
        f"SELECT * FROM fed_{k} WHERE {tok('entry')} > available" for k in WAVES) + ") GROUP BY ALL)",
    f"""outcomes AS (SELECT contact_id, 1 - CAST(readable AS int) AS errors, CASE WHEN readable THEN rows_used END AS notes,
    CAST(readable AS int) AS files, CAST(readable AND {tok('response')} < existing_tokens AS int) AS losses FROM calls
  UNION ALL SELECT contact_id, 1, NULL, 0, 0 FROM left_out)""",
    """contacts AS (SELECT contact_id, sum(errors) AS errors, sum(notes) AS notes, sum(files) AS files, sum(losses) AS losses,
    CAST(sum(files) > 0 AND contact_id IN (SELECT contact_id FROM master WHERE record_id IS NOT NULL) AS int) AS published
    FROM outcomes GROUP BY contact_id)"""])


def _sums(**columns: str) -> str:
    return ", ".join(f"CAST(coalesce(sum({of}), 0) AS bigint) AS {name}" for name, of in columns.items())


@check("run_totals", ALL_TABLES + " master",
       "SELECT count(*) AS total_scheduled, count(*) FILTER (errors = 0) AS total_completed_success, CAST(0 AS bigint) AS "
       "total_skipped_claim, count(*) FILTER (errors > 0) AS total_failed, " + _sums(
           notes_processed="CASE WHEN errors = 0 THEN notes END", files_created="CASE WHEN errors = 0 THEN files END",
           records_published="CASE WHEN errors = 0 THEN published END", token_loss_events="CASE WHEN errors = 0 THEN losses END",
           token_loss_groups_skipped="0", token_loss_records_skipped="0", error_count="errors")
       + ", true AS adds_up FROM contacts", RUN_SQL)
def totals_of_run(spark, sf):
    """A9 over a run, its publication and its token losses: every total, and the parts add up to the whole"""
    out = whole_run(spark, sf)
    answers = freeze(out.iterations)
    dst = run_folder(spark, "profiles")
    writers.append_profiles(out.versions, dst, datetime(2024, 2, 1))
    box, _ = publish_latest(read_profiles(spark, dst), frame(spark, sf, "master"), datetime(2024, 2, 1), force=True)
    # an answer that cannot be read replaces no profile
    losses = generation.token_loss(answers.filter(F.col("sections").isNotNull()))
    t = metrics.run_totals(contact_results(out, box, losses))
    parts = F.col("total_completed_success") + F.col("total_skipped_claim") + F.col("total_failed")
    return t.withColumn("adds_up", parts == F.col("total_scheduled"))


@check("s13_round_trip", "notes run_log rules", "SELECT true AS all_read_back")
def round_trip(spark, sf):
    """S13, S3 and publication over what a run wrote: sections and times come back as they were"""
    out = whole_run(spark, sf)
    dst, now = run_folder(spark, "profiles"), datetime(2024, 2, 1)
    made = freeze(out.versions)
    writers.append_profiles(made, dst, now)
    back = read_profiles(spark, dst)
    same = made.select("contact_id", "version", F.col("sections.personal").alias("p"), F.col("sections.deals").alias("d"))
    read = back.filter(F.col("updated_at") == F.lit(now)).select(
        "contact_id", "version", F.col("sections.personal").alias("p"), F.col("sections.deals").alias("d"))
    box, _ = publish_latest(back, frame(spark, sf, "master"), now, force=True)
    empty = box.filter("note_content IS NULL").select("contact_id")
    lost = same.exceptAll(read).select("contact_id").unionByName(read.exceptAll(same).select("contact_id")).unionByName(empty)
    return lost.agg((F.count(F.lit(1)) == 0).alias("all_read_back"))


def open_documents(spark, sf):
    """A stored document for every text: sections and keys beside them in ``insights``, ``content`` or at the top."""
    body = [F.col("text").alias("personal"), F.col("lang").alias("3i"), F.col("source").alias("hobbies"),
            F.col("text").alias('Odd "key"'), F.col("doc_id").alias("n"), F.struct("lang", "doc_id").alias("nested")]
    ids = [F.concat(F.lit("CNT-"), "doc_id").alias("contact_id"), F.concat(F.lit("E-"), "doc_id").alias("eni_id")]
    layout = F.col("doc_id") % 3
    doc = (F.when(layout == 0, F.to_json(F.struct(*ids, F.struct(*body).alias("insights"))))
           .when(layout == 1, F.to_json(F.struct(*ids, F.struct(*body).alias("content"))))
           .otherwise(F.to_json(F.struct(*ids, *body))))
    return table(spark, sf, "documents").select(F.col("doc_id").alias("ord"), doc.alias("doc"))


EXTRA = (("hobbies", "hobbies"), ('Odd "key"', "odd"), ("n", "n"), ("nested", "nested"))
EXTRA_SQL = """personal, three_i, CASE WHEN has THEN source END AS hobbies, CASE WHEN has THEN personal END AS odd,
  CASE WHEN has THEN CAST(doc_id AS varchar) END AS n, CASE WHEN has THEN concat('{"doc_id":', doc_id,
    CASE WHEN three_i IS NULL THEN '' ELSE concat(',"lang":"', three_i, '"') END, '}') END AS nested,
  CASE WHEN has THEN 2 + CAST(source IS NOT NULL AS int) + CAST(personal IS NOT NULL AS int) END AS keys
  FROM (SELECT doc_id, text AS personal, lang AS three_i, source, doc_id % 3 < 2 AS has FROM documents)"""


def _opened(df, *first):
    extra = [F.col("sections.extra")[key].alias(name) for key, name in EXTRA]
    return df.select(*first, "sections.personal", "sections.three_i", *extra, F.when(
        F.col("sections.extra").isNotNull(), F.size("sections.extra")).alias("keys"))


@check("f13_extra_sections", "", f"SELECT doc_id AS ord, {EXTRA_SQL}")
def extra_sections(spark, sf):
    """keys beside the six sections, with text, numbers and objects for values"""
    return _opened(normalize_records(open_documents(spark, sf)), "ord")


@check("s3_extra_sections", "",
       f"SELECT concat('CNT-', doc_id) AS contact_id, 1 + CAST(doc_id % 2 AS int) AS version, {EXTRA_SQL}")
def stored_extra_sections(spark, sf):
    """The same keys after F13, P15, P16, M2 over a table with keys of its own, S13 and S3"""
    good, _ = versions.split_records(open_documents(spark, sf))
    flat = versions.to_rows(good.select("ord", "contact_id", "eni_id", "version", "generator", "sections"))
    new = versions.from_rows(flat)
    before = F.col("sections").withField("personal", F.lit("before")).withField(
        "extra", F.create_map(F.lit("before"), F.lit("x")))
    old = new.filter("ord % 2 = 1").withColumn("sections", before).drop("ord")
    dst = run_folder(spark, "profiles")
    writers.append_profiles(versions.upsert(new, old).drop("action"), dst, datetime(2024, 2, 1))
    return _opened(read_profiles(spark, dst), "contact_id", "version")


@check("x4_profile_run", "profiles")
def run(spark, sf):
    """The run from notes to versions (rows only here; tests check it against a plain loop)."""
    out = whole_run(spark, sf).versions
    return out.select("contact_id", "generator", "version", "context_files", "record_count",
                      "est_input_tokens", "est_insights_tokens", "sections.personal", "sections.deals")
