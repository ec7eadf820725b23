"""Versions, upserts, migration, log upkeep."""
from datetime import datetime

from pyspark.sql import functions as F

from checks.bindings import frame, table
from checks.grouping import with_sections
from checks.registry import SECTIONS, check, quoted
from checks.selection import stamp, stamp_sql, with_sources
from checks.texts import RECORDS, display, note_content
from dossier.functions.responses import normalize_records
from dossier.functions.text import whole_json
from dossier.operators import metrics, publish, quality, versions
from dossier.sinks import builders

NAMES = ", ".join(SECTIONS)
NOW = datetime(2024, 1, 1, 12, 0, 0)
NOW_SQL = "TIMESTAMP '2024-01-01 12:00:00'"


def profiles(spark, sf):
    return with_sections(with_sources(frame(spark, sf, "profiles")))


# New versions for the contacts of the readable responses: several per contact, as ids repeat.
NEW_SQL = """new_rows AS (SELECT concat('CNT-', lpad(CAST(l_suppkey AS varchar(20)), 6, '0')) AS contact_id,
  'structured_insight' AS generator, l_orderkey * 10 + l_linenumber AS ord, l_returnflag AS flag FROM lineitem)"""


def new_rows(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "concat('CNT-', lpad(CAST(l_suppkey AS varchar(20)), 6, '0')) AS contact_id",
        "'structured_insight' AS generator", "l_orderkey * 10 + l_linenumber AS ord",
        "l_returnflag AS flag")


@check("w2_assign_versions", "profiles",
       "SELECT n.contact_id, n.ord, coalesce(t.top, 0) + row_number() OVER (PARTITION BY n.contact_id, n.generator "
       "ORDER BY n.ord) AS version FROM new_rows n LEFT JOIN (SELECT contact_id, generator, max(version) AS top FROM "
       "profiles GROUP BY 1, 2) t ON t.contact_id = n.contact_id AND t.generator = n.generator", NEW_SQL)
def w2(spark, sf):
    """W2"""
    return versions.assign_versions(new_rows(spark, sf), frame(spark, sf, "profiles")).select(
        "contact_id", "ord", "version")


@check("w2_sparse_ordinals", "profiles",
       "SELECT ord, CAST(row_number() OVER (ORDER BY ord) AS int) AS version FROM (SELECT ord * 1000003 AS ord FROM new_rows)", NEW_SQL)
def w2_sparse(spark, sf):
    """W2 on one contact that holds every row, with gaps of a million between the ordinals"""
    new = new_rows(spark, sf).withColumns({"contact_id": F.lit("CNT-1"), "ord": F.col("ord") * 1000003})
    return versions.assign_versions(new, frame(spark, sf, "profiles")).select("ord", "version")


@check("w3_with_latest", "profiles",
       "SELECT contact_id, generator, version, CAST(row_number() OVER (PARTITION BY contact_id, generator ORDER BY "
       "version DESC) = 1 AS int) AS is_latest FROM profiles")
def w3(spark, sf):
    """W3"""
    return versions.with_latest(frame(spark, sf, "profiles")).select(
        "contact_id", "generator", "version", F.col("is_latest").cast("int").alias("is_latest"))


@check("w3_latest_versions", "profiles",
       f"SELECT contact_id, generator, version, {NAMES} FROM (SELECT *, row_number() OVER (PARTITION BY contact_id, generator "
       "ORDER BY version DESC) AS r FROM profiles) WHERE r = 1")
def w3b(spark, sf):
    """W3, latest only"""
    return versions.latest_versions(frame(spark, sf, "profiles")).select(
        "contact_id", "generator", "version", *SECTIONS)


@check("m1_append_versions", "profiles",
       "SELECT contact_id, generator, version, record_count FROM profiles UNION ALL SELECT n.contact_id, n.generator, "
       "coalesce(t.top, 0) + row_number() OVER (PARTITION BY n.contact_id, n.generator ORDER BY n.ord), 2 FROM new_rows n "
       "LEFT JOIN (SELECT contact_id, generator, max(version) AS top FROM profiles GROUP BY 1, 2) t ON t.contact_id = "
       "n.contact_id AND t.generator = n.generator", NEW_SQL)
def m1(spark, sf):
    """M1"""
    old = frame(spark, sf, "profiles").select("contact_id", "generator", "version", "record_count")
    new = new_rows(spark, sf).withColumn("record_count", F.lit(2))
    return versions.append_versions(new, old)


OLD_SQL = f"""stored AS (SELECT contact_id, concat('ENI-', version) AS eni_id, version, generator, business, deals FROM profiles),
incoming AS (SELECT contact_id, CASE WHEN version % 4 = 0 THEN NULL ELSE concat('ENI-', version + version % 3) END AS eni_id,
  version * 100 AS ord, 1 AS version, generator, CASE WHEN version % 2 = 0 THEN deals END AS business FROM profiles),
grouped AS (SELECT contact_id, coalesce(eni_id, 'MISSING') AS k, min(eni_id) AS eni_id, count(*) AS writes, min(version) AS v,
  arg_max(generator, ord) AS generator, arg_max(business, ord) FILTER (business IS NOT NULL) AS business FROM incoming GROUP BY 1, 2)"""
UPSERT_SQL = """SELECT coalesce(o.contact_id, g.contact_id) AS contact_id, CASE WHEN o.contact_id IS NULL THEN g.eni_id ELSE o.eni_id END
  AS eni_id, CASE WHEN g.k IS NULL THEN o.version WHEN o.contact_id IS NULL THEN g.v + g.writes - 1 ELSE o.version + g.writes END
  AS version, coalesce(g.generator, o.generator) AS generator, coalesce(g.business, o.business) AS business, o.deals AS deals,
  CASE WHEN g.k IS NULL THEN 'kept' WHEN o.contact_id IS NULL THEN 'created' ELSE 'updated' END AS action
  FROM stored o FULL JOIN grouped g ON g.contact_id = o.contact_id AND g.k = o.eni_id"""


def stored(spark, sf):
    return frame(spark, sf, "profiles").selectExpr(
        "contact_id", "concat('ENI-', version) AS eni_id", "version", "generator", "business", "deals")


def incoming(spark, sf):
    return frame(spark, sf, "profiles").selectExpr(
        "contact_id", "CASE WHEN version % 4 = 0 THEN NULL ELSE concat('ENI-', version + version % 3) END AS eni_id",
        "version * 100 AS ord", "1 AS version", "generator",
        "CASE WHEN version % 2 = 0 THEN deals END AS business")


@check("j8_match_existing", "profiles",
       "SELECT i.contact_id, i.eni_id, i.ord, CAST(o.contact_id IS NOT NULL AS int) AS is_existing FROM incoming i LEFT JOIN "
       "stored o ON o.contact_id = i.contact_id AND o.eni_id = coalesce(i.eni_id, 'MISSING')", OLD_SQL)
def j8(spark, sf):
    """J8"""
    return versions.match_existing(incoming(spark, sf), stored(spark, sf)).select(
        "contact_id", "eni_id", "ord", F.col("is_existing").cast("int").alias("is_existing"))


@check("m2_upsert", "profiles", UPSERT_SQL, OLD_SQL)
def m2(spark, sf):
    """M2, with keys that are written more than once and keys without an id"""
    return versions.upsert(incoming(spark, sf), stored(spark, sf))


def doc_table(spark, sf):
    """A stored table: the records of one generator."""
    rows = normalize_records(frame(spark, sf, "docs")).filter("generator = 'g1' AND record_error IS NULL")
    return rows.select("contact_id", "eni_id", "version", F.col("generator"), F.col("sections"))


BATCH_SQL = """old AS (SELECT contact_id, eni_id, version, generator, personal FROM norm WHERE generator = 'g1' AND record_error IS NULL),
good AS (SELECT * FROM norm WHERE record_error IS NULL)"""


@check("m3_batch_upsert", "docs",
       "SELECT g.contact_id, g.eni_id, CASE WHEN o.contact_id IS NULL THEN g.version ELSE o.version + 1 END AS version, "
       "g.generator, coalesce(g.personal, o.personal) AS personal, CASE WHEN o.contact_id IS NULL THEN 'created' ELSE "
       "'updated' END AS action FROM good g LEFT JOIN old o ON o.contact_id = g.contact_id AND o.eni_id = g.eni_id",
       RECORDS + ",\n" + BATCH_SQL)
def m3(spark, sf):
    """M3"""
    table, _ = versions.batch_upsert(frame(spark, sf, "docs"), doc_table(spark, sf))
    return table.select("contact_id", "eni_id", "version", "generator",
                        F.col("sections.personal").alias("personal"), "action")


@check("m3_batch_failures", "docs", "SELECT ord, record_error FROM norm WHERE record_error IS NOT NULL", RECORDS)
def m3b(spark, sf):
    """M3: what was set aside"""
    _, bad = versions.batch_upsert(frame(spark, sf, "docs"), doc_table(spark, sf))
    return bad.select("ord", "record_error")


@check("m4_delete_ids", "profiles ids",
       "SELECT contact_id, version FROM profiles p WHERE NOT EXISTS (SELECT 1 FROM ids i WHERE i.contact_id = p.contact_id)")
def m4(spark, sf):
    """M4"""
    return versions.delete_ids(frame(spark, sf, "profiles"), frame(spark, sf, "ids"),
                               "contact_id").select("contact_id", "version")


MIGRATE = """old AS (SELECT contact_id, eni_id FROM norm WHERE generator = 'g1' AND record_error IS NULL),
report AS (SELECT n.*, CASE WHEN record_error IS NOT NULL THEN 'failed' WHEN EXISTS (SELECT 1 FROM old o WHERE o.contact_id =
  n.contact_id AND o.eni_id = coalesce(n.eni_id, 'UNKNOWN')) THEN 'skipped' ELSE 'migrated' END AS outcome FROM norm n)"""


@check("m5_migrate_report", "docs", "SELECT ord, contact_id, eni_id, outcome, record_error FROM report",
       RECORDS + ",\n" + MIGRATE)
def m5(spark, sf):
    """M5: outcome per document"""
    return versions.migrate(frame(spark, sf, "docs"), doc_table(spark, sf))[1]


@check("m5_migrate_table", "docs",
       "SELECT contact_id, eni_id, version, generator, CASE outcome WHEN 'skipped' THEN 'kept' ELSE 'created' END AS action "
       "FROM report WHERE outcome <> 'failed'", RECORDS + ",\n" + MIGRATE)
def m5b(spark, sf):
    """M5: the table after it"""
    table = versions.migrate(frame(spark, sf, "docs"), doc_table(spark, sf))[0]
    return table.select("contact_id", "eni_id", "version", "generator", "action")


@check("a18_migration_summary", "docs",
       "SELECT count(*) AS total_discovered, count(*) FILTER (outcome = 'migrated') AS migrated, count(*) FILTER (outcome = "
       "'failed') AS failed, count(*) FILTER (outcome = 'skipped') AS skipped, round(count(*) FILTER (outcome = 'migrated') / "
       "greatest(1, count(*) FILTER (outcome IN ('migrated', 'failed'))), 6) AS success_rate FROM report",
       RECORDS + ",\n" + MIGRATE)
def a18(spark, sf):
    """A18"""
    return metrics.migration_summary(versions.migrate(frame(spark, sf, "docs"), doc_table(spark, sf))[1])


@check("m6_clear_log", "run_log",
       "SELECT 'one' AS scope, contact_id, count(*) AS n FROM run_log WHERE contact_id <> 'CNT-000007' GROUP BY contact_id")
def m6(spark, sf):
    """M6: one contact's rows go, and all rows go"""
    log = frame(spark, sf, "run_log")
    rest = versions.clear_log(log, "CNT-000007").select(F.lit("one").alias("scope"), "contact_id")
    none = versions.clear_log(log).select(F.lit("all").alias("scope"), "contact_id")
    return rest.unionByName(none).groupBy("scope", "contact_id").agg(F.count(F.lit(1)).alias("n"))


@check("m7_backfill_arrays", "profiles",
       "SELECT contact_id, version, CASE WHEN version % 3 = 0 THEN source_type WHEN source_type = 'view' THEN 'view' ELSE "
       "concat('view,', source_type) END AS types, coalesce(nullif(source_subtype, 'null'), '') AS subtypes FROM profiles")
def m7(spark, sf):
    """M7: empty arrays, arrays that hold the value already, and NULL values"""
    df = frame(spark, sf, "profiles").selectExpr(
        "contact_id", "version", "source_type", "nullif(source_subtype, 'null') AS source_subtype",
        "CASE WHEN version % 3 <> 0 THEN array('view') END AS types", "CAST(NULL AS array<string>) AS subtypes")
    out = versions.backfill_arrays(df, {"source_type": "types", "source_subtype": "subtypes"})
    return out.select("contact_id", "version", F.array_join("types", ",").alias("types"),
                      F.array_join("subtypes", ",").alias("subtypes"))


@check("u4_merge_processed", "run_log legacy",
       "SELECT contact_id, eni_id FROM run_log UNION ALL SELECT DISTINCT contact_id, eni_id FROM legacy l WHERE NOT EXISTS "
       "(SELECT 1 FROM run_log r WHERE r.contact_id = l.contact_id AND r.eni_id = l.eni_id)")
def u4(spark, sf):
    """U4"""
    return versions.merge_processed(frame(spark, sf, "run_log"), frame(spark, sf, "legacy"))


@check("u5_cumulative_sources", "profiles",
       "SELECT contact_id, generator, CAST(sum(record_count) AS bigint) AS record_count, CAST(sum(total_eni_ids) AS bigint) "
       "AS total_eni_ids, string_agg(DISTINCT source_type, ',' ORDER BY source_type) AS types, string_agg(DISTINCT "
       "source_subtype, ',' ORDER BY source_subtype) AS subtypes FROM profiles GROUP BY 1, 2")
def u5(spark, sf):
    """U5"""
    return versions.cumulative_sources(profiles(spark, sf)).select(
        "contact_id", "generator", "record_count", "total_eni_ids",
        F.array_join("eni_source_types", ",").alias("types"),
        F.array_join("eni_source_subtypes", ",").alias("subtypes"))


def flat_json(p: str = "") -> str:
    parts = [f"'{'{' if i == 0 else ','}\"{s}\":', coalesce({quoted(p + s)}, 'null')" for i, s in enumerate(SECTIONS)]
    return "concat(" + ", ".join(parts) + ", '}')"


@check("p15_to_rows", "profiles",
       f"SELECT contact_id, eni_id, generator, version, {flat_json()} AS insights FROM profiles")
def p15(spark, sf):
    """P15"""
    df = profiles(spark, sf).select("contact_id", "eni_id", "generator", "version", "sections")
    return versions.to_rows(df)


@check("p16_from_rows", "profiles",
       f"SELECT contact_id, version, 'structured_insight' AS generator, 1 AS record_count, 'completed' AS processing_status, {NAMES} "
       "FROM profiles")
def p16(spark, sf):
    """Back from flat rows, with columns missing their value"""
    df = versions.to_rows(profiles(spark, sf).select("contact_id", "version", "sections"))
    flat = df.withColumns({"generator": F.lit(None).cast("string"), "record_count": F.lit(None).cast("int"),
                           "processing_status": F.lit(None).cast("string")})
    return versions.from_rows(flat).select("contact_id", "version", "generator", "record_count",
                                           "processing_status", *[F.col("sections")[s].alias(s) for s in SECTIONS])


# ---- publication ------------------------------------------------------------------------

@check("p10_search_profiles", "profiles",
       "SELECT contact_id, version FROM profiles WHERE contains(lower(personal), 'tion') OR contains(lower(deals), 'tion')")
def p10(spark, sf):
    """P10 over all rows"""
    return publish.search_profiles(profiles(spark, sf), "TION", ["personal", "deals"]).select(
        "contact_id", "version")


@check("p10_search_limited", "profiles",
       "SELECT contact_id, version FROM profiles WHERE " + " OR ".join(f"coalesce(contains(lower({s}), '_'), false)" for s in SECTIONS)
       + " OR " + " OR ".join(f"coalesce(contains(lower({s}), 'sub b'), false)" for s in SECTIONS)
       + " ORDER BY profiles.updated_at DESC, contact_id, version LIMIT 20")
def p10b(spark, sf):
    """P10 with a limit"""
    return publish.search_profiles(profiles(spark, sf), "Sub B", limit=20).select("contact_id", "version")


@check("p11_recent_profiles", "profiles",
       f"SELECT contact_id, version FROM (SELECT * FROM profiles ORDER BY updated_at DESC, contact_id, version LIMIT 60) "
       f"WHERE updated_at >= {NOW_SQL} - INTERVAL '7' HOUR")
def p11(spark, sf):
    """P11"""
    return publish.recent_profiles(profiles(spark, sf), datetime(2024, 1, 1, 5), 60).select(
        "contact_id", "version")


SKIP_SQL = f"CASE WHEN {NOW_SQL} - updated_at < INTERVAL '1' HOUR THEN 'skip' ELSE 'sync' END"


@check("p12_sync_plan", "profiles",
       f"SELECT contact_id, version, {SKIP_SQL} AS action, 'sync' AS forced FROM profiles")
def p12(spark, sf):
    """P12"""
    df = publish.sync_plan(profiles(spark, sf), NOW).withColumnRenamed("action", "usual")
    return publish.sync_plan(df, NOW, force=True).select(
        "contact_id", "version", F.col("usual").alias("action"), F.col("action").alias("forced"))


@check("p17_publish_rows", "profiles",
       f"SELECT contact_id, {NAMES}, eni_id, version, record_count, total_eni_ids FROM profiles")
def p17(spark, sf):
    """P17"""
    return publish.publish_rows(profiles(spark, sf)).select("contact_id", *SECTIONS, "metadata.eni_id",
                                                            "metadata.version", "metadata.record_count",
                                                            "metadata.total_eni_ids")


@check("j7_with_master", "notes master",
       "SELECT n.eni_id, m.record_id AS master_record_id, CASE WHEN m.record_id IS NULL THEN concat('no master record "
       "for contact ', n.contact_id) END AS sync_error FROM notes n LEFT JOIN master m ON m.contact_id = n.contact_id")
def j7(spark, sf):
    """J7"""
    m = frame(spark, sf, "master")
    return publish.with_master(frame(spark, sf, "notes"), m.unionByName(m)).select(
        "eni_id", "master_record_id", "sync_error")


def _outbox(where: str) -> str:
    shown = [f"CASE WHEN {s} <> '' THEN {display(s)} END AS {s}" for s in ("deals", "introductions")]
    return (f"SELECT l.contact_id, m.record_id AS master_record_id, 'profile' AS note_type, {note_content()} AS note_content, "
            f"{', '.join(shown)}, CASE WHEN m.record_id IS NULL THEN concat('no master record for contact ', "
            f"l.contact_id) END AS sync_error FROM latest l LEFT JOIN master m ON m.contact_id = l.contact_id {where}")


LATEST_SQL = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY version DESC) AS r FROM profiles
  WHERE generator = 'structured_insight'{}) WHERE r = 1)"""


@check("s18_build_outbox", "profiles master", _outbox(""), LATEST_SQL.format(""))
def s18(spark, sf):
    """S18"""
    latest = versions.latest_versions(profiles(spark, sf), "structured_insight")
    return publish.build_outbox(latest, frame(spark, sf, "master"))


@check("m8_republish", "profiles master", _outbox(""), LATEST_SQL.format(" AND processing_status = 'completed'"))
def m8(spark, sf):
    """M8"""
    return publish.republish(profiles(spark, sf), frame(spark, sf, "master"))


@check("m8_republish_list", "profiles master legacy",
       _outbox("WHERE l.contact_id IN (SELECT contact_id FROM legacy)"),
       LATEST_SQL.format(" AND processing_status = 'completed'"))
def m8b(spark, sf):
    """M8 for listed contacts"""
    return publish.republish(profiles(spark, sf), frame(spark, sf, "master"), frame(spark, sf, "legacy"))


@check("t3_publish_latest", "profiles master",
       f"SELECT l.contact_id, CAST(action = 'skip' OR record_id IS NOT NULL AS int) AS success, CASE WHEN action = 'skip' THEN "
       "'skipped' WHEN record_id IS NOT NULL THEN 'created' ELSE 'failed' END AS action FROM (SELECT *, "
       f"{SKIP_SQL} AS action FROM latest) l LEFT JOIN master m ON m.contact_id = l.contact_id", LATEST_SQL.format(""))
def t3_batch(spark, sf):
    """T3 as a batch: P12, J7, S18 and the results"""
    from dossier.plans.publication import publish_latest
    _, results = publish_latest(profiles(spark, sf), frame(spark, sf, "master"), NOW)
    return results.select("contact_id", F.col("success").cast("int").alias("success"), "action")


# ---- row and document builders ----------------------------------------------------------

@check("s12_run_log_rows", "notes",
       "SELECT eni_id, contact_id, '2024-01-01 12:00:00' AS processed_at, 'completed' AS processing_status, '1.0.0' AS "
       "processor_version, CASE WHEN eni_source_subtype IS NOT NULL THEN eni_source_subtype END AS batch_id, CASE WHEN "
       "eni_source_subtype <> '' THEN 'batch' ELSE 'single' END AS processing_mode, 'production' AS processing_environment, "
       "'k' AS processor_system_prompt_key, 'structured_insight' AS processor_generator FROM notes")
def s12(spark, sf):
    """S12"""
    df = frame(spark, sf, "notes").withColumnRenamed("eni_source_subtype", "batch_id")
    rows = builders.run_log_rows(df, F.lit(NOW), "k")
    return rows.withColumn("processed_at", stamp("processed_at")).drop(
        "processing_duration_ms", "error_message")


META = """concat('{', chr(10), '    "contact_id": ', {c}, ',', chr(10), '    "eni_id": "E1",', chr(10), '    "member_name": null,', chr(10),
 '    "eni_source_type": "click",', chr(10), '    "eni_source_subtype": null,', chr(10), '    "generated_at": "2024-01-01T12:00:00",', chr(10),
 '    "generator": "structured_insight",', chr(10), '    "record_count": 3', chr(10), '  }')"""


@check("s14_profile_document", "responses",
       f"SELECT ord, concat('{{', chr(10), '  \"metadata\": ', {META.replace('{c}', quoted('contact_id'))}, ',', chr(10), "
       f"'  \"insights\": {{\"raw_content\":', {quoted('response')}, '}}', chr(10), '}}') AS doc FROM responses "
       "WHERE NOT json_valid(response)")
def s14(spark, sf):
    """S14 for responses that are not JSON"""
    df = frame(spark, sf, "responses").filter(whole_json(F.col("response")).isNull())
    doc = builders.profile_document(
        F.col("contact_id"), F.lit("E1"), F.col("response"), F.lit("2024-01-01T12:00:00"),
        [("eni_source_type", F.lit('"click"')), ("record_count", F.lit("3"))])
    return df.select("ord", doc.alias("doc"))


@check("s14_profile_document_parsed", "responses",
       "SELECT ord, json_extract_string(response, '$.personal') AS personal, json_extract_string(response, '$.business') AS "
       "business, json_extract_string(response, '$[0]') AS first, contact_id FROM responses WHERE json_valid(response)")
def s14b(spark, sf):
    """S14 for responses that are JSON, objects and arrays, read back"""
    df = frame(spark, sf, "responses").filter(whole_json(F.col("response")).isNotNull())
    doc = builders.profile_document(F.col("contact_id"), F.lit("E1"), F.col("response"), F.lit("now"))
    v = whole_json(doc)
    return df.select("ord", F.try_variant_get(v, "$.insights.personal", "string").alias("personal"),
                     F.try_variant_get(v, "$.insights.business", "string").alias("business"),
                     F.try_variant_get(v, "$.insights[0]", "string").alias("first"),
                     F.try_variant_get(v, "$.metadata.contact_id", "string").alias("contact_id"))


@check("s16_event_rows", "run_events",
       "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN subtype ELSE 'run-1' END AS run_id, CASE WHEN event_id % 3 = 0 THEN "
       f"{stamp_sql('happened_at')} ELSE '2024-01-01 12:00:00' END AS \"timestamp\" FROM run_events")
def s16(spark, sf):
    """S16"""
    df = frame(spark, sf, "run_events").selectExpr(
        "event_id", "CASE WHEN event_id % 2 = 0 THEN subtype END AS run_id",
        "CASE WHEN event_id % 3 = 0 THEN CAST(happened_at AS timestamp) END AS timestamp")
    return builders.event_rows(df, "run-1", F.lit(NOW)).withColumn("timestamp", stamp("timestamp"))


def results(spark, sf):
    return frame(spark, sf, "results").withColumn("errors", F.array_compact(F.array("error")))


@check("s17_contact_report", "results",
       f"SELECT ord, concat('{{\"contact_id\":', {quoted('contact_id')}, ',\"success\":', success, CASE WHEN error IS NOT NULL THEN "
       f"concat(',\"errors\":[', {quoted('error')}, ']') ELSE ',\"errors\":[]' END, '}}') AS doc FROM results")
def s17(spark, sf):
    """S17"""
    df = results(spark, sf)
    return df.select("ord", builders.contact_report(
        df.select("contact_id", "success", "errors")).alias("doc"))


@check("s20_extract_for_publish", "docs",
       "SELECT json_extract_string(v, '$.metadata.contact_id') AS contact_id, json_extract_string(v, '$.metadata.generated_at') "
       "AS generated_at, json_extract_string(v, '$.insights.personal') AS personal FROM (SELECT TRY_CAST(doc AS json) AS v "
       "FROM docs) WHERE v IS NOT NULL")
def s20(spark, sf):
    """S20"""
    df = builders.extract_for_publish(frame(spark, sf, "docs"))
    return df.select("contact_id", "generated_at",
                     F.try_variant_get(F.try_parse_json("json_data"), "$.personal", "string").alias("personal"))


# ---- findings ---------------------------------------------------------------------------

FINDING_SQL = """SELECT ord, unnest(list_filter([
  CASE WHEN NOT coalesce(regexp_matches(contact_id, '^CNT-[A-Za-z0-9]{6,}$'), false) THEN 'invalid contact_id' END,
  CASE WHEN length(contact_id) > 50 THEN 'contact_id longer than 50' END, CASE WHEN length(eni_id) > 100 THEN 'eni_id longer than 100' END,
  CASE WHEN length(member_name) > 255 THEN 'member_name longer than 255' END, CASE WHEN length(generator) > 50 THEN 'generator longer than 50' END,
  CASE WHEN record_count < 1 THEN 'record_count below 1' END, CASE WHEN total_eni_ids < 1 THEN 'total_eni_ids below 1' END,
  CASE WHEN version < 1 THEN 'version below 1' END, CASE WHEN processing_status NOT IN ('pending', 'processing', 'completed', 'failed',
  'archived') THEN 'unknown processing_status' END], lambda x: x IS NOT NULL)) AS finding FROM source_rows"""


@check("v3_profile_findings", "docs", FINDING_SQL.replace("source_rows", "wide"),
       RECORDS + ",\nwide AS (SELECT ord, contact_id, doc AS eni_id, name AS member_name, generator, record_count, total_eni_ids, "
       "version, processing_status FROM norm)")
def v3(spark, sf):
    """V3"""
    df = normalize_records(frame(spark, sf, "docs")).withColumns(
        {"eni_id": F.col("doc"), "member_name": F.col("name")})
    return quality.profile_findings(df, ["ord"])


@check("v4_uncited_sections", "profiles",
       " UNION ALL ".join(f"SELECT contact_id, version, '{s}' AS section, 'no citation in section {s}' AS finding FROM profiles WHERE "
                          f"{s} <> '' AND NOT regexp_matches({s}, '\\[[^,\\]]+,[^\\]]+\\]')" for s in SECTIONS))
def v4(spark, sf):
    """V4"""
    return quality.uncited_sections(profiles(spark, sf), ["contact_id", "version"])


@check("v5_document_findings", "docs",
       "SELECT ord, record_error AS finding FROM norm WHERE record_error IS NOT NULL UNION ALL "
       + FINDING_SQL.replace("source_rows", "(SELECT * FROM norm WHERE record_error IS NULL)"), RECORDS)
def v5(spark, sf):
    """V5"""
    return quality.document_findings(frame(spark, sf, "docs"), ["ord"])


@check("v2_context_findings", "notes context",
       "SELECT type, subtype, path, 'file of the mapping is missing' AS finding FROM context WHERE path NOT IN (SELECT DISTINCT "
       "concat('c/', eni_source_type, '/', eni_source_subtype, '.md') FROM notes WHERE eni_source_subtype IS NOT NULL)")
def v2(spark, sf):
    """V2: mapped files without a file, where the notes' own pairs stand for the files"""
    files = frame(spark, sf, "notes").select(F.concat(
        F.lit("c/"), "eni_source_type", F.lit("/"), "eni_source_subtype", F.lit(".md")).alias("path")).distinct()
    return quality.context_findings(frame(spark, sf, "context"), files)
