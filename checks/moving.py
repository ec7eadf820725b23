"""Files and streams (S4-S7, S9, S10, S12-S17, O6, T1-T3): derived, written, read back."""
from datetime import datetime

from pyspark.sql import functions as F

from checks.bindings import frame, table
from checks.registry import SECTIONS, check, quoted, strip
from checks.running import stage_sql
from checks.selection import stamp, stamp_sql
from checks.storing import LATEST_SQL, _outbox, profiles, results
from checks.texts import MATTER, fields, matter
from dossier.checkpoints import freeze, run_folder
from dossier.operators.ordering import with_position
from dossier.sinks import builders, files, writers
from dossier.sources import files as sources
from dossier.sources.tables import read_profiles
from dossier.streaming import intake

NOW = datetime(2024, 1, 1, 12, 0, 0)


def named_docs(spark, sf, text: str):
    return frame(spark, sf, "docs").select("name", text)


# ---- documents and summaries ------------------------------------------------------------

@check("s4_read_profile_json", "docs",
       "SELECT name, doc, CASE WHEN NOT json_valid(doc) THEN 'Invalid JSON' END AS doc_error FROM docs")
def s4(spark, sf):
    """One file per document"""
    folder = run_folder(spark, "documents")
    files.write_named_files(named_docs(spark, sf, "doc"), folder, "doc")
    return sources.read_profile_json(spark, folder).select("name", "doc", "doc_error")


SUMMARY_NAME = "concat(contact_id, '_', version, '.md')"


def summaries(spark, sf) -> str:
    folder = run_folder(spark, "summaries")
    docs = frame(spark, sf, "profiles").select(
        F.concat("contact_id", F.lit("_"), F.col("version").cast("string"), F.lit(".md")).alias("name"),
        builders.summary_document(fields(), F.col("business")).alias("text"))
    files.write_named_files(docs, folder)
    return folder


@check("s5_read_summaries", "profiles",
       f"SELECT {SUMMARY_NAME} AS name, concat({matter(MATTER, False)}) AS front_matter, coalesce({strip('business')}, '') AS body "
       "FROM profiles")
def s5(spark, sf):
    """S5"""
    return sources.read_summaries(spark, summaries(spark, sf)).drop("path")


@check("s6_list_summaries", "profiles",
       f"SELECT {SUMMARY_NAME} AS name, contact_id, CAST(version AS varchar) AS eni_id, strlen(concat({matter(MATTER)}, chr(10), "
       "coalesce(business, ''))) AS length FROM profiles")
def s6(spark, sf):
    """S6"""
    return sources.list_summaries(spark, summaries(spark, sf)).select(
        "name", "contact_id", "eni_id", "length")


@check("o6_files_newest", "profiles",
       "SELECT contact_id, count(*) AS files, true AS in_order FROM profiles GROUP BY contact_id")
def o6(spark, sf):
    """File times differ from run to run, so it is the order that is checked: none is older than the next"""
    placed = with_position(sources.files_newest(sources.list_summaries(spark, summaries(spark, sf))))
    placed = placed.select("contact_id", "path", "modificationTime", "pos")
    after = placed.select((F.col("pos") - 1).alias("pos"), F.col("modificationTime").alias("later"), F.col("path").alias("next"))
    newer = (F.col("modificationTime") > F.col("later")) | (
        (F.col("modificationTime") == F.col("later")) & (F.col("path") < F.col("next")))
    return placed.join(after, "pos", "left").groupBy("contact_id").agg(
        F.count(F.lit(1)).alias("files"), F.bool_and(F.col("later").isNull() | newer).alias("in_order"))


@check("s15_write_documents", "profiles",
       "SELECT contact_id, CAST(version AS varchar) AS latest_text FROM (SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY "
       "updated_at DESC) AS r FROM profiles) WHERE r = 1")
def s15(spark, sf):
    """S15 as a table: the newest text of a name counts; without overwrite nothing is added."""
    dst = run_folder(spark, "documents")
    docs = frame(spark, sf, "profiles").select(
        F.col("contact_id").alias("name"), F.col("version").cast("string").alias("text"),
        F.col("updated_at").alias("written_at"))
    writers.write_documents(docs, dst, "text")
    later = docs.withColumn("written_at", F.lit(datetime(2030, 1, 1)))
    writers.write_documents(later, dst, "text", overwrite=False)
    return writers.current_documents(spark.read.parquet(dst)).select(
        F.col("name").alias("contact_id"), F.col("text").alias("latest_text"))


# ---- context, catalogue, legacy log -----------------------------------------------------

def corpus(spark, sf) -> str:
    """The documents as context files: the source is the type, language and id the subtype."""
    folder = run_folder(spark, "context")
    name = F.concat("source", F.lit("/"), "lang", F.lit("-"), F.col("doc_id").cast("string"), F.lit(".md"))
    files.write_named_files(table(spark, sf, "documents").select(name.alias("name"), "text"), folder)
    return folder


@check("s7_read_context", "",
       "SELECT source AS type, concat(lang, '-', doc_id) AS subtype, text AS content, strlen(text) AS length FROM documents")
def s7(spark, sf):
    """S7"""
    return sources.read_context(spark, corpus(spark, sf)).drop("path")


@check("s7_available_subtypes", "",
       "SELECT source AS type, string_agg(DISTINCT lang, ',' ORDER BY lang) AS subtypes FROM documents GROUP BY source")
def s7b(spark, sf):
    """The listing, by language"""
    listed = sources.list_context(spark, corpus(spark, sf))
    df = sources.available_subtypes(listed.withColumn("subtype", F.substring_index("subtype", "-", 1)))
    return df.select("type", F.array_join("subtypes", ",").alias("subtypes"))


@check("s9_read_catalog", "notes",
       "SELECT DISTINCT eni_source_type, CASE WHEN trim(eni_source_subtype) <> '' THEN eni_source_subtype END AS eni_source_subtype "
       "FROM notes")
def s9(spark, sf):
    """S9"""
    dst = run_folder(spark, "catalog")
    pairs = frame(spark, sf, "notes").select(
        "eni_source_type", F.when(F.trim("eni_source_subtype") != "", F.col("eni_source_subtype"))
        .alias("eni_source_subtype")).distinct()
    pairs.write.option("header", True).csv(dst)
    return sources.read_catalog(spark, dst)


@check("s10_read_legacy_log", "run_log", "SELECT contact_id, eni_id FROM run_log")
def s10(spark, sf):
    """JSON maps, with empty and broken lines among them"""
    dst = run_folder(spark, "legacy")
    one = F.create_map("contact_id", F.array("eni_id"))
    lines = F.explode(F.array(F.to_json(one), F.lit(""), F.lit('{"broken": [')))
    frame(spark, sf, "run_log").select(lines.alias("value")).write.text(dst)
    return sources.read_legacy_log(spark, dst, lines=True)


# ---- table sinks ------------------------------------------------------------------------

@check("s12_append_run_log", "notes",
       "SELECT processing_status, count(*) AS n, count(DISTINCT eni_id) AS notes FROM (SELECT eni_id, 'completed' AS processing_status "
       "FROM notes UNION ALL SELECT eni_id, 'failed' FROM notes) GROUP BY 1")
def s12(spark, sf):
    """Two appends, read back by status"""
    dst = run_folder(spark, "log")
    rows = builders.run_log_rows(frame(spark, sf, "notes"), F.lit(NOW), "k")
    writers.append_run_log(rows, dst)
    writers.append_run_log(rows.withColumn("processing_status", F.lit("failed")), dst)
    return spark.read.parquet(dst).groupBy("processing_status").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("eni_id").alias("notes"))


@check("s13_append_profiles", "profiles",
       "SELECT contact_id, version, generator, personal, deals FROM profiles")
def s13(spark, sf):
    """S13"""
    dst = run_folder(spark, "profiles")
    writers.append_profiles(profiles(spark, sf).select("contact_id", "version", "generator", "sections"), dst)
    return read_profiles(spark, dst).select("contact_id", "version", "generator", "sections.personal",
                                            "sections.deals")


@check("s14_write_profile_json", "docs", "SELECT name, doc FROM docs")
def s14(spark, sf):
    """S14 as a table of documents"""
    dst = run_folder(spark, "documents")
    writers.write_profile_json(named_docs(spark, sf, "doc"), dst)
    return spark.read.schema("name STRING, doc STRING").json(dst)


@check("s14_documents_by_name", "docs", "SELECT name, coalesce(doc, '') AS doc FROM docs")
def s14_by_name(spark, sf):
    """One file per document by Spark's commit, written twice: names are replaced, not added"""
    dst = run_folder(spark, "by-name")
    for _ in range(2):
        files.write_documents_by_name(named_docs(spark, sf, "doc"), dst, "doc")
    return sources.read_documents_by_name(spark, dst, by_tasks=True).withColumnRenamed("text", "doc")


@check("s16_append_events", "run_events",
       f"SELECT 'run-1' AS run_id, event_id, stage, {stamp_sql('happened_at')} AS \"timestamp\" FROM run_events UNION ALL SELECT 'run-2', "
       "event_id, stage, '2024-01-01 12:00:00' FROM run_events")
def s16(spark, sf):
    """S16"""
    dst = run_folder(spark, "events")
    ev = frame(spark, sf, "run_events").select("event_id", "stage", F.col("happened_at").cast("timestamp").alias("timestamp"))
    writers.append_events(builders.event_rows(ev, "run-1", F.lit(NOW)), dst)
    writers.append_events(builders.event_rows(ev.drop("timestamp"), "run-2", F.lit(NOW)), dst)
    df = spark.read.schema("run_id STRING, event_id BIGINT, stage STRING, timestamp TIMESTAMP").json(dst)
    return df.withColumn("timestamp", stamp("timestamp"))


@check("s17_write_run_report", "results",
       f"SELECT concat('{{\"contact_id\":', {quoted('contact_id')}, ',\"ord\":', ord, ',\"success\":', success, '}}') AS doc FROM results "
       "UNION ALL SELECT concat('scheduled ', count(*)) FROM results")
def s17(spark, sf):
    """S17"""
    dst = run_folder(spark, "report")
    df = results(spark, sf)
    keep = ["contact_id", "ord", "success"]
    writers.write_run_report(df, dst)
    docs = spark.read.text(f"{dst}/contacts").select(
        F.to_json(F.from_json("value", df.select(*keep).schema)).alias("doc"))
    totals = spark.read.json(f"{dst}/totals").select(
        F.concat(F.lit("scheduled "), F.col("total_scheduled").cast("string")).alias("doc"))
    return docs.unionByName(totals)


@check("m2_rewrite", "profiles", "SELECT contact_id, version FROM profiles")
def rewrite(spark, sf):
    """M2, M4, M6: the new content of a table goes to a new path"""
    dst = run_folder(spark, "rewritten")
    writers.rewrite(frame(spark, sf, "profiles"), dst)
    return spark.read.parquet(dst).select("contact_id", "version")


# ---- streams ----------------------------------------------------------------------------

def stream_of(spark, df, name: str):
    """The rows of ``df`` as a file stream."""
    src = run_folder(spark, name)
    df.write.parquet(src)
    return spark.readStream.schema(df.schema).parquet(src)


@check("t1_stream_notes", "notes run_log",
       "SELECT n.eni_id, n.contact_id FROM notes n WHERE n.eni_id NOT IN (SELECT eni_id FROM run_log WHERE processing_status = 'completed')")
def t1(spark, sf):
    """T1, drained; every note arrives twice"""
    n = frame(spark, sf, "notes").withColumn("noted_at", F.coalesce("logged_date", F.lit("2024-01-15").cast("date")).cast("timestamp"))
    dst = run_folder(spark, "stream-out")
    q = intake.stream_notes(stream_of(spark, n.unionByName(n), "stream-in"), frame(spark, sf, "run_log"), dst,
                            run_folder(spark, "stream-state"))
    q.awaitTermination()
    return spark.read.parquet(dst).select("eni_id", "contact_id")


@check("t1_late_notes", "notes run_log",
       "SELECT n.eni_id, n.contact_id FROM notes n WHERE n.eni_id NOT IN (SELECT eni_id FROM run_log WHERE processing_status = 'completed')")
def t1_late(spark, sf):
    """T1 in two runs: the older half of the notes comes after the newer one, some come twice"""
    n = freeze(frame(spark, sf, "notes").withColumn("noted_at", F.col("logged_date").cast("timestamp")))
    late = (F.dayofmonth("logged_date") < 15) | F.col("logged_date").isNull()
    src, dst, state = (run_folder(spark, x) for x in ("stream-in", "stream-out", "stream-state"))
    for part in (n.filter(~late), n.filter(late).unionByName(n.filter(F.pmod(F.xxhash64("eni_id"), F.lit(3)) == 0))):
        part.write.mode("append").parquet(src)
        stream = spark.readStream.schema(n.schema).parquet(src)
        intake.stream_notes(stream, frame(spark, sf, "run_log"), dst, state).awaitTermination()
    return spark.read.parquet(dst).select("eni_id", "contact_id")


@check("t2_stream_metrics", "run_events",
       f"SELECT strftime(time_bucket(INTERVAL '1 hour', happened_at), '%Y-%m-%d %H:%M:%S') AS started, {stage_sql()} FROM run_events "
       "GROUP BY time_bucket(INTERVAL '1 hour', happened_at)")
def t2(spark, sf):
    """T2, drained; hours instead of half minutes, as the events span a month"""
    ev = frame(spark, sf, "run_events").withColumn("timestamp", F.col("happened_at").cast("timestamp")).drop("happened_at")
    dst = run_folder(spark, "stream-out")
    q = intake.stream_metrics(stream_of(spark, ev, "stream-in"), dst, run_folder(spark, "stream-state"),
                              every="1 hour")
    q.awaitTermination()
    df = intake.current_metrics(spark.read.parquet(dst))
    return df.withColumn("started", stamp("interval.start")).drop("interval")


@check("t2_late_events", "run_events",
       f"SELECT strftime(time_bucket(INTERVAL '1 hour', happened_at), '%Y-%m-%d %H:%M:%S') AS started, {stage_sql()} FROM run_events "
       "GROUP BY time_bucket(INTERVAL '1 hour', happened_at)")
def t2_late(spark, sf):
    """T2 in two runs: the first half of the month comes after the second"""
    ev = freeze(frame(spark, sf, "run_events").withColumn("timestamp", F.col("happened_at").cast("timestamp")).drop("happened_at"))
    src, dst, state = (run_folder(spark, x) for x in ("stream-in", "stream-out", "stream-state"))
    late = F.dayofmonth("timestamp") < 15
    for part in (ev.filter(~late), ev.filter(late)):
        part.write.mode("append").parquet(src)
        stream = spark.readStream.schema(ev.schema).parquet(src)
        intake.stream_metrics(stream, dst, state, every="1 hour").awaitTermination()
    df = intake.current_metrics(spark.read.parquet(dst))
    return df.withColumn("started", stamp("interval.start")).drop("interval")


@check("t3_stream_publish", "profiles master", _outbox(""), LATEST_SQL.format(""))
def t3(spark, sf):
    """T3, drained"""
    p = profiles(spark, sf).drop(*SECTIONS)
    dst = run_folder(spark, "stream-out")
    q = intake.stream_publish(stream_of(spark, p, "stream-in"), frame(spark, sf, "master"), dst,
                              run_folder(spark, "stream-state"))
    q.awaitTermination()
    return spark.read.parquet(dst).drop("epoch", "version")
