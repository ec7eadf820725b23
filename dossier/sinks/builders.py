"""Rows and documents as they are written."""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.functions.prompts import front_matter
from dossier.functions.responses import once
from dossier.functions.sections import json_object, json_string
from dossier.functions.text import safe_name, whole_json
from dossier.schemas import DEFAULT_GENERATOR, RUN_LOG


def run_log_rows(df: DataFrame, processed_at: Column, prompt_key: str,
                 generator: str = DEFAULT_GENERATOR, version: str = "1.0.0",
                 environment: str = "production") -> DataFrame:
    """Log rows for (eni_id, contact_id, ...); a batch id makes the mode ``batch``."""
    def given(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in df.columns else default

    batch = given("batch_id", F.lit(None).cast("string"))
    is_batch = F.length(batch) > 0
    cols = {
        "eni_id": F.col("eni_id"), "contact_id": F.col("contact_id"),
        "processed_at": processed_at,
        "processing_status": given("processing_status", F.lit("completed")),
        "processor_version": given("processor_version", F.lit(version)),
        "processing_duration_ms": given("processing_duration_ms", F.lit(None)),
        "error_message": given("error_message", F.lit(None)),
        "batch_id": batch,
        "processing_mode": F.when(is_batch, "batch").otherwise("single"),
        "processing_environment": F.lit(environment),
        "processor_system_prompt_key": F.lit(prompt_key),
        "processor_generator": F.lit(generator),
    }
    return df.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in RUN_LOG.fields])


def json_value(text: Column) -> Column:
    """A text that is a JSON value as that value, in Spark's compact form; NULL otherwise."""
    return F.to_json(whole_json(text))


def profile_document(contact: Column, eni_id: Column, content: Column, generated_at: Column,
                     overlay: list[tuple[str, Column]] = ()) -> Column:
    """``{metadata, insights}``; content that is not JSON is kept under ``raw_content``.

    ``overlay`` gives further metadata, already encoded; it replaces a default of the same name.
    """
    meta = {
        "contact_id": json_string(contact), "eni_id": json_string(eni_id),
        "member_name": F.lit("null"), "eni_source_type": F.lit("null"),
        "eni_source_subtype": F.lit("null"), "generated_at": json_string(generated_at),
        "generator": F.lit(f'"{DEFAULT_GENERATOR}"'),
    }
    meta.update(dict(overlay))
    raw = F.concat(F.lit('{"raw_content":'), json_string(content), F.lit("}"))
    return json_object([("metadata", json_object(list(meta.items()), "  ")),
                        ("insights", F.coalesce(json_value(content), raw))])


def summary_document(fields: list[tuple[str, Column, str]], body: Column) -> Column:
    """Front matter followed by the body."""
    return F.concat(front_matter(fields), F.lit("\n"), F.coalesce(body, F.lit("")))


def appended_summary(document: Column, addition: Column, title: Column | None = None) -> Column:
    """A summary with a further section at its end."""
    head = F.lit("") if title is None else F.coalesce(
        F.concat(F.lit("## "), title, F.lit("\n\n")), F.lit(""))
    return F.concat(document, F.lit("\n\n"), head, addition)


def summary_name(df: DataFrame) -> DataFrame:
    return df.withColumn("name", safe_name(F.col("contact_id"), F.col("eni_id")))


def event_rows(df: DataFrame, run_id: str, now: Column) -> DataFrame:
    """Run events with ``run_id`` and ``timestamp`` filled in where they are missing."""
    def given(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in df.columns else default

    return df.withColumns({"run_id": given("run_id", F.lit(run_id)),
                           "timestamp": given("timestamp", now)})


def contact_report(results: DataFrame) -> Column:
    """Result document of one contact as JSON text; absent values are left out."""
    return F.to_json(F.struct(*[F.col(c) for c in results.columns]))


def extract_for_publish(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """What publication needs of each stored document."""
    docs, v = once(docs, _v=whole_json(F.col(doc))), F.col("_v")

    def meta(name: str) -> Column:
        return F.try_variant_get(v, f"$.metadata.{name}", "string").alias(name)

    return docs.filter(v.isNotNull()).select(
        meta("contact_id"), meta("member_name"),
        F.to_json(F.try_variant_get(v, "$.insights", "variant")).alias("json_data"),
        meta("eni_source_type"), meta("eni_source_subtype"), meta("generated_at"))
