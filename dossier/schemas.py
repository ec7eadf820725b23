"""Declared schemas of the tables this package reads and writes."""
from pyspark.sql import types as T

# The six profile sections in their published order.  The fourth one has two
# spellings, the JSON key and the column name used wherever an identifier is needed.
SECTIONS = ("personal", "business", "investing", "three_i", "deals", "introductions")
JSON_KEYS = ("personal", "business", "investing", "3i", "deals", "introductions")
HEADINGS = ("Personal", "Business", "Investing", "3i", "Deals", "Introductions")
NOTE_SECTIONS = SECTIONS[:4]

# States of a profile version and of a run-log row.
PROFILE_STATUSES = ("pending", "processing", "completed", "failed", "archived")
LOG_STATUSES = ("completed", "failed", "skipped")

DEFAULT_GENERATOR = "structured_insight"
NULL_SUBTYPE = "null"
NO_DATE = "N/A"

_STR = T.StringType()

NOTES = T.StructType([
    T.StructField("eni_id", _STR), T.StructField("contact_id", _STR),
    T.StructField("eni_source_type", _STR), T.StructField("eni_source_subtype", _STR),
    T.StructField("description", _STR), T.StructField("logged_date", T.DateType()),
])

RUN_LOG = T.StructType([
    T.StructField("eni_id", _STR), T.StructField("contact_id", _STR),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("processing_status", _STR), T.StructField("processor_version", _STR),
    T.StructField("processing_duration_ms", T.LongType()),
    T.StructField("error_message", _STR), T.StructField("batch_id", _STR),
    T.StructField("processing_mode", _STR), T.StructField("processing_environment", _STR),
    T.StructField("processor_system_prompt_key", _STR),
    T.StructField("processor_generator", _STR),
])

RULES = T.StructType([
    T.StructField("eni_source_type", _STR), T.StructField("subtype", _STR),
    T.StructField("ord", T.IntegerType()),
])

INSIGHTS = T.StructType(
    [T.StructField(s, _STR) for s in SECTIONS]
    + [T.StructField("extra", T.MapType(_STR, _STR))])

PROFILE_VERSIONS = T.StructType([
    T.StructField("contact_id", _STR), T.StructField("eni_id", _STR),
    T.StructField("member_name", _STR), T.StructField("generator", _STR),
    T.StructField("system_prompt_key", _STR), T.StructField("context_files", _STR),
    T.StructField("processing_status", _STR),
    T.StructField("eni_source_types", T.ArrayType(_STR)),
    T.StructField("eni_source_subtypes", T.ArrayType(_STR)),
    T.StructField("record_count", T.IntegerType()),
    T.StructField("total_eni_ids", T.IntegerType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("insights", INSIGHTS),
    T.StructField("generated_at", T.TimestampType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("est_input_tokens", T.LongType()),
    T.StructField("est_insights_tokens", T.LongType()),
    T.StructField("generation_time_seconds", T.DoubleType()),
])

RUN_EVENTS = T.StructType([
    T.StructField("run_id", _STR), T.StructField("event", _STR),
    T.StructField("contact_id", _STR), T.StructField("status", _STR),
    T.StructField("stage", _STR), T.StructField("duration_ms", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

CALLS = T.StructType([
    T.StructField("call_key", _STR), T.StructField("response", _STR),
    T.StructField("error", _STR), T.StructField("attempts", T.IntegerType()),
    T.StructField("seconds", T.DoubleType()), T.StructField("run_id", _STR),
])
