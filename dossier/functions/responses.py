"""Model responses and loose JSON records turned into typed sections."""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.functions.sections import all_empty, heading_sections
from dossier.functions.text import whole_json
from dossier.schemas import DEFAULT_GENERATOR, JSON_KEYS, SECTIONS

# The two kinds of fence a response may be wrapped in, and the wrapper key.
JSON_FENCE = r"(?s)```json\s*(.*?)\s*```"
ANY_FENCE = r"(?s)```\s*(.*?)\s*```"
WRAPPER_KEY = "existing_member_summary"


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out one time per row.

    Spark puts the expression of a column in place of every later use of it, filters included.
    For a parsed document with many fields that repeats the parsing many times over; a generator
    with one element is a point across which it does not do that.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


# The expressions over a parsed document are given as SQL text: one document has dozens of paths,
# and building each from Column calls takes longer than running it.

def _text(v: str, path: str) -> str:
    return f"try_variant_get({v}, '{path}', 'string')"


def _inner(v: str, path: str) -> str:
    return f"try_variant_get({v}, '{path}', 'variant')"


def _is_object(v: str) -> str:
    return f"coalesce(schema_of_variant({v}) LIKE 'OBJECT%', false)"


def _is_text(v: str, path: str) -> str:
    """The path is missing, null or text."""
    return f"coalesce(schema_of_variant({_inner(v, path)}), 'VOID') IN ('STRING', 'VOID')"


def _paths(name: str, key: str) -> list[str]:
    return [f"$.{name}"] if name == key else [f"$.{key}", f"$.{name}"]


def extra_sections(v: str) -> str:
    """SQL of the keys of a JSON object that are none of the six sections, with their values.

    Text stays as it is, any other value is its JSON text; NULL where no key is left or ``v``, the
    name of a VARIANT column, is no object.
    """
    known = ", ".join(f"'{k}'" for k in dict.fromkeys(SECTIONS + JSON_KEYS))
    left = f"map_filter(try_variant_get({v}, '$', 'map<string,string>'), (k, x) -> k NOT IN ({known}))"
    return f"if({_is_object(v)} AND size({left}) > 0, {left}, NULL)"


def variant_sections(v: str) -> Column:
    """The sections of a JSON object, NULL unless each of the six is text, null or missing.

    Further keys are in ``extra``.  ``v`` names a VARIANT column.
    """
    tests, fields = [_is_object(v)], []
    for name, key in zip(SECTIONS, JSON_KEYS):
        paths = _paths(name, key)
        tests += [_is_text(v, p) for p in paths]
        fields.append(f"'{name}', coalesce({', '.join(_text(v, p) for p in paths)}, "
                      "CAST(NULL AS string))")
    fields.append(f"'extra', {extra_sections(v)}")
    return F.expr(f"if({' AND '.join(tests)}, named_struct({', '.join(fields)}), NULL)")


def _under_headings(text: str) -> Column:
    """Sections of a text with headings, in the form of :func:`variant_sections`."""
    return heading_sections(text, ", 'extra', CAST(NULL AS map<string,string>)")


def _read(v: str, mark: str) -> dict[str, Column]:
    """What a parsed response offers: its sections, or the text it wraps them in."""
    path = f"$.{WRAPPER_KEY}"
    wrapped = f"coalesce({_is_object(v)} AND {_inner(v, path)} IS NOT NULL, false)"
    text = f"if({wrapped} AND {_is_text(v, path)}, coalesce({_text(v, path)}, ''), NULL)"
    plain = F.when(~F.expr(wrapped), variant_sections(v))
    return {f"_wrapped{mark}": F.expr(text), f"_plain{mark}": plain}


def parse_response(df: DataFrame, response: str = "response", out: str = "sections") -> DataFrame:
    """F8: add a struct column with the sections of each response, NULL when unreadable.

    Keys of a JSON response beside the six are in ``extra``.

    A fenced ``json`` block is taken at its word: if it does not parse the result is NULL.
    Without one the whole text, then any fenced block, then headings are tried.  An outcome
    without any text gets one more try by headings.
    """
    r, col = F.col(response), F.col
    fenced = F.coalesce(r.rlike(JSON_FENCE), F.lit(False))
    first = F.when(fenced, F.regexp_extract(r, JSON_FENCE, 1)).otherwise(r)
    staged = once(df, _fenced=fenced, _first=whole_json(first))
    staged = once(staged, **_read("_first", "1"))
    unread = ~col("_fenced") & col("_wrapped1").isNull() & col("_plain1").isNull()
    staged = once(staged, _second=F.when(
        unread & r.rlike(ANY_FENCE), whole_json(F.regexp_extract(r, ANY_FENCE, 1))))
    staged = once(staged, **_read("_second", "2"))
    wrapped = F.coalesce("_wrapped1", "_wrapped2").isNotNull()
    staged = once(staged, _under=F.when(wrapped, _under_headings("coalesce(_wrapped1, _wrapped2)")),
                  _headings=_under_headings(f"`{response}`"))
    found = (F.when(col("_wrapped1").isNotNull(), col("_under"))
             .when(col("_plain1").isNotNull(), col("_plain1"))
             .when(col("_fenced"), F.lit(None))
             .when(col("_wrapped2").isNotNull(), col("_under"))
             .when(col("_plain2").isNotNull(), col("_plain2"))
             .otherwise(col("_headings")))
    staged = once(staged, _found=F.when(F.length(r) > 0, found))
    retry = all_empty(col("_found")) & ~all_empty(col("_headings"))
    best = F.when(col("_found").isNotNull(),
                  F.when(retry, col("_headings")).otherwise(col("_found")))
    return once(staged, **{out: best}).select(*df.columns, out)


def parse_response_simple(df: DataFrame, response: str = "response", tail: str = "raw",
                          out: str = "sections") -> DataFrame:
    """fenced ``json`` block, else the whole text, else what ``tail`` names.

    ``raw``: empty sections and the text in ``raw_content``; ``blank``: empty sections only;
    ``error``: the text in ``raw_content`` and a message in ``parse_error``.
    """
    r = F.col(response)
    fenced = F.coalesce(r.rlike(JSON_FENCE), F.lit(False))
    empty = F.struct(*[F.lit("").alias(s) for s in SECTIONS],
                     F.lit(None).cast("map<string,string>").alias("extra"))
    block = F.when(fenced, whole_json(F.regexp_extract(r, JSON_FENCE, 1)))
    # only "raw" goes on to the whole text after a fence that fails or holds nothing
    staged = once(once(df, _block=block), _block_text=F.to_json("_block"))
    useless = F.col("_block").isNull() | F.col("_block_text").isin("{}", "[]", "null")
    whole = F.when(useless if tail == "raw" else ~fenced, whole_json(r))
    staged = once(staged, _v=F.coalesce(
        F.when(~useless, F.col("_block")) if tail == "raw" else F.col("_block"), whole))
    v = F.col("_v")
    failed = v.isNull()
    found = variant_sections("_v")
    if tail == "blank":
        sections = F.coalesce(found, empty)
    else:
        sections = F.when(failed, empty if tail == "raw" else F.lit(None)).otherwise(found)
    staged = once(staged, **{out: sections})
    if tail != "blank":
        staged = staged.withColumn("raw_content", F.when(failed, r))
    if tail == "error":
        staged = staged.withColumn(
            "parse_error", F.when(failed, F.lit("Could not parse raw_content")))
    return staged.drop("_block", "_block_text", "_v")


# Spellings of the contact id key, tried in this order.
ID_KEYS = ("contact_id", "contactId", "Contact_ID")


def normalize_records(df: DataFrame, doc: str = "doc") -> DataFrame:
    """one typed row per JSON record.

    The id may be spelled three ways at the top or in ``metadata``; the sections may sit in
    ``insights``, in ``content`` or at the top; a top-level value that is empty or zero gives
    way to the one in ``metadata``.  Further keys of ``insights`` or ``content`` are kept in
    ``sections.extra``; at the top they are no sections.  Records without an id or with sections that are not text
    keep their row and get ``record_error``.
    """
    def first_id(prefix: str) -> str:
        return "coalesce(" + ", ".join(_text("_v", f"{prefix}.{k}") for k in ID_KEYS) + ")"

    def top_or_meta(name: str) -> str:
        top = _text("_v", f"$.{name}")
        return f"coalesce(nullif({top}, ''), {_text('_v', f'$.metadata.{name}')})"

    def count(name: str) -> str:
        top = f"nullif(try_variant_get(_v, '$.{name}', 'int'), 0)"
        return f"coalesce({top}, try_variant_get(_v, '$.metadata.{name}', 'int'), 1)"

    def names(name: str) -> str:
        top = f"try_variant_get(_v, '$.{name}', 'array<string>')"
        return (f"coalesce(if(size({top}) > 0, {top}, NULL), "
                f"try_variant_get(_v, '$.metadata.{name}', 'array<string>'))")

    fields = {
        "contact_id": f"coalesce(nullif({first_id('$')}, ''), {first_id('$.metadata')})",
        "eni_id": top_or_meta("eni_id"),
        "member_name": top_or_meta("member_name"),
        "eni_source_types": names("eni_source_types"),
        "eni_source_subtypes": names("eni_source_subtypes"),
        "generator": f"coalesce({top_or_meta('generator')}, '{DEFAULT_GENERATOR}')",
        "system_prompt_key": top_or_meta("system_prompt_key"),
        "context_files": top_or_meta("context_files"),
        "record_count": count("record_count"),
        "total_eni_ids": count("total_eni_ids"),
        "generated_at_text": _text("_v", "$.metadata.generated_at"),
        "processing_status": f"coalesce({_text('_v', '$.metadata.processing_status')}, 'completed')",
        "version": "coalesce(try_variant_get(_v, '$.metadata.version', 'int'), 1)",
        "_body": f"CASE WHEN {_is_object(_inner('_v', '$.insights'))} THEN {_inner('_v', '$.insights')} "
                 f"WHEN {_is_object(_inner('_v', '$.content'))} THEN {_inner('_v', '$.content')} ELSE _v END",
        "_open": f"{_is_object(_inner('_v', '$.insights'))} OR {_is_object(_inner('_v', '$.content'))}",
    }
    staged = once(df, _v=whole_json(F.col(doc)))
    staged = once(staged, **{name: F.expr(sql) for name, sql in fields.items()})
    staged = once(staged, _found=variant_sections("_body"))
    extra = F.when(F.col("_open"), F.col("_found.extra"))
    staged = once(staged, sections=F.col("_found").withField("extra", extra))
    error = F.expr(f"CASE WHEN NOT {_is_object('_v')} THEN 'Invalid JSON' "
                   "WHEN coalesce(contact_id, '') = '' THEN 'Missing contact_id' "
                   "WHEN sections IS NULL THEN 'Invalid content format' END")
    return once(staged, record_error=error).drop("_v", "_body", "_open", "_found")
