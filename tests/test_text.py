"""Text functions case by case."""
import pytest
from pyspark.sql import functions as F

from dossier.functions import prompts, responses, sections, text
from dossier.operators import versions
from dossier.schemas import SECTIONS
from dossier.sinks import builders


def one(spark, value, fn):
    df = spark.createDataFrame([(value,)], "c STRING")
    return df.select(fn(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize("value,tokens", [
    (None, 0), ("", 0), ("a", 1), ("abcd", 1), ("abcdefgh", 2), ("é" * 11, 2), ("日本語日", 1)])
def test_estimate_tokens(spark, value, tokens):
    assert one(spark, value, text.estimate_tokens) == tokens


@pytest.mark.parametrize("value", [None, "", "  ", "\t\n", "None", "nan", "NaT", "NONE"])
def test_null_subtypes(spark, value):
    assert one(spark, value, text.norm_subtype) == "null"


@pytest.mark.parametrize("value", ["NULL", "biography", " nan x"])
def test_other_subtypes_stay(spark, value):
    assert one(spark, value, text.norm_subtype) == value


@pytest.mark.parametrize("value,shown", [
    (None, "N/A"), ("", "N/A"), (" \n", "N/A"), ("NaT", "N/A"), ("null", "N/A"), (" 2024-01-02 ", "2024-01-02")])
def test_date_text(spark, value, shown):
    assert one(spark, value, text.date_text) == shown


def test_citations(spark):
    c = "- a\n  * [2024-01-01,ENI-1]\n  * [N/A,ENI-2]\n- b\n  * [2024-01-01, ENI-3 ,type] [x] [open"
    got = [tuple(r) for r in one(spark, c, sections.citations)]
    assert got == [("2024-01-01", "ENI-1", None), (None, "ENI-2", None), ("2024-01-01", "ENI-3", "type")]
    kept = one(spark, c, lambda x: sections.citations(x, keep_no_date=True))
    assert kept[1]["cited_date"] == "N/A"
    assert one(spark, None, sections.citations) == []


def test_heading_sections(spark):
    md = "intro\n## Personal\n\n a\n### sub\nb \n\n## Business\n## Deals\n x ## y\n## Deals\nlater"
    got = one(spark, md, lambda c: sections.heading_sections("c"))
    # an empty section takes the heading line that follows it, as the line break is used up
    assert got["personal"] == "a\n### sub\nb"
    assert got["business"] == "## Deals\n x ## y"
    assert got["deals"] == "x ## y"
    assert got["investing"] == ""
    assert one(spark, md, lambda c: sections.heading_section("c", "Deals")) == "x ## y"
    assert one(spark, None, lambda c: sections.heading_sections("c"))["personal"] == ""


def test_display_markdown_and_note(spark):
    md = "- a\n  * [N/A,E1]\n  * more\n   * deep\n  *"
    assert one(spark, md, sections.display_markdown) == "- a\n    [N/A,E1]\n    • more\n   * deep\n    • "
    df = spark.createDataFrame([("p", "", None, "n", "d", "i")], ", ".join(f"{s} STRING" for s in SECTIONS))
    note = df.select(sections.note_content(F.struct(*SECTIONS)).alias("r")).first()["r"]
    assert note == "**Personal:**\np\n\n**3I:**\nn"


def test_render_order(spark):
    tpl = "{{a}} {{b}} {{a}}"
    got = one(spark, tpl, lambda c: text.render(c, [("a", F.lit("x{{b}}")), ("b", F.lit("{{a}}"))]))
    assert got == "x{{a}} {{a}} x{{a}}"


def test_front_matter(spark):
    df = spark.createDataFrame([("c1", 'say "x"\ny', 3, None)], "a STRING, b STRING, n INT, z STRING")
    got = df.select(prompts.front_matter([("a", F.col("a"), "text"), ("b", F.col("b"), "text"),
                                          ("n", F.col("n"), "number"), ("z", F.col("z"), "text")])).first()[0]
    assert got == '---\na: "c1"\nb: |\n  say "x"\n  y\nn: 3\nz: null\n---\n'


FENCE = "```"
CASES = [
    (f'{FENCE}json\n{{"personal": "a", "3i": "n"}}\n{FENCE}', {"personal": "a", "three_i": "n"}),
    ('{"business": "b", "extra": [1]}', {"business": "b"}),
    ('{"three_i": "n"}', {"three_i": "n"}),
    (f'text {FENCE}\n{{"deals": "d"}}\n{FENCE}', {"deals": "d"}),
    ('{"existing_member_summary": "## Personal\\nx"}', {"personal": "x"}),
    ('{"existing_member_summary": null}', {}),
    ("## Personal\nx\n## 3i\ny", {"personal": "x", "three_i": "y"}),
    (f"{FENCE}json\n{{broken\n{FENCE}\n## Personal\nx", None),
    (f'{FENCE}json\n[1]\n{FENCE}', None),
    (f'{FENCE}json\n{{"personal": 3}}\n{FENCE}', None),
    ('[1, 2]', {}),
    ('{"personal": 3}', {}),
    ("free text", {}),
    ('{}', {}),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("response,want", CASES)
def test_parse_response(spark, response, want):
    df = spark.createDataFrame([(response,)], "response STRING")
    got = responses.parse_response(df).first()["sections"]
    if want is None:
        assert got is None
    else:
        assert {s: got[s] for s in SECTIONS if got[s]} == want


def test_parse_blank_json_retries_headings(spark):
    r = f'{FENCE}json\n{{"personal": " "}}\n{FENCE}\n## Deals\nd'
    df = spark.createDataFrame([(r,)], "response STRING")
    assert responses.parse_response(df).first()["sections"]["deals"] == "d"


def test_simple_tails(spark):
    df = spark.createDataFrame([("oops",)], "response STRING")
    raw = responses.parse_response_simple(df, tail="raw").first()
    assert raw["raw_content"] == "oops" and raw["sections"]["personal"] == ""
    error = responses.parse_response_simple(df, tail="error").first()
    assert error["parse_error"] and error["sections"] is None
    assert responses.parse_response_simple(df, tail="blank").first()["sections"]["deals"] == ""


@pytest.mark.parametrize("value,want", [
    ('{"a": 1} x', None), ('4763 words', None), ('"a" b', None), ('1, 2', None), ('1] 2', None), ('{"a": 1}{"a": 2}', None),
    ('', None), (None, None), (' {"a": [1, "]"]}\n', '{"a":[1,"]"]}'), ('[1, 2]', '[1,2]'), ('4763', '4763'), ('null', 'null'),
])
def test_json_is_a_whole_text(spark, value, want):
    df = spark.createDataFrame([(value,)], "t STRING")
    assert df.select(F.to_json(text.whole_json(F.col("t")))).first()[0] == want


def test_words_after_a_number_are_no_response(spark):
    df = spark.createDataFrame([("4763 words",)], "response STRING")
    assert responses.parse_response_simple(df, tail="raw").first()["raw_content"] == "4763 words"
    assert responses.parse_response_simple(df, tail="error").first()["parse_error"]
    doc = builders.profile_document(F.lit("C"), F.lit("E"), F.col("response"), F.lit("now"))
    assert '"raw_content":"4763 words"' in df.select(doc).first()[0]


@pytest.mark.parametrize("doc,cid,error", [
    ('{"contactId": "CNT-000001", "content": {"personal": "x"}}', "CNT-000001", None),
    ('{"contact_id": "", "metadata": {"Contact_ID": "CNT-000002"}, "personal": "x"}', "CNT-000002", None),
    ('{"personal": "x"}', None, "Missing contact_id"),
    ('{"contact_id": "CNT-000001", "insights": {"deals": 1}}', "CNT-000001", "Invalid content format"),
    ('[1]', None, "Invalid JSON"), ('{', None, "Invalid JSON"),
])
def test_normalize_records(spark, doc, cid, error):
    row = responses.normalize_records(spark.createDataFrame([(doc,)], "doc STRING")).first()
    assert (row["contact_id"], row["record_error"]) == (cid, error)


def test_falsy_top_level_gives_way(spark):
    doc = '{"contact_id": "CNT-1", "record_count": 0, "eni_id": "", "metadata": {"record_count": 5, "eni_id": "E"}}'
    row = responses.normalize_records(spark.createDataFrame([(doc,)], "doc STRING")).first()
    assert (row["record_count"], row["eni_id"], row["total_eni_ids"]) == (5, "E", 1)


@pytest.mark.parametrize("response,extra", [
    ('{"personal": "x", "hobbies": "chess", "n": [1, null], "none": null}', {"hobbies": "chess", "n": "[1,null]", "none": None}),
    ('```json\n{"3i": "x", "three_i": "y"}\n```', None),
    ('text ```\n{"deals": "x", "$.a \\"b\\"": "c"}\n```', {'$.a "b"': "c"}),
    ('{"existing_member_summary": "## Deals\\nx", "hobbies": "chess"}', None), ("## Deals\nx", None)])
def test_extra_keys_of_a_response(spark, response, extra):
    df = spark.createDataFrame([(response,)], "response STRING")
    got = responses.parse_response(df).first()["sections"]
    assert got["extra"] == extra and any(got[s] for s in SECTIONS)
    if not response.startswith("text") and "##" not in response:
        assert responses.parse_response_simple(df).first()["sections"]["extra"] == extra


def test_extra_keys_in_flat_rows(spark):
    """Rows without further keys are written as before, and a null value stays a key."""
    docs = ['{"contact_id": "a", "content": {"deals": "x", "none": null, "q": "\\"\\\\"}}', '{"contact_id": "b", "content": {}}']
    good = responses.normalize_records(spark.createDataFrame([(d,) for d in docs], "doc STRING")).select("contact_id", "sections")
    flat = versions.to_rows(good)
    assert [r["insights"].count("null") for r in flat.orderBy("contact_id").collect()] == [6, 6]
    back = {r["contact_id"]: r["sections"]["extra"] for r in versions.from_rows(flat).collect()}
    assert back == {"a": {"none": None, "q": '"\\'}, "b": None}


def test_profile_json_is_readable(spark):
    import json
    df = spark.createDataFrame([('a "q"\n\\', None, None, "n", None, "ü\t")], ", ".join(f"{s} STRING" for s in SECTIONS))
    got = df.select(sections.profile_json(F.struct(*SECTIONS)).alias("r")).first()["r"]
    want = {"personal": 'a "q"\n\\', "business": "", "investing": "", "3i": "n", "deals": "", "introductions": "ü\t"}
    assert got == json.dumps(want, ensure_ascii=False, indent=2)


def test_headings_of_a_response_are_split_once(spark):
    """One split for the response and one for the text of a wrapper key, not one for each section."""
    df = responses.parse_response(spark.createDataFrame([("## Personal\nx",)], "response STRING"))
    assert df.first()["sections"]["personal"] == "x"
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        plan = df.select("*")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("split(") == 2


@pytest.mark.parametrize("value,out", [
    ("{}", "{}"), (" \r\n\t[1]", "[1]"), ('"x"', '"x"'), ("-1", "-1"), ("true", "true"), ("tru", None), ("## a", None),
    ("- a", None), ("'a'", None), ("NaN", None), ("+1", None), ("/**/1", None), ("\ufeff{}", None), ("\x0b{}", None),
    ("", None), (None, None), ("1,2", None), ("{} x", None)])
def test_whole_json_by_its_start(spark, value, out):
    assert one(spark, value, lambda c: F.to_json(text.whole_json(c))) == out
