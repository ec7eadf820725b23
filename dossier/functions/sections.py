"""Profile sections: headings, JSON text, citations, display form."""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.functions.text import WHITE_SPACE, is_blank, strip
from dossier.schemas import HEADINGS, INSIGHTS, JSON_KEYS, NO_DATE, NOTE_SECTIONS, SECTIONS

# Fixed value: a citation is ``[date,id]`` or ``[date,id,type]``.
CITATION = r"\[([^,\]]+),([^\]]+)\]"


def citations(c: Column, keep_no_date: bool = False) -> Column:
    """``array<struct<cited_date, eni_id, source_type>>`` of the citations in a text.

    ``N/A`` becomes a NULL date unless ``keep_no_date`` is set.
    """
    def parse(m: Column) -> Column:
        inner = F.substring(m, F.lit(2), F.length(m) - 2)
        date = strip(F.substring_index(inner, ",", 1))
        rest = F.substring(inner, F.instr(inner, ",") + F.lit(1), F.length(inner))
        kind = strip(F.split_part(rest, F.lit(","), F.lit(2)))
        return F.struct(
            (date if keep_no_date else F.nullif(date, F.lit(NO_DATE))).alias("cited_date"),
            strip(F.split_part(rest, F.lit(","), F.lit(1))).alias("eni_id"),
            F.nullif(kind, F.lit("")).alias("source_type"))

    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(CITATION), F.lit(0))
    return F.transform(found, parse)


def _heading_parts(text: str) -> str:
    """SQL for ``array<struct<name, body>>``: the text under each heading, in order.

    A heading at once followed by another one takes that line as its text: the line break before
    the second heading already ends the first.
    """
    body = ("if(instr(x, char(10)) > 0, substring(x, instr(x, char(10)) + 1), "
            "concat('## ', get(p, i + 1)))")
    part = f"named_struct('name', substring_index(x, char(10), 1), 'body', {body})"
    split = f"split(concat(char(10), coalesce({text}, '')), concat(char(10), '## '))"
    # a one-element array binds the split text to a name, so that it is split one time
    return f"get(transform(array({split}), p -> transform(p, (x, i) -> {part})), 0)"


def _under(parts: str, name: str) -> str:
    found = f"get(filter({parts}, h -> h.name = '{name}' AND h.body IS NOT NULL), 0).body"
    blanks = "concat(" + ", ".join(f"char({ord(b)})" for b in WHITE_SPACE) + ")"
    return f"coalesce(btrim({found}, {blanks}), '')"


def heading_section(text: str, name: str) -> Column:
    """the text under ``## name`` up to the next heading of that level, stripped.

    ``text`` is a column name or SQL expression, as lambdas over it are far shorter in SQL.
    """
    return F.expr(_under(_heading_parts(text), name))


def heading_sections(text: str, extra: str = "") -> Column:
    """All six sections of a text that uses headings; ``text`` as in :func:`heading_section`.

    ``extra`` is SQL of further fields.  They belong in here: ``withField`` over the result would
    split the text anew for each of its fields.
    """
    fields = ", ".join(f"'{s}', {_under('q', h)}" for h, s in zip(HEADINGS, SECTIONS)) + extra
    return F.expr(f"get(transform(array({_heading_parts(text)}), q -> named_struct({fields})), 0)")


def all_empty(s: Column) -> Column:
    """none of the six sections holds anything but white space."""
    out = is_blank(s[SECTIONS[0]])
    for name in SECTIONS[1:]:
        out = out & is_blank(s[name])
    return out


def stored_sections(df: DataFrame) -> DataFrame:
    """``sections`` in the form they are stored in, whichever fields they came with."""
    have = df.schema["sections"].dataType.names
    fields = [(F.col("sections")[f.name] if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
              for f in INSIGHTS]
    return df.withColumn("sections", F.when(F.col("sections").isNotNull(), F.struct(*fields)))


def json_string(c: Column) -> Column:
    """A text as a quoted JSON string; NULL stays NULL."""
    # a one-element array binds the document to a name, so that it is made one time
    doc = F.array(F.to_json(F.struct(c.alias("v"))))
    return F.when(c.isNotNull(), F.transform(doc, lambda d: F.substring(d, F.lit(6), F.length(d) - 6))[0])


def json_object(items: list[tuple[str, Column]], indent: str = "") -> Column:
    """An indented JSON object of already encoded values."""
    parts: list[Column] = []
    for i, (key, value) in enumerate(items):
        parts.append(F.lit(("{\n" if i == 0 else ",\n") + f'{indent}  "{key}": '))
        parts.append(F.coalesce(value, F.lit("null")))
    return F.concat(*parts, F.lit(f"\n{indent}}}"))


def profile_json(s: Column | None) -> Column:
    """six-key JSON text of a profile, empty text for what is missing."""
    def value(name: str) -> Column:
        return F.lit('""') if s is None else json_string(F.coalesce(s[name], F.lit("")))

    return json_object([(k, value(n)) for k, n in zip(JSON_KEYS, SECTIONS)])


def display_markdown(c: Column) -> Column:
    """sub-bullets indented for display; citations lose their star, others get a dot."""
    def line(x: Column) -> Column:
        tail = F.substring(x, F.lit(5), F.length(x))
        return (F.when(x.startswith("  * ["), F.concat(F.lit("    "), tail))
                .when(x.startswith("  *"), F.concat(F.lit("    • "), tail))
                .otherwise(x))

    return F.array_join(F.transform(F.split(c, "\n"), line), "\n")


def note_content(s: Column) -> Column:
    """the first four sections under bold titles, blank line between."""
    def block(name: str, title: str) -> Column:
        return F.when(F.length(s[name]) > 0,
                      F.concat(F.lit(f"**{title}:**\n"), display_markdown(s[name])))

    titles = [k.title() for k in JSON_KEYS[:4]]
    return F.concat_ws("\n\n", *[block(n, t) for n, t in zip(NOTE_SECTIONS, titles)])


# Own wording: what an empty profile offers for the two sections that are laid out in parts.
DEALS_SKELETON = "**Experienced in:**\n\n**Wants to explore:**\n\n**Stays away from:**\n"
INTRODUCTIONS_SKELETON = "**Wants to meet:**\n\n**Does not want to meet:**\n"


def with_skeleton(s: Column, deals: str = DEALS_SKELETON,
                  introductions: str = INTRODUCTIONS_SKELETON) -> Column:
    """empty text for missing sections, a layout for missing deals and introductions."""
    defaults = {"deals": deals, "introductions": introductions}
    return F.struct(*[
        F.coalesce(F.nullif(s[n], F.lit("")), F.lit(defaults.get(n, ""))).alias(n)
        for n in SECTIONS])


def uncited(s: Column) -> Column:
    """V4: names of the sections that hold text but no citation."""
    return F.array_compact(F.array(*[
        F.when((F.length(s[n]) > 0) & ~s[n].rlike(CITATION), F.lit(n)) for n in SECTIONS]))
