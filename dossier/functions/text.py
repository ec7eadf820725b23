"""Text primitives: tokens, trimming, null spellings, note entries, templates."""
from pyspark.sql import Column
from pyspark.sql import functions as F

from dossier.schemas import NO_DATE, NULL_SUBTYPE

# Fixed value: what counts as white space, the same as ``\\s`` in a pattern.
WHITE_SPACE = " \t\n\x0b\f\r"

# What a JSON value can start with.
JSON_START = r'^[ \t\n\r]*[{\["\-0-9tfn]'


def strip(c: Column) -> Column:
    """Drop white space at both ends; plain ``trim`` would keep tabs and line breaks.

    Looks at the ends only, where a regular expression would try every blank of a long text.
    """
    return F.btrim(c, F.lit(WHITE_SPACE))


def is_blank(c: Column) -> Column:
    """NULL, empty or white space only."""
    return ~F.coalesce(c.rlike(r"\S"), F.lit(False))


def whole_json(c: Column) -> Column:
    """The JSON value that a text is as VARIANT, NULL unless the whole text is one value.

    ``try_parse_json`` alone takes the first value and passes over whatever text follows it.  The
    text is parsed as the first of two elements here; the other is its hash, which ends the array
    where nothing but the one value comes before.  A text that starts like no JSON value is not
    parsed, as a parser that gives up costs far more than the look at the start.
    """
    def value(t: Column) -> Column:
        t = F.when(t.rlike(JSON_START), t)
        mark = F.xxhash64(t)
        both = F.try_parse_json(F.concat(F.lit("["), t, F.lit(","), mark.cast("string"), F.lit("]")))
        return F.transform(F.array(both), lambda v: F.when(
            F.try_variant_get(v, "$[1]", "long") == mark, F.try_variant_get(v, "$[0]", "variant")))[0]

    return F.transform(F.array(c), value)[0]


def estimate_tokens(c: Column) -> Column:
    """0 for NULL or empty text, else a quarter of the code points, at least 1."""
    # no CASE: Spark works out what stands in a condition and in its branch twice
    n = F.coalesce(F.length(c), F.lit(0))
    return F.greatest(F.least(n, F.lit(1)), F.shiftright(n, 2))


def norm_subtype(c: Column) -> Column:
    """NULL, blank and the spellings none / nan / nat all become ``null``."""
    spelled = F.lower(c).isin("none", "nan", "nat")
    return F.when(is_blank(c) | spelled, F.lit(NULL_SUBTYPE)).otherwise(c)


def date_text(c: Column) -> Column:
    """the date as text, or ``N/A`` when there is none."""
    s = strip(c.cast("string"))
    missing = s.isNull() | (s == "") | F.lower(s).isin("nan", "nat", "none", "null")
    return F.when(missing, F.lit(NO_DATE)).otherwise(s)


def note_entry(text: Column, date: Column, eni_id: Column, source_type: Column) -> Column:
    """one bullet with its citation sub-bullet.

    ``date`` is a DATE, as the note schema declares; dates held as text go through
    :func:`date_text` first.
    """
    return F.concat(
        F.lit("- "), strip(text), F.lit("\n  * ["),
        F.coalesce(date.cast("string"), F.lit(NO_DATE)), F.lit(","),
        F.coalesce(strip(eni_id), F.lit("")), F.lit(","), source_type, F.lit("]\n"))


def ordered_join(order: list[Column], text: Column, sep: str = "") -> Column:
    """aggregate that joins ``text`` in the given order.

    Use it only on groups whose size is bounded (the token budget, the number of rules).
    """
    row = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], text.alias("t"))
    return F.array_join(
        F.transform(F.array_sort(F.collect_list(row)), lambda r: r["t"]), sep)


def render(template: Column, values: list[tuple[str, Column]]) -> Column:
    """replace ``{{key}}`` in the given order; NULL counts as empty.

    A value that holds a later placeholder is expanded in its turn, as keys are replaced one
    after the other.
    """
    out = F.coalesce(template, F.lit(""))
    for key, value in values:
        out = F.replace(out, F.lit("{{" + key + "}}"), F.coalesce(value, F.lit("")))
    return out


def group_id(source_type: Column, subtype: Column, contact: Column, n: Column) -> Column:
    """F16: id of one (type, subtype) group of a contact."""
    return F.concat(F.lit("COMBINED-"), source_type, F.lit("-"), subtype, F.lit("-"), contact,
                    F.lit("-"), n.cast("string"), F.lit("ENI"))


def contact_all_id(contact: Column) -> Column:
    """F16: id under which all groups of a contact are stored."""
    return F.concat(F.lit("COMBINED-"), contact, F.lit("-ALL"))


def contact_count_id(contact: Column, n: Column) -> Column:
    """F16: id of a whole-contact run over ``n`` notes."""
    return F.concat(F.lit("COMBINED-"), contact, F.lit("-"), n.cast("string"), F.lit("ENI"))


def batch_id(contact: Column) -> Column:
    """F16: id given to a batch record that has none."""
    return F.concat(F.lit("BATCH-"), contact)


def safe_name(contact: Column, eni_id: Column, ext: str = ".md") -> Column:
    """file name of a contact's document with path separators replaced."""
    return F.concat(F.translate(contact, "/\\", "__"), F.lit("_"),
                    F.translate(eni_id, "/\\", "__"), F.lit(ext))


def contact_from_name(name: Column) -> Column:
    """the contact id a file name starts with."""
    return F.substring_index(name, "_", 1)


def id_from_name(name: Column) -> Column:
    """What follows the first ``_`` of a file name, without its extension; NULL without ``_``."""
    stem = F.regexp_replace(name, r"\.[^.]*\z", "")
    at = F.instr(stem, "_")
    return F.when(at > 0, F.substring(stem, at + F.lit(1), F.length(stem)))


def bullets(section: Column) -> Column:
    """The bullets of a section, each with the sub-bullets under it."""
    return F.filter(F.split(section, r"\n(?=- )"), lambda b: b.rlike(r"\S"))


def norm_bullet(c: Column) -> Column:
    """The form in which two bullets are compared: lower case, white space collapsed."""
    return F.lower(F.regexp_replace(strip(c), r"\s+", " "))
