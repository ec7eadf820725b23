"""Prompt and document text."""
from pyspark.sql import Column
from pyspark.sql import functions as F

from dossier.functions.sections import json_object, json_string
from dossier.functions.text import estimate_tokens, ordered_join
from dossier.schemas import NULL_SUBTYPE

# Fixed value: tokens set aside for the fixed parts of a prompt.
OVERHEAD_TOKENS = 500


def front_matter(fields: list[tuple[str, Column, str]]) -> Column:
    """YAML front matter; each field is (key, column, ``text`` or ``number``).

    Text is quoted, text with quotes or line breaks becomes a block, NULL is ``null``.
    """
    lines = [F.lit("---")]
    for key, c, kind in fields:
        if kind == "number":
            body = F.concat(F.lit(f"{key}: "), c.cast("string"))
        else:
            block = F.array_join(
                F.transform(F.split(c, "\n"), lambda x: F.concat(F.lit("  "), x)), "\n")
            body = (F.when(c.rlike("[\\n\"']"), F.concat(F.lit(f"{key}: |\n"), block))
                    .otherwise(F.concat(F.lit(f'{key}: "'), c, F.lit('"'))))
        lines.append(F.when(c.isNull(), F.lit(f"{key}: null")).otherwise(body))
    return F.concat_ws("\n", *lines, F.lit("---"), F.lit(""))


def row_json(cols: list[str], null_as: str | None = None) -> Column:
    """One row as an indented JSON object; every value is text, NULL is null or ``null_as``."""
    def value(name: str) -> Column:
        text = F.col(name).cast("string")
        return json_string(text if null_as is None else F.coalesce(text, F.lit(null_as)))

    return F.concat(F.lit("  "), json_object([(c, value(c)) for c in cols], "  "))


def rows_json(cols: list[str], order: list[Column], null_as: str | None = None) -> Column:
    """aggregate that gives the rows of a group as a JSON array text.

    Meant for groups already cut to a token budget.
    """
    return F.concat(F.lit("[\n"), ordered_join(order, row_json(cols, null_as), ",\n"),
                    F.lit("\n]"))


def group_header(source_type: Column, subtype: Column) -> Column:
    """upper-case header of one (type, subtype) group."""
    tail = F.when(F.coalesce(subtype, F.lit("")).isin("", NULL_SUBTYPE), F.lit("")).otherwise(
        F.concat(F.lit(" / "), F.upper(subtype)))
    return F.concat(F.lit("=== "), F.upper(source_type), tail, F.lit(" ==="))


def row_text(eni_id: Column, date: Column, member: Column | None, content: Column) -> Column:
    """one note as labelled lines; absent parts are left out."""
    member_line = (F.lit(None).cast("string") if member is None
                   else F.when(F.length(member) > 0, F.concat(F.lit("member = "), member)))
    return F.concat_ws(
        "\n",
        F.concat(F.lit("note = "), F.coalesce(eni_id, F.lit("?"))),
        F.concat(F.lit("on = "), F.coalesce(date.cast("string"), F.lit("?"))),
        member_line,
        F.concat(F.lit("says = "), content))


# The labels each prompt layout uses; the closing lines are our own wording.
LAYOUTS = {
    "numbered": ("SYSTEM PROMPT:\n", "\nCONTEXT INFORMATION:\n", "\nMEMBER DATA:\n", "\n\n",
                 "\nAnswer from the information above."),
    "plain": ("", "Context Information:\n", "Member Data:\n", "\n\n",
              "Summarise the member from the prompt, context and data above."),
    "banner": ("", "=== CONTEXT ===\n", "=== MEMBER DATA ===\n", "\n\n",
               "Answer in the format asked for, using the data above."),
}


def assemble_prompt(system: Column, context: Column, data: Column, layout: str,
                    extra: Column | None = None) -> Column:
    """the final prompt in one of three layouts.

    ``banner`` leaves the context out when it is empty; ``numbered`` takes an optional extra
    block between context and data.
    """
    head, ctx, body, sep, closing = LAYOUTS[layout]
    context_part = F.concat(F.lit(ctx), F.coalesce(context, F.lit("")))
    if layout == "banner":
        context_part = F.when(F.length(context) > 0, context_part)
    parts = [F.concat(F.lit(head), F.coalesce(system, F.lit(""))), context_part]
    if extra is not None and layout == "numbered":
        parts.append(F.when(F.length(extra) > 0,
                            F.concat(F.lit("\nADDITIONAL CONTEXT:\n"), extra)))
    parts += [F.concat(F.lit(body), F.coalesce(data, F.lit(""))), F.lit(closing)]
    return F.concat_ws(sep, *parts)


def available_tokens(base: Column, window: int, reserve: int, cap: int) -> Column:
    """Tokens left for new notes once everything else has its share."""
    room = F.greatest(F.lit(0), F.lit(window - reserve - OVERHEAD_TOKENS) - base)
    return F.least(F.lit(cap), room)


def token_stats(base: Column, new_data: Column, profile: Column, type_ctx: Column,
                subtype_ctx: Column, template: Column, rendered: Column,
                window: int, reserve: int, cap: int) -> Column:
    """how the token window of one prompt is used, part by part."""
    used = estimate_tokens(new_data)
    return F.struct(
        F.lit(window).alias("context_window_tokens"),
        F.lit(reserve).alias("reserve_output_tokens"),
        base.alias("base_tokens"),
        F.lit(OVERHEAD_TOKENS).alias("overhead_tokens"),
        available_tokens(base, window, reserve, cap).alias("available_for_new_data"),
        used.alias("new_data_tokens_used"),
        (base + used).alias("total_rendered_tokens"),
        estimate_tokens(profile).alias("existing_summary_tokens"),
        estimate_tokens(type_ctx).alias("type_context_tokens"),
        estimate_tokens(subtype_ctx).alias("subtype_context_tokens"),
        estimate_tokens(template).alias("system_prompt_tokens"),
        estimate_tokens(rendered).alias("rendered_full_tokens"))
