"""A whole batch run: pending notes in, new profile versions and run-log rows out."""
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.checkpoints import freeze
from dossier.functions.responses import parse_response, parse_response_simple
from dossier.functions.sections import stored_sections
from dossier.functions.text import contact_all_id, estimate_tokens, group_id, render
from dossier.operators.budget import GROUP, PROMPT_KEYS, combine_groups, with_profile
from dossier.operators.generation import generate, generate_once, next_state, wave_numbers
from dossier.operators.rules import group_ordinal, union_groups
from dossier.operators.versions import assign_versions
from dossier.plans.preparation import group_frame, pending_notes, prompts_and_oversized, with_room, written_notes
from dossier.schemas import DEFAULT_GENERATOR
from dossier.sinks.builders import run_log_rows

# Token window of a prompt, share kept for the answer, most for new notes.
WINDOW_TOKENS = 400_000
RESERVE_TOKENS = 8_000
NEW_DATA_TOKENS = 12_000


@dataclass
class RunResult:
    """Frames of one run; the caller appends ``versions`` and ``log`` with the sinks.

    Every pending note is in ``log`` or in ``deferred``.  A note that is larger than the room of
    its prompt is in ``oversized`` too, and logged as failed with that reason; so is a note without
    an id, which no later run could tell from one that was not processed: those are in ``nameless``.
    Rows that repeat an id are notes of their own in the prompt and one row of the log.
    ``iterations`` has one row per call, with the tokens of the profile it was to replace.
    """
    versions: DataFrame
    log: DataFrame
    iterations: DataFrame
    oversized: DataFrame
    deferred: DataFrame
    nameless: DataFrame


def run_profiles(notes: DataFrame, log: DataFrame, rules: DataFrame, context: DataFrame,
                 versions: DataFrame, latest: DataFrame, template: str,
                 make_client: Callable[[], Callable[[str], str]], now: datetime,
                 prompt_key: str = DEFAULT_GENERATOR, window: int = WINDOW_TOKENS,
                 reserve: int = RESERVE_TOKENS, cap: int = NEW_DATA_TOKENS,
                 types: list[str] | None = None, attempts: int = 3, base_delay: float = 1.0,
                 concurrency: int | None = None, contacts: DataFrame | None = None,
                 ledger: str | None = None, run_id: str | None = None, chunk_calls: int = 10_000) -> RunResult:
    """Process every pending group of every contact, or of ``contacts`` (contact_id).

    ``latest`` has (contact_id, sections).  Wave k handles the k-th group of all contacts at
    once and sees the profiles of wave k - 1.  The pending notes are written once to the shared
    folder, split by wave, so a wave reads only its own, and so are the profiles of their contacts.

    Only notes that fit the budget are logged: ``completed`` when the response could be read,
    else ``failed``; the others come back in the next run.

    With a ``ledger``, a folder, and a ``run_id`` answers are saved as they come, a chunk of calls at a time: a run
    that was stopped in any wave and is started again with the same inputs and ``run_id`` takes
    them from there, see :func:`dossier.operators.generation.generate_once`.
    """
    if (ledger is None) != (run_id is None):
        raise ValueError("a ledger needs a run_id, and a run_id a ledger")
    ask = (lambda prompts: generate(prompts, make_client, attempts, base_delay, concurrency)) if ledger is None else (
        lambda prompts: generate_once(prompts, make_client, ledger, run_id, chunk_calls, attempts, base_delay, concurrency))
    if contacts is not None:
        notes = notes.join(contacts.select("contact_id").distinct(), "contact_id", "left_semi")
    pending, nameless = _identified(pending_notes(notes, log, rules, types))
    groups = freeze(group_ordinal(group_frame(pending)))
    work = freeze(pending.join(groups.select(*GROUP, "ordinal"), GROUP), ("ordinal",))

    state = freeze(stored_sections(latest.select("contact_id", "sections")).join(
        groups.select("contact_id").distinct(), "contact_id", "left_semi"))
    done: list[DataFrame] = []
    large: list[DataFrame] = []
    for k in wave_numbers(groups) or [1]:
        mine = groups.filter(F.col("ordinal") == k)
        dressed = freeze(with_room(mine, context, state, template, window, reserve, cap))
        wave = work.filter(F.col("ordinal") == k)
        prompts, too_large = prompts_and_oversized(wave, dressed, template, window, reserve, cap)
        large.append(too_large)
        # frozen at once: a client is called one time per prompt, all later steps see its answer
        out = freeze(_answer(prompts, ask))
        done.append(out)
        state = next_state(state, out.filter(F.col("sections").isNotNull()).select("contact_id", "sections"))
    iterations, oversized = union_groups(*done), union_groups(*large)
    return RunResult(_new_versions(iterations, versions, prompt_key, now),
                     _log_rows(iterations, oversized, nameless, prompt_key, now), iterations, oversized,
                     _deferred(pending, iterations, oversized), nameless)


def run_combined(notes: DataFrame, log: DataFrame, rules: DataFrame, context: DataFrame,
                 versions: DataFrame, latest: DataFrame, template: str,
                 make_client: Callable[[], Callable[[str], str]], now: datetime,
                 prompt_key: str = DEFAULT_GENERATOR, window: int = WINDOW_TOKENS,
                 reserve: int = RESERVE_TOKENS, cap: int = NEW_DATA_TOKENS,
                 types: list[str] | None = None, attempts: int = 3, base_delay: float = 1.0,
                 concurrency: int | None = None) -> RunResult:
    """One call per contact, whose prompt holds the notes of all its groups.

    Every group is cut to the room it would have alone, so a prompt is at most as many times the
    ``cap`` as there are rules.
    """
    pending, nameless = _identified(pending_notes(notes, log, rules, types))
    groups = freeze(group_frame(pending))
    dressed = freeze(with_room(groups, context, latest, template, window, reserve, cap))
    prompts, oversized = prompts_and_oversized(pending, dressed, template, window, reserve, cap)
    blocks = freeze(prompts.filter(F.col("rows_used") > 0))
    # bounded by the rules and their budgets
    per = blocks.groupBy("contact_id").agg(
        F.array_sort(F.flatten(F.collect_list("used_ids"))).alias("used_ids"),
        F.array_sort(F.collect_set("eni_source_type")).alias("eni_source_types"),
        F.array_sort(F.collect_set("subtype")).alias("eni_source_subtypes"))
    whole = with_profile(combine_groups(blocks).join(per, "contact_id"), latest)
    prompt = render(F.lit(template), list(zip(PROMPT_KEYS, [
        F.col("profile_json"), F.lit(""), F.lit(""), F.col("combined")])))
    sendable = whole.select(
        "contact_id", F.lit("all").alias("eni_source_type"), F.lit("all").alias("subtype"),
        F.lit(1).alias("ordinal"), "rows_total", "rows_used", "used_ids", "eni_source_types",
        "eni_source_subtypes", prompt.alias("prompt"), estimate_tokens(F.col("profile_json")).alias("existing_tokens")).withColumn(
        "input_tokens", estimate_tokens(F.col("prompt")).cast("long"))
    answered = parse_response_simple(generate(sendable, make_client, attempts, base_delay, concurrency), tail="error")
    iterations = freeze(answered.drop("prompt").withColumns({
        "output_tokens": estimate_tokens(F.col("response")).cast("long"),
        "error": F.coalesce("error", "parse_error")}))
    return RunResult(_new_versions(iterations, versions, prompt_key, now),
                     _log_rows(iterations, oversized, nameless, prompt_key, now), iterations, oversized,
                     _deferred(pending, iterations, oversized), nameless)


def _identified(pending: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pending notes, written once with a number for each row, and apart from them those without an id."""
    numbered = written_notes(pending)
    return numbered.filter("eni_id IS NOT NULL"), numbered.filter("eni_id IS NULL")


def _deferred(pending: DataFrame, iterations: DataFrame, oversized: DataFrame) -> DataFrame:
    """Pending notes that are in no prompt of the run, though they could be in one."""
    used = iterations.select(F.explode("used_ids").alias("eni_id"))
    return (pending.select(*GROUP, "eni_id").join(used, "eni_id", "left_anti")
            .join(oversized.select("eni_id"), "eni_id", "left_anti")
            .select(*GROUP, "eni_id", F.lit("no room in this run").alias("reason")).distinct())


def _answer(prompts: DataFrame, ask: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Responses and their sections for the groups that have at least one note."""
    sendable = prompts.filter(F.col("rows_used") > 0).select(
        *GROUP, "ordinal", "rows_total", "rows_used", "used_ids", "prompt",
        F.col("token_stats.rendered_full_tokens").cast("long").alias("input_tokens"),
        F.col("token_stats.existing_summary_tokens").alias("existing_tokens"))
    answered = parse_response(ask(sendable))
    return answered.drop("prompt").withColumn(
        "output_tokens", estimate_tokens(F.col("response")).cast("long"))


def _new_versions(iterations: DataFrame, versions: DataFrame, prompt_key: str,
                  now: datetime) -> DataFrame:
    stamped = iterations.filter(F.col("sections").isNotNull()).select(
        "contact_id", F.lit(DEFAULT_GENERATOR).alias("generator"),
        F.col("ordinal").alias("ord"), contact_all_id(F.col("contact_id")).alias("eni_id"),
        *(["eni_source_types", "eni_source_subtypes"] if "eni_source_types" in iterations.columns else
          [F.array("eni_source_type").alias("eni_source_types"),
           F.array("subtype").alias("eni_source_subtypes")]),
        F.concat("eni_source_type", F.lit("/"), "subtype").alias("context_files"),
        F.lit(prompt_key).alias("system_prompt_key"),
        F.lit("completed").alias("processing_status"),
        F.col("rows_used").cast("int").alias("record_count"),
        F.col("rows_used").cast("int").alias("total_eni_ids"), "sections",
        F.col("input_tokens").alias("est_input_tokens"),
        F.col("output_tokens").alias("est_insights_tokens"),
        F.col("seconds").alias("generation_time_seconds"),
        F.lit(now).cast("timestamp").alias("generated_at"))
    return assign_versions(stamped, versions)


def _log_rows(iterations: DataFrame, oversized: DataFrame, nameless: DataFrame, prompt_key: str,
              now: datetime) -> DataFrame:
    unread = F.col("sections").isNull()
    used = iterations.select(
        "contact_id", F.explode(F.array_distinct("used_ids")).alias("eni_id"),
        F.when(unread, "failed").otherwise("completed").alias("processing_status"),
        F.when(unread, F.coalesce("error", F.lit("unreadable response"))).alias("error_message"),
        group_id(F.col("eni_source_type"), F.col("subtype"), F.col("contact_id"),
                 F.col("rows_used")).alias("batch_id"))
    no_group = group_id(F.col("eni_source_type"), F.col("subtype"), F.col("contact_id"), F.lit(0)).alias("batch_id")
    failed = F.lit("failed").alias("processing_status")
    without = nameless.select("contact_id", "eni_id", failed, F.lit("note without an id").alias("error_message"), no_group)
    large = oversized.select(
        "contact_id", "eni_id", failed,
        F.concat(F.lit("note of "), "tokens", F.lit(" tokens exceeds the room of "), "budget").alias("error_message"),
        no_group)
    return run_log_rows(used.unionByName(large.distinct()).unionByName(without), F.lit(now), prompt_key)


def contact_results(result: RunResult, outbox: DataFrame | None = None,
                    token_losses: DataFrame | None = None) -> DataFrame:
    """One result row per contact of a run, as :func:`dossier.operators.metrics.run_totals` takes.

    ``outbox`` is what was published of the run, ``token_losses`` the rows of
    :func:`dossier.operators.generation.token_loss` over its iterations.  The errors of a contact
    are at most three per group, so the rules bound the list.
    """
    unread = F.col("sections").isNull()
    group = F.concat("eni_source_type", F.lit("/"), "subtype", F.lit(": "))
    error = F.when(unread, F.concat(group, F.coalesce("error", F.lit("unreadable response"))))
    zero = F.lit(0).cast("long")
    parts = result.iterations.select(
        "contact_id", error.alias("error"), F.when(~unread, F.col("rows_used")).cast("long").alias("notes"),
        F.when(~unread, 1).cast("long").alias("files"))

    def left_out(notes: DataFrame, why: str) -> DataFrame:
        return notes.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n")).select(
            "contact_id", F.concat(group, "n", F.lit(why)).alias("error"), zero.alias("notes"), zero.alias("files"))

    large = left_out(result.oversized, " notes exceed the room of a prompt")
    nameless = left_out(result.nameless, " notes without an id")
    per = parts.unionByName(large).unionByName(nameless).groupBy("contact_id").agg(
        F.array_sort(F.collect_list("error")).alias("errors"),
        F.coalesce(F.sum("notes"), zero).alias("notes_processed"),
        F.coalesce(F.sum("files"), zero).alias("files_created"))
    per = _counted(per, outbox if outbox is None else outbox.filter("sync_error IS NULL"),
                   {"records_published": F.count(F.lit(1))})
    losses = token_losses if token_losses is None else token_losses.filter("is_loss")
    per = _counted(per, losses, {"token_loss_events": F.count(F.lit(1))})
    return per.select(
        "contact_id", (F.size("errors") == 0).alias("success"), "errors", "notes_processed", "files_created",
        "records_published", "token_loss_events",
        # a run takes every group: none is skipped for what its answer lost
        zero.alias("token_loss_groups_skipped"), zero.alias("token_loss_records_skipped"))


def _counted(per: DataFrame, rows: DataFrame | None, counts: dict) -> DataFrame:
    """Counts of ``rows`` per contact beside ``per``; 0 where there are none."""
    zero = F.lit(0).cast("long")
    if rows is None:
        return per.withColumns({name: zero for name in counts})
    found = rows.groupBy("contact_id").agg(*[c.alias(name) for name, c in counts.items()])
    return per.join(found, "contact_id", "left").withColumns({name: F.coalesce(name, zero) for name in counts})
