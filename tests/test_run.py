"""A whole run against a plain loop over contacts and groups, and generation by itself."""
import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from checks.bindings import CONTEXT, CONTEXT_ROWS, RULE_MAP, RULE_ROWS
from checks.grouping import TEMPLATE
from checks.running import echo_clients, totals_of_run
from dossier.operators import generation
from dossier.operators.rules import rules_frame
from dossier.operators.metrics import run_totals
from dossier.plans.run import contact_results, run_profiles
from dossier.schemas import NOTES, RUN_LOG, SECTIONS
from dossier.sources.local import local_frame

WINDOW, RESERVE, CAP = 1200, 100, 60
SUBTYPES = [None, "", "NaN", "biography", "sector", "other"]
KEYS = ("personal", "business", "investing", "3i", "deals", "introductions")


def make_notes(n=400):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        rows.append((f"ENI-{i:05d}", f"CNT-{rnd.randrange(6):06d}" if rnd.random() < .6 else "CNT-000000",
                     rnd.choice(["click", "view", "purchase", "error"]), rnd.choice(SUBTYPES),
                     rnd.choice([None, "  ", f" note {i} \t", "née ".ljust(rnd.randrange(5, 60), "x")]),
                     rnd.choice([None, dt.date(2024, 1, rnd.randrange(1, 9))])))
    return rows


def tokens(s):
    return max(1, len(s) // 4) if s else 0


def quoted(s):
    import json
    return json.dumps(s, ensure_ascii=False)


def as_json(profile):
    return "{\n" + ",\n".join(f'  "{k}": {quoted(profile.get(k) or "")}' for k in KEYS) + "\n}"


def loop(notes, logged, profiles, broken):
    """One contact after the other, one group after the other."""
    context = {(t, s): c for t, s, _, c in CONTEXT_ROWS}
    iterations, log = [], {}
    for contact in sorted({n[1] for n in notes}):
        profile = dict(profiles.get(contact, {}))
        k = 0
        for kind, sub, _ in RULE_ROWS:
            mine = [n for n in notes if n[1] == contact and n[2] == kind and n[0] not in logged
                    and (n[4] or "").strip() and (n[3] if n[3] not in (None, "", "NaN") else "null") == sub]
            if not mine:
                continue
            k += 1
            mine.sort(key=lambda n: (-(n[5] or dt.date(1, 1, 1)).toordinal(), n[0]))

            def render(data):
                out = TEMPLATE
                for key, value in (("current_structured_insight", as_json(profile)),
                                   ("eni_source_type_context", context.get((kind, "default"), "")),
                                   ("eni_source_subtype_context", "" if sub == "null" else context.get((kind, sub), "")),
                                   ("new_data_to_process", data)):
                    out = out.replace("{{" + key + "}}", value)
                return out

            room = min(CAP, max(0, WINDOW - RESERVE - tokens(render("")) - 500))
            block, used, ids = "", 0, []
            for n in mine:
                entry = f"- {n[4].strip()}\n  * [{n[5] or 'N/A'},{n[0]},{kind}]\n"
                if used + tokens(entry) > room:
                    break
                block, used, ids = block + entry, used + tokens(entry), ids + [n[0]]
            if not ids:
                continue
            prompt = render(block)
            digest = hashlib.md5(prompt.encode()).hexdigest()
            ok = digest[0] not in broken
            log.update({i: "completed" if ok else "failed" for i in ids})
            if ok:
                # an answer replaces the whole profile
                profile = {"personal": digest, "deals": f"{prompt.count(chr(10))} lines"}
                iterations.append((contact, k, f"{kind}/{sub}", len(ids), digest, profile["deals"], tokens(prompt)))
    return iterations, log

RESULTS = ("contact_id STRING, success BOOLEAN, errors ARRAY<STRING>, notes_processed INT, files_created INT, records_published INT, "
           "token_loss_events INT, token_loss_groups_skipped INT, token_loss_records_skipped INT")


def start(spark, notes, log_rows):
    empty = spark.createDataFrame([], "contact_id STRING, generator STRING, version INT")
    latest = spark.createDataFrame([("CNT-000001", 'old "p"', "d")], "contact_id STRING, personal STRING, deals STRING").select(
        "contact_id", F.struct(*[F.col(s) if s in ("personal", "deals") else F.lit(None).cast("string").alias(s)
                                 for s in SECTIONS]).alias("sections"))
    return run_profiles(spark.createDataFrame(notes, NOTES), log_rows, rules_frame(spark, RULE_MAP),
                        local_frame(spark, CONTEXT_ROWS, CONTEXT), empty, latest, TEMPLATE, echo_clients("0123"),
                        dt.datetime(2024, 2, 1), window=WINDOW, reserve=RESERVE, cap=CAP, types=list(RULE_MAP),
                        attempts=1, base_delay=0.0)


def test_run_equals_loop(spark):
    notes = make_notes()
    logged = {n[0] for n in notes if int(n[0][4:]) % 7 == 0}
    rows = [(i, "c", dt.datetime(2024, 1, 1), "completed" if int(i[4:]) % 7 == 0 else "failed", *[None] * 8)
            for i in (n[0] for n in notes) if int(i[4:]) % 5 != 1]
    logged = {r[0] for r in rows if r[3] == "completed"}
    log = spark.createDataFrame(rows, RUN_LOG)
    result = start(spark, notes, log)
    want, want_log = loop(notes, logged, {"CNT-000001": {"personal": 'old "p"', "deals": "d"}}, "0123")
    got = sorted((r["contact_id"], r["ord"], r["context_files"], r["record_count"], r["sections"]["personal"],
                  r["sections"]["deals"], r["est_input_tokens"]) for r in result.versions.collect())
    assert got == sorted(want)
    by_contact = {}
    for r in result.versions.collect():
        by_contact.setdefault(r["contact_id"], []).append(r["version"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in by_contact.values())
    got_log = {r["eni_id"]: r["processing_status"] for r in result.log.collect()}
    assert got_log == want_log and "failed" in got_log.values()

    totals = run_totals(contact_results(result)).first()
    assert totals["notes_processed"] <= list(got_log.values()).count("completed")
    assert totals["total_failed"] == len({r["contact_id"] for r in result.log.collect() if r["processing_status"] == "failed"})
    assert totals["total_completed_success"] + totals["total_failed"] == totals["total_scheduled"]
    assert all(r["generation_time_seconds"] >= 0 for r in result.versions.collect())

    # the next run sees no note that is done, and takes up the ones that were cut or failed
    second = start(spark, notes, log.unionByName(result.log))
    done = {i for i, s in got_log.items() if s == "completed"} | logged
    again = {r["eni_id"] for r in second.log.collect()}
    assert again and not again & done


def test_second_run_of_finished_work_is_empty(spark):
    notes = [("E1", "CNT-000001", "click", None, "text", None)]
    log = spark.createDataFrame([("E1", "CNT-000001", dt.datetime(2024, 1, 1), "completed", *[None] * 8)], RUN_LOG)
    result = start(spark, notes, log)
    assert result.versions.count() == 0 and result.log.count() == 0


def test_generate_retries_and_isolates_failures(spark):
    def make():
        seen = {}

        def call(text):
            seen[text] = seen.get(text, 0) + 1
            if text == "never":
                raise ValueError("no")
            if text == "late" and seen[text] < 3:
                return ""
            return text.upper()

        return call

    df = spark.createDataFrame([("ok",), ("late",), ("never",)], "prompt STRING")
    got = {r["prompt"]: (r["response"], r["error"], r["attempts"])
           for r in generation.generate(df, make, attempts=3, base_delay=0.0, concurrency=2).collect()}
    assert got == {"ok": ("OK", None, 1), "late": ("LATE", None, 3), "never": (None, "ValueError: no", 3)}


def test_client_is_called_once_per_prompt_in_a_run(spark, tmp_path):
    folder = str(tmp_path)

    def make():
        import uuid

        def call(text):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write("x")
            return "## Personal\nx"

        return call

    notes = [(f"E{i}", f"CNT-{i:06d}", "click", None, "text", None) for i in range(9)]
    empty = spark.createDataFrame([], "contact_id STRING, generator STRING, version INT")
    latest = spark.createDataFrame([], "contact_id STRING, sections STRUCT<" + ", ".join(f"{s}: STRING" for s in SECTIONS) + ">")
    result = run_profiles(spark.createDataFrame(notes, NOTES), spark.createDataFrame([], RUN_LOG), rules_frame(spark, {"click": None}),
                          local_frame(spark, CONTEXT_ROWS, CONTEXT), empty, latest, "{{new_data_to_process}}", make,
                          dt.datetime(2024, 2, 1))
    assert result.versions.count() == 9 and result.log.count() == 9
    assert len(list(tmp_path.iterdir())) == 9


def test_oversized_note_does_not_keep_others_waiting(spark):
    notes = [("E1", "CNT-000001", "click", None, "long " * 800, dt.date(2024, 1, 9)), ("E2", "CNT-000001", "click", None, "short", dt.date(2024, 1, 2)),
             ("E3", "CNT-000002", "click", None, "long " * 900, None)]
    result = start(spark, notes, spark.createDataFrame([], RUN_LOG))
    log = {r["eni_id"]: (r["processing_status"], r["error_message"]) for r in result.log.collect()}
    assert set(log) == {"E1", "E2", "E3"} and log["E1"][0] == log["E3"][0] == "failed"
    assert "exceeds the room" in log["E1"][1] and "exceeds" not in (log["E2"][1] or "")
    assert result.deferred.count() == 0 and result.oversized.count() == 2
    per = {r["contact_id"]: r for r in contact_results(result).collect()}
    assert set(per) == {"CNT-000001", "CNT-000002"} and not per["CNT-000002"]["success"]


def test_threads_and_cap_of_calls(spark, tmp_path):
    folder = str(tmp_path)

    def make():
        import os
        import time
        import uuid

        def call(text):
            mine = f"{folder}/{uuid.uuid4().hex}"
            open(mine, "w").close()
            at_once = len(os.listdir(folder))
            time.sleep(0.05)
            os.remove(mine)
            return str(at_once)

        return call

    df = spark.range(60).selectExpr("cast(id AS string) AS prompt")
    most = [int(r["response"]) for r in generation.generate(df, make, concurrency=6, threads=3).collect()]
    assert len(most) == 60 and 1 < max(most) <= 6


def test_frozen_tables_are_removed(spark):
    import os

    from dossier.checkpoints import freeze, released_after
    with released_after(spark):
        frozen = freeze(spark.range(5))
        where = os.path.dirname(frozen.inputFiles()[0].removeprefix("file://"))
        assert frozen.count() == 5 and os.path.isdir(where)
    assert not os.path.exists(where)


def test_rows_that_repeat_an_id_or_have_none(spark):
    """Twice the same row, twice an id with other texts, and no id: nothing multiplies, nothing waits for ever."""
    day = dt.date(2024, 1, 2)
    notes = [("E1", "C1", "click", "sector", "one two three", day)] * 2 + [
        ("E2", "C1", "click", "sector", "first text", day), ("E2", "C1", "click", "sector", "second text", day),
        (None, "C1", "click", "sector", "no id", day), (None, "C2", "view", None, "no id either", None)]
    result = start(spark, notes, spark.createDataFrame([], RUN_LOG))
    (made,) = result.iterations.collect()
    assert (made["rows_total"], made["rows_used"], sorted(set(made["used_ids"]))) == (4, 4, ["E1", "E2"])
    log = sorted((r["eni_id"] or "", r["contact_id"], r["error_message"]) for r in result.log.collect())
    failed = made["error"] if made["sections"] is not None else "unreadable response"
    assert log == [("", "C1", "note without an id"), ("", "C2", "note without an id"),
                   ("E1", "C1", failed), ("E2", "C1", failed)]
    assert result.deferred.count() == result.oversized.count() == 0


class Stop(BaseException):
    """What no retry catches: the worker dies, and with it the run."""


def counting_clients(folder, stop_at=None):
    folder.mkdir(exist_ok=True)

    def make():
        import os
        import uuid

        def call(text):
            if stop_at is not None and len(os.listdir(folder)) >= stop_at:
                raise Stop
            digest = hashlib.md5(text.encode()).hexdigest()
            (folder / f"{digest}-{uuid.uuid4().hex}").touch()
            return None if digest[0] in "01" else f"## Personal\n{digest}\n"
        return call
    return make


def test_a_stopped_run_goes_on_without_a_second_call(spark, tmp_path):
    notes = make_notes(40)
    empty = spark.createDataFrame([], "contact_id STRING, generator STRING, version INT")
    latest = spark.createDataFrame([], "contact_id STRING").select(
        "contact_id", F.struct(*[F.lit(None).cast("string").alias(s) for s in SECTIONS]).alias("sections"))

    def run(clients, ledger, chunk_calls):
        return run_profiles(spark.createDataFrame(notes, NOTES), spark.createDataFrame([], RUN_LOG),
                            rules_frame(spark, RULE_MAP), local_frame(spark, CONTEXT_ROWS, CONTEXT), empty, latest, TEMPLATE,
                            clients, dt.datetime(2024, 2, 1), window=WINDOW, reserve=RESERVE, cap=CAP, types=list(RULE_MAP),
                            attempts=1, base_delay=0.0, ledger=str(ledger), run_id="night", chunk_calls=chunk_calls)

    def outcome(result):
        return (sorted((r["contact_id"], r["version"], r["sections"]["personal"]) for r in result.versions.collect()),
                sorted((r["eni_id"], r["processing_status"], r["error_message"] or "") for r in result.log.collect()))
    called = lambda folder: [f.name.split("-")[0] for f in folder.iterdir()]
    undisturbed = run(counting_clients(tmp_path / "undisturbed"), tmp_path / "ledger-a", 1000)
    whole, prompts = outcome(undisturbed), called(tmp_path / "undisturbed")
    first = undisturbed.iterations.filter("ordinal = 1").count()
    assert len(prompts) == len(set(prompts)) > first + 1

    with pytest.raises(Exception, match="Stop|worker"):
        run(counting_clients(tmp_path / "stopped", first + 1), tmp_path / "ledger-b", 2)
    saved = generation.read_calls(spark, str(tmp_path / "ledger-b"), "night").count()
    assert first <= saved < len(prompts)  # the run was stopped in its second wave
    assert outcome(run(counting_clients(tmp_path / "restarted"), tmp_path / "ledger-b", 1000)) == whole
    # only what the chunk had asked in which the run stopped is asked again
    assert len(called(tmp_path / "restarted")) == len(prompts) - saved
    assert set(called(tmp_path / "stopped")) | set(called(tmp_path / "restarted")) == set(prompts)


def jobs_of(spark, name, action):
    spark.sparkContext.setJobGroup(name, name)
    try:
        return action(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_chunks_of_a_ledger_are_tasks(spark, tmp_path):
    """The jobs do not grow with the calls, and the chunks of a job that fails stay."""
    prompts = spark.createDataFrame([(f"p{i}",) for i in range(80)], "prompt STRING")

    def clients(stop):
        def make():
            def call(text):
                if stop and text == "p7":
                    import time
                    time.sleep(8)  # the other chunks end before
                    raise KeyboardInterrupt
                return f"answer to {text}"
            return call
        return make

    with pytest.raises(Exception):
        generation.generate_once(prompts, clients(True), str(tmp_path / "ledger"), "r", 2, attempts=1)
    assert 60 <= generation.read_calls(spark, str(tmp_path / "ledger"), "r").count() < 80
    out, few = jobs_of(spark, "few", lambda: generation.generate_once(prompts, clients(False), str(tmp_path / "ledger"), "r", 40))
    assert sorted(r["response"] for r in out.collect()) == sorted(f"answer to p{i}" for i in range(80))
    _, many = jobs_of(spark, "many", lambda: generation.generate_once(prompts, clients(False), str(tmp_path / "other"), "r", 2))
    assert many <= few + 2
    out = generation.generate_once(prompts, clients(False), str(tmp_path / "bounded"), "r", 30, concurrency=2)
    assert out.count() == 80


def test_a_run_over_what_an_earlier_run_stored(spark, tmp_path):
    """Keys beside the six sections are stored with a version, and stored profiles are where the next run begins."""
    from dossier.operators.versions import latest_versions
    from dossier.sinks.writers import append_profiles
    from dossier.sources.tables import read_profiles

    def client():
        return lambda prompt: '{"personal": "' + ("more" if "first" in prompt else "first") + '", "hobbies": "chess"}'

    def run_over(versions, latest, notes):
        return run_profiles(spark.createDataFrame(notes, NOTES), spark.createDataFrame([], RUN_LOG), rules_frame(spark, RULE_MAP),
                            local_frame(spark, CONTEXT_ROWS, CONTEXT), versions, latest, TEMPLATE, client, dt.datetime(2024, 2, 1),
                            window=WINDOW, reserve=RESERVE, cap=CAP, types=list(RULE_MAP), attempts=1, base_delay=0.0)
    notes = [(f"E{i}", f"CNT-00000{i}", "click", None, "a note", None) for i in (1, 2)]
    path = str(tmp_path / "profiles")
    empty = spark.createDataFrame([], "contact_id STRING, generator STRING, version INT, sections STRUCT<"
                                  + ", ".join(f"{s}: STRING" for s in SECTIONS) + ">")
    append_profiles(run_over(empty, empty, notes).versions, path, dt.datetime(2024, 2, 1))
    stored = read_profiles(spark, path)
    second = run_over(stored, latest_versions(stored), [("E3", "CNT-000001", "click", None, "a later note", None),
                                                        ("E4", "CNT-000003", "click", None, "a new contact", None)])
    append_profiles(second.versions, path, dt.datetime(2024, 2, 2))
    got = {(r["contact_id"], r["version"]): (r["sections"]["personal"], r["sections"]["extra"])
           for r in read_profiles(spark, path).collect()}
    extra = {"hobbies": "chess"}
    assert got == {("CNT-000001", 1): ("first", extra), ("CNT-000001", 2): ("more", extra),
                   ("CNT-000002", 1): ("first", extra), ("CNT-000003", 1): ("first", extra)}


def test_a_wave_writes_four_tables(spark):
    """Prompt parts, sizes of the notes, answers and profiles; notes meet their group's room one time."""
    from dossier import checkpoints

    notes = [(f"E{i}", "CNT-000001", kind, None, "a note", None) for i, kind in enumerate(("click", "view"))]
    with checkpoints.released_after(spark):
        result = start(spark, notes, spark.createDataFrame([], RUN_LOG))
        before_waves, waves, numbering = 4, 2, 1
        assert len(checkpoints._KEPT[-1]) <= before_waves + 4 * waves + numbering
        assert result.iterations.count() == 2 and result.oversized.count() == 0


def test_totals_hold_every_contact_what_was_published_and_what_answers_lost(spark):
    """A contact whose notes have no id is scheduled and fails; an answer is held against the profile it replaces."""
    notes = [("E2", "CNT-000001", "click", None, "words", None), (None, "CNT-000002", "click", None, "text", None),
             (None, "CNT-000002", "click", None, "more", None)]
    result = start(spark, notes, spark.createDataFrame([], RUN_LOG))
    made = result.iterations.first()
    before = tokens(as_json({"personal": 'old "p"', "deals": "d"}))
    assert (result.iterations.count(), made["existing_tokens"]) == (1, before) and before > tokens(made["response"])
    outbox = spark.createDataFrame([("CNT-000001", None)], "contact_id STRING, sync_error STRING")
    per = contact_results(result, outbox, generation.token_loss(result.iterations))
    assert {r["contact_id"]: r["errors"] for r in per.collect()} == {
        "CNT-000001": [], "CNT-000002": ["click/null: 2 notes without an id"]}
    got = run_totals(per).first().asDict()
    assert got == {"total_scheduled": 2, "total_completed_success": 1, "total_skipped_claim": 0, "total_failed": 1, "notes_processed": 1,
                   "files_created": 1, "records_published": 1, "token_loss_events": 1, "token_loss_groups_skipped": 0,
                   "token_loss_records_skipped": 0, "error_count": 1}


def test_the_totals_of_a_run_are_all_worked_out(spark):
    """The query reads the publication and the lost tokens, which no total of its own would be left to do."""
    plan = totals_of_run(spark, "/root/testdata/sf0.001")
    assert set(run_totals(spark.createDataFrame([], RESULTS)).columns) <= set(plan.columns)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "record_id" in text and "existing_tokens" in text
