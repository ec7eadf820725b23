"""Generating profiles from prompts or notes."""
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dossier.checkpoints import freeze
from dossier.functions.text import bullets, estimate_tokens, is_blank, norm_bullet, ordered_join
from dossier.schemas import CALLS, SECTIONS


#: Calls whose answers a task hands on together.
BATCH_CALLS = 32


def generate(prompts: DataFrame, make_client: Callable[[], Callable[[str], str]],
             attempts: int = 3, base_delay: float = 1.0, concurrency: int | None = None,
             prompt: str = "prompt", threads: int = 1) -> DataFrame:
    """Add ``response``, ``error``, ``attempts`` and ``seconds`` to each prompt.

    ``seconds`` is the time of the last call.

    ``make_client`` runs once per partition and thread and returns a function from prompt to text.
    A call that raises or returns nothing is tried again with doubling delays; when all tries fail
    the row gets an error and the others go on.  A task makes ``threads`` calls at a time and hands
    on its answers every few calls.  ``concurrency`` bounds the calls of all tasks together.

    A retried task calls the client again: a client that must not be called twice for one prompt
    has to be idempotent, or its calls go through :func:`generate_once`.  Freeze the result before using
    it more than once.
    """
    schema = T.StructType([
        *prompts.schema.fields, T.StructField("response", T.StringType()),
        T.StructField("error", T.StringType()), T.StructField("attempts", T.IntegerType()),
        T.StructField("seconds", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import threading
        import time
        from concurrent.futures import ThreadPoolExecutor

        own = threading.local()

        def ask(text: str) -> tuple:
            if not hasattr(own, "call"):
                own.call = make_client()
            answer, problem, n, started = None, None, 0, time.monotonic()
            while n < attempts and not answer:
                if n:
                    time.sleep(base_delay * 2 ** (n - 1))
                n += 1
                started = time.monotonic()
                try:
                    answer = own.call(text)
                    problem = None if answer else "empty response"
                except Exception as e:  # a failed call is a failed row, never a failed job
                    answer, problem = None, f"{type(e).__name__}: {e}"
            return answer or None, problem, n, time.monotonic() - started

        names = ("response", "error", "attempts", "seconds")
        kinds = (pa.string(), pa.string(), pa.int32(), pa.float64())
        with ThreadPoolExecutor(threads) as pool:
            call_all = pool.map if threads > 1 else map
            for whole in batches:
                for begin in range(0, whole.num_rows, BATCH_CALLS):
                    # the other columns go through as they are, only the prompts become Python values
                    batch = whole.slice(begin, BATCH_CALLS)
                    done = zip(*call_all(ask, batch.column(prompt).to_pylist()))
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, *(pa.array(values, kind) for values, kind in zip(done, kinds))],
                        names=[*batch.schema.names, *names])

    spread = prompts if concurrency is None else prompts.repartition(max(1, concurrency // threads))
    return spread.mapInArrow(run, schema)


def read_calls(spark: SparkSession, ledger: str, run_id: str) -> DataFrame:
    """The calls of one run that a ledger holds; no other run's files are read."""
    spark.createDataFrame([], CALLS).write.mode("append").partitionBy("run_id").parquet(ledger)  # there may be none yet
    return spark.read.schema(CALLS).parquet(ledger).filter(F.col("run_id") == run_id)


def generate_once(prompts: DataFrame, make_client: Callable[[], Callable[[str], str]], ledger: str, run_id: str,
                  chunk_calls: int = 10_000, attempts: int = 3, base_delay: float = 1.0,
                  concurrency: int | None = None, prompt: str = "prompt", threads: int = 1) -> DataFrame:
    """X1-X3 with a ledger: :func:`generate`, but no prompt of a run is paid for twice.

    Answers and failures are appended to ``ledger`` under the digest of their prompt, in chunks of
    about ``chunk_calls`` calls.  A chunk is one task of one job, whose output is in the ledger as soon as
    the task has ended, whatever becomes of the job.  What a run has in
    the ledger is looked up by an anti-join and not asked again, so a run that was stopped goes
    on where its last chunks ended when it is started with the same ``run_id``; equal prompts are one call.
    A run under another id asks anew.  Only the chunks that were running when a run stopped, at most one
    per core, are asked again.  With ``concurrency``, which bounds the tasks of a job, a chunk is a job of its own,
    and each is committed before the next begins.
    """
    spark = prompts.sparkSession
    keyed = freeze(prompts.withColumn("call_key", F.sha2(F.coalesce(F.col(prompt), F.lit("")), 256)))
    known = read_calls(spark, ledger, run_id).select("call_key").distinct()
    todo = freeze(keyed.groupBy("call_key").agg(F.any_value(prompt).alias("prompt")).join(known, "call_key", "left_anti"))
    n = todo.count()
    chunks = math.ceil(n / chunk_calls)

    def ask(part: DataFrame) -> None:
        # version 2 of Hadoop's committer puts the files of a task in place when the task commits
        (generate(part, make_client, attempts, base_delay, concurrency, threads=threads)
         .select("call_key", "response", "error", "attempts", "seconds", F.lit(run_id).alias("run_id"))
         .write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
         .partitionBy("run_id").parquet(ledger))

    if concurrency is None and n:
        ask(todo.repartition(max(chunks, min(n, spark.sparkContext.defaultParallelism)), "call_key"))
    elif chunks:
        # written by chunk, so that each job reads its own
        chunk = F.pmod(F.xxhash64("call_key"), F.lit(chunks))
        todo = freeze(todo.withColumn("chunk", chunk).repartition("chunk"), ("chunk",))
        for k in range(chunks):
            ask(todo.filter(F.col("chunk") == k).drop("chunk"))
    # a chunk that was written twice, as by a task that was tried again, counts once
    calls = read_calls(spark, ledger, run_id).groupBy("call_key").agg(
        F.max_by(F.struct("response", "error", "attempts", "seconds"), F.col("response").isNotNull()).alias("call"))
    return keyed.join(calls, "call_key").select(*prompts.columns, "call.*")


def section_rows(profiles: DataFrame) -> DataFrame:
    """One row per (contact, section) from profiles with a ``sections`` struct."""
    pairs = F.array(*[F.struct(F.lit(s).alias("section"), F.col("sections")[s].alias("text"))
                      for s in SECTIONS])
    return profiles.select("contact_id", F.explode(pairs).alias("_s")).select(
        "contact_id", "_s.section", "_s.text")


def section_struct(rows: DataFrame) -> DataFrame:
    """Back from rows to one ``sections`` struct per contact."""
    fields = [F.max(F.when(F.col("section") == s, F.col("text"))).alias(s) for s in SECTIONS]
    return rows.groupBy("contact_id").agg(*fields).select(
        "contact_id", F.struct(*SECTIONS).alias("sections"))


def append_merge(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Keep every existing bullet, append the new ones not there yet.

    ``existing`` has (contact_id, section, text), ``new`` has (contact_id, section, ord, bullet)
    with ``ord`` sortable.  A section that gains nothing keeps its text unchanged.  Old and new
    bullets meet in one grouped minimum with partial results, so a bullet that occurs very often
    costs one row per task; the appended text is bounded by the token budget the new notes were
    cut to.
    """
    keys = ["contact_id", "section"]
    seen = (existing.select(*keys, F.explode(bullets(F.col("text"))).alias("b"))
            .select(*keys, norm_bullet(F.col("b")).alias("norm"), F.lit(True).alias("old")))
    incoming = new.select(*keys, norm_bullet(F.col("bullet")).alias("norm"),
                          F.lit(False).alias("old"), F.struct("ord", "bullet").alias("first"))
    fresh = (seen.unionByName(incoming, allowMissingColumns=True)
             .groupBy(*keys, "norm")
             .agg(F.bool_or("old").alias("old"), F.min("first").alias("first"))
             .filter(~F.col("old")))
    added = fresh.groupBy(*keys).agg(
        ordered_join([F.col("first.ord")], F.col("first.bullet")).alias("added"))
    old = F.coalesce("text", F.lit(""))
    gap = F.when((F.length(old) > 0) & ~F.endswith(old, F.lit("\n")), "\n").otherwise("")
    merged = F.when(F.col("added").isNull(), F.col("text")).otherwise(
        F.concat(old, gap, F.col("added")))
    return existing.join(added, keys, "full_outer").select(*keys, merged.alias("text"))


def next_state(state: DataFrame, changed: DataFrame) -> DataFrame:
    """The state after a wave: the rows of the contacts it changed are replaced, and it is written.

    One table holds the current state of all contacts, so a wave reads no earlier wave.
    """
    rest = state.join(changed.select("contact_id").distinct(), "contact_id", "left_anti")
    return freeze(rest.select(*state.columns).unionByName(changed.select(*state.columns)))


def wave_numbers(groups: DataFrame) -> list[int]:
    """The ordinals that occur: at most as many values as there are rules."""
    return sorted(r[0] for r in groups.select("ordinal").distinct().collect())


def fold_groups(groups: DataFrame, latest: DataFrame,
                step: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Group k of each contact sees the profile that group k - 1 left.

    All contacts advance together: wave k is one whole-table step over the groups with ordinal
    k, so the number of waves is the number of rules and not of contacts.  ``groups`` is written
    once, split by wave.  ``step`` takes the wave's rows and the current profiles of the wave's
    contacts and returns all their profiles after it.  Each wave writes the current state anew, so K
    waves read K tables, and the lineage is one wave deep.
    """
    work = freeze(groups, ("ordinal",))
    state = freeze(latest)
    for k in wave_numbers(work):
        wave = work.filter(F.col("ordinal") == k).drop("ordinal")
        current = state.join(wave.select("contact_id").distinct(), "contact_id", "left_semi")
        state = next_state(state, step(wave, current.select(*state.columns)))
    return state


def token_loss(df: DataFrame, before: str = "existing", after: str = "response") -> DataFrame:
    """V6: report responses that are shorter, in tokens, than the summary they replace.

    Where ``df`` has ``existing_tokens`` already, as the iterations of a run do, ``before`` is not looked at.
    """
    old = F.col("existing_tokens") if "existing_tokens" in df.columns else estimate_tokens(F.col(before))
    new = estimate_tokens(F.col(after))
    return df.withColumns({
        "existing_tokens": old, "response_tokens": new,
        "is_loss": (old > 0) & (new < old),
        "lost_tokens": F.greatest(F.lit(0), old - new)})


def contact_tokens(iterations: DataFrame) -> DataFrame:
    """Input tokens and time summed, output tokens of the last iteration, per contact."""
    return iterations.groupBy("contact_id").agg(
        F.sum("input_tokens").alias("est_input_tokens"),
        F.max_by("output_tokens", "ordinal").alias("est_insights_tokens"),
        F.sum("seconds").alias("generation_time_seconds"))


def failed_responses(df: DataFrame) -> DataFrame:
    """Rows without a usable response."""
    return df.filter(is_blank(F.col("response")))
