"""Continuous forms: note intake, interval metrics, interval publication.

Event times must be timestamps with a zone: ``TIMESTAMP_NTZ`` columns are cast first, as
watermarks do not take them.
"""
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dossier.operators.metrics import stage_metrics
from dossier.operators.publish import build_outbox
from dossier.operators.selection import unprocessed
from dossier.operators.versions import latest_versions
from dossier.schemas import DEFAULT_GENERATOR


@contextmanager
def _state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state on disk and not on the heap."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _earlier(batch: DataFrame, dst: str, epoch: int) -> DataFrame | None:
    """What the batches before this one wrote."""
    if epoch == 0:
        return None
    return batch.sparkSession.read.parquet(dst).filter(F.col("epoch") < epoch)


def stream_notes(stream: DataFrame, log: DataFrame, dst: str, checkpoint: str) -> StreamingQuery:
    """Notes that are neither logged nor delivered yet, added to ``dst``, a folder per batch.

    Delivered ids are keyed state of the stream, held in RocksDB and kept with ``checkpoint``: a
    batch reads what arrived and the log, and never what earlier batches wrote.  The state has no
    time limit, as a note may arrive at any later time.  Notes without an id count as the same when
    the whole row is the same.  A batch that is run again after a failure starts from the state
    before it and overwrites its own folder, so every note is delivered once.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        unprocessed(batch, log).select(*batch.columns).write.mode("overwrite").parquet(f"{dst}/epoch={epoch}")

    whole = F.concat(F.lit("\0"), F.sha2(F.to_json(F.struct(*stream.columns)), 256))
    fresh = stream.withColumn("_key", F.coalesce("eni_id", whole)).dropDuplicates(["_key"]).drop("_key")
    with _state_in_rocksdb(stream.sparkSession):
        return (fresh.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())


def interval_metrics(stream: DataFrame, time: str = "timestamp", every: str = "30 seconds",
                     lateness: str | None = None) -> DataFrame:
    """Stage metrics per interval of event time.

    Late events change the interval they belong to.  The state is one row per interval, about a
    million in a year of half minutes; give a ``lateness`` only where later events may be lost.
    """
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    if lateness is not None:
        timed = timed.withWatermark(time, lateness)
    return stage_metrics(timed, [F.window(time, every).alias("interval")])


def stream_metrics(stream: DataFrame, dst: str, checkpoint: str, time: str = "timestamp",
                   every: str = "30 seconds", lateness: str | None = None) -> StreamingQuery:
    """Append every changed interval with the number of its batch.

    A batch that is run again after a failure overwrites its own folder, so nothing is counted
    twice; :func:`current_metrics` takes the newest batch of each interval.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{dst}/epoch={epoch}")

    return (interval_metrics(stream, time, every, lateness).writeStream.outputMode("update")
            .foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def current_metrics(stored: DataFrame) -> DataFrame:
    """The newest figures of each interval from what :func:`stream_metrics` wrote."""
    row = F.struct(*[c for c in stored.columns if c != "epoch"])
    return (stored.groupBy(F.col("interval.start").alias("_start"))
            .agg(F.max_by(row, "epoch").alias("_r")).select("_r.*"))


def stream_publish(stream: DataFrame, master: DataFrame, dst: str, checkpoint: str,
                   every: str | None = None,
                   send: Callable[[DataFrame], None] | None = None,
                   generator: str = DEFAULT_GENERATOR) -> StreamingQuery:
    """Turn newly appended versions into outbox records, each batch's latest per contact.

    Only completed versions of ``generator`` count, and only those newer than what an earlier
    batch published of the contact, so an old version that arrives late is never sent.

    ``every`` is the time between publications, such as ``6 hours``; without it what is there is
    published once.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        done = batch.filter((F.col("processing_status") == "completed") & (F.col("generator") == generator))
        newest = latest_versions(done)
        earlier = _earlier(batch, dst, epoch)
        if earlier is not None:
            sent = earlier.groupBy("contact_id").agg(F.max("version").alias("_sent"))
            newest = newest.join(sent, "contact_id", "left").filter(
                F.col("_sent").isNull() | (F.col("version") > F.col("_sent"))).drop("_sent")
        numbers = newest.select("contact_id", "version")
        outbox = build_outbox(newest, master).join(numbers, "contact_id")
        outbox.write.mode("overwrite").parquet(f"{dst}/epoch={epoch}")
        if send is not None:
            send(batch.sparkSession.read.parquet(f"{dst}/epoch={epoch}"))

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())


def publication_due(last_sync, now, hours: int) -> bool:
    """T3 as a scheduled batch: never published, or at least ``hours`` ago."""
    return last_sync is None or (now - last_sync).total_seconds() >= hours * 3600
