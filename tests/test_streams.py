"""Note intake keeps delivered ids as state: nothing comes twice, and output is never read."""
from dossier.schemas import NOTES, RUN_LOG
from dossier.streaming.intake import stream_notes


def note(i, text="x"):
    return (i, "CNT-000001", "click", None, text, None)


def test_ids_are_remembered_without_the_output(spark, tmp_path):
    log = spark.createDataFrame([], RUN_LOG)
    src, state = f"{tmp_path}/in", f"{tmp_path}/state"
    arrivals = [[note("E1"), note("E2"), note("E2"), note(None, "p"), note(None, "p"), note(None, "q")],
                [note("E2"), note("E3"), note(None, "p")],
                [note("E1"), note("E3")]]
    got, read = [], []
    for k, rows in enumerate(arrivals):
        spark.createDataFrame(rows, NOTES).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(NOTES).parquet(src)
        # each run writes to a folder of its own: earlier output is out of reach
        query = stream_notes(stream, log, f"{tmp_path}/out{k}", state)
        query.awaitTermination()
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
        out = spark.read.schema(NOTES).parquet(f"{tmp_path}/out{k}")
        got.append(sorted((r.eni_id or "", r.description) for r in out.collect()))
    assert got == [[("", "p"), ("", "q"), ("E1", "x"), ("E2", "x")], [("E3", "x")], []]
    assert read == [6, 3, 2]


def test_logged_notes_stay_out_and_the_provider_is_put_back(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    log = spark.createDataFrame([("E1", "CNT-000001", None, "completed", *[None] * 8)], RUN_LOG)
    spark.createDataFrame([note("E1"), note("E2")], NOTES).write.parquet(f"{tmp_path}/in")
    query = stream_notes(spark.readStream.schema(NOTES).parquet(f"{tmp_path}/in"), log, f"{tmp_path}/out", f"{tmp_path}/state")
    query.awaitTermination()
    assert [r.eni_id for r in spark.read.parquet(f"{tmp_path}/out").collect()] == ["E2"]
    assert spark.conf.get(name) == before
