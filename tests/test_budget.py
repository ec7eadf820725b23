"""The budget cut against a plain loop, on groups that share one day, one key, or no date."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dossier.operators import budget

KEYS = ["contact_id", "eni_source_type", "subtype"]
SCHEMA = "contact_id STRING, eni_source_type STRING, subtype STRING, logged_date DATE, eni_id STRING, tokens INT"


def greedy(rows, limit):
    """Per group: newest first, no date last, ids break ties; stop at the first that is too much."""
    groups = {}
    for r in rows:
        groups.setdefault(r[:3], []).append(r)
    kept = {}
    for notes in groups.values():
        used = 0
        for r in sorted(notes, key=lambda r: (-(r[3] or dt.date(1, 1, 1)).toordinal(), r[4])):
            if used + r[5] > limit:
                break
            kept[r[4]] = used
            used += r[5]
    return kept


def notes(n, hot, days, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        hot_row = rnd.random() < hot
        contact = "CNT-HOT" if hot_row else f"CNT-{rnd.randrange(20)}"
        day = rnd.choice(days)
        rows.append((contact, "click", "null", day, f"ENI-{rnd.randrange(10**9):09d}-{i}", rnd.randrange(1, 9)))
    return rows


DAYS = [dt.date(2024, 1, d) for d in range(1, 6)] + [None]


@pytest.mark.parametrize("limit", [0, 1, 37, 400, 10**6])
@pytest.mark.parametrize("hot,days", [(0.4, DAYS), (1.0, [None]), (0.9, [dt.date(2024, 1, 1)])])
def test_cut_equals_loop(spark, monkeypatch, limit, hot, days):
    monkeypatch.setattr(budget, "SLICE_ROOT", 2)  # many slices already for small days
    rows = notes(3000, hot, days, limit)
    got = budget.budget_cut(spark.createDataFrame(rows, SCHEMA), limit).collect()
    assert {r["eni_id"]: r["used_before"] for r in got} == greedy(rows, limit)
    assert len(got) == len({r["eni_id"] for r in got})


def test_cut_keeps_rows_with_null_keys(spark):
    rows = [(None, "click", None, None, "a", 2), (None, "click", None, None, "b", 2)]
    got = budget.budget_cut(spark.createDataFrame(rows, SCHEMA), 3).collect()
    assert [r["eni_id"] for r in got] == ["a"]


def test_budget_per_group_from_a_table(spark):
    rows = [("A", "t", "s", None, f"a{i}", 2) for i in range(9)] + [("B", "t", "s", None, f"b{i}", 2) for i in range(9)]
    df = spark.createDataFrame(rows, SCHEMA)
    room = df.select(*KEYS).distinct().withColumn("budget", F.when(F.col("contact_id") == "A", 5).otherwise(-1))
    got = budget.budget_cut(df, room, KEYS).collect()
    assert sorted(r["eni_id"] for r in got) == ["a0", "a1"]


def test_stats_hold_their_invariants(spark):
    rows = notes(2000, 0.5, DAYS, 7)
    stats = budget.group_stats(spark.createDataFrame(rows, SCHEMA), 50).collect()
    assert sum(r["rows_total"] for r in stats) == len(rows)
    for r in stats:
        assert r["rows_used"] <= r["rows_total"] and r["tokens_used"] <= 50
        assert len(r["used_ids"]) == r["rows_used"]
