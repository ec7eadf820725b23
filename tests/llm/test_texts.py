"""Exact and near duplicates, lines, shards and urls against plain loops and the oracles."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from dossier.llm import exact_dedup, line_dedup, minhash, queries, sharding, url_filter
from tests.compare import differences, duck
from tests.llm.fixtures import awkward_frame, awkward_texts, components, frame, sentence

SF = "/root/testdata/sf0.001"
WHITE = re.compile(r"[\x20\x09-\x0D]")


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_oracle(spark, name):
    assert differences(spark, duck(SF), name, queries.QUERIES[name], queries.ORACLES[name], SF) == ""


def test_exact_duplicates(spark):
    rows = exact_dedup.exact_duplicates(awkward_frame(spark)).collect()
    texts = awkward_texts()
    every = list(enumerate(texts)) + [(None, "no id"), (None, "no id"), (5, texts[5])]
    groups, stays = defaultdict(list), set()
    for i, t in every:
        groups[WHITE.sub("", t or "")].append((-len(t or ""), i is None, i))
    want = Counter()
    for i, t in every:
        group = groups[WHITE.sub("", t or "")]
        n, _, best = min(group, key=lambda x: (x[0], x[1], x[2] or 0))
        # one row of a group stays, also where rows repeat the id and text of it
        kept = i == best and -len(t or "") == n and WHITE.sub("", t or "") not in stays
        if kept:
            stays.add(WHITE.sub("", t or ""))
        want[i, best, len(group), kept,
             hashlib.sha256(WHITE.sub("", t or "").encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows) == want


def test_exact_duplicates_when_few_digests_are_frequent(spark):
    texts = [f"t{i % 50}" if i % 3 else "hot" for i in range(3000)]
    rows = exact_dedup.exact_duplicates(frame(spark, texts), most=2).collect()
    sizes = Counter(texts)
    assert all(r.group_size == sizes[texts[r.doc_id]] and r.keep_id == texts.index(texts[r.doc_id]) for r in rows)
    assert sum(r.kept for r in rows) == len(sizes)


@pytest.mark.parametrize("keep_first", [False, True])
def test_repeated_lines(spark, keep_first):
    texts = awkward_texts()
    rows = line_dedup.drop_repeated_lines(frame(spark).repartition(4), min_docs=3, keep_first=keep_first)
    assert rows.columns == [*frame(spark).columns, "n_lines", "n_dropped"]
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(
        {c: c + 32 for c in range(65, 91)})
    lines = [(t or "").split("\n") for t in texts]
    docs = defaultdict(set)
    for i, ls in enumerate(lines):
        for line in ls:
            docs[key(line)].add(i)
    seen, want = set(), {}
    for i, ls in enumerate(lines):
        kept = []
        for line in ls:
            k = key(line)
            gone = k and len(docs[k]) >= 3 and not (keep_first and k not in seen)
            seen.add(k)
            if not gone:
                kept.append(line)
        want[i] = ("\n".join(kept), len(ls), len(ls) - len(kept))
    assert {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in rows.collect()} == want


def test_lines_that_fill_many_partitions(spark):
    texts = ["hot\n" + (f"only{i}" if i % 2 else "warm") for i in range(4000)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = line_dedup.drop_repeated_lines(frame(spark, texts), keep_first=True).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    got = {r.doc_id: r.text for r in rows}
    assert got[0] == "hot\nwarm" and all(got[i] == (f"only{i}" if i % 2 else "") for i in range(1, 4000))


def test_lines_of_repeated_rows_and_rows_without_id(spark):
    rows = line_dedup.drop_repeated_lines(awkward_frame(spark)).collect()
    assert len(rows) == len(awkward_texts()) + 3
    assert sorted(r.text for r in rows if r.doc_id is None) == ["no id", "no id"]


def test_near_duplicates(spark):
    rng = random.Random(3)
    texts = awkward_texts()
    for _ in range(40):
        base = sentence(rng, rng.randrange(4, 120)).split(" ")
        for _ in range(rng.randrange(1, 5)):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = "new" + str(rng.randrange(999))
            texts.append(" ".join(copy))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in minhash.near_duplicates(frame(spark, texts), width=4).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in enumerate(components(texts, 4))}


def test_near_duplicates_of_a_family_larger_than_a_task(spark):
    rng = random.Random(5)
    base, texts = sentence(rng, 150).split(" "), []
    for i in range(900):
        copy = list(base)
        for _ in range(rng.randrange(0, 12)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10 ** 6)}"
        texts.append(" ".join(copy))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, texts), width=4).collect()}
    assert got == {i: c for i, (_, c) in enumerate(components(texts, 4))}


def test_near_duplicates_without_ids(spark):
    rows = minhash.near_duplicates(awkward_frame(spark), width=4).collect()
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)] * 2
    assert [r.component_id for r in rows if r.doc_id == 5] == [5, 5]


@pytest.mark.parametrize("limit", [1, 2_000, 10 ** 9])
def test_shards_stay_under_the_limit(spark, limit):
    docs = awkward_frame(spark)
    rows = sharding.assign_shards(docs, limit).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
    sizes, counts = defaultdict(int), Counter()
    for r in rows:
        sizes[r.shard] += r.n_bytes
        counts[r.shard] += 1
    assert all(size <= limit or counts[s] == 1 for s, size in sizes.items())
    assert all(r.shard_bytes == sizes[r.shard] for r in rows)
    # no shard is part of another one, and no two that one bucket could hold are apart
    shards = sorted(sizes)
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:]))
    for s in shards:
        twin = s[:-1] + "10"[int(s[-1])] if s else ""
        assert not s or twin not in sizes or sizes[s] + sizes[twin] > limit


def test_urls(spark):
    urls = ["http://WWW.Example.COM/en/x?y#z", "https://a.example.com/en/", "https://a.example.com/fr", "x.net/es/",
            "http://q.net/es/1", "http://net/fr/", "http://notnet/fr/", None, "", "http://b.com", "http://b.com?x/en/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([(4, 1), (6, 1), (6, None), (8, 0)], "page_id long, bad int")
    rows = {r.page_id: r for r in url_filter.judge_urls(pages, outcomes).collect()}
    assert [rows[i].rule for i in range(len(urls))] == [
        "www.example.com/en/", "example.com/en/", "com/", None, "net/es/", "net/fr/", None, None, None, None, None]
    assert (rows[0].host, rows[0].path, rows[0].verdict) == ("www.example.com", "/en/x", "allow")
    assert (rows[3].host, rows[7].host, rows[10].host, rows[10].path) == ("", "", "b.com", "")


@pytest.mark.parametrize("first, verdict", [("allow", "allow"), ("block", "block")])
def test_first_of_equally_long_rules_wins(spark, first, verdict):
    other = {"allow": "block", "block": "allow"}[first]
    pages = spark.createDataFrame([(1, "http://a.com/x/y")], "page_id long, url string")
    rules = [(first, "com", "/x/y"), (other, "a.com", "/x")]
    row = url_filter.judge_urls(pages, spark.createDataFrame([], "page_id long, bad int"), rules).first()
    assert (row.rule, row.verdict) == ("com/x/y", verdict)


def test_reputation_shrinks_and_filters(spark):
    hosts = [(f"bad{i}.spam.org", 40, 38) for i in range(20)] + [(f"h{i}.good.org", 40, 1) for i in range(20)]
    hosts += [("new.spam.org", 0, 0), ("new.good.org", 0, 0), ("one.good.org", 1, 1)]
    rows = {r.host: r for r in url_filter.host_reputation(
        spark.createDataFrame(hosts, "host string, n long, bad long")).collect()}
    assert rows["bad1.spam.org"].low > 0.5 > rows["h1.good.org"].mean
    assert rows["new.spam.org"].mean > 0.8 and rows["new.good.org"].mean < 0.1
    assert rows["one.good.org"].mean < 0.5


@pytest.mark.parametrize("apply", [
    exact_dedup.exact_duplicates, line_dedup.drop_repeated_lines, minhash.near_duplicates, sharding.assign_shards])
def test_empty_tables(spark, apply):
    assert apply(frame(spark, [])).count() == 0


def test_empty_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.judge_urls(pages, spark.createDataFrame([], "page_id long, bad int")).count() == 0
    one = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    rows = url_filter.judge_urls(one, spark.createDataFrame([], "page_id long, bad int")).collect()
    assert [(r.verdict, r.host_low) for r in rows] == [("allow", None)]
    assert rows[0].host_pages == 0
