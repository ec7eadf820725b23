"""Classifiers, packing, leaks, chats and the pipeline against plain loops and held-out rows."""
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from dossier.llm import chat, decontaminate, language, packing, toxicity
from dossier.llm.tables import table
from tests.llm.fixtures import LABELS, awkward_frame, awkward_texts, components, frame, sentence

SF = "/root/testdata/sf0.01"


def test_toxicity_on_held_out_documents(spark):
    rows = toxicity.op3_toxicity(spark, SF).join(table(spark, SF, "labels"), "doc_id").filter("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    hits = sum(r.predicted == r.toxic for r in rows)
    assert hits >= 0.93 * len(rows)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)


def test_toxicity_of_awkward_texts(spark):
    docs = awkward_frame(spark)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(20)] + [(3, None, None), (None, 1, 1)], LABELS)
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    rows = toxicity.score_toxicity(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.fit(toxicity.training_rows(docs, spark.createDataFrame([], LABELS))) is None
    assert [r.score for r in toxicity.score_toxicity(docs, None).limit(1).collect()] == [0.0]
    assert toxicity.score_toxicity(frame(spark, []), model).count() == 0


def test_toxicity_learns_from_four_thousand_of_a_class(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "'text' AS text")
    labels = spark.range(6000).selectExpr("id AS doc_id", "1 AS quality", "int(id < 100) AS toxic")
    found = Counter(r.label for r in toxicity.training_rows(docs, labels).select("label").collect())
    toxic = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(100))
    assert found == {0: 4000, 1: toxic}


def test_toxicity_takes_the_smallest_hashes_and_no_other_labels(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'text' AS text")
    labels = spark.range(3000).selectExpr("id AS doc_id", "1 AS quality", "int(id % 4) AS toxic")
    rows = toxicity.training_rows(docs, labels, per_class=50).select("doc_id", "label", "weight").collect()
    hashes = {r.id: r.h for r in spark.range(3000).selectExpr("id", "xxhash64(id) AS h").collect()}
    for label in (0, 1):
        known = [i for i in range(3000) if i % 4 == label and zlib.crc32(str(i).encode()) % 5]
        assert {r.doc_id for r in rows if r.label == label} == set(sorted(known, key=hashes.get)[:50])
        assert {r.weight for r in rows if r.label == label} == {len(known) / 50}
    assert {r.label for r in rows} == {0, 1}


def plain_fit(docs):
    """The classifier by dictionaries: ``docs`` of (text, label), all n-grams weighted."""
    grams = [Counter(g for block in toxicity._grams(t) for g in block.tolist()) for t, _ in docs]
    labels = [y for _, y in docs]
    seen = {y: Counter(g for c, l in zip(grams, labels) if l == y for g in c) for y in (0, 1)}
    ratio = {g: np.log((1 + seen[1][g]) / (labels.count(1) + 2)) - np.log((1 + seen[0][g]) / (labels.count(0) + 2))
             for c in grams for g in c}
    x = [{g: toxicity.SCALE * n / sum(c.values()) * ratio[g] for g, n in c.items()} for c in grams]
    w, b = dict.fromkeys(ratio, 0.0), 0.0
    first, second, step = {}, {}, 0
    for step in range(1, toxicity.STEPS + 1):
        slope = [(1 / (1 + np.exp(-(sum(w[g] * v for g, v in c.items()) + b))) - y) / len(docs) for c, y in zip(x, labels)]
        slopes = {g: toxicity.PENALTY * w[g] for g in w}
        for c, s in zip(x, slope):
            for g, v in c.items():
                slopes[g] += v * s
        slopes[None] = sum(slope)
        for g, s in slopes.items():
            first[g] = 0.9 * first.get(g, 0) + 0.1 * s
            second[g] = 0.999 * second.get(g, 0) + 0.001 * s * s
            move = toxicity.RATE * first[g] / (1 - 0.9 ** step) / (np.sqrt(second[g] / (1 - 0.999 ** step)) + 1e-8)
            if g is None:
                b -= move
            else:
                w[g] -= move

    def score(text):
        c = Counter(g for block in toxicity._grams(text) for g in block.tolist())
        z = sum(toxicity.SCALE * n / sum(c.values()) * ratio.get(g, 0) * w.get(g, 0) for g, n in c.items()) + b
        return 1 / (1 + np.exp(-z))
    return score


def test_toxicity_fit_and_scores_against_a_plain_loop(spark):
    rng = random.Random(2)
    words = {0: "kind warm calm green".split(), 1: "vile foul nasty green".split()}
    docs = [(" ".join(rng.choices(words[y], k=4)), y) for y in (0, 1) * 8]
    rows = [(i, t, y, 1.0) for i, (t, y) in enumerate(docs)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id bigint, text string, label int, weight double").repartition(3))
    want = plain_fit(docs)
    for text in ["kind", "nasty foul", "green vile warm", "unseen words", *[t for t, _ in docs]]:
        assert model.score(text) == pytest.approx(want(text), abs=2e-4)


def test_toxicity_of_a_text_is_that_of_its_blocks(monkeypatch):
    rng = np.random.default_rng(1)
    model = toxicity.ToxicityModel(rng.normal(size=1 << toxicity.BITS).astype(np.float32) / 1000, 0.0)
    text = sentence(random.Random(1), 300)
    want = model.score(text)
    monkeypatch.setattr(toxicity, "BLOCK_CHARS", 50)
    assert model.score(text) == pytest.approx(want)


def test_language_on_held_out_documents(spark):
    rows = (language.op8_language_id(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
            .filter("held_out").collect())
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)


def test_language_learns_from_rows_not_from_ids(spark):
    """Ids that repeat with texts of two languages: every text is learned under its own."""
    docs = spark.createDataFrame([(i, "abc abc", "aa") for i in range(40)] + [(i, "xyz xyz", "xx") for i in range(40)],
                                 "doc_id bigint, text string, lang string")
    rows = [tuple(r) for r in language.training_rows(docs, per_language=9).collect()]
    assert Counter(rows) == {("abc abc", "aa"): 9, ("xyz xyz", "xx"): 9}
    more = docs.withColumns({"_guess": docs["doc_id"], "guess": docs["lang"], "row": docs["text"]})
    found = language.identify_languages(more, language.fit(language.training_rows(docs))).collect()
    assert all(r.lang_pred == r.lang == r.guess and r._guess == r.doc_id and r.row == r.text for r in found)


def plain_bits(counts, languages, text):
    """Code length by walking the context tree of each language."""
    out = []
    raw = language.START + text.lower().encode()
    for lang in languages:
        bits = 0.0
        for i in range(language.ORDER, len(raw)):
            p = 1 / 256
            for order in range(language.ORDER + 1):
                seen = counts[lang][raw[i - order:i]]
                total, kinds = sum(seen.values()), len(seen)
                if total:
                    p = seen[raw[i]] / (total + kinds) if seen[raw[i]] else p * kinds / (total + kinds)
            bits -= np.log2(p)
        out.append(bits)
    return out


def test_code_lengths(spark):
    train = [("the cat sat on the mat", "en"), ("then they thatched it", "en"), ("le chat é sur la natte", "fr")]
    model = language.fit(spark.createDataFrame(train, "text string, lang string"))
    counts = defaultdict(lambda: defaultdict(Counter))
    for text, lang in train:
        raw = language.START + text.encode()
        for i in range(language.ORDER, len(raw)):
            for order in range(language.ORDER + 1):
                counts[lang][raw[i - order:i]][raw[i]] += 1
    texts = ["the natte", "", "ça va? THE", "éé the chat " * 30]
    got = model.code_lengths(texts)
    assert model.languages == ["en", "fr"]
    assert np.allclose(got, [plain_bits(counts, model.languages, t) for t in texts], rtol=1e-5)


def test_every_context_of_many_languages_counts(spark):
    """40 languages over 90 symbols: a table of all contexts, symbols and languages would be too large to be full."""
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789 .,;:!?-+*/=()[]{}<>_~^%$#@&|" + "äöüßéèçñøåæœłžšč"
    train = [("".join(rng.choices(letters, k=600)), f"l{k:02}") for k in range(40)]
    model = language.fit(spark.createDataFrame(train, "text string, lang string"))
    counts = defaultdict(lambda: defaultdict(Counter))
    for text, lang in train:
        raw = language.START + text.encode()
        for i in range(language.ORDER, len(raw)):
            for order in range(language.ORDER + 1):
                counts[lang][raw[i - order:i]][raw[i]] += 1
    texts = [train[3][0][50:250], train[39][0], "€ unseen \x00"]
    got = model.code_lengths(texts)
    assert np.allclose(got, [plain_bits(counts, model.languages, t) for t in texts], rtol=1e-5)
    assert [model.languages[b] for b in got[:2].argmin(axis=1)] == ["l03", "l39"]


def test_language_of_awkward_texts(spark, monkeypatch):
    docs = awkward_frame(spark)
    model = language.fit(spark.createDataFrame([("alpha beta", "en"), ("été", "fr")], "text string, lang string"))
    rows = language.identify_languages(docs, model).collect()
    assert Counter(r.lang_pred == "und" for r in rows)[True] == sum(
        not re.search(r"[^\W\d_]", t or "") for t in awkward_texts())
    assert all(0 <= r.score <= 1 for r in rows)
    assert language.fit(spark.createDataFrame([], "text string, lang string")) is None
    assert {r.lang_pred for r in language.identify_languages(docs, None).collect()} == {"und"}
    text = "alpha été " * 50
    want = model.code_lengths([text, "x"])
    monkeypatch.setattr(language, "BLOCK_BYTES", 64)
    assert np.allclose(model.code_lengths([text, "x"]), want)


def test_words_are_looked_up_alike_in_blocks(monkeypatch):
    import pyarrow as pa
    texts = [None, "", "  one\ttwo  ", "One two, THREE\x0b four!\r\n", "ΑΣ ααα\x00 é" * 50, *awkward_texts()]
    words = packing.WordTokenizer(packing.default_tokenizer())
    want = [words.tokenizer.encode(t or "", add_special_tokens=False).ids + [7] for t in texts]
    monkeypatch.setattr(packing, "BLOCK_CHUNKS", 5)
    ids, n = words.ids(pa.array(texts), 7)
    assert [np.frombuffer(raw, words.kind).tolist() for raw in ids.to_pylist()] == want
    assert n.tolist() == [len(w) for w in want]
    words.forget()
    assert not words.known and not words.older
    assert words.ids(pa.array([], pa.string()), 7)[1].tolist() == []


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer
    path = packing.default_tokenizer()
    whole = Tokenizer.from_file(path)
    docs = awkward_frame(spark).repartition(3)
    pieces = packing.pack(docs, path, size=64, with_ids=True).collect()
    want = Counter((r.doc_id, tuple(whole.encode(r.text or "", add_special_tokens=False).ids) + (1,))
                   for r in docs.collect())
    spans = sorted((p.sequence_id * 64 + p.offset, p) for p in pieces)
    at, got, open_ids = 0, Counter(), ()
    for begin, p in spans:
        ids = tuple(np.frombuffer(p.ids, "<u4").tolist())
        assert begin == at and p.offset + p.length <= 64 and len(ids) == p.length and p.start == len(open_ids)
        assert p.ids_crc32 == zlib.crc32(p.ids)
        at, open_ids = at + p.length, open_ids + ids
        if len(open_ids) == p.doc_tokens:
            got[p.doc_id, open_ids] += 1
            open_ids = ()
    assert got == want and not open_ids
    assert packing.pack(frame(spark, []), path).count() == 0


def test_sequences(spark):
    path = packing.default_tokenizer()
    docs = frame(spark).repartition(5)
    rows = {r.sequence_id: r.ids for r in packing.sequences(docs, path, size=64).collect()}
    n = sum(p.length for p in packing.pack(docs, path, size=64).collect())
    assert sorted(rows) == list(range(-(-n // 64))) and sum(len(x) for x in rows.values()) == 4 * n
    assert all(len(rows[i]) == 256 for i in range(n // 64))


def test_pieces_are_those_of_the_written_sequences(spark, monkeypatch):
    """Digests and the pipeline's tokens come from the sequences, not from the documents' ids."""
    path, written = packing.default_tokenizer(), []
    monkeypatch.setattr(packing, "freeze", lambda df, freeze=packing.freeze: written.append(freeze(df)) or written[-1])
    docs = awkward_frame(spark).repartition(4)
    pieces = packing.pack(docs, path, size=64, with_ids=True).collect()
    cut = [x for x in written if "whole" in x.columns]
    assert len(cut) == 1
    records = defaultdict(bytes)
    for r in sorted(cut[0].collect(), key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset * 4 == len(records[r.sequence_id]) and r.whole == (len(r.ids) == 256)
        records[r.sequence_id] += r.ids
    for p in pieces:
        assert p.ids == records[p.sequence_id][4 * p.offset:4 * (p.offset + p.length)] and p.ids_crc32 == zlib.crc32(p.ids)
    assert sum(p.length for p in pieces) * 4 == sum(map(len, records.values()))
    last = corpus_pipeline.pack_sequences(spark, docs, SF).collect()
    assert all(len(p.ids) == 4 * p.length and p.ids_crc32 == zlib.crc32(p.ids) for p in last)


def plain_leaks(texts, items):
    def norm(t):
        return " " + " ".join(re.sub(r"[!-/:-@\[-`{-~]", " ", (t or "").lower()).split()) + " "
    docs = [norm(t) for t in texts]
    return {(d, i) for i, item in items if len(norm(item).split()) >= decontaminate.SHINGLE
            for d, t in enumerate(docs) if norm(item) in t}


def test_leaks(spark):
    rng = random.Random(9)
    items = [(i, (sentence(rng, rng.randrange(6, 90)) + ". Answer " + sentence(rng, 6)).capitalize() + ".")
             for i in range(60)] + [(60, None), (61, "too short")]
    texts = awkward_texts()
    for k in range(80):
        text = sentence(rng, rng.randrange(0, 400))
        if k % 2:
            words = text.split(" ")
            cut = rng.randrange(len(words) + 1)
            text = " ".join(words[:cut] + [rng.choice(items[:60])[1].upper()] + words[cut:])
        texts.append(text)
    benchmark = spark.createDataFrame(items + [(None, "an item without an id at all")], "item_id long, text string")
    want = plain_leaks(texts, [x for x in items if x[1]])
    rows = decontaminate.find_leaks(frame(spark, texts), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want and len(rows) == len(want)
    left = decontaminate.without_leaks(frame(spark, texts), benchmark)
    assert left.columns == frame(spark, []).columns
    assert {r.doc_id for r in left.collect()} == set(range(len(texts))) - {d for d, _ in want}
    assert decontaminate.find_leaks(frame(spark, []), benchmark).count() == 0
    assert decontaminate.find_leaks(frame(spark), benchmark.filter("false")).count() == 0


def test_leaks_do_not_depend_on_blocks(spark):
    """Scores are the same however many items an index holds, and ids keep their type."""
    rng = random.Random(31)
    items = [(i + 0.5, sentence(rng, rng.randrange(6, 150)) + ". Answer " + sentence(rng, 5) + ".") for i in range(60)]
    texts = []
    for k, (_, item) in enumerate(items):
        edited = item.split(" ")
        edited[k % len(edited)] = "edited"
        texts.append(f"{sentence(rng, rng.randrange(90))} {' '.join(edited)} {sentence(rng, 70)}")
    docs, benchmark = frame(spark, texts), spark.createDataFrame(items, "item_id double, text string")
    whole, *blocks = [{(r.doc_id, r.item_id): r.score for r in decontaminate.find_leaks(docs, benchmark, most).collect()}
                      for most in (5000, 20, 7)]
    assert sum((k, k + 0.5) in whole for k in range(60)) >= 54
    for other in blocks:
        assert other.keys() == whole.keys() and all(abs(other[k] - whole[k]) < 1e-12 for k in whole)
    left = [{r.doc_id for r in decontaminate.without_leaks(docs, benchmark, most).collect()} for most in (5000, 20)]
    assert left[0] == left[1] == set(range(60)) - {d for d, _ in whole}


def test_leaks_of_short_items(spark):
    """Items of one to four words are searched for as a whole, without the cut of plain_leaks."""
    rng = random.Random(12)
    items = [("a", "Who wrote Emma?", "Austen"), ("b", "Zyx", ""), ("c", "", "Quux corge"), ("d", "!?", "."),
             ("e", "Capital of Peru?", "Lima"), ("f", sentence(rng, 30), "long enough")]
    texts = [f"{sentence(rng, 100)} who wrote Emma -- Austen, {sentence(rng, 200)}", "who once wrote emma austen",
             "zyx", f"{sentence(rng, 62)} QUUX corge {sentence(rng, 3)}", "corge quux", "Capital of Peru, not Lima",
             "capital of peru LIMA", None, ""]
    benchmark = spark.createDataFrame(items, "item_id string, question string, answer string")

    def norm(t):
        return " " + " ".join(re.sub(r"[!-/:-@\[-`{-~]", " ", (t or "").lower()).split()) + " "
    want = {(d, i) for d, t in enumerate(texts) for i, q, a in items
            if norm(q + " " + a).strip() and norm(q + " " + a) in norm(t)}
    assert want == {(0, "a"), (2, "b"), (3, "c"), (6, "e")}
    rows = decontaminate.find_leaks(frame(spark, texts), benchmark).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == sorted(want)
    left = decontaminate.without_leaks(frame(spark, texts), benchmark)
    assert {r.doc_id for r in left.collect()} == {1, 4, 5, 7, 8}


def test_leaks_of_edited_passages(spark):
    rng = random.Random(4)
    question, answer = sentence(rng, 40), sentence(rng, 8)
    benchmark = spark.createDataFrame([("q", question, answer)], "item_id string, question string, answer string")
    words = question.split(" ")
    words[3] = "changed"
    texts = [f"{sentence(rng, 50)} {' '.join(words)} {answer} {sentence(rng, 70)}", f"{question} no answer here",
             " ".join(words[::2]) + " " + answer]
    rows = decontaminate.find_leaks(frame(spark, texts), benchmark).collect()
    assert [(r.doc_id, r.item_id) for r in rows] == [(0, "q")]


def test_role_repair_is_the_cheapest():
    rng = random.Random(2)
    for _ in range(200):
        codes = [rng.randrange(4) for _ in range(rng.randrange(1, 6))]
        best = min(chat.path_cost(codes, r) for r in itertools.product((1, 2, 3), repeat=len(codes)))
        assert chat.path_cost(codes, chat.best_path([chat.COSTS[c] for c in codes], chat.START)) == best


def test_chats(spark):
    rng = random.Random(6)
    turns = [(c, t, rng.choice(["system", "User", "assistant", "gpt", None, "odd"]), rng.choice([None, "", "hi <|end|>", "yo"]))
             for c in range(30) for t in range(rng.randrange(1, 9))]
    turns += [(1000, t, "user" if t % 3 else "assistant", f"t{t}") for t in range(3000)] + [(None, 1, "user", "x")] * 2
    rows = spark.createDataFrame([(*t, 1, 2) for t in turns], "conv_id long, turn long, role string, text string, part int, pos int")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = chat.format_chats(rows).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert Counter((r.conv_id, r.turn, r.role_was) for r in got) == Counter(t[:3] for t in turns)
    by_conv = defaultdict(list)
    for r in sorted(got, key=lambda r: tuple(r.place)):
        by_conv[r.conv_id].append(r)
    for rs in by_conv.values():
        text = "".join(r.rendered for r in rs)
        roles = re.findall(r"<\|(system|user|assistant)\|>\n", text)
        assert text.count("<|end|>") == len(roles) and text.endswith("<|end|>\n")
        tail = roles[1:] if roles[0] == "system" else roles
        assert tail == ["user", "assistant"] * (len(tail) // 2)
        codes = [chat.SPELLINGS.get((r.role_was or "").lower(), 0) for r in rs]
        best = chat.best_path([chat.COSTS[c] for c in codes], chat.START)
        assert chat.path_cost(codes, [chat.ROLES.index(r.role) for r in rs]) == chat.path_cost(codes, best)
    assert chat.format_chats(rows.filter("false")).count() == 0


def test_pipeline(spark):
    """Every stage's decisions against a plain version on the stage's own input."""
    docs = table(spark, SF, "documents")
    kept = docs
    from dossier.checkpoints import freeze
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").orderBy("doc_id").collect()]
        kept = freeze(stage(spark, kept, SF))
        texts = [t for _, t in before]
        if name != "packing":
            assert kept.columns == docs.columns
            after = {r.doc_id: r.text for r in kept.collect()}
        if name == "toxicity":
            said = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
            gone = [i for i, _ in before if i not in after]
            assert sum(said.get(i, 1) for i in gone) >= 0.9 * len(gone) > 0
        if name == "line_dedup":
            key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
            found = Counter(k for t in texts for k in {key(x) for x in t.split("\n")})
            assert after == {i: "\n".join(x for x in t.split("\n") if not key(x) or found[key(x)] < 10) for i, t in before}
        if name == "near_dedup":
            assert set(after) == {before[i][0] for i, (_, c) in enumerate(components(texts, 5)) if i == c}
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
            assert set(after) == {i for i, _ in before} - {before[d][0] for d, _ in plain_leaks(texts, items)}
        if name == "packing":
            assert kept.select("doc_id").distinct().count() == len(before)


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
@pytest.mark.parametrize("rows", ["awkward", "none"])
def test_stages_on_awkward_rows(spark, stage, rows):
    docs = awkward_frame(spark) if rows == "awkward" else frame(spark, [])
    got = stage(spark, docs, "/root/testdata/sf0.001")
    if stage is not corpus_pipeline.pack_sequences:
        assert got.columns == docs.columns
    assert (got.count() > 0) == (rows == "awkward")
