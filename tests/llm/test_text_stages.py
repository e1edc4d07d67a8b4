"""Decontamination, mixing, licenses, quality and the language model."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontam, hmm, licenses, mixing, quality

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute_hits(text, items):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        v = words(t)
        n = min(10, len(v))
        grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(w), len(hit), len(found)


def test_decontamination(spark):
    rng = random.Random(5)
    vocab = ["alpha", "Beta", "gamma", "Éa", "éa", "d7", "e"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([1, 4, 10, 12, 30]))) for i in range(3, 12)] + [(1, None), (2, "..."), (20, "One rare passage that has more than ten words in its only line")]
    items = [x for x in items if len(words(x[1])) != 1]
    docs = [(i, text(rng.randrange(0, 60))) for i in range(60)] + [(60, None), (61, ""), (62, "x ONE rare passage, that has more than TEN words in its only line y"), (62, "other"), (None, "one rare passage that has more than ten words in its")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("runs", F.lit(0))
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontam.report(d, b).collect())
    want = sorted((i is not None, i or 0, *brute_hits(t, items), brute_hits(t, items)[1] > 0) for i, t in docs)
    assert got == want
    left = decontam.clean(d, b)
    assert left.columns == d.columns
    assert sorted(r.text or "" for r in left.collect()) == sorted(t or "" for _, t in docs if not brute_hits(t, items)[1])
    cut = {(r.doc_id, r.text) for r in decontam.clean(d, b.filter("item_id = 20"), "span").collect()}
    assert (62, "x  y") in cut and (62, "other") in cut and len(cut) == len(set(docs))
    assert decontam.report(d, b.limit(0)).filter("contaminated").count() == 0
    assert decontam.report(d.limit(0), b).count() == 0


def test_targets_stop_at_the_cap():
    got = mixing.targets_of([100.0, 10.0, 1.0, 0.0], [1.0, 2.0, 3.0, 1.0])
    assert got[1:] == [30.0, 3.0, 0.0] and got[0] == pytest.approx(78.0)
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randrange(1, 8)
        sizes = [float(rng.choice([0, 1, 5, 80, 1000])) for _ in range(n)]
        t = mixing.targets_of(sizes, [float(i % 3 + 1) for i in range(n)])
        assert sum(t) == pytest.approx(sum(sizes)) and all(a <= 3 * s + 1e-9 for a, s in zip(t, sizes))


def test_mix_meets_targets_and_repeats_itself(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * int(rng.paretovariate(1.2) * 5)), rng.choice(["a", "b", "b", "c", None])) for i in range(3000)]
    rows += [(3000, None, "a"), (3001, "", "z"), (5, rows[5][1], rows[5][2])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"rows": F.lit(1), "rate": F.lit("x")})
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    names = sorted(k for k in size if k) + [None]
    due = dict(zip(names, mixing.targets_of([float(size[k]) for k in names], [(1.0, 2.0, 3.0)[i % 3] for i in range(len(names))])))
    plan = mixing.rates(df).collect()
    taken = {}
    for r in plan:
        assert 0 <= r.copies <= 3 and r.target == pytest.approx(due[r.source], rel=1e-9)
    out = mixing.mixed(df)
    assert out.columns == df.columns
    for r in out.select("source", mixing.word_count(F.col("text")).alias("n")).collect():
        taken[r.source] = taken.get(r.source, 0) + r.n
    for s, t in due.items():
        assert taken.get(s, 0) == pytest.approx(t, rel=0.01, abs=5)
    assert sorted((r.doc_id, r.copies) for r in mixing.rates(df.repartition(3)).collect()) == sorted((r.doc_id, r.copies) for r in plan)
    assert mixing.mixed(df.limit(0)).count() == 0


def test_license_templates_match_and_reject():
    m = licenses.Scanner((), [("l", "grant <<beginOptional>>free <<var;name=a;match=.{0,12}>><<endOptional>> to <<var;name=who;match=.+>> forever")])
    yes = ["grant to all forever", "Grant, free of to one two forever!", "x grant free to any forever y"]
    no = ["grant forever", "grant to forever", "grant freely to all forever", "grant free a b c to all forever", "grant to all for ever"]
    assert all(m.scan(t.lower().encode())[4] == "l" for t in yes)
    assert all((m.scan(t.lower().encode()) or licenses.NONE)[4] == "" for t in no)
    with pytest.raises(ValueError):
        licenses.compiled("l", "<<beginOptional>>all<<endOptional>>")
    with pytest.raises(ValueError):
        licenses.compiled("l", "a <<beginOptional>>b")


def test_license_regions_take_versions_and_any_length():
    m = licenses.Scanner((), licenses.TEMPLATES)
    for version in ("4.0", "3.0", "2.0", "4"):
        for text in (f"Creative Commons Attribution {version} International License", f"a Creative Commons Attribution {version} License."):
            assert m.scan(text.lower().encode())[4] == "cc-by"
    assert (m.scan(b"creative commons attribution 4.0 or any license") or licenses.NONE)[4] == ""
    for match in (";match=.+", ";match=.*", ""):
        m = licenses.Scanner((), [("l", f"granted to <<var;name=who{match}>> forever")])
        assert m.scan(b"granted to " + b"a b. " * 400 + b"forever")[4] == "l"
        assert (m.scan(b"granted to forever") or licenses.NONE)[4] == ("" if "+" in match else "l")


def plain_matches(items, words, spans, joined, at):
    """Where matches of items end that begin at word at, by recursion without an automaton."""
    if not items:
        return {at}
    x, rest = items[0], items[1:]
    if isinstance(x, bytes):
        return plain_matches(rest, words, spans, joined, at + 1) if at < len(words) and words[at] == x else set()
    if isinstance(x, list):
        return plain_matches(rest, words, spans, joined, at) | plain_matches(x + rest, words, spans, joined, at)
    least, most = x
    out = set() if least else plain_matches(rest, words, spans, joined, at)
    for end in range(at + 1, len(words) + 1):
        size = spans[end - 1][1] - spans[at][0]
        runs = 1 + sum(not joined[i] for i in range(at + 1, end))
        if most is not None and (size > most or runs > -(-most // licenses.MEAN_WORD)):
            break
        if size >= least:
            out |= plain_matches(rest, words, spans, joined, end)
    return out


def test_license_labels_match_plain_recursion():
    rng = random.Random(8)
    templates = [
        ("a", "one <<var;match=.{0,12}>> two"),
        ("b", "one <<beginOptional>>two <<var;match=.{3,9}>><<endOptional>> three <<beginOptional>>two<<endOptional>>"),
        ("c", "<<beginOptional>>two <<beginOptional>>three<<endOptional>><<endOptional>> one <<var;match=.+>> one"),
        ("d", "three <<var;match=.{1,8}>> <<var;match=.{0,5}>> one two"),
        *licenses.TEMPLATES,
    ]
    machine = licenses.Scanner((), templates)
    vocab = ["one", "two", "three", "é", "abcdefghijklmnop", "x", "abc"]
    texts = [rng.choice(["{}", "{}."]).format(rng.choice([" ", "  ", ".", " "]).join(rng.choice(vocab) for _ in range(rng.randrange(0, 14)))) for _ in range(1500)]
    for _, t in licenses.TEMPLATES:
        plain = licenses._MARKUP.sub(lambda m: rng.choice(["", "any 4.0"]) if m[1].lower() == "var" else " ", t)
        texts += [plain, "x " + plain + " y", plain.replace(" the ", " a ", 1), plain.upper()]
    matched = 0
    for text in texts:
        data = text.encode().lower()
        found = list(WORD.finditer(data))
        spans = [(len(data[: m.start()].decode()), len(data[: m.end()].decode())) for m in found]
        joined = [False] + [not re.search(rb"\s", data[x.end() : y.start()]) for x, y in zip(found, found[1:])]
        w = [m[0] for m in found]
        want = {label for label, t in templates if any(plain_matches(licenses._tree(t), w, spans, joined, i) - {i} for i in range(len(w)))}
        got = machine.scan(data) or licenses.NONE
        assert set(filter(None, got[4].split(","))) == want, text
        matched += bool(want)
    assert matched > 200


def test_license_region_bounds_count_characters():
    m = licenses.Scanner((), [("l", "foo <<var;name=a;match=.{0,12}>> bar")])
    hit = lambda t: (m.scan(t.encode()) or licenses.NONE)[4]
    assert hit("foo abcdefghijkl bar") == "l" and hit("foo abcdefghijklmnop bar") == "" and hit("foo bar") == "l"
    assert hit("foo éééééééééééé bar") == "l" and hit("foo ééééééééééééé bar") == ""


def test_license_scan_counts_base_places(spark):
    rng = random.Random(4)
    parts = ["under", "the", "MIT", "license", "Apache License,", "Version", "2", "2.0", "cc", "BY", "nc", "mit-license", "licenses"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(0, 80)))) for i in range(150)] + [(200, None), (201, ""), (202, "CC-BY-NC" * 3), (203, "Released under the MIT\nLicense. All rights reserved.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("labels", F.lit(1))
    for r in licenses.scan(df).collect():
        w = words(dict(rows)[r.doc_id])
        at = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.encode().split()]
        assert (r.n_words, r.n_base) == (len(w), len(at))
        assert (r.first_word, r.last_word) == (min((i for i, _ in at), default=None), max((i for i, _ in at), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in at})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    got = licenses.scan(df.filter("doc_id = 203")).first()
    assert got.labels == "all-rights-reserved,mit" and got.base_labels == "mit"


def test_quality_on_held_out_rows(spark):
    path = "/root/testdata/sf0.1"
    got = quality.query(spark, path).filter("held_out").join(spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "quality"), "doc_id")
    r = got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("a"), F.avg(F.when(F.col("quality") == 0, F.col("predicted"))).alias("missed"), F.min("score"), F.max("score")).first()
    assert r.a > 0.98 and r.missed < 0.05 and 0 <= r[2] and r[3] <= 1


def test_quality_edges(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([None, "", " \n", "some plain words", "x" * 3_000_000, "some plain words"])], "doc_id long, text string").withColumn("quality", F.lit("clash"))
    labels = spark.createDataFrame([(3, 1), (3, 1), (99, 0), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r["__score"] for r in quality.scored(docs, quality.fit(docs, labels)).collect()}
    assert got[0] == got[1] == got[2] == 0 and got[3] == got[5]
    assert quality.kept(docs, labels.limit(0)).count() == 6  # without labels nothing is rejected
    assert quality.kept(docs.limit(0), labels).columns == docs.columns


def base_scores(rows):
    tok = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    train = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    count = {}
    for t in train:
        for w in [*tok(t), None]:
            count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    return {i: (len(tok(t)) + 1, sum(w in count for w in [*tok(t), None]), n, sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in [*tok(t), None])) for i, t in rows}


@pytest.mark.parametrize("known", [1 << 21, 20])
def test_language_model_counts(spark, monkeypatch, known):
    monkeypatch.setattr(hmm, "KNOWN", known)
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(60)] + ["Été", "ÉTÉ", "a b"]
    rows = [(i, rng.choice([" ", "\n"]).join(rng.choice(vocab) for _ in range(rng.randrange(0, 90)))) for i in range(120)] + [(500, None), (501, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("base", F.lit(1))
    want = base_scores(rows)
    for r in hmm.score(df).collect():
        n, k, total, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, k, total)
        assert r.base_score == pytest.approx(base, abs=1e-6) and r.score <= 0 and math.isfinite(r.score)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)


def test_language_model_beats_its_base_on_held_out_text(spark):
    r = hmm.score(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(3000)).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b
    assert hmm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_baum_welch_settles_on_all_training_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("text is not null").limit(1800)
    docs = docs.withColumn("text", F.array_join(F.slice(F.split("text", r"\s+"), 1, 60), " "))  # one segment each
    training = docs.filter(~hmm.held_out(F.col("doc_id")))
    rows = hmm.classified(docs, hmm.vocabulary(hmm.token_counts(training), training.count())).select("doc_id", "held_out", "classes").cache()
    texts = hmm._sequences(rows.filter("not held_out").select("classes").toArrow()["classes"])
    assert len(texts) > 1200 and max(map(len, texts)) <= hmm.SEGMENT
    model = hmm.train(rows)
    prior = np.bincount(np.concatenate(texts), minlength=hmm.CLASSES) + 1e-2
    after = hmm.Hmm.from_counts(sum(model.expected(*x) for x in hmm.segments_of(texts)), prior)
    last, likelihood = model.log10_forward(texts).sum(), after.log10_forward(texts).sum()
    assert likelihood - last < 2e-4 * abs(likelihood)


def test_forward_and_baum_welch_are_exact():
    rng = np.random.default_rng(0)
    s, c = hmm.STATES, hmm.CLASSES
    unit = lambda x: x / x.sum(-1, keepdims=True)
    m = hmm.Hmm(unit(rng.random(s)), unit(rng.random((s, s))), unit(rng.random((s, c))), unit(rng.random(s)))
    texts = [rng.integers(0, c, n).astype(np.uint16) for n in (1, 2, 5, 40)]

    def plain(x):
        a = m.start * m.emit[:, x[0]]
        for w in x[1:]:
            a = (a @ m.move) * m.emit[:, w]
        return math.log10(a.sum())

    assert m.log10_forward(texts) == pytest.approx([plain(x) for x in texts], abs=1e-9)
    n = sum(m.expected(*x) for x in hmm.segments_of(texts))
    start, share, move, emit = hmm._parts(n)
    total = sum(map(len, texts))
    assert start.sum() == pytest.approx(4, rel=1e-4) and share.sum() == pytest.approx(total, rel=1e-4)
    assert move.sum() == pytest.approx(total - 4, rel=1e-4) and emit.sum() == pytest.approx(total, rel=1e-4)
    # expected moves of a two-token text by enumeration
    x = texts[1]
    joint = m.start[:, None] * m.emit[:, [x[0]]] * m.move * m.emit[:, x[1]][None, :]
    got = hmm._parts(sum(m.expected(*y) for y in hmm.segments_of([x])))[2]
    assert got == pytest.approx(joint / joint.sum(), abs=1e-4)
