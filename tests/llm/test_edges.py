"""Columns of clashing names, repeated rows, null keys, hash identity and bounded memory."""

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import common, decontam, hmm, htmltext, licenses, mixing, neardup, repair, warc
from tests.llm.test_text_stages import brute_hits

PATH = "/root/testdata/sf0.001"
#: Names that the operators use inside, and names of their results.
INNER = "__d __t __u __doc __source __size __copies __copy __runs __parts __shift __score __rows d t u s n h p w x at of wid spans items copies kept rows size rate bucket component block part seq base from to".split()


def test_pipeline_takes_clashing_names_nulls_and_repeats(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    odd = docs.limit(3).unionByName(docs.limit(3))
    odd = odd.unionByName(docs.limit(2).withColumns({"doc_id": F.lit(None).cast("long"), "source": F.lit(None).cast("string")}))
    odd = odd.unionByName(docs.limit(1).withColumns({"doc_id": F.lit(10**9), "text": F.lit(None).cast("string"), "source": F.lit(None).cast("string")}))
    docs = docs.unionByName(odd).withColumns({c: F.lit(i) for i, c in enumerate(INNER)})
    plain = [c for c in docs.columns if c not in INNER]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        last = i == len(corpus_pipeline.STAGES) - 1
        want = stage(spark, docs.select(*plain), PATH)
        got = stage(spark, docs, PATH)
        if last:
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        else:
            assert got.columns == docs.columns
            assert sorted(map(repr, got.select(*plain).collect())) == sorted(map(repr, want.collect()))
            docs = common.written(got, "test-clash")
            assert docs.count() > 0 and docs.filter("__d <> 0 or wid <> " + str(INNER.index("wid"))).count() == 0


def test_unused_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "__a int, __A_ int, b int")
    assert common.unused(df, "a", "a", "b") == ["__a__", "__a___", "__b"]


def items_of_every_length(rng):
    vocab = ["alpha", "Beta", "gamma", "Éa", "éa", "d7", "e", "Kelvin", "kelvin"]
    line = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocab) for _ in range(n))
    items = [(n, line(n)) for n in range(1, 13)] + [(13, line(40)), (20, None), (21, "..."), (22, "")]
    items[0] = (1, "lonely")
    docs = [(i, line(rng.randrange(0, 80))) for i in range(80)]
    docs += [(i, f"{line(5)} {items[i % 12][1].upper()} {line(3)}") for i in range(100, 130)] + [(200, None), (201, "x LONELY"), (201, "x LONELY"), (None, "lonely")]
    return docs, items


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_decontamination_of_items_of_every_length(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", broadcast)
    monkeypatch.setattr(decontam, "COPIES_AT_ONCE", 1)
    docs, items = items_of_every_length(random.Random(3))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items + items[:2], "item_id long, text string")
    got = sorted((r.doc_id or -1, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontam.report(d, b).collect())
    want = sorted((i or -1, *brute_hits(t, items), brute_hits(t, items)[1] > 0) for i, t in docs)
    assert got == want


def test_decontamination_scans_documents_once(spark, tmp_path):
    docs, items = items_of_every_length(random.Random(4))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    b = spark.createDataFrame(items, "item_id long, text string")
    plan = decontam.report(spark.read.parquet(f"{tmp_path}/documents.parquet"), b)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<doc_id:bigint,text:string>") == 1 and "Python" not in plan and "InArrow" not in plan


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(2)
    cases = [rng.integers(0, 6, 5000), np.tile(rng.permutation(64), 2000), np.zeros(30_001, np.int64), np.repeat(rng.integers(0, 9, 400), rng.integers(1, 40, 400)), rng.zipf(1.3, 20_000) % 50_000]
    for ids in cases:
        values, x = np.unique(ids, return_inverse=True)
        sequence, rules = repair.grammar(x, len(values))
        count, last = {}, {}
        for i, pair in enumerate(zip(sequence[:-1].tolist(), sequence[1:].tolist())):
            if last.get(pair) != i - 1:
                count[pair], last[pair] = count.get(pair, 0) + 1, i
        assert max(count.values(), default=0) < repair.LEAST_COUNT
        blob = repair.encode_shard(ids)
        assert (repair.Shard(blob).decode() == ids).all()
    assert len(repair.grammar(np.tile(np.arange(64), 20_000), 64)[0]) < 64


def test_shards_of_several_sections(monkeypatch):
    monkeypatch.setattr(repair, "SHARD_TOKENS", 700)
    ids = np.random.default_rng(1).integers(0, 20, 5000)
    shard = repair.Shard(repair.encode_shard(ids))
    assert len(shard.sections) == 8 and shard.tokens == 5000
    for a, n in ((0, 5000), (690, 20), (699, 1402), (4990, 100), (5000, 3)):
        assert shard.decode(a, n).tolist() == ids[a : a + n].tolist()


def test_shards_of_one_repeated_id(spark):
    df = spark.createDataFrame([(7 if i % 3 else None, f"text {i}") for i in range(400)], "doc_id long, text string").repartition(6)
    got = sorted((r.start, r.n_tokens) for r in repair.round_trip(df).collect())
    assert len(got) == 400 and all(a + n == b for (a, n), (b, _) in zip(got, got[1:]))


def test_archives_are_read_by_several_tasks(spark):
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"<p>{i}</p>" * 50) for i in range(60)], "page_id long, url string, html string")
    manifest = warc.write_archives(pages, common.scratch(spark, "warc-test"), archive_bytes=400)
    archives = manifest.count()
    records = warc.read_archives(manifest)[0]
    per = records.groupBy(F.spark_partition_id()).count().collect()
    assert archives > 8 and len(per) > archives / 2 and records.count() == 60


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_of_equal_polynomials_stay_apart(spark):
    x = thue_morse(2048)
    y = x.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"{x} one two three four"), (2, f"{y} one two three four"), (3, x), (4, y), (5, x)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in neardup.labelled(df).collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 3}
    counts = hmm.token_counts(df).collect()
    assert sorted(r.c for r in counts) == [2, 2, 2, 2, 2, 3]


def test_word_hashes_tell_words_apart():
    rng = random.Random(0)
    words = {bytes(rng.choices(b"abcxyz\xc3\xa9", k=rng.choice([1, 2, 7, 8, 9, 16, 17, 40, 128, 129, 300]))) for _ in range(20_000)}
    words = sorted(words)
    is_word = common.word_table(common.WHITE_SPACE)
    h, at = common.word_hashes([b" ".join(words)], is_word)
    assert at.tolist() == [0, len(words)] and len(np.unique(h)) == len(words)
    assert (common.word_hashes(words, is_word)[0] == h).all()
    assert not np.isin(common.word_hashes(words, is_word, seed=1)[0], h).any()


def test_hmm_edges(spark):
    long = "palabra " * 400_000
    rows = [(1, long), (2, "a b c"), (2, "a b c"), (None, "a b"), (3, None), (4, ""), (5, "x" * 1_000_000)]
    got = hmm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and all(np.isfinite(r.score) and r.score <= 0 for r in got)
    twice = [r for r in got if r.doc_id == 2]
    assert twice[0].score == pytest.approx(twice[1].score) and max(r.n_tokens for r in got) == 400_001


def test_license_edges(spark):
    long = "word " * 300_000 + "released under the MIT License"
    df = spark.createDataFrame([(1, long), (2, "cc by nc"), (2, "cc by nc")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_base, r.first_word, r.labels) for r in licenses.scan(df).collect())
    assert got == [(1, 300_005, 1, 300_001, "mit"), (2, 3, 1, 0, "cc-by-nc"), (2, 3, 1, 0, "cc-by-nc")]
    assert licenses.scan(df.limit(0)).count() == 0


def fair_targets(sizes):
    """Targets by exact bisection on the level, weights 1, 2, 3 in turn."""
    low, high = Fraction(0), Fraction(3 * sum(sizes) + 1)
    given = lambda level: sum(min(Fraction(3 * s), level * (i % 3 + 1)) for i, s in enumerate(sizes))
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if given(middle) < sum(sizes) else (low, middle)
    return [float(min(Fraction(3 * s), high * (i % 3 + 1))) for i, s in enumerate(sizes)]


def test_mix_against_targets_by_bisection(spark):
    rng = random.Random(6)
    rows = [(i, "w " * (rng.randrange(1, 30)), rng.choice(["a", "b", "c", "é", None, "Z"])) for i in range(4000) if i % 7]
    rows += [(5000, "w " * 200_000, "big"), (5001, "w", "one"), (5002, None, "none"), (None, "w w", "a"), (None, "w w", "a")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.mode("overwrite").parquet(path := common.scratch(spark, "mix-test") + "/documents.parquet")
    got = mixing.query(spark, path.removesuffix("/documents.parquet")).collect()
    assert len(got) == len(rows)
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    due = dict(zip(names, fair_targets([size[s] for s in names])))
    taken = {}
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(due[r.source], rel=1e-9, abs=1e-6)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in names:
        assert taken[s] == pytest.approx(due[s], rel=0.01, abs=200_000 if s == "big" else 5)


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_mix_of_many_sources(spark, monkeypatch, broadcast):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", broadcast)
    rng = random.Random(9)
    rows = [(i, "w " * rng.randrange(1, 9), None if i % 701 == 0 else f"s{rng.randrange(700)}") for i in range(6000)]
    got = mixing.rates(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(t.split())
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    due = dict(zip(names, fair_targets([size[s] for s in names])))
    taken = {}
    for r in got:
        assert r.target == pytest.approx(due[r.source], rel=1e-9) and r.rate * r.source_size == pytest.approx(r.target, rel=1e-6)
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
    assert all(abs(taken[s] - due[s]) <= 8 for s in names)


def test_differencing_decides_doubtful_blocks(spark):
    page = '<article><p>{}</p><p class="notice-text">{}</p><div class="share-price">{}</div><p id="comments-on-law">{}</p><div class="ad">x</div></article>'
    rows = [(1, "http://a/1", page.format("one", "n1", "Share this", "law one")), (2, "http://a/2", page.format("two", "n2", "Share this", "law two")), (3, "http://b/1", page.format("one", "n", "Share this", "law"))]
    got = {r.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "one\nn1\nlaw one", 2: "two\nn2\nlaw two", 3: "one\nn\nShare this\nlaw"}
