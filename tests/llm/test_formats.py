"""Token shards, WARC archives and page texts."""

import random
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import htmltext, repair, warc
from tidemark.llm.common import scratch


@given(st.lists(st.integers(0, 5), max_size=400), st.integers(0, 400), st.integers(0, 50))
@settings(max_examples=150, deadline=None)
def test_shards_round_trip(ids, start, count):
    x = np.array(ids, np.uint32)
    shard = repair.Shard(repair.encode_shard(x))
    assert shard.decode().tolist() == ids
    start = min(start, len(ids))
    assert shard.decode(start, count).tolist() == ids[start : start + count]


def test_shards_compress_and_read_at_random():
    rng = np.random.default_rng(0)
    phrase = rng.integers(0, 40000, 300)
    x = np.concatenate([np.concatenate([phrase[:k], rng.integers(0, 70000, 3)]) for k in rng.integers(1, 300, 600)]).astype(np.uint32)
    blob = repair.encode_shard(x)
    shard = repair.Shard(blob)
    assert len(blob) < 2 * len(x) and len(shard.rules) and (shard.decode() == x).all()
    assert shard.lengths.sum() > 2 * len(shard.rules)
    for a in rng.integers(0, len(x), 30):
        assert (shard.decode(int(a), 100) == x[a : a + 100]).all()


def test_words_have_the_ids_of_whole_texts():
    path = repair.tokenizer_file()
    code, whole = repair.Encoder(path), Tokenizer.from_file(path)
    texts = ["It's they'RE 12.5% Été!!", "<|endoftext|> a <|endoftext|>b", "straße İstanbul ΣΑΣ é", "tab\tline\r\nend em nb", "x'sx ''ll '' o'clock'", "ªº × ÷", "\U0001f600 你好", "a\x1cb\x85c", "~`{|}^_@[\\]"]
    rng = random.Random(0)
    pool = "aZ 9'.,\néÉß× s t re<|>"
    texts += ["".join(rng.choice(pool) for _ in range(rng.randrange(40))) for _ in range(800)]
    for t in texts:
        assert np.frombuffer(code.ids(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, t


def _cpu(f):
    """The least CPU seconds of five calls."""
    out = []
    for _ in range(5):
        began = time.process_time()
        f()
        out.append(time.process_time() - began)
    return min(out)


def test_cost_of_new_words_and_of_reading():
    rng = np.random.default_rng(0)
    code = repair.Encoder(repair.tokenizer_file())
    letters = list("éàüñaeionrst")
    words = sorted({"é" + "".join(rng.choice(letters, 8)) for _ in range(8000)})
    texts = [code.letters[list(w.encode())].tobytes().decode("utf-32-le") for w in words]
    tokenize = code.tokenizer.model.tokenize
    coded = [w.encode() for w in words]
    ids, count = code._words(coded)
    assert ids.tolist() == [t.id for x in texts for t in tokenize(x)] and count.sum() == len(ids)
    assert _cpu(lambda: code._words(coded)) < 1.65 * _cpu(lambda: [[t.id for t in tokenize(x)] for x in texts])

    x = rng.integers(0, 300, 1 << 19).astype(np.uint32)
    blob = repair.encode_shard(x)
    assert zlib.crc32(blob) == 710442358  # the grammar is the same, however it is computed
    places = rng.permutation(len(x))
    assert _cpu(lambda: repair.Shard(blob).decode()) < 8.2 * _cpu(lambda: x[places].astype(np.int64))


def test_token_shards_of_documents(spark, monkeypatch):
    whole = Tokenizer.from_file(repair.tokenizer_file())
    rows = [(i, f"text number {i} of many, many words " * (i % 7)) for i in range(90)] + [(200, None), (201, ""), (-5, "first"), (7, "again"), (7, "again"), (300, "long " * 300_000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("clash")).repartition(5)
    path = repair.write_shards(df, repair.tokenizer_file(), scratch(spark, "test"), shard_tokens=500)
    got = [tuple(r) for r in repair.read_shards(spark, path).collect()]
    want, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = np.array(whole.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(got) == sorted(want)
    assert repair.round_trip(df.limit(0)).collect() == []


PAGES = [(i, f"http://h.example/{i}", f"<p>page {i % 4}</p>" * 40) for i in range(12)]


def archive():
    return [warc.member(warc.record_bytes(i, u, h.encode())) for i, u, h in PAGES]


def ids(found):
    return [int(r["X-Page-ID"]) for r in found.records]


def test_salvage_skips_damaged_members_and_logs_gaps():
    parts = archive()
    good = b"".join(parts)
    assert ids(warc.read_archive(good)) == list(range(12)) and not warc.read_archive(good).gaps
    start = [sum(map(len, parts[:i])) for i in range(13)]
    for victim in (0, 5, 11):
        bad = bytearray(good)
        middle = start[victim] + len(parts[victim]) // 2
        bad[middle : middle + 4] = b"\xff\x00\xff\x00"
        got = warc.read_archive(bytes(bad))
        assert ids(got) == [i for i in range(12) if i != victim]
        assert [(a, b) for a, b, _ in got.gaps] == [(start[victim], start[victim + 1])]
    got = warc.read_archive(good[: start[11] + 20])
    assert ids(got) == list(range(11)) and got.gaps[0][:2] == (start[11], start[11] + 20)
    junk = b"junk\x1f\x8b\x08junk"
    got = warc.read_archive(parts[0] + junk + parts[1])
    assert ids(got) == [0, 1] and got.gaps[0][:2] == (start[1], start[1] + len(junk))
    assert warc.read_archive(b"").records == [] and len(warc.read_archive(b"nothing here").gaps) == 1


def test_salvage_of_plain_archives():
    plain = [warc.record_bytes(i, u, h.encode()) for i, u, h in PAGES]
    data = b"".join(plain)
    assert ids(warc.read_archive(data)) == list(range(12))
    cut = b"".join([plain[0], plain[1][:200], plain[2]])
    got = warc.read_archive(cut)
    assert ids(got) == [0, 2] and [(a, b) for a, b, _ in got.gaps] == [(len(plain[0]), len(plain[0]) + 200)]
    wrong = data.replace(b"page 3", b"page X", 1)
    assert ids(warc.read_archive(wrong)) == [i for i in range(12) if i != 3]


def test_salvage_of_mixed_and_single_member_archives():
    plain = [warc.record_bytes(i, u, h.encode()) for i, u, h in PAGES]
    packed = archive()
    everything = b"".join(plain)
    first_bad = b"XARC" + everything[4:]
    assert ids(warc.read_archive(first_bad)) == list(range(1, 12))
    assert [(a, b) for a, b, _ in warc.read_archive(first_bad).gaps] == [(0, len(plain[0]))]
    assert ids(warc.read_archive(warc.member(first_bad))) == list(range(1, 12))
    mixed = packed[0] + plain[1] + packed[2] + b"junk" + plain[3] + packed[4]
    assert ids(warc.read_archive(mixed)) == [0, 1, 2, 3, 4]
    whole = bytearray(warc.member(everything))
    whole[-8] ^= 255  # the checksum
    got = warc.read_archive(bytes(whole))
    assert ids(got) == list(range(12)) and got.gaps[0][:2] == (0, len(whole))
    got = warc.read_archive(warc.member(everything)[:-40] + packed[0])
    assert len(got.records) > 1 and ids(got)[-1] == 0
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    stored = bytearray(packer.compress(everything) + packer.flush())
    stored[-8] ^= 255
    assert ids(warc.read_archive(bytes(stored))) == list(range(12))


def test_archives_of_pages(spark):
    rows = [*PAGES, (50, None, None), (51, "http://x/\r\nb c", ""), (52, "u", "é你 html"), (2, PAGES[2][1], PAGES[2][2]), (None, "n", "alone")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("first", F.lit(1))
    manifest = warc.write_archives(df, scratch(spark, "warc-test"), archive_bytes=600)
    records, gaps = warc.read_archives(manifest)
    got = sorted((r.page_id if r.page_id is not None else -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records.collect())
    want = []
    for i, _, h in rows:
        p = (h or "").encode()
        first = min((j for j, _, x in rows if (x or "") == (h or "") and j is not None), default=None)
        same = first is None or first == i or i is None
        want.append((i if i is not None else -1, len(p), warc.digest_of(p), "response" if same else "revisit", None if same else first))
    assert got == sorted(want, key=lambda r: r[:4]) and gaps.count() == 0
    big = warc.write_archives(df, scratch(spark, "warc-test"), least=1 << 20)
    assert warc.read_archives(big)[0].filter("record_type = 'revisit'").count() == 0
    assert warc.read_archives(warc.write_archives(df.limit(0), scratch(spark, "warc-test")))[0].count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="sidebar-left"><header>Site</header><nav><ul><li>Home<li>About</ul></nav>
<div class="cookie-notice">We use cookies</div><div id="main-content"><article><header><h1>Head&amp;line</h1></header><p>First  para&#233;
graph<br>goes on<p>Second <b>bold<div class="ad">Buy</div><script>var x="</p>";</script><!-- <p>no</p> -->
<table><tr><td>a</td><td>b</td></tr></table><form><p>Mail <input></form></article><section class="comments"><article>Nice!</article></section></div>
<aside>More</aside><footer>&copy; us</footer></body></html>"""


def test_article_text():
    lines, kept = htmltext.lines_of(PAGE)
    assert htmltext.main_text(lines, kept, None) == "Head&line\nFirst paraé graph goes on\nSecond bold\na b"


def test_lcs_is_longest():
    rng = random.Random(0)
    for _ in range(400):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        got = htmltext.shared_lines(a, b)
        it = iter(b)
        assert len(got) == table[-1][-1] and all(any(x == a[i] for x in it) for i in sorted(got))
    assert htmltext._aligned_once(list("abcxe"), list("bacye")) in ({0, 2, 4}, {1, 2, 4})


def test_pages_without_markup_are_differenced(spark):
    frame = "<div>Home | News</div><p>{}</p><p>{}</p><div>Imprint of us</div>"
    rows = [(1, "http://a/x/1", frame.format("one", "own one")), (2, "http://a/x/2", frame.format("two", "own two")), (3, "http://b/1", frame.format("three", "other host")), (4, None, "<p>no url</p>"), (5, "http://a/y", None), (6, "http://c/1", PAGE), (6, "http://c/1", PAGE), (7, "http://d/1", "<p>same</p>"), (8, "http://d/2", "<p>same</p>"), (9, "http://[bad", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("lines", F.lit(1))
    got = sorted((r.page_id, r.text, r.n_chars) for r in htmltext.extract(df).collect())
    texts = {i: t for i, t, _ in got}
    assert texts[1] == "one\nown one" and texts[2] == "two\nown two" and texts[3].startswith("Home | News\nthree")
    assert texts[4] == "no url" and texts[5] == "" and texts[6].startswith("Head&line") and texts[7] == texts[8] == "same"
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    assert htmltext.extract(df.limit(0)).count() == 0


def test_huge_pages_are_aligned_exactly(monkeypatch):
    rng = random.Random(5)
    cases = [[[rng.choice("abcdef") for _ in range(rng.randrange(40))] for _ in range(2)] for _ in range(100)]
    want = [len(htmltext.shared_lines(a, b)) for a, b in cases]
    monkeypatch.setattr(htmltext, "EXACT_CELLS", 30)
    for (a, b), n in zip(cases, want):
        got = htmltext.shared_lines(a, b)
        it = iter(b)
        assert len(got) == n and all(any(x == a[i] for x in it) for i in sorted(got))


@pytest.mark.parametrize("block", [1 << 20, 1, 3])
def test_copies_and_blocks_hide_no_neighbour(spark, monkeypatch, block):
    """Runs of equal pages, of any length, in blocks of any size."""
    monkeypatch.setattr(htmltext, "BLOCK_PAGES", block)
    frame = "<div>Home | News</div><p>{}</p><div>Imprint of us</div>"
    texts = ["a"] * 5 + ["b", None, "c", "c"] + ["d"] * 4 + [None] + ["e"]
    rows = [(i, f"http://a/x/{i:02}", frame.format(t) if t else None) for i, t in enumerate(texts)]
    rows += [(50, "http://b/1", frame.format("f")), (51, None, "<p>g</p>")]
    got = {r.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: t or "" for i, t in enumerate(texts)} | {50: "Home | News\nf\nImprint of us", 51: "g"}


@pytest.mark.parametrize("html", ["<", "<p", "<!--", "<script>", "</p></div>", "<p class='ad>x</p>", "<div hidden>x</div>y", "&#0;&bogus;", "<a " * 200_000, "<!" * 200_000, "<p>" * 3000])
def test_broken_html_does_not_crash(html):
    htmltext.lines_of(html)
