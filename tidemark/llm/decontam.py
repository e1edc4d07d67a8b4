"""Benchmark decontamination with DataFrame functions only.

A window is ten consecutive words of a benchmark item; an item of fewer words
is one window.  The windows' hashes are a broadcast hash table.  One scan of the
documents cuts each text into words once, hashes the window of every length
that the benchmark has at every position, probes the table, and verifies a hit
on the words themselves at once; of a text only its hits and its number of
words leave the scan.

The table is broadcast while it has at most BROADCAST_WINDOWS windows of at
most BROADCAST_BYTES.  Beyond, the hashes of all positions are joined by a
shuffle, and the hits are verified by a second scan of the documents hit.

Defined results: a null or empty text has no words and no hits; items without
words have no windows; equal item ids count once; repeated document rows each
get their result; extra columns, whatever their names, are kept by clean() and
ignored elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import character_class, unused, written

WINDOW = 10
#: Windows of the benchmark that are broadcast, and bytes of their words.
BROADCAST_WINDOWS, BROADCAST_BYTES = 1_000_000, 128 << 20
#: Rows of two or three numbers that are broadcast: windows' items, documents hit.
BROADCAST_ROWS = 500_000
#: Rows made at once of a document that is repeated.
COPIES_AT_ONCE = 65536

#: ASCII that no word holds, whatever its case, and the letters lower-cased.
_OTHER = character_class([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
WORD, NOT_WORD = f"[^{_OTHER}]+", f"[{_OTHER}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased."""
    text = text.cast("string")
    plain = F.octet_length(text) == F.char_length(text)  # lower() changes other letters too
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _hashes(w: Column, at: Column, size: int) -> list[Column]:
    """Hashes of the windows of 1 to size words that begin at a position."""
    out = [F.xxhash64(F.get(w, at))]
    for k in range(1, size):
        out.append(F.xxhash64(out[-1], F.get(w, at + k)))
    return out


def _window(w: Column, at: Column, length: Column) -> Column:
    return F.array_join(F.slice(w, at + 1, length), " ")


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The distinct windows (wid, h, length, window), and the items that each occurs in (wid, item_id)."""
    item = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w")).filter("size(w) > 0 and item_id is not null")
    item = item.withColumn("length", F.least(F.lit(size), F.size("w")))
    spot = item.select("item_id", "length", "w", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("length"))).alias("at"))
    h = F.element_at(F.array(*_hashes(F.col("w"), F.col("at"), size)), F.col("length"))
    spot = written(spot.select("item_id", "length", h.alias("h"), _window(F.col("w"), F.col("at"), F.col("length")).alias("window")).distinct(), "benchmark-spots")
    windows = written(spot.select("h", "length", "window").distinct().withColumn("wid", F.monotonically_increasing_id()), "benchmark-windows")
    items = written(spot.join(windows, ["h", "length", "window"]).select("wid", "item_id"), "benchmark-items")
    return windows, items


def _small(df: DataFrame) -> DataFrame:
    """With a broadcast hint if a count shows that it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text that tells rows of one id apart, and the words."""
    return docs.select(F.col("doc_id"), F.xxhash64("text").alias("t"), words(F.col("text")).alias("w"))


def _spots(docs: DataFrame, windows: DataFrame, size: int, every: bool) -> DataFrame:
    """doc_id, t, n (words), at, to, wid: a row for each hit, and with every a row for each document, which alone has n."""
    known = windows.groupBy("length").agg(F.count("*").alias("n"), F.sum(F.octet_length("window")).alias("bytes")).collect()  # at most size rows
    lengths = sorted(r.length for r in known)
    rows = _keyed(docs)
    whole = rows.select("doc_id", "t", F.size("w").alias("n"), *[F.lit(None).cast(k).alias(c) for c, k in (("at", "int"), ("to", "int"), ("wid", "long"))])
    if not lengths:
        return whole if every else whole.limit(0)
    # one position more than there are words: the row that stands for the document
    spots = rows.select("doc_id", "t", "w", F.explode_outer(F.sequence(F.lit(0), F.size("w"))).alias("at"))
    h = _hashes(F.col("w"), F.col("at"), size)
    if len(lengths) == 1:
        spots = spots.select("*", F.lit(lengths[0]).alias("of"), h[lengths[0] - 1].alias("p"))
    else:
        probes = F.array(*[F.struct(F.lit(k).alias("of"), h[k - 1].alias("p")) for k in lengths])
        spots = spots.select("*", F.explode_outer(probes).alias("x")).select("doc_id", "t", "w", "at", "x.of", "x.p")
    end = F.col("at") == F.size("w")
    if sum(r.n for r in known) <= BROADCAST_WINDOWS and sum(r.bytes for r in known) <= BROADCAST_BYTES:
        same = (F.col("p") == F.col("h")) & (_window(F.col("w"), F.col("at"), F.col("length")) == F.col("window"))
        found = spots.join(F.broadcast(windows), same, "left" if every else "inner")
        if every:
            found = found.filter(F.col("wid").isNotNull() | (end & (F.col("of") == lengths[0])))
        return found.select("doc_id", "t", F.when(F.col("wid").isNull(), F.size("w")).alias("n"), "at", (F.col("at") + F.col("length")).alias("to"), "wid")
    likely = spots.filter(~end).select("doc_id", "t", "at", "p").join(windows.select("h", "length"), F.col("p") == F.col("h"))
    likely = likely.groupBy("doc_id", "t").agg(F.collect_set(F.struct("at", "length")).alias("spots"))
    likely = written(likely.select(F.col("doc_id").alias("d"), F.col("t").alias("u"), "spots"), "probe-hits")
    again = rows.join(_small(likely), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("t") == F.col("u"))).select("doc_id", "t", "w", F.explode("spots").alias("s"))
    again = again.select("doc_id", "t", "s.at", (F.col("s.at") + F.col("s.length")).alias("to"), "s.length", _window(F.col("w"), F.col("s.at"), F.col("s.length")).alias("window"))
    found = again.join(windows.select("window", "length", "wid"), ["window", "length"]).select("doc_id", "t", F.lit(None).cast("int").alias("n"), "at", "to", "wid")
    return found.unionByName(whole) if every else found


def _runs(spans: Column) -> Column:
    """Sorted spans of which those that overlap or touch are one."""

    def merged(runs: Column, x: Column) -> Column:
        last = F.try_element_at(runs, F.lit(-1))
        longer = F.struct(last["from"].alias("from"), F.greatest(last["to"], x["to"]).alias("to"))
        return F.when(last["to"] >= x["from"], F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(longer))).otherwise(F.concat(runs, F.array(x)))

    return F.aggregate(spans, F.array().cast("array<struct<from:int,to:int>>"), merged)


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, every: bool = False) -> DataFrame:
    """doc_id, t, n_words, copies, runs (start and end of each run of hit words), n_hit, items: distinct documents with hits, or all."""
    windows, items = benchmark_windows(benchmark, size)
    span = F.when(F.col("wid").isNotNull(), F.struct(F.col("at").alias("from"), F.col("to").alias("to")))
    per = _spots(docs, windows, size, every).groupBy("doc_id", "t").agg(F.max("n").alias("n"), F.count("n").alias("copies"), F.collect_set(span).alias("spans"), F.collect_set("wid").alias("wids"))
    of_window = per.select("*", F.explode_outer("wids").alias("wid")).join(_small(items), "wid", "left")
    per = of_window.groupBy("doc_id", "t").agg(F.first("n").alias("n"), F.first("copies").alias("copies"), F.first("spans").alias("spans"), F.collect_set("item_id").alias("items"))
    per = per.withColumn("runs", _runs(F.array_sort("spans")))
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + (r["to"] - r["from"]).cast("long"))
    return per.select("doc_id", "t", F.col("n").cast("long").alias("n_words"), "copies", "runs", n_hit.alias("n_hit"), "items")


def report(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of docs."""
    ids = F.array_sort("items")
    rows = hits(docs, benchmark, size, every=True).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "copies",
    )
    names = [c for c in rows.columns if c != "copies"]
    blocks = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES_AT_ONCE).cast("long"))).alias("from"))
    return blocks.select(*names, F.explode(F.sequence(F.col("from"), F.least(F.col("copies"), F.col("from") + COPIES_AT_ONCE) - 1)).alias("copy")).drop("copy")


def clean(docs: DataFrame, benchmark: DataFrame, action: str = "document", size: int = WINDOW) -> DataFrame:
    """docs without contaminated documents ("document"), or with the hit words cut out of them ("span").

    A cut takes the words of a run and what stands between them; the text around it is untouched.
    """
    if action not in ("document", "span"):
        raise ValueError("action is document or span")
    doc, t, runs, parts, shift = unused(docs, "doc", "t", "runs", "parts", "shift")
    found = written(hits(docs, benchmark, size).select(F.col("doc_id").alias(doc), F.col("t").alias(t), F.col("runs").alias(runs)), "contaminated")
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(t))
    if action == "document":
        return docs.join(_small(found.drop(runs)), same, "left_anti")
    pieces = F.regexp_extract_all("text", F.lit(f"{WORD}|{NOT_WORD}"), F.lit(0))
    joined = docs.join(found, same, "left").withColumns({parts: pieces, shift: F.when(F.col("text").rlike("^" + NOT_WORD), 1).otherwise(0)})

    def stays(_: Column, i: Column) -> Column:
        at = i - F.col(shift)  # words stand at the even places
        inside = lambda r: (at >= 2 * r["from"]) & (at <= 2 * r["to"] - 2)
        return ~F.exists(runs, inside)

    cut = F.array_join(F.filter(parts, stays), "")
    return joined.withColumn("text", F.when(F.col(runs).isNotNull(), cut).otherwise(F.col("text"))).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), l AS (
  SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0
), g AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM l)
), s AS (
  SELECT DISTINCT n FROM g
), p AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, s WHERE len(w) >= n)
), h AS (
  SELECT p.doc_id, p.i, p.n, g.item_id FROM p JOIN g ON p.g = g.g AND p.n = g.n
), x AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY doc_id
), y AS (
  SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM h) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(x.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(y.n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(y.ids, '')) AS items_sha256, coalesce(x.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN x USING (doc_id) LEFT JOIN y USING (doc_id)
"""
