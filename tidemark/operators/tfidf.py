"""TF-IDF in DataFrame form: 1 + ln(tf) times ln((1 + n) / (1 + df)) + 1, at unit length.

Terms are counted where a document is, in arrays: no row of a document and term
is shuffled.  A vocabulary that max_features bounds goes to the documents by
broadcast.  Any other meets them in groups of documents, once for each term and
group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import CLASSIFIER_TOKEN, grams, tokens, without

#: Vocabularies of at most so many terms are broadcast.
BROADCAST_TERMS = 200_000
#: Bytes of text of a group on average, and terms that a task counts before it passes them on.
GROUP_BYTES, HELD_TERMS = 1 << 24, 1 << 20
#: Terms are summed up by so many numbers, and those of the greatest sums are counted one by one first.
NUMBERS, FIRST_NUMBERS = 1 << 18, 4096


def term_counts(docs: DataFrame, id_col: str, text_col: str, pattern: str = CLASSIFIER_TOKEN, ngram_max: int = 2, stop: list[str] | None = None) -> DataFrame:
    """doc_id, term, tf. Stop words go before n-grams are formed."""
    words = without(tokens(F.col(text_col), pattern), stop or [])
    return docs.select(F.col(id_col).alias("doc_id"), words.alias("w")).select("doc_id", F.explode(grams(F.col("w"), ngram_max)).alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("tf"))


def vocabulary(counts: DataFrame, documents: Column | int, min_df: int = 1, max_df: float = 1.0, max_features: int | None = None) -> DataFrame:
    """term, df, idf of the terms that pass; of too many, the ones of greatest count, ties by term."""
    return _limited(counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total")), documents, min_df, max_df, max_features)


def _passing(n: Column, min_df: int, max_df: float) -> Column:
    return (F.col("df") >= min_df) & (F.col("df") <= n * F.lit(float(max_df)))


def _idf(n: Column) -> Column:
    return F.log((1 + n) / (1 + F.col("df"))) + 1


def _limited(terms: DataFrame, documents: Column | int, min_df: int = 1, max_df: float = 1.0, max_features: int | None = None) -> DataFrame:
    n = documents if isinstance(documents, Column) else F.lit(documents)
    terms = terms.filter(_passing(n, min_df, max_df))
    if max_features is not None:
        terms = terms.orderBy(F.desc("total"), "term").limit(max_features)
    return terms.select("term", "df", _idf(n).alias("idf"))


def weights(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """doc_id, term, weight; a document without known terms has no rows (the zero vector)."""
    raw = counts.join(terms.select("term", "idf"), "term").select("doc_id", "term", ((1 + F.log(F.col("tf").cast("double"))) * F.col("idf")).alias("w"))
    size = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return raw.select("doc_id", "term", (F.col("w") / size).alias("weight"))


def _coded(words: pa.Array, most: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms of lists of words (n-grams up to most), and for each occurrence its row and term."""
    words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
    sizes = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = words.flatten().dictionary_encode()
    names, code = flat.dictionary, flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    rows, codes, run, text, n_terms = [row], [code], code, names, len(names)
    parts = [names]
    for n in range(2, most + 1):  # a run of n words: the run before its last word, and that word
        here = np.flatnonzero(row[: max(0, len(row) - n + 1)] == row[n - 1 :])
        pairs, back = np.unique(run[here] * max(1, len(names)) + code[here + n - 1], return_inverse=True)
        text = pc.binary_join_element_wise(text.take(pa.array(pairs // max(1, len(names)))), names.take(pa.array(pairs % max(1, len(names)))), " ")
        run = np.zeros(len(row), np.int64)
        run[here] = back
        rows.append(row[here])
        codes.append(back + n_terms)
        parts.append(text)
        n_terms += len(pairs)
    terms, row, code = pa.concat_arrays(parts), np.concatenate(rows), np.concatenate(codes)
    if most > 1:  # a token may hold a space and equal a run
        again = terms.dictionary_encode()
        terms, code = again.dictionary, again.indices.to_numpy(zero_copy_only=False).astype(np.int64)[code]
    return terms, row, code


def _counted(words: pa.Array, most: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms, and row, term and count of each pair of both."""
    terms, row, code = _coded(words, most)
    pairs, tf = np.unique(row * max(1, len(terms)) + code, return_counts=True)
    return terms, pairs // max(1, len(terms)), pairs % max(1, len(terms)), tf


def _totals(words: pa.Array, most: int) -> pa.Table:
    """term, df, total over the rows."""
    terms, _, code, tf = _counted(words, most)
    df = np.bincount(code, minlength=len(terms))
    return pa.table({"term": terms, "df": df, "total": np.bincount(code, weights=tf, minlength=len(terms)).astype(np.int64)})


def _weighed(ids: pa.Array, words: pa.Array, most: int, known: pa.Array, idf: np.ndarray) -> pa.RecordBatch:
    """doc_id, term, weight of the known terms."""
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    terms, row, code, tf = _counted(words, most)
    place = pc.index_in(terms, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
    held = place[code] >= 0
    row, code, tf = row[held], code[held], tf[held]
    w = (1.0 + np.log(tf.astype(np.float64))) * idf[place[code]]
    size = np.sqrt(np.bincount(row, weights=w * w, minlength=len(ids)))
    return pa.RecordBatch.from_arrays([ids.take(pa.array(row)), terms.take(pa.array(code)), pa.array(w / size[row])], ["doc_id", "term", "weight"])


class Corpus:
    """Documents by id, whose terms are counted without a shuffle of them; rows of one id are one document.

    Without an id column every row is one; that serves vocabulary alone.
    """

    def __init__(self, docs: DataFrame, id_col: str | None, text_col: str, pattern: str = CLASSIFIER_TOKEN, ngram_max: int = 2, stop: list[str] | None = None) -> None:
        rows = docs.select((F.lit(0) if id_col is None else F.col(id_col)).alias("doc_id"), F.col(text_col).alias("text"))
        said = rows.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("size")).first()
        self.rows, self.groups, self.most = said.rows, max(1, -(-(said.size or 0) // GROUP_BYTES)), ngram_max
        self.kind = rows.schema["doc_id"].dataType.simpleString()
        self._words = lambda c: without(tokens(c, pattern), stop or [])
        self.repeats = id_col is not None and not rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
        if self.repeats:  # n-grams end with their row
            rows = rows.groupBy("doc_id").agg(F.collect_list(F.coalesce("text", F.lit(""))).alias("text"))
            own, self.most, split = self._words, 1, ngram_max
            self._words = lambda c: F.flatten(F.transform(F.transform(c, own), lambda w: grams(w, split)))
        self.docs = rows

    def _lists(self) -> DataFrame:
        return self.docs.select("doc_id", self._words(F.col("text")).alias("w"))

    def _partial(self) -> DataFrame:
        """term, df, total of parts of the documents."""
        most = self.most

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n = [], 0
            for batch in batches:
                held.append(_totals(batch.column(0), most))
                n += held[-1].num_rows
                if n >= HELD_TERMS:
                    yield from _summed(held).to_batches()
                    held, n = [], 0
            if held:
                yield from _summed(held).to_batches()

        return self._lists().select("w").mapInArrow(counted, "term string, df long, total long")

    def vocabulary(self, min_df: int = 1, max_df: float = 1.0, max_features: int | None = None) -> DataFrame:
        """term, df, idf of the terms that pass; of too many, the ones of greatest count, ties by term."""
        part = self._partial()
        if max_features is None or max_features > FIRST_NUMBERS // 4 or self.most == 1:
            return _limited(part.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total")), self.rows, min_df, max_df, max_features)
        return self._leading(part, min_df, max_df, max_features)

    def _leading(self, part: DataFrame, min_df: int, max_df: float, most: int) -> DataFrame:
        """The most frequent terms, from those whose numbers have the greatest sums.

        No other term occurs more often than the greatest sum that is left out; the
        answer stands when its last term occurs more often than that.
        """
        spark = part.sparkSession
        number = F.pmod(F.xxhash64("term"), F.lit(NUMBERS)).cast("int")
        sums = part.groupBy(number.alias("number")).agg(F.sum("total").alias("total")).toArrow()  # at most NUMBERS rows
        order = np.argsort(-sums["total"].to_numpy(), kind="stable")
        numbers, total = sums["number"].to_numpy()[order], sums["total"].to_numpy()[order]
        n = FIRST_NUMBERS
        while True:
            chosen = spark.createDataFrame(pa.table({"number": pa.array(numbers[:n], pa.int32())}))
            terms = part.withColumn("number", number).join(F.broadcast(chosen), "number", "left_semi")
            terms = terms.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total")).filter(_passing(F.lit(self.rows), min_df, max_df))
            got = terms.orderBy(F.desc("total"), "term").limit(most).toArrow()  # at most FIRST_NUMBERS / 4 rows
            if n >= len(numbers) or (got.num_rows == most and got["total"][-1].as_py() > total[n]):
                break
            n *= 8
        found = spark.createDataFrame(got) if got.num_rows else spark.createDataFrame([], "term string, df long, total long")
        return found.select("term", "df", _idf(F.lit(self.rows)).alias("idf"))

    def weights(self, min_df: int = 1, max_df: float = 1.0, max_features: int | None = None) -> DataFrame:
        """doc_id, term, weight; a document without known terms has no rows (the zero vector)."""
        if max_features is not None and max_features <= BROADCAST_TERMS:
            return self._by_broadcast(self.vocabulary(min_df, max_df, max_features))
        return self._by_groups(min_df, max_df) if max_features is None else weights(self._pairs(), self.vocabulary(min_df, max_df, max_features))

    def _pairs(self) -> DataFrame:
        most, schema = self.most, f"doc_id {self.kind}, term string, tf long"

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                terms, row, code, tf = _counted(batch.column(1), most)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), terms.take(pa.array(code)), pa.array(tf)], ["doc_id", "term", "tf"])

        return self._lists().mapInArrow(counted, schema)

    def _by_broadcast(self, terms: DataFrame) -> DataFrame:
        most, table = self.most, terms.select("term", "idf").toArrow()
        held = self.docs.sparkSession.sparkContext.broadcast((table["term"].combine_chunks(), table["idf"].to_numpy()))

        def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, idf = held.value
            for batch in batches:
                yield _weighed(batch.column(0), batch.column(1), most, known, idf)

        return self._lists().mapInArrow(weighed, f"doc_id {self.kind}, term string, weight double")

    def _by_groups(self, min_df: int, max_df: float) -> DataFrame:
        """Groups of documents name their terms once each, and get back the idf of those that pass."""
        most, n = self.most, F.lit(self.rows)
        dealt = self.docs.withColumn("g", F.pmod(F.xxhash64("doc_id"), F.lit(self.groups)).cast("int")).repartition("g")
        lists = dealt.select("g", "doc_id", self._words(F.col("text")).alias("w"))

        def named(key: tuple, group: pa.Table) -> pa.Table:
            terms = _totals(group["w"], most)
            return pa.table({"g": pa.repeat(key[0], terms.num_rows), "term": terms["term"], "df": terms["df"]})

        def weighed(key: tuple, group: pa.Table, known: pa.Table) -> pa.Table:
            return pa.Table.from_batches([_weighed(group["doc_id"], group["w"], most, known["term"].combine_chunks(), known["idf"].to_numpy())])

        parts = lists.groupBy("g").applyInArrow(named, "g int, term string, df long")
        parts = parts.withColumn("df", F.sum("df").over(Window.partitionBy("term"))).filter(_passing(n, min_df, max_df)).select("g", "term", _idf(n).alias("idf"))
        return lists.groupBy("g").cogroup(parts.groupBy("g")).applyInArrow(weighed, f"doc_id {self.kind}, term string, weight double")


def _summed(parts: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables(parts).group_by("term").aggregate([("df", "sum"), ("total", "sum")])
    return whole.select(["term", "df_sum", "total_sum"]).rename_columns(["term", "df", "total"])
