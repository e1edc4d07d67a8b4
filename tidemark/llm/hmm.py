"""Hidden Markov language model, trained by Baum-Welch over the cluster.

A token's probability in a state is E[state, class] * q(token | class).  The
OWN most frequent tokens and the text's end are classes by themselves; any other
token's class is read off its last two bytes, and q shares the class out by
(count + 1).  Classes bound the size of the model whatever the vocabulary;
counts of all training tokens stay in a table of the cluster.

1. Token counts over all training documents: sums per task, then a shuffle.
2. Tokens counted so often that at most KNOWN of them are, are broadcast; the
   counts of the rarer tokens of a document come from a join.
3. Baum-Welch.  States start as seeded noise around the class counts of all
   training documents.  Every round runs over all of them: a task turns its
   documents into expected counts and their log-likelihood, which are summed
   across partitions.  Rounds end when one gains less than SETTLED of the
   summed log-likelihood.  Training cuts documents into segments of SEGMENT
   tokens; a segment that continues a document starts from the states' shares.
4. Scoring: the scaled forward recursion over each whole text, without cuts,
   in double precision: the exact log10 probability that the model gives it.

Defined results: a null or empty text is its end alone; a row without doc_id
counts as training text; repeated rows count each; without training documents
all classes are alike.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WHITE_SPACE, encoded, groups_of, word_hashes, word_table, written

HELD_OUT_OF, HELD_OUT = 7, 2
STATES, OWN = 12, 3071
END, RARE = OWN, OWN + 1
CLASSES = RARE + 1024
PARAMETERS = STATES * (2 + STATES + CLASSES)
KNOWN = 1 << 21
SEGMENT = 64
#: Baum-Welch ends with the first round that gains less than this share of the log-likelihood.
SETTLED = 1e-4
#: Segments of one step: rows of this length stay in the cache and below what BLAS would share out to threads.
SEGMENTS_AT_ONCE = 2048
BATCH_BYTES = 1 << 20
#: Distinct tokens that a task holds before it passes its counts on.
FLUSH = 1 << 21
SMOOTH = 0.05

_IS_WORD = word_table(WHITE_SPACE)


def _letter_codes() -> np.ndarray:
    """Of each byte, one of 32: letters, digits, other ASCII, and three for non-ASCII bytes."""
    code = np.full(256, 28, np.uint16)
    code[0] = 0
    code[97:123] = np.arange(1, 27)
    code[48:58] = 27
    code[128:] = 29 + np.arange(128) % 3
    return code


_CODE = _letter_codes()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == HELD_OUT, F.lit(False))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and rare classes of all tokens but ends, and where each text's tokens begin."""
    endings: list[np.ndarray] = []
    h, at = word_hashes(texts, _IS_WORD, endings)
    last = np.concatenate(endings) if endings else np.zeros((0, 2), np.uint8)
    return h, (_CODE[last[:, 1]] * 32 + _CODE[last[:, 0]]).astype(np.uint16), at


def _summed(h: np.ndarray, cls: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(h)
    h, cls, n = h[order], cls[order], n[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    return h[first], cls[first], np.add.reduceat(n, first) if len(h) else n


def token_counts(docs: DataFrame) -> DataFrame:
    """h, cls, c of every distinct token of docs (text), ends apart."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        fresh: list[tuple] = []
        size = 0

        def merged() -> tuple:
            parts = ([held] if held else []) + fresh
            return _summed(*(np.concatenate(x) for x in zip(*parts)))

        def out(x: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x[0].view(np.int64)), pa.array(x[1].astype(np.int32)), pa.array(x[2])], ["h", "cls", "c"])

        for batch in batches:
            for a, b in groups_of(pc.binary_length(batch.column(0)).fill_null(0).to_pylist(), BATCH_BYTES):
                h, cls, _ = tokens(encoded(batch.column(0).slice(a, b - a).to_pylist()))
                fresh.append(_summed(h, cls, np.ones(len(h), np.int64)))
                size += len(fresh[-1][0])
                if size >= FLUSH:
                    held, fresh, size = merged(), [], 0
                    if len(held[0]) >= FLUSH:
                        yield out(held)
                        held = None
        if held or fresh:
            yield out(merged())

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "h long, cls int, c long")
    return found.groupBy("h").agg(F.min("cls").alias("cls"), F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Counts of the frequent tokens and what the rest needs."""

    h: np.ndarray  # sorted hashes of the known tokens
    c: np.ndarray  # their counts
    cls: np.ndarray  # their classes, own or rare
    complete: bool  # whether all counted tokens are known
    total: int  # training tokens, ends included
    distinct: int
    ends: int
    rare_mass: np.ndarray  # for each rare class, counts plus distinct tokens plus one

    def __post_init__(self) -> None:
        self.bits = 22
        self.slot = np.full(1 << self.bits, -1, np.int32)
        self.slot[(self.h >> np.uint64(64 - self.bits)).astype(np.int64)[::-1]] = np.arange(len(self.h), dtype=np.int32)[::-1]

    def place(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash among the known, or -1."""
        if not len(self.h):
            return np.full(len(h), -1, np.int64)
        at = self.slot[(h >> np.uint64(64 - self.bits)).astype(np.int64)].astype(np.int64)
        other = np.flatnonzero((at >= 0) & (self.h[at] != h))
        if len(other):
            at[other] += 1  # sorted: those that share a slot follow one another
            for _ in range(64):
                inside = at[other] < len(self.h)
                at[other[~inside]] = -1
                other = other[inside]
                miss = self.h[at[other]] != h[other]
                beyond = miss & ((self.h[at[other]] >> np.uint64(64 - self.bits)) != (h[other] >> np.uint64(64 - self.bits)))
                at[other[beyond]] = -1
                other = other[miss & ~beyond]
                if not len(other):
                    break
                at[other] += 1
            else:
                exact = np.searchsorted(self.h, h[other])
                exact = np.minimum(exact, len(self.h) - 1)
                at[other] = np.where(self.h[exact] == h[other], exact, -1)
        return at


def vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    """From a written table of token_counts()."""
    bars = [F.count_if(F.col("c") >= 2**k).alias(f"n{k}") for k in range(62)]
    row = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total"), F.count("*").alias("distinct"), *bars).first()
    bar = 2 ** next(k for k in range(62) if row[f"n{k}"] <= KNOWN)
    top = counts.filter(F.col("c") >= bar).toArrow()
    h, cls, c = top["h"].to_numpy().view(np.uint64), top["cls"].to_numpy(), top["c"].to_numpy()
    order = np.argsort(h)
    h, cls, c = h[order], cls[order], c[order]
    own = np.argsort(-c, kind="stable")[:OWN]
    mass = np.ones(CLASSES - RARE, np.float64)
    for r in counts.groupBy("cls").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():  # at most 1024 rows
        mass[r.cls] += r.c + r.n
    np.subtract.at(mass, cls[own], c[own] + 1)
    named = cls.astype(np.int64) + RARE
    named[own] = np.arange(len(own))
    return Vocabulary(h, c, named.astype(np.uint16), bar == 1, int(row.total) + ends, int(row.distinct) + (ends > 0), ends, mass)


def classified(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """uid, doc_id, held_out, n_tokens, n_known, base (log10 sums), inner (log10 q sums), rest (hashes to look up), classes of every row."""
    held = docs.sparkSession.sparkContext.broadcast(vocab)

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = held.value
        uid = TaskContext.get().partitionId() << 40
        floor = np.log10(v.total + v.distinct + 1)
        mass = np.log10(np.maximum(v.rare_mass, 1))
        for batch in batches:
            for a, b in groups_of(pc.binary_length(batch.column(2)).fill_null(0).to_pylist(), BATCH_BYTES):
                part = batch.slice(a, b - a)
                h, rare, at = tokens(encoded(part.column(2).to_pylist()))
                place = v.place(h)
                known = place >= 0
                safe = np.maximum(place, 0)
                cls = np.where(known, v.cls[safe], rare + RARE).astype(np.uint16) if len(v.h) else (rare + RARE).astype(np.uint16)
                seen = np.where(known, np.log10((v.c[safe] if len(v.h) else safe) + 1.0), 0.0)
                inner = np.where(cls >= RARE, seen - mass[np.maximum(cls.astype(np.int64) - RARE, 0)], 0.0)
                rest = np.zeros(len(h), bool) if v.complete else ~known
                sums = [np.append(0, np.cumsum(x)) for x in (seen, inner, known, rest)]
                base, inside, n_known, n_rest = (s[at[1:]] - s[at[:-1]] for s in sums)
                n = np.diff(at) + 1
                ids = uid + np.arange(len(n))
                uid += len(n)
                stream = np.insert(cls, at[1:], END)
                cut = np.append(0, np.cumsum(n))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids),
                        part.column(0),
                        part.column(1),
                        pa.array(n),
                        pa.array(n_known.astype(np.int64) + (v.ends > 0)),
                        pa.array(base + np.log10(v.ends + 1.0) - n * floor),
                        pa.array(inside),
                        pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_rest)), pa.int32()), pa.array(h[rest].view(np.int64))),
                        pa.array([stream[x:y].tobytes() for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())], pa.binary()),
                    ],
                    ["uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "inner", "rest", "classes"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(classify, "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, inner double, rest array<long>, classes binary")


@dataclass
class Hmm:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # states x classes
    share: np.ndarray  # states: how often each is met

    @staticmethod
    def fresh(weights: np.ndarray, seed: int = 6) -> "Hmm":
        """Every state near the given class weights, told apart by seeded noise."""
        rng = np.random.default_rng(seed)
        emit = (weights + SMOOTH) * np.exp(rng.normal(0, 0.5, (STATES, CLASSES)))
        even = np.full(STATES, 1 / STATES)
        return Hmm(even, 0.6 * np.eye(STATES) + 0.4 / STATES, emit / emit.sum(1, keepdims=True), even)

    @staticmethod
    def from_counts(n: np.ndarray, prior: np.ndarray) -> "Hmm":
        """Re-estimated from the expected counts, laid out as in expected()."""
        start, share, move, emit = _parts(n)
        weights = prior / prior.sum()
        emit = emit + SMOOTH * CLASSES * weights + 1e-3
        start, share, move = start + 0.1, share + 0.1, move + 0.1
        return Hmm(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True), share / share.sum())

    def expected(self, segments: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of padded segments (longest first): expected starts, shares, moves and emissions, and the log-likelihood, in one array.

        States stand in rows and segments in columns, so that a step is a few operations on long rows.
        """
        n, width = segments.shape
        out = np.zeros(PARAMETERS + 1)
        start, share, move, emit = _parts(out)
        by_state, a = self.emit.astype(np.float32), self.move.astype(np.float32)
        back = np.ascontiguousarray(a.T)
        alive = np.searchsorted(-lengths, -np.arange(width + 1), "left").tolist()  # segments longer than t
        classes = np.ascontiguousarray(segments.T).astype(np.intp)
        alpha = np.zeros((width, STATES, n), np.float32)
        seen = np.empty((width, STATES, n), np.float32)  # emissions over the scales
        scale = np.ones((width, n), np.float32)  # one over what the forward sums come to
        for t in range(width):
            k = alive[t]
            x, e, c = alpha[t, :, :k], seen[t, :, :k], scale[t, :k]
            np.take(by_state, classes[t, :k], axis=1, out=e, mode="clip")
            if t:
                np.matmul(back, alpha[t - 1, :, :k], out=x)
            else:
                x[:] = np.where(first[:k], self.start[:, None], self.share[:, None])
            x *= e
            np.add.reduce(x, axis=0, out=c)
            np.reciprocal(np.maximum(c, 1e-30, out=c), out=c)
            x *= c
            e *= c
        beta = np.ones((STATES, n), np.float32)
        pairs = np.zeros((STATES, STATES))
        for t in range(width - 1, -1, -1):
            if k := alive[t + 1]:
                y = seen[t + 1, :, :k]
                y *= beta[:, :k]
                pairs += alpha[t, :, :k] @ y.T
                np.matmul(a, y, out=beta[:, :k])
            alpha[t, :, : alive[t]] *= beta[:, : alive[t]]  # now the states' probabilities given the segment
        move += self.move * pairs
        out[PARAMETERS] = -np.log(scale, dtype=np.float64).sum()
        start += alpha[0][:, first].sum(1)
        flat = classes.ravel()  # padded places have no weight
        for s in range(STATES):
            emit[s] += np.bincount(flat, weights=alpha[:, s].ravel(), minlength=CLASSES)
        share += emit.sum(1)
        return out

    def log10_forward(self, texts: list[np.ndarray]) -> np.ndarray:
        """Exact log10 likelihood of each whole class sequence by the scaled forward recursion."""
        sizes = np.array([len(x) for x in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        flat = np.concatenate([texts[i] for i in order]) if len(texts) else np.zeros(0, np.uint16)
        sizes = sizes[order]
        begin = np.cumsum(sizes) - sizes
        total, back = np.zeros(len(texts)), np.ascontiguousarray(self.move.T)
        ahead = np.repeat(self.start[:, None], len(texts), 1)
        m = len(texts)
        product, held = np.ones(len(texts)), 0
        for t in range(int(sizes[0]) if m else 0):
            while m and sizes[m - 1] <= t:
                m -= 1
            x = np.take(self.emit, flat[begin[:m] + t], axis=1)
            x *= ahead[:, :m]
            s = x.sum(0)
            product[:m] *= s
            held += 1
            if held == 16 or s.min() < 1e-12:  # logs of products of a few scales at once
                total += np.log10(product)
                product[:], held = 1.0, 0
            x /= s
            ahead = back @ x
        total += np.log10(product)
        out = np.zeros(len(texts))
        out[order] = total
        return out


def _parts(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Views of the counts: starts, shares, moves, emissions."""
    s = STATES
    return n[:s], n[s : 2 * s], n[2 * s : 2 * s + s * s].reshape(s, s), n[2 * s + s * s : PARAMETERS].reshape(s, CLASSES)


def segments_of(texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Padded segments of class sequences, longest first, with lengths and whether each begins a text."""
    sizes = np.array([len(x) for x in texts], np.int64)
    flat = np.concatenate(texts) if len(texts) else np.zeros(0, np.uint16)
    per = -(-sizes // SEGMENT)
    first = np.cumsum(per) - per
    number = np.arange(int(per.sum())) - np.repeat(first, per)
    begin = np.repeat(np.cumsum(sizes) - sizes, per) + number * SEGMENT
    lengths = np.minimum(SEGMENT, np.repeat(sizes, per) - number * SEGMENT)
    order = np.argsort(-lengths, kind="stable")
    padded = np.append(flat, np.zeros(SEGMENT, np.uint16))
    for i in range(0, len(order), SEGMENTS_AT_ONCE):
        o = order[i : i + SEGMENTS_AT_ONCE]
        yield padded[begin[o][:, None] + np.arange(int(lengths[o[0]]))], lengths[o], number[o] == 0


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint16) for x in column.to_pylist()]


def class_counts(own: DataFrame) -> np.ndarray:
    """How often each class occurs in column classes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES, np.int64)
        for batch in batches:
            for x in _sequences(batch.column(0)):
                total += np.bincount(x, minlength=CLASSES)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["at", "n"])

    return _totals(own.select("classes").mapInArrow(count, "at int, n long"), CLASSES)


def _totals(parts: DataFrame, size: int) -> np.ndarray:
    """Sums of n by at, of which there are size."""
    sums = parts.groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size)
    out[sums["at"].to_numpy()] = sums["n"].to_numpy()
    return out


def train(rows: DataFrame) -> Hmm:
    """Baum-Welch over the written rows of classified() that are not held out."""
    own = rows.filter(~F.col("held_out")).select("classes")
    prior = class_counts(own)
    if not prior.any():
        return Hmm.fresh(np.ones(CLASSES))
    prior += 1e-2
    model, last = Hmm.fresh(prior / prior.sum() * CLASSES), -np.inf
    while True:
        held = rows.sparkSession.sparkContext.broadcast(model)

        def gather(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            total = np.zeros(PARAMETERS + 1)
            for batch in batches:
                for a, b in groups_of(pc.binary_length(batch.column(0)).to_pylist(), 2 * BATCH_BYTES):
                    for s in segments_of(_sequences(batch.column(0).slice(a, b - a))):
                        total += held.value.expected(*s)
            at = np.flatnonzero(total)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["at", "n"])

        counts = _totals(own.mapInArrow(gather, "at int, n double"), PARAMETERS + 1)  # a row for each parameter
        held.unpersist()
        likelihood = counts[PARAMETERS]
        model = Hmm.from_counts(counts, prior)
        if likelihood - last < SETTLED * abs(likelihood):
            return model
        last = likelihood


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of docs."""
    spark = docs.sparkSession
    training = docs.filter(~held_out(F.col("doc_id").cast("long")))
    ends = training.count()
    counts = written(token_counts(training), "token-counts")
    vocab = vocabulary(counts, ends)
    rows = written(classified(docs, vocab), "token-classes")
    held = spark.sparkContext.broadcast(train(rows))

    flat = rows.select("uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "inner", "classes")
    names = ["uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "inner"]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in groups_of(pc.binary_length(batch.column(7)).to_pylist(), 8 * BATCH_BYTES):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns[:7], pa.array(held.value.log10_forward(_sequences(part.column(7))))], [*names, "outer"])

    done = flat.mapInArrow(finish, "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, inner double, outer double")
    if vocab.complete:
        done = done.withColumns({"more": F.lit(0.0), "found": F.lit(0).cast("long")})
    else:
        rest = rows.select("uid", F.explode("rest").alias("h")).join(counts.select("h", "c"), "h")
        rest = rest.groupBy("uid").agg(F.sum(F.log10(F.col("c") + 1.0)).alias("more"), F.count("*").alias("found"))
        done = done.join(rest, "uid", "left").withColumns({"more": F.coalesce("more", F.lit(0.0)), "found": F.coalesce("found", F.lit(0).cast("long"))})
    return done.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.col("found")).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("more")).alias("base_score"),
        (F.col("outer") + F.col("inner") + F.col("more")).alias("score"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
