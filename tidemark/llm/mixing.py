"""Mixing sources to target weights by entropy balancing.

The mix is the set of document rates r that is closest, in relative entropy
weighted by document size, to taking each document once, under one token
constraint for each source: sum(r * size) = target.  Its dual is convex, with
one multiplier for each source, and its solution tilts a document exponentially:
r = exp(lambda[source]).  The dual's gradient and its diagonal Hessian are sums
over all documents, sum(size * exp(lambda)) for each source; as lambda is one
number for a source, they need the documents only through its sum of sizes, one
aggregation over the cluster.  Newton's method then runs on all sources at once,
where their rows are; neither sources nor multipliers reach the driver.  The
level of the targets does: two sums over the sources for each source set that
meets its cap.

Rates become whole copies by error diffusion: inside a bucket of at most about
BUCKET_ROWS documents of one source, from the largest document to the smallest,
a document takes the whole number of copies nearest to its due plus what is
still owed, so that the error left is about half of the bucket's smallest
document.  Buckets are dealt by a hash of doc_id, so a source of any size is
spread over the cluster and reruns agree.

Defined results: a null text has size 0; a null source is a source of its own
and comes last; documents without words are kept once and take no part in the
targets; rows with equal doc_id, source and size are taken alike.  An empty
table gives an empty mix.  Extra columns, whatever their names, pass through
mixed() and are ignored by rates().
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import character_class, unused, written

WEIGHTS = (1.0, 2.0, 3.0)
MOST_COPIES = 3
BUCKET_ROWS = 2000
WORD = f"[^{character_class([0x20, *range(0x09, 0x0E)])}]+"
#: Rows of the table of sources that are broadcast.
BROADCAST_SOURCES = 200_000
#: Newton's method ends at this share of the target, after so many steps at most, each of at most so much.
TOLERANCE, MOST_STEPS, LONGEST_STEP = 1e-12, 60, 2.0


def word_count(text: Column) -> Column:
    """Runs of other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _level(measure, total: float) -> float:
    """The level at which targets of level * weight, none above its cap, come to total.

    measure(level) gives how many sources a level fills, what those hold at their
    cap, and the weight of the others.
    """
    _, _, weight = measure(0.0)
    level, before = (total / weight if weight else 0.0), 0
    while True:
        full, held, weight = measure(level)
        if full == before or not weight:
            return level
        level, before = (total - held) / weight, full


def targets_of(sizes: list[float], weights: list[float], cap: float = MOST_COPIES, share: float = 1.0) -> list[float]:
    """Targets in proportion to the weights; none above cap times its size, the excess shared again."""

    def measure(level: float) -> tuple[int, float, float]:
        full = [i for i, s in enumerate(sizes) if s > 0 and level * weights[i] > cap * s]
        return len(full), sum(cap * sizes[i] for i in full), sum(w for i, w in enumerate(weights) if sizes[i] > 0) - sum(weights[i] for i in full)

    level = _level(measure, share * sum(sizes))
    return [min(level * w, cap * s) if s > 0 else 0.0 for s, w in zip(sizes, weights)]


def _numbered(sources: DataFrame) -> DataFrame:
    """sources with number, its place by code point, null last; written."""
    order = [F.col("source").isNull(), F.col("source")]
    rows = sources.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id())
    rows = written(rows, "mix-sources")
    part, inside = F.shiftrightunsigned("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted((r.part, r.n) for r in rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # a row for each partition
    starts, at = [], 0
    for number, n in sizes:
        starts += [F.lit(number), F.lit(at)]
        at += n
    if not starts:
        return rows.withColumn("number", F.col("id")).drop("id")
    return rows.withColumn("number", inside + F.element_at(F.create_map(*starts), part)).drop("id")


def _multiplier(tokens: Column, target: Column) -> Column:
    """Newton's method on the dual of one source: the lambda at which tokens * exp(lambda) is target."""

    def step(now: Column, _: Column) -> Column:
        mass = tokens * F.exp(now)
        gap = target - mass
        move = F.greatest(F.lit(-LONGEST_STEP), F.least(F.lit(LONGEST_STEP), gap / mass))
        return F.when(F.abs(gap) <= TOLERANCE * target, now).otherwise(now + move)

    return F.aggregate(F.sequence(F.lit(1), F.lit(MOST_STEPS)), F.lit(0.0), step)


def balanced(units: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = MOST_COPIES, share: float = 1.0) -> DataFrame:
    """source, tokens, n, target, rate of every source of units (source, size, rows)."""
    per = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("tokens"), F.count("*").alias("n"))
    per = _numbered(per)
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.pmod(F.col("number"), F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight)
    most = cap * F.col("tokens").cast("double")

    def measure(level: float) -> tuple[int, float, float]:
        full = F.lit(level) * F.col("weight") > most
        row = per.filter("tokens > 0").agg(F.count_if(full), F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("weight")))).first()
        return row[0], row[1] or 0.0, row[2] or 0.0

    total = per.agg(F.sum("tokens")).first()[0] or 0
    level = _level(measure, share * total)
    target = F.when(F.col("tokens") > 0, F.least(F.lit(float(level)) * F.col("weight"), most)).otherwise(F.lit(0.0))
    rows = per.withColumn("target", target)
    rate = F.when(F.col("target") > 0, F.least(F.lit(float(cap)), F.exp(_multiplier(F.col("tokens").cast("double"), F.col("target"))))).otherwise(F.lit(0.0))
    return rows.select("source", "tokens", "n", "target", rate.alias("rate"))


def _diffused(group: pd.DataFrame) -> pd.DataFrame:
    """Copies of the documents of one bucket, largest first."""
    group = group.sort_values(["size", "doc_id"], ascending=[False, True], kind="stable")
    masses = (group["size"] * group["rows"]).astype(float)
    owed, copies = 0.0, []
    left, rest = float((masses * group["rate"]).sum()), float(masses.sum())  # tokens still to take, and tokens that can give them
    for mass, rate in zip(masses, group["rate"]):
        if mass <= 0:
            copies.append(1)
            continue
        rest -= mass
        due = rate * mass + owed
        take = min(MOST_COPIES, max(0, math.floor(due / mass + 0.5)))
        while take > 0 and left < take * mass and left - (take - 1) * mass <= MOST_COPIES * rest:
            take -= 1  # what is taken too much can't be given back, what lacks the smaller ones can give
        while take < MOST_COPIES and left - take * mass > MOST_COPIES * rest + mass / 2:
            take += 1
        owed, left = due - take * mass, left - take * mass
        copies.append(take)
    return group.assign(copies=copies)[["doc_id", "source", "size", "copies", "rate", "source_size", "target"]]


def rates(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """doc_id, source, size, copies, rate, source_size, target: one row for each distinct (doc_id, source, size)."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    units = written(narrow.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")), "mix-sizes")
    known = balanced(units, weights).select(
        F.col("source").alias("of"), F.col("tokens").cast("long").alias("source_size"), "target", "rate", F.greatest(F.lit(1), F.ceil(F.col("n") / BUCKET_ROWS)).cast("long").alias("buckets")
    )
    known = written(known, "mix-rates")
    few = known.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    dealt = units.join(F.broadcast(known) if few else known, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.col("buckets"))).drop("buckets")
    return dealt.groupBy("source", "bucket").applyInPandas(lambda g: _diffused(g), "doc_id long, source string, size long, copies int, rate double, source_size long, target double")


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of docs."""
    d, s, n, copies, copy = unused(docs, "doc", "source", "size", "copies", "copy")
    plan = written(rates(docs, weights), "mix-plan").filter("copies > 0")
    plan = plan.select(F.col("doc_id").alias(d), F.col("source").alias(s), F.col("size").alias(n), F.col("copies").alias(copies))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & F.col("source").cast("string").eqNullSafe(F.col(s)) & (word_count(F.col("text")) == F.col(n))
    # dealt by their keys at every size alike: the plan grows with the documents and is never broadcast
    rows = docs.join(plan.hint("merge"), same).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    plan = rates(docs).select(F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("size").alias("n"), "source_size", "target", "rate", "copies")
    out = rows.join(plan.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("n")))
    taken = F.when(F.col("size") > 0, F.col("copies") * F.col("size")).otherwise(F.lit(0)).cast("long")
    return out.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "source", "rate", "copies")
