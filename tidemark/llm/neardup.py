"""MinHash near-duplicates by an LSH forest, confirmed on full shingle sets.

1. Every text becomes its set of distinct word shingles and a MinHash signature.
   Equal sets collapse to one representative before anything else is compared.
2. The forest is TREES sorted orders of the representatives, each by its own
   DEPTH hash values.  Neighbours in an order with a common prefix of at least
   LEAST_DEPTH values form a region; all of a region of up to BLOCK_DOCS
   documents are candidates of one another.  A larger region is first cut along
   the order into overlapping blocks, so that blocks hold the longest common
   prefixes; step 6 tests the pairs that the cuts part.
3. Inside a block, documents whose signatures agree on at least LEAST_AGREEMENT
   are joined into candidate groups; a group found by several orders counts once.
4. A task reads the whole texts of a group and computes all intersections of
   its full sets, under two independent hashes of the words: a link has to hold
   under both.  Of the links found it emits a spanning forest.
5. Components of the links come from alternating large-star and small-star
   steps over the cluster.
6. A region that was cut and whose documents are not all in one component is
   dealt into chunks, and every two chunks meet in a block of their own: all of
   its pairs across components are tested.  Its largest component is not held
   against itself.

Copies are never expanded into pairs, a task holds one block at a time, and the
driver holds counts alone.  A link between two texts can be missed only if they
share LEAST_DEPTH leading values in none of the orders (7e-5 at similarity
0.85, less above), or if their signatures agree on less than LEAST_AGREEMENT.
Step 6 copies a document once for each chunk that it has to meet: work and
shuffle grow with the square of such a region's documents outside its largest
component.

Defined results: a null or empty text, or one without words, has an empty set
and is linked with nothing; a text of fewer words than a shingle is one
shingle; rows of one doc_id are one document; a row without doc_id is kept and
has no component.  Extra columns, whatever their names, pass through
deduplicated() and are ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WHITE_SPACE, encoded, groups_of, mixed, unused, word_hashes, word_table, written

SHINGLE = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 85
TREES, DEPTH, LEAST_DEPTH = 10, 12, 3
HASHES = TREES * DEPTH
LEAST_AGREEMENT = 0.68
#: Documents and shingles of a block, and the rows that consecutive blocks of one region share in the first pass.
BLOCK_DOCS, BLOCK_SHINGLES, OVERLAP = 1024, 1 << 21, 64
BATCH_BYTES = 1 << 20
#: Rows that are broadcast to a scan of the texts: one or two numbers each.
BROADCAST_ROWS = 500_000

_IS_WORD = word_table(WHITE_SPACE)
_SEED = np.random.default_rng(85)
_XOR = _SEED.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_FACTOR = _SEED.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_POSITION = _SEED.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: list[bytes], seed: int = 0) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each lower-cased text."""
    words, at = word_hashes(texts, _IS_WORD, seed=seed)
    n = max(0, len(words) - SHINGLE + 1)
    with np.errstate(over="ignore"):
        rolled = np.zeros(n, np.uint64)
        for k in range(SHINGLE):
            rolled += words[k : k + n] * _POSITION[k]
        rolled = mixed(rolled)
        out = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= SHINGLE:
                own = np.sort(rolled[a : b - SHINGLE + 1])
                out.append(own[np.append(True, own[1:] != own[:-1])])
            elif b > a:
                short = mixed(np.array([(words[a:b] * _POSITION[: b - a]).sum() + np.uint64(b - a)], np.uint64))
                out.append(short)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """HASHES values of 16 bits; two sets agree on a value as often as they are similar."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(low, ((x[i : i + 2048, None] ^ _XOR) * _FACTOR).min(0), out=low)
    low ^= low >> np.uint32(16)
    low *= np.uint32(0x85EBCA6B)
    low ^= low >> np.uint32(13)
    low *= np.uint32(0xC2B2AE35)
    return (low >> np.uint32(16)).astype(np.uint16)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n (set size), k1 and k2 (which name the set), sig (big-endian bytes) for every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).fill_null(0).to_pylist()
            for a, b in groups_of(sizes, BATCH_BYTES):
                part = batch.slice(a, b - a)
                sets = shingle_sets(encoded(part.column(1).to_pylist()))
                with np.errstate(over="ignore"):
                    k1 = np.array([s.sum() for s in sets], np.uint64).view(np.int64)
                    k2 = np.array([mixed(s + np.uint64(1)).sum() for s in sets], np.uint64).view(np.int64)
                sig = [signature(s).astype(">u2").tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(k1), pa.array(k2), pa.array(sig, pa.binary())], ["doc_id", "n", "k1", "k2", "sig"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(sign, "doc_id long, n long, k1 long, k2 long, sig binary")


def _nibbles(sig: pa.Array, rows: int) -> np.ndarray:
    """The low four bits of every value of every signature."""
    return (np.frombuffer(b"".join(sig.to_pylist()), ">u2").reshape(rows, HASHES) & 15).astype(np.uint8)


def _candidate_groups(ids: np.ndarray, sketch: np.ndarray, apart: np.ndarray | None = None) -> list[np.ndarray]:
    """Ids of the groups that estimated similarity joins, of two documents and more.

    With apart, two columns for each document, only pairs that differ in both join.
    """
    m = len(ids)
    need = HASHES * (LEAST_AGREEMENT + (1 - LEAST_AGREEMENT) / 16)
    if m == 2 and apart is None:
        return [ids] if (sketch[0] == sketch[1]).sum() >= need else []
    label = np.full(m, -1, np.int64)
    for start in range(m):  # each document's row of estimates is computed once
        if label[start] >= 0:
            continue
        label[start], todo = start, [start]
        while todo:
            free = np.flatnonzero(label < 0)
            if not len(free):
                break
            block, todo = np.array(todo[:64]), todo[64:]
            hit = np.zeros(len(free), bool)
            for i in block:
                rest = ~hit
                if apart is not None:
                    rest &= (apart[free] != apart[i]).all(1)
                hit[rest] = (sketch[free[rest]] == sketch[i]).sum(1) >= need
            new = free[hit]
            label[new] = start
            todo += new.tolist()
    out = [ids[label == k] for k in np.unique(label)]
    return [g for g in out if len(g) > 1]


def _group_name(group: np.ndarray) -> int:
    """A number that names a group of ids; called where overflow is silenced."""
    g64 = group.astype(np.uint64)
    return int(mixed(np.array([(mixed(g64) * np.uint64(0x9E3779B97F4A7C15)).sum() + np.uint64(len(group))], np.uint64)).view(np.int64)[0])


def _orders(reps: DataFrame) -> DataFrame:
    """doc_id, n, sketch, tree, key, prefix: every representative in every order; tree and prefix name its region."""
    width = 2 * DEPTH
    trees = F.array(*[F.substring("sig", 1 + t * width, width) for t in range(TREES)])
    rows = reps.select("doc_id", "n", "sketch", F.posexplode(trees).alias("tree", "key"))
    return rows.withColumn("prefix", F.substring("key", 1, 2 * LEAST_DEPTH))


def _large_regions(orders: DataFrame) -> DataFrame:
    """tree, prefix of the regions that don't fit a block."""
    sizes = orders.groupBy("tree", "prefix").agg(F.count("*").alias("docs"), F.sum("n").alias("weight"))
    heavy = (F.col("docs") > 2 * OVERLAP) & (F.col("weight") >= BLOCK_SHINGLES)
    return sizes.filter((F.col("docs") > BLOCK_DOCS) | heavy).select("tree", "prefix")


def _forest(orders: DataFrame, large: DataFrame) -> DataFrame:
    """block, doc_id: members of the candidate groups of all orders."""
    width, prefix = 2 * DEPTH, 2 * LEAST_DEPTH
    rows = orders.join(large.withColumn("large", F.lit(True)), ["tree", "prefix"], "left")
    # only large regions are parted at a partition's edge
    rows = rows.repartitionByRange("tree", "prefix", F.when(F.col("large"), F.col("key")), F.when(F.col("large"), F.col("doc_id")))
    rows = rows.sortWithinPartitions("tree", "key", "doc_id").select("tree", "key", "doc_id", "n", "sketch")

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[np.ndarray] = []
        members: list[np.ndarray] = []

        def settle(ids: list[np.ndarray], sketches: list[np.ndarray]) -> None:
            """Adds the groups of a region, or of a block of it."""
            all_ids = np.concatenate(ids)
            all_ids, first = np.unique(all_ids, return_index=True)
            if len(all_ids) > 1:
                for g in _candidate_groups(all_ids, np.concatenate(sketches)[first]):
                    blocks.append(np.full(len(g), _group_name(g), np.int64))
                    members.append(g)

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(np.concatenate(blocks)), pa.array(np.concatenate(members))], ["block", "doc_id"])
            blocks.clear()
            members.clear()
            return batch

        held_ids: list[np.ndarray] = []
        held_sketches: list[np.ndarray] = []
        held, weight, mark = 0, 0, None
        with np.errstate(over="ignore"):
            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                key = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(n, width)[:, :prefix]
                tree, ids, sizes = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in (0, 2, 3))
                sketch = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(n, HASHES // 2)
                new = np.ones(n, bool)
                new[1:] = (tree[1:] != tree[:-1]) | (key[1:] != key[:-1]).any(1)
                new[0] = mark != (int(tree[0]), key[0].tobytes())
                mark = (int(tree[-1]), key[-1].tobytes())
                cuts = np.append(np.flatnonzero(new), n)
                if not new[0]:
                    cuts = np.insert(cuts, 0, 0)
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    if new[a]:
                        if held > 1:
                            settle(held_ids, held_sketches)
                        held_ids, held_sketches, held, weight = [], [], 0, 0
                    if b - a == 1 and not held and b < n:
                        continue  # alone in its region
                    for i in range(a, b):
                        pair = sketch[i]
                        held_ids.append(ids[i : i + 1])
                        held_sketches.append(np.stack([pair >> 4, pair & 15], 1).reshape(1, HASHES))
                        held, weight = held + 1, weight + int(sizes[i])
                        if held > OVERLAP * 2 and (held >= BLOCK_DOCS or weight >= BLOCK_SHINGLES):
                            settle(held_ids, held_sketches)
                            held_ids, held_sketches, held, weight = held_ids[-OVERLAP:], held_sketches[-OVERLAP:], OVERLAP, 0
                if sum(map(len, members)) > 20_000:
                    yield out()
            if held > 1:
                settle(held_ids, held_sketches)
            if members:
                yield out()

    return rows.mapInArrow(regions, "block long, doc_id long")


def _across(orders: DataFrame, large: DataFrame, linked: DataFrame) -> DataFrame:
    """block, doc_id: candidate groups of all pairs of large regions whose components differ.

    Chunks of a region are numbered: first those of its other documents, then
    those of its largest component, which meet the others alone.
    """

    def chunks(docs: Column, weight: Column) -> Column:
        return F.least(docs, F.greatest(F.ceil(docs * 2 / BLOCK_DOCS), F.ceil(weight * 2 / BLOCK_SHINGLES)))

    region = ["tree", "prefix"]
    members = orders.join(large, region).join(linked, "doc_id", "left")
    members = written(members.select(*region, "doc_id", "n", "sketch", F.coalesce("component", "doc_id").alias("component")), "large-region-members")
    parts = members.groupBy(*region, "component").agg(F.count("*").alias("docs"), F.sum("n").alias("weight"))
    parts = parts.groupBy(*region).agg(F.max(F.struct("docs", "component", "weight")).alias("most"), F.sum("docs").alias("docs"), F.sum("weight").alias("weight"))
    parts = parts.filter("docs > most.docs").select(
        *region,
        F.col("most.component").alias("main"),
        chunks(F.col("most.docs"), F.col("most.weight")).alias("main_chunks"),
        chunks(F.col("docs") - F.col("most.docs"), F.col("weight") - F.col("most.weight")).alias("chunks"),
    )
    is_main, deal = F.col("component") == F.col("main"), F.xxhash64("doc_id")
    own = F.when(is_main, F.col("chunks") + F.pmod(deal, F.col("main_chunks"))).otherwise(F.pmod(deal, F.col("chunks")))
    last = F.when(is_main, F.col("chunks")).otherwise(F.col("chunks") + F.col("main_chunks")) - 1
    rows = members.join(parts, region).withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0).cast("long"), last))})
    # documents of one chunk meet where it stands alone
    side = F.when(F.col("own") == F.col("other"), F.col("doc_id")).otherwise(F.col("own"))
    block = F.struct(*region, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    rows = rows.select(F.xxhash64(block).alias("deal"), block.alias("b"), "doc_id", "component", side.alias("side"), "sketch")
    rows = rows.repartition("deal").sortWithinPartitions("deal", "b", "doc_id")
    rows = rows.select("b.tree", "b.prefix", "b.low", "b.high", "doc_id", "component", "side", "sketch")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            packed = np.frombuffer(b"".join(r[3] for r in held), np.uint8).reshape(len(held), HASHES // 2)
            sketch = np.stack([packed >> 4, packed & 15], 2).reshape(len(held), HASHES)
            numbers = np.array([r[:3] for r in held], np.int64)
            with np.errstate(over="ignore"):
                for g in _candidate_groups(numbers[:, 0], sketch, numbers[:, 1:]):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), _group_name(np.sort(g)), np.int64)), pa.array(np.sort(g))], ["block", "doc_id"])

        mark, held = None, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for name, row in zip(zip(*columns[:4]), zip(*columns[4:])):
                if name != mark:
                    if len(held) > 1:
                        yield from settle(held)
                    mark, held = name, []
                held.append(row)
        if len(held) > 1:
            yield from settle(held)

    return rows.mapInArrow(compare, "block long, doc_id long")


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of any two of the sets."""
    m = len(sets)
    flat = np.concatenate(sets) if m else np.zeros(0, np.uint64)
    if m == 2:
        return np.full((2, 2), len(flat) - len(np.unique(flat)), np.int64)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    width = int(column.max()) + 1 if len(column) else 0
    inter = np.zeros((m, m), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for a in range(0, width, 4096):
        lo, hi = np.searchsorted(column, [a, a + 4096])
        dense = np.zeros((m, min(4096, width - a)), np.float32)
        dense[owner[lo:hi], column[lo:hi] - a] = 1
        inter += dense @ dense.T
    return inter.astype(np.int64)


def exact_links(sets: list[np.ndarray], percent: int = PERCENT, again: list[np.ndarray] | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sets, as pairs of places; every intersection is exact.

    again: the same sets under another hash; an intersection is the smaller one of both.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    both = _intersections(sets)
    if again is not None:
        both = np.minimum(both, _intersections(again))
    linked = (100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)) & (both > 0)
    np.fill_diagonal(linked, False)
    out, seen = [], np.zeros(m, bool)
    for start in range(m):
        if seen[start]:
            continue
        seen[start], todo = True, [start]
        while todo:
            i = todo.pop()
            near = np.flatnonzero(linked[i] & ~seen)
            seen[near] = True
            out += [(i, int(j)) for j in near]
            todo += near.tolist()
    return out


def _small(df: DataFrame) -> DataFrame:
    """With a broadcast hint if a count shows that it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _confirmed(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """a, b: exact links inside the groups."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(ids: list[int], texts: list[bytes]) -> list[tuple[int, int]]:
            sets: list[list[np.ndarray]] = [[], []]
            for a, b in groups_of(map(len, texts), BATCH_BYTES):
                for seed, own in enumerate(sets):
                    own += shingle_sets(texts[a:b], seed)
            return [(min(ids[i], ids[j]), max(ids[i], ids[j])) for i, j in exact_links(sets[0], again=sets[1]) if ids[i] != ids[j]]

        block, ids, texts, found = None, [], [], []
        for batch in batches:
            blocks, docs_, column = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            for i, (b, d) in enumerate(zip(blocks, docs_)):
                if b != block:
                    found += settle(ids, texts)
                    block, ids, texts = b, [], []
                ids.append(d)
                texts += encoded([column[i].as_py()])
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                found = []
        if found := settle(ids, texts):
            a, b = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(_small(groups), "doc_id")
    rows = rows.select("block", "doc_id", "text").repartition("block").sortWithinPartitions("block", "doc_id")
    return rows.mapInArrow(confirm, "a long, b long").distinct()


def components(links: DataFrame, most: int = 40) -> DataFrame:
    """doc_id, component: for every document of a link the smallest id reachable from it.

    Alternates large-star and small-star steps (each a minimum per node and a
    join) until every node points at a root; the number of rounds grows with
    the logarithm of the longest chain.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    for _ in range(most):
        ways = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ways.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = written(small.filter("u <> v").distinct(), "links")
        done = edges.agg(F.count("*").alias("n"), F.countDistinct("u").alias("k")).first()
        if done.n == done.k and edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").limit(1).count() == 0:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("doc_id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("doc_id"), F.col("v").alias("component")).distinct())


def labelled(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs."""
    signed = written(signatures(docs), "signatures")
    sets = signed.filter("n > 0 and doc_id is not null").groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "n", "sig")).alias("r"), F.count("*").alias("copies"))
    sets = written(sets.select("k1", "k2", "r.doc_id", "r.n", "r.sig", "copies"), "distinct-sets")
    reps = sets.mapInArrow(_sketched, "doc_id long, n long, sig binary, sketch binary")
    orders = _orders(reps)
    large = written(_large_regions(orders), "large-regions")
    groups = written(_forest(orders, large).distinct(), "candidate-groups")
    linked = components(_confirmed(docs, groups))
    if not large.isEmpty():
        groups = written(_across(orders, large, linked).distinct(), "candidate-groups")
        if not groups.isEmpty():
            linked = components(linked.select(F.col("doc_id").alias("a"), F.col("component").alias("b")).unionByName(_confirmed(docs, groups)))
    # the component of each set of several rows or of a linked representative; other rows are their own
    of_set = sets.join(linked, "doc_id", "left").filter("copies > 1 or component is not null").select("k1", "k2", F.coalesce("component", "doc_id").alias("component"))
    of_set = written(of_set, "set-components")
    rows = signed.drop("sig").join(_small(of_set), ["k1", "k2"], "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds two nibbles a byte of each signature."""
    for batch in batches:
        if not batch.num_rows:
            continue
        low = _nibbles(batch.column(4), batch.num_rows)
        packed = (low[:, ::2] << 4) | low[:, 1::2]
        yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), batch.column(4), pa.array([r.tobytes() for r in packed], pa.binary())], ["doc_id", "n", "sig", "sketch"])


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs without the rows whose component has a smaller doc_id; of several rows of one doc_id one stays."""
    (d,) = unused(docs, "d")
    rows = labelled(docs).filter("doc_id is not null").groupBy(F.col("doc_id").alias(d))
    rows = written(rows.agg(F.bool_and("kept").alias("kept"), F.count("*").alias("rows")).filter("not kept or rows > 1"), "dropped-documents")
    same = F.col("doc_id").cast("long") == F.col(d)
    out = docs.join(_small(rows.select(d)), same, "left_anti")
    again = rows.filter("kept").select(d)
    if not again.isEmpty():
        out = out.unionByName(docs.join(_small(again), same).dropDuplicates([d]).drop(d))
    return out


def query(spark, sf_dir: str) -> DataFrame:
    return labelled(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0))
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), c AS (
  WITH RECURSIVE r(doc_id, c) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id WHERE r.c < e.b
  ) SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.c AS component_id, d.doc_id = c.c AS kept
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
