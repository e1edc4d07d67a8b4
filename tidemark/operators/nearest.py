"""Exact cosine top-k of dense vectors, block against block.

Products of whole blocks tell which pairs can reach a query's k-th best
similarity; those alone are summed in the order of their components, as SQL
does, and ranked.  So ties, and the last bit of a similarity, do not depend on
how the blocks were cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Candidates and queries multiplied at once, and pairs summed at once.
BLOCK_ROWS, QUERY_ROWS, PAIRS = 1024, 2048, 1 << 16
#: More than what the products of unit vectors lose by rounding.
SLACK = 1e-9


class Units:
    """Vectors at unit length; absent components count as nothing, and rows of none as missing."""

    def __init__(self, column: pa.Array) -> None:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = column.flatten()
        absent = flat.is_null().to_numpy(zero_copy_only=False)
        values = np.where(absent, 0.0, flat.to_numpy(zero_copy_only=False).astype(np.float64))
        m = np.zeros((len(sizes), int(sizes.max(initial=0))))
        inside = np.arange(m.shape[1])[None, :] < sizes[:, None]
        m[inside] = values
        there = np.zeros(m.shape, bool)
        there[inside] = ~absent
        self.missing = ~there.any(1)
        square = np.zeros(len(m))
        for x in m.T:  # in the order of the components
            square += x * x
        with np.errstate(divide="ignore", invalid="ignore"):
            m /= np.sqrt(square)[:, None]
        m[self.missing] = 0.0
        self.m, self.odd = m, not np.isfinite(m).all()

    def part(self, rows: slice, width: int) -> "Units":
        out = Units.__new__(Units)
        out.m = np.zeros((len(self.m[rows]), width))
        out.m[:, : self.m.shape[1]] = self.m[rows]
        out.missing, out.odd = self.missing[rows], self.odd
        return out


class Candidates:
    """Candidates in the order of their ids, in blocks."""

    def __init__(self, ids: pa.Array, vectors: pa.Array) -> None:
        self.ids, self.units = ids, Units(vectors)
        self.names = np.asarray(ids.to_numpy(zero_copy_only=False))

    def search(self, ids: pa.Array, vectors: pa.Array, k: int, own: bool) -> Iterator[tuple[pa.Array, pa.Array, pa.Array]]:
        """Ids of queries, ids of their k best candidates, similarities; null where a vector is missing."""
        for i in range(0, len(ids), QUERY_ROWS):
            some = ids.slice(i, QUERY_ROWS)
            q, place, key = self._best(np.asarray(some.to_numpy(zero_copy_only=False)), Units(vectors.slice(i, QUERY_ROWS)), k, own)
            if len(q):
                yield some.take(pa.array(q)), self.ids.take(pa.array(place)), pa.array(np.where(key == np.inf, np.nan, key), mask=key == -np.inf)

    def _best(self, names: np.ndarray, asked: Units, k: int, own: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, places and similarities; an undefined similarity counts as the greatest, a missing one as the least."""
        width = max(asked.m.shape[1], self.units.m.shape[1])
        asked = asked.part(slice(None), width)
        turned = np.ascontiguousarray(asked.m.T)
        bound, full = np.full(len(names), -np.inf), np.zeros(len(names), bool)
        q, place, key = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for at in range(0, len(self.names), BLOCK_ROWS):
            c, c_names = self.units.part(slice(at, at + BLOCK_ROWS), width), self.names[at : at + BLOCK_ROWS]
            with np.errstate(invalid="ignore", over="ignore"):
                s = asked.m @ c.m.T
            if asked.odd or c.odd:
                s[np.isnan(s)] = np.inf
            s[asked.missing] = -np.inf
            s[:, c.missing] = -np.inf
            if not own:
                low, high = np.searchsorted(c_names, names, "left"), np.searchsorted(c_names, names, "right")
                for j in range(int((high - low).max(initial=0))):
                    rows = np.flatnonzero(low + j < high)
                    s[rows, low[rows] + j] = -np.inf
            least = np.where(full, bound, -np.inf)
            if not at and s.shape[1] > k:
                least = np.partition(s, -k, axis=1)[:, -k]
            least = np.where(np.isinf(least), least, least - SLACK)
            least[full & (bound == -np.inf)] = -1e300  # of equals, those that stand first stay
            least[full & (bound == np.inf)] = np.nan
            rows, cols = np.nonzero(s >= least[:, None])
            if not own:
                other = names[rows] != c_names[cols]
                rows, cols = rows[other], cols[other]
            if not len(rows):
                continue
            c_turned = np.ascontiguousarray(c.m.T)
            sums = np.zeros(len(rows))
            for a in range(0, len(rows), PAIRS):
                r, o = rows[a : a + PAIRS], cols[a : a + PAIRS]
                for x, y in zip(turned, c_turned):  # in the order of the components
                    sums[a : a + PAIRS] += x[r] * y[o]
            sums[np.isnan(sums)] = np.inf
            sums[asked.missing[rows] | c.missing[cols]] = -np.inf
            q, place, key = np.concatenate([q, rows]), np.concatenate([place, cols + at]), np.concatenate([key, sums])
            order = np.lexsort((place, -key, q))
            q, place, key = q[order], place[order], key[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            last = rank == k - 1
            bound[q[last]], full[q[last]] = key[last], True
            q, place, key = q[rank < k], place[rank < k], key[rank < k]
        return q, place, key


def met(batches: Iterator[pa.RecordBatch], k: int, own: bool) -> Iterator[pa.RecordBatch]:
    """query_id, doc_id, similarity from rows (range, tile, asks, id, vector) in that order, candidates before queries."""
    mark, held, block = None, [], None
    for batch in batches:
        names = [np.asarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in range(3)]
        cuts = [0, *(np.flatnonzero(np.any([x[1:] != x[:-1] for x in names], axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            here, part = (int(names[0][a]), int(names[1][a])), batch.slice(a, b - a)
            if here != mark:
                mark, held, block = here, [], None
            if not names[2][a]:
                held.append(part.select([3, 4]))
                continue
            if held:
                whole = pa.Table.from_batches(held).combine_chunks()
                block, held = Candidates(whole.column(0).combine_chunks(), whole.column(1)), []
            if block is not None:
                for found in block.search(part.column(3), part.column(4), k, own):
                    yield pa.RecordBatch.from_arrays(list(found), ["query_id", "doc_id", "similarity"])
