"""Token-id shards compressed by Re-Pair grammars.

File format.  A dataset is a Parquet table with one row for each shard: where it
stands (part, seq), how many tokens the shards before it in its part hold
(base), its documents and its grammar blob.  Parquet is the container because
Spark's committer then publishes shards exactly once on any store it can write.

A blob is little-endian: magic ``RPG2``, uint32 number of sections, for each
section its tokens and bytes (uint64), then the sections; a section has at most
SHARD_TOKENS tokens.  A section begins with uint32 terminals, rules, symbols,
tokens, width of a symbol (2 or 4 bytes), step of the index; then the token ids
that the terminals stand for (uint32), the rules (left, right) as symbols, the
rules' expansion lengths (uint32), the sequence of symbols, and for every
step-th symbol the number of tokens before it (uint64).  Symbols below the
number of terminals are terminals; a rule refers to terminals and to earlier
rules only.

Compression.  Pairs are counted exactly, and the most frequent ones are replaced
first: a round takes all pairs that occur at least ``level`` times, the more
frequent before the less frequent where they overlap; level is halved once no
pair reaches it, and the section is done when none reaches LEAST_COUNT.  No
pair that occurs so often is left.  Expansion lengths let a reader take any
range of tokens without expanding what stands before it.

Defined results: a null or empty text holds the end id alone; documents stand in
ascending doc_id order, null first, those of one id in the order of their
texts; a document is never split, so a longer document than a shard has a
larger shard of its own, of several sections.  An empty table gives no shards.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import groups_of, mixed, scratch

END_ID = 2
SHARD_TOKENS = 1 << 20
#: Pairs that occur less often are not replaced.
LEAST_COUNT = 8
INDEX_STEP = 4096
#: Words whose ids a worker remembers, in each of two generations.
MEMO_WORDS = 400_000

_HEAD = struct.Struct("<6I")
#: Bounds of a pair's occurrences that stand for "not known" and "no pair begins here".
_UNKNOWN, _NONE = 65535, 0
#: Above the code of every pair.
_LAST = np.uint64((1 << 64) - 1)


def grammar(ids: np.ndarray, first: int, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray]:
    """The sequence left and the rules (n x 2) of a Re-Pair grammar of ids, all of them below first.

    Symbols stay where they are and are chained to the next and the previous
    one left; beside each stands the next symbol, so that a place's pair is one
    number.  A pair of symbols occurs less and less often after the round that
    made it, so places whose pair is known to be too rare for a level are not
    counted again before the level sinks.  Places to be changed are taken in
    ascending order, which is several times as fast as in the order of pairs.
    """
    n = len(ids)
    pair = np.zeros(n + 1, "<u8")  # symbol << 32 | next symbol
    right, left = pair.view("<u4").reshape(-1, 2).T
    left[:n] = ids
    right[:n] = left[1:]
    left_over = np.ones(n, bool)
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n, dtype=np.int32)  # n and -1 stand beyond the ends
    bound = np.full(n + 1, _NONE, np.uint16)
    bound[: max(0, n - 1)] = _UNKNOWN
    rank = np.full(n + 1, n, np.int32)
    listed = np.zeros(n + 1, bool)
    place_bits = np.uint64(n.bit_length())
    place_mask, half, low = np.uint64((1 << int(place_bits)) - 1), np.uint64(32), np.uint64(0xFFFFFFFF)
    rules: list[np.ndarray] = []
    made, level = 0, 0
    p = np.arange(max(0, n - 1))
    while True:
        own_pair = pair[p]
        own_left = own_pair >> half
        own_pair &= low
        twin = np.flatnonzero(own_left == own_pair)
        bits = np.uint64((first + made).bit_length())
        code = own_left
        code <<= bits
        code |= own_pair
        twins, odd = p[twin], twin
        if len(twins):  # of a run of one symbol, every second place
            twin = twin[np.argsort(twins)]
            twins = p[twin]
            at = np.arange(len(twins))
            head = np.append(True, twins[1:] != after[twins[:-1]])
            odd = twin[np.flatnonzero((at - np.maximum.accumulate(np.where(head, at, 0))) & 1)]
        kept = len(p) - len(odd)  # the others are sorted behind all pairs
        if 2 * int(bits) + int(place_bits) <= 64:
            code <<= place_bits
            code |= p.view(np.uint64)
            code[odd] = _LAST
            code.sort()
            code = code[:kept]
            p = (code & place_mask).view(np.int64)
            code >>= place_bits
        else:
            code[odd] = _LAST
            order = np.argsort(code, kind="stable")[:kept]
            p, code = p[order], code[order]
        cut = np.append(np.flatnonzero(np.append(True, code[1:] != code[:-1])), len(code)) if len(code) else np.zeros(1, np.int64)
        count = np.diff(cut)
        bound[p] = np.repeat(np.minimum(count, _UNKNOWN - 1).astype(np.uint16), count)
        bound[twins] = _UNKNOWN  # which places of a run count changes with its ends
        level = level or max(least, (int(count.max(initial=0)) + 1) // 2)
        hot = np.flatnonzero(count >= level)
        if not len(hot):
            if level <= least:
                break
            level = max(least, level // 2)
            p = np.flatnonzero(bound >= min(level, _UNKNOWN))
            continue
        hot = hot[np.argsort(-count[hot], kind="stable")]
        size, begin = count[hot], cut[hot]
        found = p[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))].view(np.uint64)
        found <<= half
        found |= np.repeat(np.arange(len(hot), dtype=np.uint64), size)
        found.sort()
        own, found = (found & low).astype(np.int32), (found >> half).view(np.int64)
        rank[found] = own
        taken, ranks = [], []
        spots, a, b = found, before[found].astype(np.int64), after[found].astype(np.int64)
        while len(spots):  # a place goes to the more frequent of the pairs that overlap there
            wins = np.flatnonzero((own < rank[a]) & (own < rank[b]))
            taken.append(spots[wins])
            ranks.append(own[wins])
            for places in (taken[-1], a[wins], b[wins]):
                rank[places] = n
            left_out = np.flatnonzero(rank[spots] < n)
            spots, own, a, b = spots[left_out], own[left_out], a[left_out], b[left_out]
        spots, own = np.concatenate(taken), np.concatenate(ranks)
        used = np.bincount(own, minlength=len(hot)) >= least  # the most frequent one always is
        number = (np.cumsum(used) - 1 + first + made).astype(np.uint32)
        if not used.all():
            stay = np.flatnonzero(used[own])
            spots, own = spots[stay], own[stay]
        pairs = code[begin[used]]
        rules.append(np.stack([pairs >> bits, pairs & np.uint64((1 << int(bits)) - 1)], 1).astype(np.uint32))
        made += len(pairs)
        symbols = number[own]
        gone = after[spots].astype(np.int64)
        beyond = after[gone].astype(np.int64)
        left_over[gone] = False
        bound[gone] = _NONE
        after[spots] = beyond
        before[beyond] = spots
        left[spots] = symbols
        right[spots] = left[beyond]
        a = before[spots].astype(np.int64)
        inner = np.flatnonzero(a >= 0)
        a = a[inner]
        right[a] = symbols[inner]
        spots = spots.compress(beyond < n)
        bound[a] = _UNKNOWN
        bound[spots] = _UNKNOWN
        bound[before[n]] = _NONE
        # places of this level: those whose pair is new, and those there were
        listed[spots] = True
        a = a.compress(~listed[a])
        listed[a] = True
        held = found.compress((bound[found] >= min(level, _UNKNOWN)) & ~listed[found])
        listed[held] = True
        twins = twins.compress((bound[twins] == _UNKNOWN) & ~listed[twins])
        p = np.concatenate([held, twins, spots, a])
        listed[p] = False
    return left[:n][left_over], (np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32))


def _lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """Tokens that each rule expands to."""
    out = np.ones(len(rules), np.int64)
    done = 0
    while done < len(rules):  # rules that refer to finished ones alone, together
        most = rules[done:].max(1).astype(np.int64) - first
        stop = done + int(np.argmax(np.append(most >= done, True)))
        side = rules[done:stop].astype(np.int64) - first
        out[done:stop] = np.where(side >= 0, out[np.maximum(side, 0)], 1).sum(1)
        done = stop
    return out


def _section(ids: np.ndarray) -> bytes:
    """The bytes of a section of token ids below 2**31."""
    if len(ids) and int(ids.max()) < 1 << 22:
        met = np.bincount(ids) > 0
        terminals, x = np.flatnonzero(met), (np.cumsum(met) - 1)[ids]
    else:
        terminals, x = np.unique(ids, return_inverse=True)
    first = len(terminals)
    x, rules = grammar(x, first)
    lengths = _lengths(rules, first)
    kind = "<u2" if first + len(rules) <= 1 << 16 else "<u4"
    each = np.append(np.ones(first, np.int64), lengths)[x]
    before = np.cumsum(each) - each
    head = _HEAD.pack(first, len(rules), len(x), len(ids), int(kind[-1]), INDEX_STEP)
    return head + terminals.astype("<u4").tobytes() + rules.astype(kind).tobytes() + lengths.astype("<u4").tobytes() + x.astype(kind).tobytes() + before[::INDEX_STEP].astype("<u8").tobytes()


def encode_shard(ids: np.ndarray) -> bytes:
    """The blob of a sequence of token ids below 2**31."""
    cuts = range(0, len(ids), SHARD_TOKENS)
    parts = [_section(ids[i : i + SHARD_TOKENS]) for i in cuts]
    sizes = np.array([(min(SHARD_TOKENS, len(ids) - i), len(x)) for i, x in zip(cuts, parts)], "<u8")
    return struct.pack("<4sI", b"RPG2", len(parts)) + sizes.tobytes() + b"".join(parts)


class Section:
    """Reads a section; expansions of rules are laid out once, in one array."""

    def __init__(self, data: memoryview) -> None:
        self.first, rules, symbols, self.tokens, width, self.step = _HEAD.unpack_from(data)
        if width not in (2, 4):
            raise ValueError("not a section")
        kind, at = f"<u{width}", _HEAD.size
        self.terminals = np.frombuffer(data, "<u4", self.first, at)
        at += 4 * self.first
        self.rules = np.frombuffer(data, kind, 2 * rules, at).reshape(-1, 2).astype(np.int64)
        at += 2 * rules * width
        self.lengths = np.frombuffer(data, "<u4", rules, at).astype(np.int64)
        at += 4 * rules
        self.sequence = np.frombuffer(data, kind, symbols, at)
        at += symbols * width
        self.index = np.frombuffer(data, "<u8", -(-symbols // self.step), at).astype(np.int64)
        self._expanded: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def _table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How long each symbol's expansion is, where it begins, and all expansions one after another."""
        if self._expanded is None:
            sizes = np.append(np.ones(self.first, np.int64), self.lengths)
            begin = np.cumsum(sizes) - sizes
            flat = np.zeros(int(sizes.sum()), np.uint32)
            flat[: self.first] = self.terminals
            self._expanded = sizes, begin, flat
            done = 0
            while done < len(self.rules):
                most = self.rules[done:].max(1) - self.first
                stop = done + int(np.argmax(np.append(most >= done, True)))
                both = self._expand(self.rules[done:stop].reshape(-1))
                flat[begin[self.first + done] :][: len(both)] = both
                done = stop
        return self._expanded

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        sizes, begin, flat = self._table()
        symbols = symbols.astype(np.int64)
        own = sizes[symbols]
        ends = np.cumsum(own)
        source = np.repeat(begin[symbols] - (ends - own), own)
        source += np.arange(len(source))
        return flat[source]

    def decode(self, start: int, end: int) -> np.ndarray:
        """Tokens from start to end; only the symbols that cover them are expanded."""
        low = int(np.searchsorted(self.index, start, "right") - 1)
        high = int(np.searchsorted(self.index, end, "left"))
        part = self._expand(self.sequence[low * self.step : high * self.step])
        skip = start - int(self.index[low])
        return part[skip : skip + end - start]


class Shard:
    """Reads a blob, section by section."""

    def __init__(self, blob: bytes) -> None:
        magic, count = struct.unpack_from("<4sI", blob)
        if magic != b"RPG2":
            raise ValueError("not a shard")
        sizes = np.frombuffer(blob, "<u8", 2 * count, 8).astype(np.int64).reshape(-1, 2)
        ends = 8 + 16 * count + np.cumsum(sizes[:, 1])
        self.sections = [Section(memoryview(blob)[e - n : e]) for e, n in zip(ends.tolist(), sizes[:, 1].tolist())]
        self.ends = np.cumsum(sizes[:, 0]).tolist()
        self.tokens = self.ends[-1] if count else 0

    @property
    def rules(self) -> np.ndarray:
        return np.concatenate([np.zeros((0, 2), np.int64), *(x.rules for x in self.sections)])

    @property
    def lengths(self) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int64), *(x.lengths for x in self.sections)])

    def decode(self, start: int = 0, count: int | None = None) -> np.ndarray:
        """count tokens from start on."""
        end = self.tokens if count is None else min(start + count, self.tokens)
        out = [np.zeros(0, np.uint32)]
        for own, stop in zip(self.sections, self.ends):
            base = stop - own.tokens
            if (a := max(start, base)) < (b := min(end, stop)):
                out.append(own.decode(a - base, b - base))
        return np.concatenate(out)


#: Texts of ASCII and of Latin-1 letters, and the tokenizer's own split of such a text in lower case.
_PLAIN = re.compile(r"[\n -~À-ÖØ-öø-ÿ]*\Z")
_PIECES = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+").findall
#: What a byte of a plain text is: 0 white space, 1 letter, 2 digit, 3 other.
_KIND = np.array([0 if c in (10, 32) else 2 if 48 <= c < 58 else 1 if 97 <= c < 123 or c > 127 else 3 for c in range(256)], np.uint8)


def plain_pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of a plain text in lower case (bytes)."""
    kind = np.zeros(len(data) + 2, np.uint8)
    np.take(_KIND, data, out=kind[1:-1])
    new = kind[1:] != kind[:-1]
    new[1:] |= (kind[1:-1] == 2) & (kind[2:] == 2)  # every digit is a piece
    edges = np.flatnonzero(new)
    held = kind[edges + 1] > 0
    starts, ends = edges[held], edges[np.flatnonzero(held) + 1] if len(edges) else edges
    # a single apostrophe takes the ending of a contraction from the letters after it
    mark = np.flatnonzero((data[starts] == 39) & (ends - starts == 1)) if len(starts) else starts
    mark = mark[mark + 1 < len(starts)]
    mark = mark[(starts[mark + 1] == ends[mark]) & (kind[starts[mark + 1] + 1] == 1)]
    if len(mark):
        one = data[starts[mark + 1]]
        two = np.where(ends[mark + 1] - starts[mark + 1] > 1, data[np.minimum(starts[mark + 1] + 1, len(data) - 1)], 0)
        size = np.where(np.isin(one, list(b"stmd")), 1, 0)
        size[((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)] = 2  # re, ve, ll
        ends[mark] += size
        starts[mark + 1] += size
        stay = starts < ends
        starts, ends = starts[stay], ends[stay]
    return starts, ends


class WordTable:
    """Ids of words of up to 24 bytes, found for whole arrays of words at once.

    A slot holds a word's bytes and where its ids stand; words are compared, not hashes.
    A full table is emptied.
    """

    BITS, PROBES = 21, 32
    _MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

    def __init__(self, make) -> None:
        self.make = make
        self.clear()

    def clear(self) -> None:
        self.slots = np.zeros((1 << self.BITS, 4), np.uint64)
        self.pool, self.used, self.words = np.zeros(1 << 16, np.uint32), 0, 0

    def _find(self, keys: list[np.ndarray], slot: np.ndarray) -> np.ndarray:
        """Where each word's ids stand (start << 8 | count), 0 for unknown words."""
        out = np.zeros(len(slot), np.uint64)
        left: np.ndarray | slice = slice(None)
        for step in range(self.PROBES):
            row = self.slots.take((slot[left] + step) & (len(self.slots) - 1), 0)
            same = (row[:, 0] == keys[0][left]) & (row[:, 1] == keys[1][left]) & (row[:, 2] == keys[2][left])
            out[left] = row[:, 3] * same
            other = np.flatnonzero(~same & (row[:, 0] != 0))
            left = left[other] if step else other
            if not len(left):
                break
        return out

    def _add(self, words: list[bytes], keys: list[np.ndarray], slot: np.ndarray) -> None:
        """Adds words that are not there; those that find no slot stay unknown."""
        ids, count = self.make(words)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.append(self.pool, np.zeros(len(self.pool), np.uint32))
        self.pool[self.used : self.used + len(ids)] = ids
        begin = self.used + np.cumsum(count) - count
        rows = np.stack([*keys, (begin << 8 | count).astype(np.uint64)], 1)
        left = np.flatnonzero((count > 0) & (count < 256))
        for step in range(self.PROBES):
            at = (slot[left] + step) & (len(self.slots) - 1)
            free = self.slots[at, 0] == 0
            _, first = np.unique(at[free], return_index=True)  # of words that want one slot, one gets it
            got = np.flatnonzero(free)[first]
            self.slots[at[got]] = rows[left[got]]
            left = np.delete(left, got)
            if not len(left):
                break
        self.used += len(ids)
        self.words += len(words)

    def ids(self, text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each has; text ends in 24 zero bytes."""
        if self.words > len(self.slots) // 2:
            self.clear()
        sizes = ends - starts
        eights = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))
        keys = [eights[starts] & self._MASK[np.minimum(sizes, 8)], np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)]
        hashes = keys[0]
        longer = np.flatnonzero(sizes > 8)
        if len(longer):
            at, rest = starts[longer], sizes[longer]
            more = [eights[at + 8 * i] & self._MASK[np.clip(rest - 8 * i, 0, 8)] for i in (1, 2)]
            keys[1][longer], keys[2][longer] = more
            hashes = hashes.copy()
            hashes[longer] ^= mixed(more[0] ^ mixed(more[1]))
        slot = (mixed(hashes) >> np.uint64(64 - self.BITS)).astype(np.int64)
        found = self._find(keys, slot)
        short = sizes <= 24
        found[~short] = 0
        fresh = np.flatnonzero((found == 0) & short)
        if len(fresh):
            new = {text[a:b]: i for i, a, b in zip(fresh.tolist(), starts[fresh].tolist(), ends[fresh].tolist())}
            at = np.fromiter(new.values(), np.int64, len(new))
            self._add(list(new), [k[at] for k in keys], slot[at])
            found[fresh] = self._find([k[fresh] for k in keys], slot[fresh])
        count = (found & np.uint64(255)).astype(np.int64)
        begin = (found >> np.uint64(8)).astype(np.int64)
        rest = np.flatnonzero(found == 0)  # too long for the table, or without room in it
        if len(rest):
            own, count[rest] = self.make([text[a:b] for a, b in zip(starts[rest].tolist(), ends[rest].tolist())])
            begin[rest] = self.used + np.cumsum(count[rest]) - count[rest]
            pool = np.append(self.pool[: self.used], own)
        else:
            pool = self.pool
        ends_ = np.cumsum(count)
        total = int(ends_[-1]) if len(count) else 0
        return pool[np.repeat(begin - (ends_ - count), count) + np.arange(total)], count


class Encoder:
    """Ids of texts by the tokenizers library, remembering the ids of words.

    Whole texts and their words have equal ids where the tokenizer drops white
    space as it splits words by the rule known here (its file says so); other
    tokenizers encode whole texts.  Words of plain texts go to the library's
    model, chunks between spaces of other texts to the whole library.
    """

    BLOCK_BYTES = 1 << 20

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        kinds = [x.get("type") for x in (said.get("normalizer") or {}).get("normalizers", [])]
        steps = (said.get("pre_tokenizer") or {}).get("pretokenizers", [])
        split = steps[0].get("pattern", {}).get("Regex") if steps else None
        self.by_chunk = kinds == ["NFC", "Replace", "Lowercase"] and split == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" and not any(x["lstrip"] or x["rstrip"] for x in said["added_tokens"])
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = np.arange(256, dtype="<u4")  # the library's letter for each byte of plain texts
        for c in range(0xC0, 0x100):
            self.letters[list(chr(c).encode())] = [ord(x) for x in level.pre_tokenize_str(chr(c))[0][0]]
        self.special = [x["content"] for x in said["added_tokens"]]
        self.chunks, self.table = _Memo(self._whole), WordTable(self._words)

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after another, and how many each has."""
        tokenize = self.tokenizer.model.tokenize
        texts = self.letters[np.frombuffer(b" ".join(words), np.uint8)].tobytes().decode("utf-32-le").split(" ")
        ids: list[int] = []
        ends = [0]
        for x in texts:
            ids += [t.id for t in tokenize(x)]
            ends.append(len(ids))
        return np.array(ids, np.uint32), np.diff(ends)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() if text else b""

    def ids(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return self.all_ids([text])[0]

    def all_ids(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text."""
        out: list[bytes] = [b""] * len(texts)
        block: list[bytes] = []
        owners: list[int] = []
        size = 0

        def settle() -> None:
            nonlocal block, owners, size
            for i, x in zip(owners, self._plain(block)):
                out[i] += x
            block, owners, size = [], [], 0

        for i, text in enumerate(texts):
            if not text:
                continue
            if not self.by_chunk:
                out[i] = self._whole(text)
                continue
            plain = _PLAIN.match(text) and not any(x in text for x in self.special)
            at = 0
            while at < len(text):  # long texts in pieces that end at a space
                end = len(text) if len(text) - at <= self.BLOCK_BYTES else text.find(" ", at + self.BLOCK_BYTES)
                end = len(text) if end < 0 else end
                piece = text[at:end]
                if plain:
                    block.append(piece.encode())
                    owners.append(i)
                    size += len(piece)
                    if size >= self.BLOCK_BYTES:
                        settle()
                else:
                    out[i] += b"".join(map(self.chunks.__getitem__, piece.replace("\n", " ").split(" ")))
                at = end
        settle()
        return out

    def _plain(self, texts: list[bytes]) -> list[bytes]:
        """The ids of plain texts, all in one array."""
        data = np.frombuffer(bytearray(b"\n".join(texts).lower() + bytes(24)), np.uint8)
        lead = np.flatnonzero(data == 0xC3)  # capitals of Latin-1
        second = data[lead + 1]
        data[lead[(second < 0x9F) & (second != 0x97)] + 1] += 0x20
        starts, ends = plain_pieces(data[:-24])
        ids, count = self.table.ids(data.tobytes(), starts, ends)
        limits = np.searchsorted(starts, np.cumsum([len(x) + 1 for x in texts]))
        cuts = np.append(0, np.append(0, np.cumsum(count))[limits]).tolist()
        view = memoryview(ids.astype("<u4").tobytes())
        return [bytes(view[4 * a : 4 * b]) for a, b in zip(cuts[:-1], cuts[1:])]


class _Memo(dict):
    """What make() gave for a key; of two generations of MEMO_WORDS keys the older is dropped, so frequent keys stay."""

    def __init__(self, make) -> None:
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= MEMO_WORDS:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 64:
            self[key] = value
        return value


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and tokenizer file."""
    return Encoder(path)


SHARDS = "part int, seq int, base long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, blob binary"


def write_shards(docs: DataFrame, tokenizer_path: str, path: str, shard_tokens: int = SHARD_TOKENS) -> str:
    """Encodes docs (doc_id, text) and writes their shards under path."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, end = encoder(tokenizer_path), np.array([END_ID], "<u4").tobytes()
        part, seq, base = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        sizes: list[int] = []
        held: list[bytes] = []
        total = 0

        def out() -> pa.RecordBatch:
            data = np.frombuffer(b"".join(held), "<u4")
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([base], pa.int64()), pa.array([total], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())), pa.array([encode_shard(data)], pa.binary())],
                ["part", "seq", "base", "n_tokens", "doc_ids", "doc_tokens", "blob"],
            )

        def encoded(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
            for a, b in groups_of(pc.binary_length(batch.column(1)).fill_null(0).to_pylist(), code.BLOCK_BYTES):
                part = batch.slice(a, b - a)
                yield from zip(part.column(0).to_pylist(), code.all_ids(part.column(1).to_pylist()))

        for batch in batches:
            for doc_id, data in encoded(batch):
                n = len(data) // 4 + 1
                if total and total + n > shard_tokens:
                    yield out()
                    seq, base = seq + 1, base + total
                    ids, sizes, held, total = [], [], [], 0
                ids.append(doc_id)
                sizes.append(n)
                held += [data, end]
                total += n
        if total:
            yield out()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows.repartitionByRange(F.col("doc_id"), F.substring("text", 1, 32)).sortWithinPartitions("doc_id", "text").mapInArrow(pack, SHARDS).write.parquet(path)
    return path


def read_shards(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the shards alone."""
    shards = spark.read.schema(SHARDS).parquet(path)
    totals = sorted((r.part, r.n) for r in shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())  # a row for each part
    starts, at = {}, 0
    for part, n in totals:
        starts[part], at = at, at + n

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, base, ids, sizes, blob = (batch.column(i)[row] for i in range(5))
                tokens = Shard(blob.as_py()).decode().astype("<u4")
                n = np.asarray(sizes.values.to_numpy(zero_copy_only=False), np.int64)
                ends = np.cumsum(n)
                first = starts[part.as_py()] + base.as_py()
                view = memoryview(tokens).cast("B")
                crc = [zlib.crc32(view[4 * (b - k) : 4 * b]) for b, k in zip(ends.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(first + ends - n), pa.array(n), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.select("part", "base", "doc_ids", "doc_tokens", "blob").mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def round_trip(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Writes the shards of docs to the shared folder and reads them back."""
    spark = docs.sparkSession
    return read_shards(spark, write_shards(docs, tokenizer_path or tokenizer_file(), scratch(spark, "token-shards")))


def query(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
