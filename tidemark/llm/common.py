"""What several operators share: the shared folder, written tables, word hashes.

Words are hashed in whole byte buffers with numpy, so that a word costs a few
array operations and no Python object: 64 bits of its eight-byte pieces, each
mixed into the result of those before.  Words of up to eight bytes never share
a hash with another word of their length.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text hashed at once; bounds the memory of the array operations.
BLOCK_BYTES = 1 << 20

#: Words of more bytes are hashed one by one.
LONG_WORD = 128

#: Fixed values of the hash: an odd multiplier and the finaliser's factors.
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xFF51AFD7ED558CCD)
_MIX_2 = np.uint64(0xC4CEB9FE1A85EC53)

#: Of an eight-byte piece, the bytes that belong to a word of so many bytes.
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

#: Bytes that separate words when words are runs of other than ASCII white space.
WHITE_SPACE = bytes([0x20, *range(0x09, 0x0E)])
#: Bytes that separate words when words are ASCII letters and digits and all of non-ASCII.
NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Only where the session has none and runs on one machine (tests) a temporary folder is set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir names no folder that the executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tidemark-shared-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; the folder's owner clears it after the run."""
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: a cut in the lineage that outlives any executor."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like those given that no column of df has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"__{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def character_class(characters: Iterable[int]) -> str:
    """Characters below 256 as the inside of a regular expression's class.

    Java's engine looks characters that stand one by one up in a table; a
    negated class of ranges takes it ten times as long.
    """
    return "".join(f"\\x{c:02x}" for c in sorted(characters))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h *= _MIX_1
    h ^= h >> np.uint64(33)
    h *= _MIX_2
    h ^= h >> np.uint64(33)
    return h


def word_table(separators: bytes) -> np.ndarray:
    """For each byte value, whether it belongs to a word."""
    kind = np.ones(256, bool)
    kind[np.frombuffer(separators, np.uint8)] = False
    return kind


def word_spans(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a byte array."""
    flags = np.zeros(len(data) + 2, bool)
    np.take(is_word, data, out=flags[1:-1])
    edges = np.flatnonzero(flags[1:] != flags[:-1])
    return edges[::2], edges[1::2]


def _pieces(text: bytes, is_word: np.ndarray) -> Iterator[bytes]:
    """A long text in pieces of about BLOCK_BYTES that end between words."""
    at = 0
    while len(text) - at > BLOCK_BYTES:
        end = at + BLOCK_BYTES
        while end < len(text):  # to the next separator
            stop = min(len(text), end + 4096)
            gaps = np.flatnonzero(~is_word[np.frombuffer(text, np.uint8, stop - end, end)])
            if len(gaps):
                end += int(gaps[0])
                break
            end = stop
        yield text[at:end]
        at = end
    yield text[at:]


def _hashed(data: bytes, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of the words of data, which ends in eight bytes of none."""
    sizes = ends - starts
    pieces = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    with np.errstate(over="ignore"):
        salt = mixed(np.array([seed], np.uint64) + _ODD)
        h = mixed((pieces[starts] & _MASK[np.minimum(sizes, 8)]) ^ (sizes.astype(np.uint64) * _ODD + salt))
        left, at = np.flatnonzero((sizes > 8) & (sizes <= LONG_WORD)), 8
        while len(left):
            piece = pieces[starts[left] + at] & _MASK[np.minimum(sizes[left] - at, 8)]
            h[left] = mixed((h[left] * _ODD) ^ piece)
            at += 8
            left = left[sizes[left] > at]
    key = seed.to_bytes(8, "little")
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8, key=key).digest(), "little")
    return h


def word_hashes(texts: list[bytes], is_word: np.ndarray, endings: list[np.ndarray] | None = None, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, one after another, and where each text's words begin.

    The second array has len(texts) + 1 entries.  Texts are expected in the
    letter case in which they are to be compared.  A list given as endings gets
    arrays of the words' last two bytes (0 for the second last of a one-byte
    word).  Hashes of different seeds are independent of one another.
    """
    hashes: list[np.ndarray] = []
    counts = np.zeros(len(texts) + 1, np.int64)
    separator = bytes([int(np.flatnonzero(~is_word)[0])])

    def take(block: list[bytes], owners: list[int]) -> None:
        joined = separator.join(block) + bytes(8)
        data = np.frombuffer(joined, np.uint8, len(joined) - 8)
        starts, ends = word_spans(data, is_word)
        hashes.append(_hashed(joined, starts, ends, seed))
        if endings is not None:
            before = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0) if len(data) else starts
            endings.append(np.stack([before, data[ends - 1]], 1).astype(np.uint8))
        limits = np.cumsum([len(x) + 1 for x in block])
        per = np.diff(np.searchsorted(starts, limits), prepend=0)
        np.add.at(counts, np.asarray(owners) + 1, per)

    block: list[bytes] = []
    owners: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        for piece in [text] if len(text) <= BLOCK_BYTES else _pieces(text, is_word):
            block.append(piece)
            owners.append(i)
            size += len(piece)
            if size >= BLOCK_BYTES:
                take(block, owners)
                block, owners, size = [], [], 0
    if block:
        take(block, owners)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), np.cumsum(counts)


def encoded(values: Iterable[str | None], lower: bool = True) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty; lower changes A-Z alone."""
    return [(v.encode("utf-8", "surrogatepass").lower() if lower else v.encode("utf-8", "surrogatepass")) if v else b"" for v in values]


def groups_of(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about limit bytes in all; a larger row stands alone."""
    begin = at = total = 0
    for at, size in enumerate(sizes, 1):
        if total and total + size > limit:
            yield begin, at - 1
            begin, total = at - 1, 0
        total += size
    if at > begin:
        yield begin, at
