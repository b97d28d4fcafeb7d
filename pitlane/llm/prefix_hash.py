"""Document fingerprints from prefix polynomial hashes.

A text's prefix array holds, modulo two primes, the polynomial hash of each of its
beginnings.  Any span's hash follows from two entries, so spans are
compared in constant time and the longest common extension of two positions is found by
binary search.  The fingerprint is the whole text's hash and length, a ladder (the
prefix array's entries modulo the first prime at 1, 2, 4, ... code points) and a sketch: the
smallest mixed hashes among all spans of ``SPAN`` code points, ``SKETCH`` of them or one
for each ``EACH`` code points, whichever is more.  Two fingerprints alone tell whether spans between
rungs are equal, and a binary search of their ladders brackets the common beginning.  Their
likeness is the share of spans in common (Dice) as the sketches estimate it, at least the
share that the equal beginning proves, 1 for equal texts.  A sketch of k hashes
estimates the Jaccard share J with standard error sqrt(J (1 - J) / k).

The query compares each document with its neighbour in descending id order.
Documents are range-partitioned by id and hash of text, so rows of one id spread, too; each task
pairs the rows within its range, and only its last row and its first row travel on to be paired across ranges.

Defined cases: null text counts as empty; texts shorter than ``SPAN`` are one
span; null ids come last, rows of equal id are ordered by the XXH64 of their text, then the text; a single row is
its own neighbour; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import staged

PRIMES = (2**31 - 1, 2**31 - 19)
BASES = (911_382_323, 972_663_749)
SPAN = 8
SKETCH = 64
EACH = 256  # 3 bytes in 100 of a long text, for both of its fingerprints: the disk budget has no more
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LENGTH = 10  # hex digits of the length in a fingerprint

_powers: list[list[np.ndarray]] = [[np.ones(1, np.uint64)] * 2, [np.ones(1, np.uint64)] * 2]


def powers(n: int) -> list[list[np.ndarray]]:
    """For each prime, the powers of its base and of the base's inverse, at least ``n`` of them."""
    while len(_powers[0][0]) < n:
        for pair, prime, base in zip(_powers, PRIMES, BASES, strict=True):
            for k, b in enumerate((base, pow(base, -1, prime))):
                step = np.uint64(pow(b, len(pair[k]), prime))
                pair[k] = np.concatenate([pair[k], pair[k] * step % np.uint64(prime)])
    return _powers


class PrefixHash:
    """Prefix arrays of one text."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        self.arrays = []
        for (up, _), prime in zip(powers(self.n + 1), PRIMES, strict=True):
            # terms are below 2^31, so sums of up to 2^33 of them fit
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(codes * up[: self.n] % np.uint64(prime), out=sums[1:])
            self.arrays.append(sums % np.uint64(prime))

    def span(self, start: int, end: int) -> tuple[int, int]:
        """Hash of text[start:end], the same wherever the span stands."""
        return tuple(
            (int(a[end]) - int(a[start])) * int(down[start]) % prime for a, (_, down), prime in zip(self.arrays, powers(self.n + 1), PRIMES, strict=True)
        )

    def common_extension(self, start: int, other: PrefixHash, at: int) -> int:
        """Length of the longest common span from ``start`` here and ``at`` there, by binary search."""
        low, high = 0, min(self.n - start, other.n - at)
        while low < high:
            mid = (low + high + 1) // 2
            if self.span(start, start + mid) == other.span(at, at + mid):
                low = mid
            else:
                high = mid - 1
        return low

    def spans(self, width: int) -> np.ndarray:
        """Mixed 64-bit hashes of all spans of ``width`` code points (of the whole text, if shorter)."""
        width = min(width, self.n)
        if not width:
            return np.zeros(0, np.uint64)
        out = np.zeros(self.n - width + 1, np.uint64)
        for a, (_, down), prime in zip(self.arrays, powers(self.n + 1), PRIMES, strict=True):
            value = (a[width:] + np.uint64(prime) - a[: len(out)]) % np.uint64(prime) * down[: len(out)] % np.uint64(prime)
            out = (out << np.uint64(31)) ^ value
        with np.errstate(over="ignore"):
            out ^= out >> np.uint64(29)
            out *= _MIX
            out ^= out >> np.uint64(32)
            return out * _MIX

    def fingerprint(self, width: int = SPAN) -> str:
        """Hex: whole hash (16 digits), length, the ladder's entries and the sketch's 32-bit values in order."""
        whole = "".join(f"{h:08x}" for h in self.span(0, self.n))
        ladder = "".join(f"{h:08x}" for h in self.arrays[0][rungs(self.n)].tolist())
        hashes, sketch = self.spans(width) >> np.uint64(32), sketch_size(self.n)
        if len(hashes) > 8 * sketch:  # most texts: the smallest are below a multiple of their expected bound
            few = np.unique(hashes[hashes < np.uint64((sketch * 4 << 32) // len(hashes))])
            hashes = few if len(few) >= sketch else hashes
        return whole + f"{self.n:0{_LENGTH}x}" + ladder + "".join(f"{h:08x}" for h in np.unique(hashes)[:sketch].tolist())


def rungs(n: int) -> list[int]:
    """The ladder's positions in a text of ``n`` code points: the powers of two below it."""
    return [1 << k for k in range(max(n - 1, 0).bit_length())]


def sketch_size(n: int) -> int:
    """Most hashes in the sketch of a text of ``n`` code points."""
    return max(SKETCH, n // EACH)


class Fingerprint:
    """A fingerprint's parts: ``n`` code points, ``entries`` of the prefix array by position, ``sketch``."""

    def __init__(self, text: str):
        head = 16 + _LENGTH
        self.n = int(text[16:head], 16)
        positions = rungs(self.n)
        values = [text[i : i + 8] for i in range(head, len(text), 8)]
        self.entries = {0: 0, **{p: int(v, 16) for p, v in zip(positions, values, strict=False)}, self.n: int(text[:8], 16) if self.n else 0}
        self.sketch = values[len(positions) :]

    def span(self, start: int, end: int) -> int:
        """Hash of the span between two positions of the ladder (0 and ``n`` among them), the same wherever it stands."""
        return (self.entries[end] - self.entries[start]) * pow(BASES[0], -start, PRIMES[0]) % PRIMES[0]

    def common_beginning(self, other: Fingerprint) -> tuple[int, int]:
        """Least and greatest length the two texts' common beginning can have, by binary search of the ladders."""
        shared = sorted(self.entries.keys() & other.entries.keys())
        low, high = 0, len(shared) - 1  # the entries at 0 agree
        while low < high:
            mid = (low + high + 1) // 2
            if self.entries[shared[mid]] == other.entries[shared[mid]]:
                low = mid
            else:
                high = mid - 1
        return shared[low], shared[low + 1] - 1 if low + 1 < len(shared) else min(self.n, other.n)


def likeness(a: str, b: str) -> float:
    """Estimated share of spans in common of two fingerprinted texts, 0 to 1."""
    if a == b:
        return 1.0
    one, two = Fingerprint(a), Fingerprint(b)
    if not one.n or not two.n:
        return 0.0
    x, y = set(one.sketch), set(two.sketch)
    least = sorted(x | y)[: min(sketch_size(one.n), sketch_size(two.n))]  # both sketches are complete this far
    shared = sum(h in x and h in y for h in least) / len(least)
    proven = 2 * max(one.common_beginning(two)[0] - SPAN + 1, 0) / (max(one.n - SPAN + 1, 1) + max(two.n - SPAN + 1, 1))
    return max(2 * shared / (1 + shared), proven)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the beginning of ``following``."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


# fingerprints travel as bytes, half their hex form
_RESULT = "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, common_prefix long"
_NAMES = [c.split()[0] for c in _RESULT.split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int64()]


class _Rows:
    """Compares consecutive texts, hashing each once."""

    def __init__(self):
        self.out: list[list] = [[] for _ in _NAMES]

    def add(self, doc: int | None, text: str, hashed: PrefixHash, own: str, following: str, following_print: str) -> None:
        changed = edited(text, following)
        other = PrefixHash(changed)
        changed_print = other.fingerprint()
        sha = hashlib.sha256(changed.encode()).digest()
        near = likeness(own, changed_print), likeness(own, following_print)
        row = (doc, len(text), sha, bytes.fromhex(own), bytes.fromhex(changed_print), *near, hashed.common_extension(0, other, 0))
        for column, value in zip(self.out, row, strict=True):
            column.append(value)

    def flush(self) -> list[pa.Array]:
        arrays = [pa.array(c, k) for c, k in zip(self.out, _KINDS, strict=True)]
        self.out = [[] for _ in _NAMES]
        return arrays


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all rows but the range's last; its first and last row with their texts, marked by ``edge``."""
    part, rows = TaskContext.get().partitionId(), _Rows()
    names = [*_NAMES, "part", "edge", "text"]

    def result():
        arrays = rows.flush()
        n = len(arrays[0])
        return pa.RecordBatch.from_arrays([*arrays, pa.array([part] * n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], names)

    def edge(kind, doc, text):
        nothing = [pa.nulls(1, k) for k in _KINDS[1:]]
        return pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), *nothing, pa.array([part], pa.int32()), pa.array([kind]), pa.array([text])], names)

    last = None
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            text = text.as_py() or ""
            hashed = PrefixHash(text)
            own = hashed.fingerprint()
            if last is None:
                yield edge("first", doc, text)
            else:
                rows.add(*last, text, own)
            last = (doc, text, hashed, own)
        yield result()
    if last is not None:
        yield edge("last", last[0], last[1])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _Rows()
    for batch in batches:
        for doc, text, following in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")), strict=True):
            hashed = PrefixHash(text)
            rows.add(doc, text, hashed, hashed.fingerprint(), following, PrefixHash(following).fingerprint())
        yield pa.RecordBatch.from_arrays(rows.flush(), _NAMES)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, common_prefix."""
    order = F.col("doc_id").desc_nulls_last()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranged = texts.repartitionByRange(order, F.xxhash64("text")).sortWithinPartitions(order, F.xxhash64("text"), "text")
    done = staged(ranged.mapInArrow(_within, f"{_RESULT}, part int, edge string, text string"), "within")
    edges = done.where("edge IS NOT NULL")
    parts = sorted(r["part"] for r in edges.where("edge = 'first'").select("part").collect())  # one number per range
    spark = docs.sparkSession
    columns = [F.lower(F.hex(c)).alias(c) if kind == pa.binary() else c for c, kind in zip(_NAMES, _KINDS, strict=True)]
    if not parts:
        return done.select(*columns)
    following = spark.createDataFrame(list(zip(parts, [*parts[1:], parts[0]], strict=True)), "part int, follows int")
    firsts = edges.where("edge = 'first'").select(F.col("part").alias("follows"), F.col("text").alias("following"))
    lasts = edges.where("edge = 'last'").select("doc_id", "text", "part").join(following, "part").join(firsts, "follows")
    pairs = lasts.select("doc_id", "text", "following").mapInArrow(_across, _RESULT)
    return done.where("edge IS NULL").select(*_NAMES).unionByName(pairs).select(*columns)
