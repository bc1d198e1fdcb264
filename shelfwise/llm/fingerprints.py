"""Document fingerprints from prefix polynomial hashes.

For a text of code points c the prefix array is P[i] = sum c[k] * b^k (k < i)
modulo 2^31 - 1, for two bases.  ``(P[j] - P[i]) * b^-i`` is the hash of the span
[i, j) wherever it stands, so two spans compare in constant time, and the
longest common extension of two positions is found by binary search.

A fingerprint is the length, the hash of the whole text and the smallest hashes
among all spans of ``WIDTH`` code points (the whole text where it is shorter).
Two fingerprints alone tell how alike the texts are.

Defined cases: a null text is empty; an empty text has no spans and is like
another empty text only; equal texts have equal fingerprints; repeated doc_ids
are ordered by a hash of the text; rows without doc_id come last; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import _batch, arrow_schema, map_rows, mix64, stage

PRIME = (1 << 31) - 1
BASES = (911382323, 972663749)
WIDTH = 24
SKETCH = 48

_P = np.uint64(PRIME)
_31 = np.uint64(31)


def _reduce(x: np.ndarray) -> np.ndarray:
    """Modulo the Mersenne prime 2^31 - 1 for x < 2^62."""
    x = (x & _P) + (x >> _31)
    x = (x & _P) + (x >> _31)
    return np.where(x >= _P, x - _P, x)


class _Powers:
    """Powers of each base and of its inverse, grown on demand once per task."""

    def __init__(self):
        self.tables = [np.ones(1, dtype=np.uint64) for _ in range(4)]

    def get(self, n: int) -> list[np.ndarray]:
        while len(self.tables[0]) < n:
            for i, base in enumerate((BASES[0], BASES[1], pow(BASES[0], -1, PRIME), pow(BASES[1], -1, PRIME))):
                t = self.tables[i]
                self.tables[i] = np.concatenate([t, _reduce(t * np.uint64(pow(base, len(t), PRIME)))])
        return self.tables


POWERS = _Powers()


class PrefixHash:
    """Prefix arrays of one text."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.powers = POWERS.get(self.n + 1)
        values = codes.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for i in range(2):
            p = np.zeros(self.n + 1, dtype=np.uint64)
            np.cumsum(_reduce(values * self.powers[i][:self.n]), out=p[1:])
            self.sums.append(_reduce(p))

    def span(self, i: int, j: int) -> tuple[int, int]:
        """Hash of [i, j), independent of where the span stands."""
        return tuple((int(p[j]) - int(p[i])) * int(self.powers[2 + b][i]) % PRIME for b, p in enumerate(self.sums))

    def spans(self, width: int, start: int = 0) -> np.ndarray:
        """Hashes of all spans of ``width`` from ``start`` on, 62 bits each."""
        m = self.n - width + 1 - start
        if m <= 0:
            return np.zeros(0, dtype=np.uint64)
        out = []
        for b, p in enumerate(self.sums):
            d = p[start + width:start + width + m] + _P - p[start:start + m]
            out.append(_reduce(_reduce(d) * self.powers[2 + b][start:start + m]))
        return (out[0] << _31) | out[1]

    def extension(self, i: int, other: "PrefixHash", j: int) -> int:
        """Length of the longest common extension of ``self[i:]`` and ``other[j:]``."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            if self.span(i, i + mid) == other.span(j, j + mid):
                low = mid
            else:
                high = mid - 1
        return low


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class Fingerprint:
    """Prefix arrays, span hashes and sketch of one text."""

    def __init__(self, text: str, like: "Fingerprint | None" = None, same: int = 0):
        """``same``: so many first code points are those of ``like``, whose span
        hashes are taken over."""
        self.text = text
        self.prefix = PrefixHash(codes_of(text))
        n = self.prefix.n
        kept = max(0, same - WIDTH + 1)
        self.hashes = np.concatenate([like.hashes[:kept], self.prefix.spans(WIDTH, kept)]) if kept else self.prefix.spans(WIDTH)
        whole = self.prefix.span(0, n)
        values = mix64(self.hashes) if n >= WIDTH else np.array([(whole[0] << 31 | whole[1])] if n else [], dtype=np.uint64)
        if n < WIDTH:
            values = mix64(values)
        self.sketch = smallest(values >> np.uint64(32))
        self.value = f"{n:x}-{whole[0]:08x}{whole[1]:08x}-" + "".join(f"{v:08x}" for v in self.sketch.tolist())


def smallest(values: np.ndarray, k: int = SKETCH) -> np.ndarray:
    """The ``k`` smallest distinct values, in order; ties at the border keep the count exact."""
    take = 4 * k
    while len(values) > take:
        part = np.unique(np.partition(values, take)[:take])
        if len(part) >= k:
            return part[:k]
        take *= 4
    return np.unique(values)[:k]


def likeness(a: str, b: str) -> float:
    """Estimated share of spans in common (Dice), from two fingerprints."""
    if a == b:
        return 1.0
    x, y = (_sketch(v) for v in (a, b))
    if not x or not y:
        return 0.0
    union = sorted(x | y)
    if len(x) >= SKETCH or len(y) >= SKETCH:
        union = union[:SKETCH]
    jaccard = sum(1 for v in union if v in x and v in y) / len(union)
    return 2 * jaccard / (1 + jaccard)


def _sketch(fingerprint: str) -> set[str]:
    s = fingerprint.rsplit("-", 1)[1]
    return {s[i:i + 8] for i in range(0, len(s), 8)}


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double, common_edited long, common_next long")


def compare(doc_id, own: Fingerprint, nxt: Fingerprint) -> tuple:
    """Result row: ``own`` against its edited form and against the next text."""
    n = own.prefix.n
    m = n // 3
    edited = own.text[:n - m] + nxt.text[:m]
    other = Fingerprint(edited, own, n - m)
    return (doc_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own.value, other.value,
            likeness(own.value, other.value), likeness(own.value, nxt.value),
            own.prefix.extension(0, other.prefix, 0), own.prefix.extension(0, nxt.prefix, 0))


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited form (the last third replaced
    by the start of the next document in descending doc_id, the first after the
    last) and their likenesses.

    One range shuffle orders the documents; a task streams its range and holds
    two documents at a time.  Only the first and last document of each range
    meet across tasks, in a join on the range number.  The sort keys are numbers:
    Spark samples keys to set the ranges, and no text goes to the driver.
    """
    schema = arrow_schema(OUT + ", kind string, part int, text string")

    def stream(batches):
        part = TaskContext.get().partitionId()
        previous, out = None, []
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = batch.slice(at, 64)
                for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                    current = Fingerprint(text or "")
                    if previous is None:
                        out.append((doc_id, *[None] * 8, "head", part, current.text))
                    else:
                        out.append((*compare(previous[0], previous[1], current), "row", part, None))
                    previous = doc_id, current
                if len(out) >= 512:
                    yield _batch(out, schema)
                    out = []
        if previous is not None:
            out.append((previous[0], *[None] * 8, "tail", part, previous[1].text))
        if out:
            yield _batch(out, schema)

    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text").asc()]
    ranged = documents.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    done = stage(ranged.mapInArrow(stream, OUT + ", kind string, part int, text string"), "fingerprints")
    # one row per range, so as many as tasks
    parts = sorted(r.part for r in done.where("kind = 'head'").select("part").collect())
    follows = documents.sparkSession.createDataFrame(
        [(p, parts[(i + 1) % len(parts)]) for i, p in enumerate(parts)], "part int, next int")
    heads = done.where("kind = 'head'").select(F.col("part").alias("next"), F.col("text").alias("next_text"))
    tails = done.where("kind = 'tail'").select("doc_id", "text", "part").join(follows, "part").join(heads, "next")
    last = map_rows(tails.select("doc_id", "text", "next_text"),
                    lambda d, t, x: compare(d, Fingerprint(t), Fingerprint(x)), OUT)
    return done.where("kind = 'row'").drop("kind", "part", "text").unionByName(last)


def op10_fingerprints(documents: DataFrame) -> DataFrame:
    return fingerprint_documents(documents)
