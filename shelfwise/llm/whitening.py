"""Embedding whitening from bit-sliced, exact integer cross-products.

Each entry c of a vector becomes the integer x = floor(256 * c).  The fit list
holds each distinct x-vector once.  Its entries, shifted to be non-negative, are
written as bit planes: plane (j, b) packs bit b of dimension j of 64 rows into one
word.  The sum over rows of a product of two dimensions is then

    sum over b, c of 2^(b + c) * popcount(plane(j, b) AND plane(k, c)),

exact in integers; sums of one dimension are weighted popcounts too.  Tasks pass
on one total per pair of dimensions, cut into limbs of 31 bits, so plain long sums
stay exact for any long x and any number of rows.  The scatter is centred in
integers (n * M - S * S', free of the shift) before it becomes a matrix of doubles
for ``eigh``.  The d x d totals are all that reaches the driver.

Defined cases: rows whose vector is null, or holds an entry that is null, not
finite or too large for a long x, are dropped.  A vector shorter than the longest
one counts as ending in zeros (the fit list tells them apart before that).  There are as many components as dimensions, four at
most.  A component without variance (a single vector, equal columns) is whitened
to 0.0 and left out of ``identity_error``, which is 0.0 if none is left; ``explained``
is 0.0 where the trace is 0.  A ``deviation`` beyond a long is null in the query (the
operator's is a decimal(38), null beyond that).  Repeated rows, null vec_ids and ties
keep their rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import arrow_schema, stage, unstage

SCALE = 256
COMPONENTS = 4
BLOCK = 4096            # rows sliced at once: 64 words a plane
LIMB, LIMBS = 31, 6     # 6 * 31 bits: products of two longs, summed over 2^58 rows
_LIMB_COLUMNS = [f"l{i}" for i in range(LIMBS)]


def quantised(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``embeddings`` with ``x`` (array of longs) in place of the vector; rows that
    cannot be written so are dropped."""
    rest = [c for c in embeddings.columns if c != vector]
    scaled = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * SCALE))
    # floor() saturates at the ends of a long; those and NaN (as 0) are seen in the doubles
    held = F.forall(F.col(vector), lambda c: F.coalesce(F.abs(c.cast("double") * SCALE) < float(2**63), F.lit(False)))
    return embeddings.where(F.col(vector).isNotNull() & held).select(*rest, scaled.alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Arrow list column as rows x width longs, short vectors ending in zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def planes(y: np.ndarray, bits: int) -> np.ndarray:
    """(dimension, bit, word) of non-negative longs (rows x dimensions, as uint64)."""
    rows, width = y.shape
    words = -(-rows // 64)
    shift = np.arange(bits, dtype=np.uint64)
    out = np.zeros((width, bits, words * 8), dtype=np.uint8)
    for j in range(width):
        of_bit = ((y[:, j] >> shift[:, None]) & np.uint64(1)).astype(np.uint8)
        packed = np.packbits(of_bit, axis=1)
        out[j, :, :packed.shape[1]] = packed
    return out.view(np.uint64)


def cross_counts(p: np.ndarray) -> np.ndarray:
    """Popcounts by (j, k, weight b + c) for j <= k; entries with j > k stay 0."""
    width, bits, _ = p.shape
    out = np.zeros((width, width, 2 * bits - 1), dtype=np.int64)
    for j in range(width):
        for b in range(bits):
            met = np.bitwise_count(p[j:] & p[j, b]).sum(axis=2, dtype=np.int64)      # (k, c)
            out[j, j:, b:b + bits] += met
    return out


def plane_counts(p: np.ndarray) -> np.ndarray:
    return np.bitwise_count(p).sum(axis=2, dtype=np.int64)


def _weighted(counts: np.ndarray) -> int:
    return sum(int(c) << w for w, c in enumerate(counts))


def _limbs(total: int) -> list[int]:
    return [(total >> (LIMB * i)) & ((1 << LIMB) - 1) for i in range(LIMBS)]


def _scatter_task(width: int, low: int, bits: int):
    """Totals of a task: (j, k, limbs) for j <= k, and (-1, k, limbs) for the sums."""
    schema = arrow_schema("j int, k int, " + ", ".join(f"{c} long" for c in _LIMB_COLUMNS))

    def run(batches):
        cross = np.zeros((width, width, 2 * bits - 1), dtype=np.int64)
        ones = np.zeros((width, bits), dtype=np.int64)
        seen = False
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                x = _matrix(batch.column(0).slice(at, BLOCK), width)
                p = planes(x.astype(np.uint64) - np.uint64(low % 2**64), bits)     # wraps to x - low
                cross += cross_counts(p)
                ones += plane_counts(p)
                seen = True
        if not seen:
            return
        rows = [(-1, k, *_limbs(_weighted(ones[k]))) for k in range(width)]
        rows += [(j, k, *_limbs(_weighted(cross[j, k]))) for j in range(width) for k in range(j, width)]
        for at in range(0, len(rows), 1 << 16):
            part = rows[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)

    return run, schema


@dataclass(frozen=True)
class Whitening:
    """Fitted transformation; ``sums`` and ``n`` are exact."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray          # falling, the kept components only
    vectors: np.ndarray         # dimension x component
    identity_error: float = 0.0

    @property
    def width(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) if self.trace > 0 else 0.0 for e in self.values]

    @property
    def weights(self) -> np.ndarray:
        """Components over the root of their variance; 0 where there is none."""
        live = self.live
        root = np.sqrt(np.where(live, self.values, 1.0))
        return np.where(live, self.vectors / root, 0.0)

    @property
    def live(self) -> np.ndarray:
        return self.values > max(self.trace, 0.0) * self.width * np.finfo(float).eps

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S: longs where they hold it, Python integers beyond."""
        most = max([1, *(abs(s) for s in self.sums)]) + self.n * int(max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))))
        if self.width * most * most < 2**63:
            return x * np.int64(self.n) - np.array(self.sums, dtype=np.int64)
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def project(self, centred: np.ndarray) -> np.ndarray:
        x = (centred / self.n).astype(np.float64)
        # row by row in one order, unlike a matrix product: reruns agree to the last bit
        return np.stack([(x * w).sum(axis=1) for w in self.weights.T], axis=1)


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of a staged fit list with one column ``x``; None if it is empty."""
    span = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width"),
                        F.min(F.array_min("x")).alias("low"), F.max(F.array_max("x")).alias("high"),
                        F.min(F.size("x")).alias("least")).first()
    if not span["n"]:
        return None
    n, width = span["n"], span["width"]
    if width == 0:
        return Whitening(n, [], 0.0, np.zeros(0), np.zeros((0, 0)))
    low, high = span["low"], span["high"]
    if span["least"] < width:
        low, high = min(low, 0), max(high, 0)
    bits = max(1, (high - low).bit_length())
    run, schema = _scatter_task(width, low, bits)
    totals = (distinct.select("x").mapInArrow(run, "j int, k int, " + ", ".join(f"{c} long" for c in _LIMB_COLUMNS))
              .groupBy("j", "k").agg(*(F.sum(c).alias(c) for c in _LIMB_COLUMNS)).collect())   # d * (d + 3) / 2 rows
    held = {(r["j"], r["k"]): sum(r[c] << (LIMB * i) for i, c in enumerate(_LIMB_COLUMNS)) for r in totals}
    shifted = [held[-1, k] for k in range(width)]
    v = np.zeros((width, width))
    for j in range(width):
        for k in range(j, width):
            v[j, k] = v[k, j] = (n * held[j, k] - shifted[j] * shifted[k]) / (n * n)
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    vectors = vectors[:, order]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    model = Whitening(n, [s + n * low for s in shifted], float(np.trace(v)), np.maximum(values[order], 0.0), vectors)
    return Whitening(n, model.sums, model.trace, model.values, model.vectors, _identity_error(distinct, model))


def _identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest entry of the covariance of the whitened fit list less the identity,
    taken from the whitened vectors themselves."""
    k = len(model.values)
    schema = arrow_schema("i int, j int, total double")

    def run(batches):
        total = np.zeros((k, k))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                w = model.project(model.centred(_matrix(batch.column(0).slice(at, BLOCK), model.width)))
                total += w.T @ w        # centred already: n * x - S adds up to 0 exactly
        i, j = np.indices((k, k))
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], schema=schema)

    rows = distinct.select("x").mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("t")).collect()
    c = np.zeros((k, k))
    for r in rows:
        c[r["i"], r["j"]] = r["t"] / model.n
    live = model.live
    return float(np.abs(c - np.eye(k))[np.ix_(live, live)].max(initial=0.0))


def transform(rows: DataFrame, model: Whitening, key: str = "vec_id") -> DataFrame:
    """``key, deviation, whitened`` (array, one entry a component) of quantised rows."""
    ddl = f"{key} {rows.schema[key].dataType.simpleString()}, deviation decimal(38,0), whitened array<double>"
    schema = arrow_schema(ddl)
    most = 10**38

    def run(batches):
        import decimal

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                c = model.centred(_matrix(part.column(1), model.width))
                deviation = [decimal.Decimal(int(s)) if s < most else None for s in (c * c).sum(axis=1)]
                w = model.project(c)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(deviation, schema.field(1).type), lists.cast(schema.field(2).type)], schema=schema)

    return rows.select(key, "x").mapInArrow(run, ddl)


def whiten(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """Whitened rows (see :func:`transform`) and the fitted model."""
    rows = quantised(embeddings.select(key, vector), vector)
    distinct = stage(rows.select("x").distinct(), "whitening-distinct")
    model = fit(distinct, components)
    unstage(distinct)
    if model is None or not model.width:
        empty = rows.where("false").selectExpr(key, "cast(null as decimal(38,0)) deviation", "cast(null as array<double>) whitened")
        return empty, model
    return transform(rows, model, key), model


def op11_whitening(embeddings: DataFrame) -> DataFrame:
    rows, model = whiten(embeddings)
    n, explained, error = (model.n, model.explained, model.identity_error) if model else (0, [], 0.0)
    shares = F.array(*map(F.lit, explained)).cast("array<double>") if explained else F.lit(None).cast("array<double>")
    return (rows.select("vec_id", F.expr("try_cast(deviation AS bigint)").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.element_at(shares, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error")))
