"""Exact Jaccard join of word shingles in a metric space.

A document is the set A of its distinct word shingles.  The measure metric
d(A, B) = |A xor B| and the Jaccard distance are metrics; sets with Jaccard
similarity s or more have d(A, B) <= (1 - s) / (1 + s) * (|A| + |B|).

*Rings.*  The first pivot is the empty set, at distance |A|.  Its regions are
rings of sizes.  By the triangle inequality a linked partner is at most
|A| / s, so a document near the upper border of its ring is copied into the next
one (the window); a pair meets in the ring of its larger member.

*Cells.*  Document pivots alone cannot divide a ring, for nearly all documents
are at Jaccard distance 1 from each other and from any pivot.  So the shingle
universe is cut by hash into m cells, and every cell is a space of its own whose
pivots are the contents that occur in it; a document lies in the region of its
own content.  d is the sum of the distances in the cells, so with more than T
non-empty cells, T being the largest d of a linked pair in the ring, a linked
pair is at distance 0 in a cell and shares that region.  A region is a key, and
only keys with two or more different sets go on.  A set with u non-empty cells
even shares u - d of them (and at least one region) with a partner, so sets that share fewer with all
others together leave their ring.  Of a shared keys that are left a set needs only
the a - (u - d) + 1 rarest ones, for any u - d of them hold one of these: a passage
of many documents is the first to go.  Regions of the same documents are one.

*Regions* are joined recursively.  Each elects pivots among its documents, the one
that shares most with others first, and measures the others against them (exact
Jaccard distance).  Documents within the bound are linked, and the pivots leave.

After the first round the documents A that one pivot P has met are known by their
difference D = A xor P, and d(A, B) is the distance of two differences.  With one
of them not linked to P, linked A and B share an element of their differences; more
exactly |D| - d of the larger one's and |D| - d / 2 of the smaller one's elements.
So the new regions are the elements (P, e), of which again each document keeps the
rarest ones that suffice, in either role.  Copies with edits of their own, however
many, share no region any more.  Only documents in the smaller role become pivots.

Of those known to be in the first pivot's component only the window stays whose
distance to it is, by the triangle inequality, within the bound of some document of
another component.  Regions with one component left are done; the others go on with
four times as many pivots.

Equal sets are one node throughout, so copies are never paired.  A set is known
by 96 bits of its digest and its size, a shingle by 64 bits.

Defined cases: words are split at ASCII space and A-Z lower-cased; null, empty
and blank texts have no shingles and are linked with nothing; a text shorter than
a shingle is one shingle; equal texts are linked; repeated rows are equal
documents; a null doc_id is no candidate for a component's smallest id unless
all its ids are null; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import arrow_schema, map_rows, mix64, packed, stage, unstage, window_hashes, word_hashes
from shelfwise.llm.graph import components

WIDTH = 5
#: Linked from 80 / 100 on.
NUMERATOR, DENOMINATOR = 80, 100
GROWTH = 1.6
#: Growth of the number of pivots of a region, one at first, from round to round.
PIVOTS = 4
#: Bits of the bitmap of wanted texts, a power of two: 2 MiB.
SLOTS = 1 << 24
EMPTY = b"\0" * 16


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes of one whole text."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(words):
        return words
    if len(words) < width:
        return window_hashes(words, len(words)) ^ np.uint64(len(words))
    return np.unique(window_hashes(words, width))


def node_of(shingles: np.ndarray) -> bytes:
    """96 bits of the set's digest and its size; zeros for the empty set."""
    if not len(shingles):
        return EMPTY
    return hashlib.blake2b(shingles.tobytes(), digest_size=12).digest() + len(shingles).to_bytes(4, "big")


def node_size(column: str):
    """Set size out of a node."""
    return F.conv(F.hex(F.substring(column, 13, 4)), 16, 10).cast("long")


def _ring_borders(limit: int = 1 << 32) -> list[int]:
    out, x = [1], 1.0
    while out[-1] < limit:
        x *= GROWTH
        out.append(max(out[-1] + 1, math.ceil(x)))
    return out


#: Ring r holds the sizes from RINGS[r] up to RINGS[r + 1] - 1.
RINGS = np.array(_ring_borders())


def rings_of(size: int, num: int = NUMERATOR, den: int = DENOMINATOR) -> range:
    """The ring of a size and, in the window, the next ones that hold partners."""
    first = int(np.searchsorted(RINGS, size, side="right")) - 1
    last = int(np.searchsorted(RINGS, size * den // num, side="right")) - 1
    return range(first, last + 1)


def ring_bound(ring: int, num: int = NUMERATOR, den: int = DENOMINATOR) -> int:
    """Largest measure distance of a linked pair whose larger member is in the ring."""
    return (den - num) * 2 * (int(RINGS[ring + 1]) - 1) // (den + num)


def cell_keys(shingles: np.ndarray, num: int = NUMERATOR, den: int = DENOMINATOR) -> list[tuple[int, int, np.ndarray]]:
    """``(ring, least, keys)`` of each ring of a set: a key per non-empty cell, of
    which it shares ``least`` with a linked partner in that ring.  Where hashing
    leaves no more than the bound of cells non-empty (tiny sets, rarely), the empty
    cells are regions as well; a partner beyond the bound has none of these, so
    ``least`` counts non-empty cells only.  Sets that only an equal one can be
    linked to have no keys."""
    out = []
    n = len(shingles)
    for ring in rings_of(len(shingles), num, den):
        bound = ring_bound(ring, num, den)
        if not bound:
            continue
        m = math.ceil(1.2 * (bound + 1) + 3 * math.sqrt(bound + 1))
        # cells follow the order of the sorted hashes
        cells = ((shingles >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
        content = np.add.reduceat(mix64(shingles + np.uint64(1)), starts)
        used = cells[starts]
        largest = min(int(RINGS[ring + 1]) - 1, n * den // num)
        least = max(1, len(used) - (den - num) * (n + largest) // (den + num))
        if len(used) <= bound:
            missing = np.setdiff1d(np.arange(m, dtype=np.uint64), used)
            used, content = np.concatenate([used, missing]), np.concatenate([content, np.zeros(len(missing), dtype=np.uint64)])
        out.append((ring, least, mix64(content + mix64(used * np.uint64(1 << 16) + np.uint64(ring + 1))).view(np.int64)))
    return out


def region_rows(documents: DataFrame, width: int = WIDTH, num: int = NUMERATOR, den: int = DENOMINATOR) -> DataFrame:
    """``key, node, quota`` rows of all sets; quota holds the ring and the least
    number of keys to share in it.  A task sends equal sets once."""
    ddl = "key long, node binary, quota long"
    schema = arrow_schema(ddl)

    def run(batches):
        seen: set[bytes] = set()
        keys, nodes, quotas, rows = [], [], [], 0

        def flush():
            raw = b"".join(n * len(k) for n, k in zip(nodes, keys, strict=True))
            column = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), rows, [None, pa.py_buffer(raw)]).cast(pa.binary())
            quota = np.repeat(np.array(quotas, dtype=np.int64), [len(k) for k in keys])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), column, pa.array(quota)], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                for text in batch.column(0).slice(at, 128).to_pylist():
                    shingles = shingle_set(text, width)
                    node = node_of(shingles)
                    if not len(shingles) or node in seen:
                        continue
                    seen.add(node)
                    for ring, least, k in cell_keys(shingles, num, den):
                        keys.append(k)
                        nodes.append(node)
                        quotas.append(ring << 32 | least)
                        rows += len(k)
                    if rows >= 100_000:
                        yield flush()
                        keys, nodes, quotas, rows = [], [], [], 0
        if rows:
            yield flush()

    return documents.select("text").mapInArrow(run, ddl)


def distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, common, joined`` sizes of intersection and union of node pairs."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", F.size(F.array_intersect("x", "y")).cast("long").alias("common"),
                                                       (F.size("x") + F.size("y")).cast("long").alias("both"))
    return met.select("a", "b", "common", (F.col("both") - F.col("common")).alias("joined"))


def rarest_regions(regions: DataFrame) -> DataFrame:
    """``key, node, w`` rows of the keys that suffice of ``key, node, quota``: of a
    set's keys in a ring all but ``least`` - 1, which are the most frequent ones by
    an order that all sets have in common, so linked sets keep the rarest key that
    they share.  Keys of the same nodes are reduced to one.  ``w`` is how often a
    node meets others."""
    frequent = regions.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    ranked = (regions.join(frequent, "key").withColumn("w", F.sum("n").over(Window.partitionBy("node")))
              .withColumn("a", F.count("*").over(Window.partitionBy("node", "quota")))
              .withColumn("r", F.row_number().over(Window.partitionBy("node", "quota").orderBy("n", "key"))))
    kept = stage(ranked.where("r <= a - (quota & 4294967295L) + 1").select("key", "node", "w"), "rarest")
    held = kept.groupBy("key").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"))
    alone = held.where("m > 1").groupBy("m", "x", "y").agg(F.min("key").alias("key")).select("key")
    out = stage(kept.join(alone, "key"), "regions")
    unstage(kept)
    return out


def _linked(num: int, den: int):
    return F.col("common") * den >= F.col("joined") * num


def join_regions(regions: DataFrame, sets: DataFrame, num: int = NUMERATOR, den: int = DENOMINATOR) -> tuple[DataFrame | None, DataFrame]:
    """Recursive join of ``key, node, w`` regions: (edges, components).  The nodes
    of most weight ``w`` are the first pivots."""
    active = regions.withColumn("away", F.lit(0).cast("long")).withColumn("small", F.lit(True))
    edges = measured = None
    labels = stage(regions.select("node", F.col("node").alias("root")).limit(0), "components")
    pivots = 1
    size, other = node_size("node"), node_size("pivot")
    while True:
        # the first of each region by weight, then node, measure the others
        order = Window.partitionBy("key").orderBy(F.desc("w"), F.desc("node"))
        chosen = active.where("small").withColumn("r", F.row_number().over(order)).where(F.col("r") <= pivots)
        chosen = _with_root(chosen.select("key", "r", F.col("w").alias("pw"), F.col("away").alias("pivot_away"), F.col("node").alias("pivot")),
                            labels, "pivot", "pivot_root")
        met = (_with_root(active, labels, "node", "root").join(chosen, "key").where("node <> pivot")
               .where(~F.col("small") | (F.struct("w", "node") < F.struct("pw", "pivot")))
               .where("root <> pivot_root"))        # one component needs no more links
        if measured is not None:    # the first round needs all differences
            met = met.where((size * den >= other * num) & (other * den >= size * num)
                            & (F.abs(F.col("away") - F.col("pivot_away")) * (den + num) <= (size + other) * (den - num)))
        pairs = met.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
        if measured is not None:
            pairs = pairs.join(measured.select("a", "b"), ["a", "b"], "left_anti")
        fresh = stage(distances(pairs, sets), "distances")
        found = fresh.where(_linked(num, den)).select("a", "b")
        if not found.isEmpty():
            edges = found if edges is None else edges.unionByName(found)
            labels = stage(components(edges), "components")
        if measured is None:
            measured = fresh
            active = difference_regions(fresh, sets, labels, num, den)
            unstage(regions)
        else:
            measured, before = measured.unionByName(fresh), active
            active = _others(active, chosen, measured, labels, 1 - num / den)
            unstage(before)
            pivots *= PIVOTS
        if active.isEmpty():
            return edges, labels


def _others(active: DataFrame, chosen: DataFrame, measured: DataFrame, labels: DataFrame, bound: float) -> DataFrame:
    """Regions with several components, without this round's pivots and without
    what is too far from all other components."""
    rooted = _with_root(active, labels, "node", "root")
    several = rooted.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("key")
    gone = chosen.select("key", F.col("pivot").alias("node"))
    first = _with_root(chosen.where("r = 1").select("key", F.col("pivot").alias("p")), labels, "p", "p_root")
    known = measured.select(F.col("a").alias("p"), F.col("b").alias("node"), (1 - F.col("common") / F.col("joined")).alias("d"))
    rest = stage(rooted.join(several, "key").join(gone, ["key", "node"], "left_anti").join(first, "key")
                 .join(known, ["p", "node"], "left").select("key", "node", "w", "away", "small", "root", "p_root", "d"), "rest")
    # an unmeasured distance (sizes too far apart, or one component before) excludes nothing
    outside = F.col("root") != F.col("p_root")
    per_key = rest.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.max("small").alias("open"),
                                      F.min(F.when(outside, F.coalesce("d", F.lit(0.0)))).alias("low"),
                                      F.max(F.when(outside, F.coalesce("d", F.lit(1.0)))).alias("high"))
    window = outside | F.col("d").isNull() | F.col("d").between(F.col("low") - bound - 1e-9, F.col("high") + bound + 1e-9)
    out = stage(rest.join(per_key.where("open AND r0 <> r1"), "key").where(window).select("key", "node", "w", "away", "small"), "regions")
    unstage(rest)
    return out


def difference_regions(met: DataFrame, sets: DataFrame, labels: DataFrame, num: int = NUMERATOR, den: int = DENOMINATOR) -> DataFrame:
    """``key, node, w, away, small`` regions of the documents ``b`` that a pivot ``a``
    has met: elements in which they differ from it.  ``away`` is the size of the
    difference; ``small`` rows can be the smaller one of a linked pair."""
    rooted = _with_root(met.select("a", "b", (F.col("joined") - F.col("common")).alias("away")), labels, "b", "root")
    several = rooted.groupBy("a").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("a")
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    differ = F.concat(F.array_except("x", "y"), F.array_except("y", "x"))
    rows = stage(rooted.join(several, "a").join(left, "a").join(right, "b")
                 .select(F.xxhash64("a").alias("p"), F.col("b").alias("node"), "root", "away", F.explode(differ).alias("e"))
                 .select("p", F.xxhash64("p", "e").alias("key"), "node", "root", "away"), "differences")
    # of the elements that a linked partner with a larger (smaller) difference must share
    as_small = F.greatest(F.lit(1), F.col("away") - F.floor(node_size("node") * (den - num) / (2 * num)))
    as_large = F.greatest(F.lit(1), F.col("away") - F.floor(node_size("node") * (den - num) / num))
    own = Window.partitionBy("p", "node")

    def met_in(rows):
        """Rows of the elements that a pair can share, with their number by element and by document."""
        held = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("small").alias("open"), F.min("root").alias("r0"), F.max("root").alias("r1"))
        return rows.join(held.where("open AND r0 <> r1").select("key", "n"), "key").withColumn("c", F.count("*").over(own))

    # documents without enough of them make other elements lonely, as above
    enough = stage(met_in(rows.withColumn("small", F.lit(True))).where(F.col("c") >= as_large)
                   .select("p", "key", "node", "root", "away", (F.col("c") >= as_small).alias("small")), "differences")
    unstage(rows)
    kept = stage(met_in(enough).withColumn("r", F.row_number().over(own.orderBy("n", "key"))).where(F.col("r") <= F.col("c") - as_large + 1)
                 .select("p", "key", "node", "root", "away", (F.col("small") & (F.col("r") <= F.col("c") - as_small + 1)).alias("small")), "rarest")
    unstage(enough)
    held = kept.groupBy("key").agg(F.first("p").alias("p"), F.max("small").alias("open"), F.min("root").alias("r0"), F.max("root").alias("r1"),
                                   F.bit_xor(F.xxhash64("node", "small")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node", "small")).alias("y"))
    alone = held.where("open AND r0 <> r1").groupBy("p", "x", "y").agg(F.min("key").alias("key")).select("key")
    out = stage(kept.join(alone, "key").select("key", "node", (-F.col("away")).alias("w"), "away", "small"), "regions")
    unstage(kept)
    return out


def _with_root(rows: DataFrame, labels: DataFrame, node: str, root: str) -> DataFrame:
    """Adds the component of a node, the node itself where it has no edge."""
    named = labels.select(F.col("node").alias(node), F.col("root").alias(root))
    return rows.join(named, node, "left").withColumn(root, F.coalesce(root, node))


def _maybe(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``text, text_key`` rows without most of those whose key is not wanted: a bitmap
    of ``SLOTS`` bits, whatever the data, is broadcast, so they are not shuffled."""
    slot = F.col("text_key").bitwiseAND(F.lit(SLOTS - 1))
    bucket, at = F.shiftright(slot, 15), slot.bitwiseAND(F.lit((1 << 15) - 1))
    bits = wanted.select(bucket.alias("bucket"), at.alias("at")).repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(at, 3).cast("int") + 1, 1)), 16, 10).cast("int")
    met = texts.join(F.broadcast(bits), bucket == F.col("bucket"))
    return met.where(byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0).select("text", "text_key")


def link_documents(documents: DataFrame, width: int = WIDTH, num: int = NUMERATOR, den: int = DENOMINATOR) -> DataFrame:
    """``doc_id, n_shingles, component_id, node, root, text_key`` of every document;
    the root is a node that names the component."""
    members = stage(map_rows(documents.select("doc_id", "text", F.xxhash64("text").alias("text_key")),
                             lambda d, t, k: (d, k, node_of(shingle_set(t, width))), "doc_id long, text_key long, node binary"), "members")
    rows = region_rows(documents, width, num, den)
    regions = rows.withColumn("n", F.count("*").over(Window.partitionBy("key"))).where("n > 1").select("key", "node", "quota").distinct()
    regions = stage(regions, "regions")
    # leaving sets make other keys lonely, which the choice of the rarest counts again
    enough = stage(regions.withColumn("n", F.count("*").over(Window.partitionBy("node", "quota")))
                   .where(F.col("n") >= F.expr("quota & 4294967295L")).drop("n"), "enough")
    unstage(regions)
    regions = rarest_regions(enough)
    unstage(enough)
    # whole sets of the documents in regions, one document a set
    wanted = stage(members.join(regions.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.min("text_key").alias("text_key"))
                   .select("text_key").distinct(), "wanted")
    texts = _maybe(documents.select("text", F.xxhash64("text").alias("text_key")), wanted).join(wanted, "text_key", "left_semi")
    to_set = lambda t: (node_of(s := shingle_set(t, width)), s.view(np.int64))
    sets = stage(map_rows(texts.select("text"), to_set, "node binary, shingles array<long>", 64).dropDuplicates(["node"]), "sets")
    _, labels = join_regions(regions, sets, num, den)
    unstage(sets, wanted)
    # smallest id by node, then by component
    nodes = members.groupBy("node").agg(F.min("doc_id").alias("least")).join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    by_node = nodes.join(least, "root").select("node", "root", "component_id")
    blank = F.col("node") == F.lit(EMPTY)
    return (members.join(by_node, "node")
            .select("doc_id", node_size("node").alias("n_shingles"), F.when(blank, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "node", "root",
                    "text_key"))


def op3_jaccard_join(documents: DataFrame) -> DataFrame:
    return link_documents(documents).select("doc_id", "n_shingles", "component_id")


def one_per_group(documents: DataFrame, width: int = WIDTH, num: int = NUMERATOR, den: int = DENOMINATOR) -> DataFrame:
    """One row of each group: of its smallest doc_id, or without any of its first
    text by hash.  A text without shingles is a group of its own, and rows of it
    without doc_id all stay."""
    linked = link_documents(documents.select("doc_id", "text"), width, num, den)
    blank = F.col("node") == F.lit(EMPTY)
    groups = linked.groupBy("root", F.when(blank, F.col("doc_id")).alias("i"), F.when(blank, F.col("text_key")).alias("t"))
    first = groups.agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", blank.alias("blank"))).alias("f"))
    kept = first.select(F.col("f.doc_id").alias("id"), F.col("f.text_key").alias("key"), (F.col("f.none") & F.col("f.blank")).alias("every"))
    rows = packed(documents, "doc_id", "text").withColumn("hash", F.xxhash64("text"))
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(kept["id"]) & (rows["hash"] == kept["key"]))
    rows = rows.withColumn("own", F.when(F.col("every"), F.monotonically_increasing_id()))
    same = Window.partitionBy("doc_id", "hash", "own").orderBy(F.xxhash64("text"))
    return rows.withColumn("place", F.row_number().over(same)).where("place = 1").select("row.*")
