"""Prefix trie of conversations, its subtree totals by time-forward processing.

Two conversations share a node as far as their first turns are equal (role and
text).  The steps:

1. Turns are range-partitioned and sorted by (conversation, turn), texts left out: a
   turn is its SHA-256 and its number of words.  A prefix is known by a polynomial
   of its turns' digests modulo 2^127 - 1 and by its depth.  Such sums are taken
   within a partition and completed by what lies in earlier partitions, so a
   conversation of any length may span many partitions.
2. Each conversation is rebuilt (:func:`rebuilt`): its first turns come from the
   first conversation of its group, and the prefix sums are shifted to fit.
3. Equal prefixes become nodes with their members counted, combined before the
   shuffle.  Nodes of a single conversation form bare chains whose totals are known
   (one leaf, nothing saved); only the top of each chain enters the next step.
4. Nodes go to shards.  A shard is the subtree of the first node on the way down
   that has at most ``shard_nodes`` nodes, so a frequent first turn is cut at its
   second, third, ... ``HEAD``-th turn.  A task gets the shards of its hash bucket,
   sorted by Spark in reverse level order, deepest nodes first.  Each node takes the
   messages waiting for it from a priority queue, adds them to its own values, and
   sends the totals to the queue under its parent's key, which comes later in the
   order.  A queue beyond ``QUEUE`` messages spills sorted runs to an anonymous file
   of the task (gone with it) and merges them on the way out.
5. Across shard roots: each root's totals are passed on to the nodes above it, at
   most ``HEAD`` of them, combined before the shuffle.

A subtree whose members share ``HEAD`` turns and that still has more nodes is one
shard: its task streams it with the spilling queue.  The SHA-256 of the members that
end at a node is a chain by definition; sorted ids are joined into pieces by many
tasks, and one task a node digests the pieces in order.

Defined cases: null role and text are empty; rows without conv_id are left out; turns
are ordered with null first, then by number, equal numbers by the digest of role and
text; repeated rows are turns of their own; a conversation's group is found with
SQL's remainder; an empty table has no node, not even the root; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from itertools import groupby, islice
from operator import itemgetter

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import _batch, arrow_schema, map_rows, stage, unstage

GROUP, HEADS = 20, 4        # conversation c starts like c - c % GROUP, for crc32(c) % HEADS turns
HEAD = 4                    # turns by which a large subtree may be cut
SHARD_NODES = 4096
QUEUE = 1 << 16
IDS = 4096
WORDS_RE = r"[^\x20\x09-\x0D]+"
_P = 2**127 - 1
# any fixed number will do: the digests it is multiplied with cannot be chosen freely
_BASE = int.from_bytes(hashlib.sha256(b"prefix of turns").digest()[:15], "big")
_INVERSE = pow(_BASE, -1, _P)
ROOT = bytes(16)


def _number(b: bytes) -> int:
    return int.from_bytes(b, "big")


def _binary(n: int) -> bytes:
    return n.to_bytes(16, "big")


# ---- 1. turns with their place and prefix ----------------------------------------

def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, digest, words``: turns without their texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return (conversations.where("conv_id IS NOT NULL")
            .select("conv_id", "turn", F.substring(F.unhex(F.sha2(content, 256)), 1, 16).alias("digest"),
                    F.regexp_count(text, F.lit(WORDS_RE)).cast("long").alias("words")))


def streamed(df: DataFrame, function, ddl: str, batch_rows: int = 4096) -> DataFrame:
    """``mapInArrow`` of a generator from a partition's rows to rows, in their order."""
    schema = arrow_schema(ddl)

    def run(batches):
        out = []
        for row in function(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)):
            out.append(row)
            if len(out) == batch_rows:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    return df.mapInArrow(run, ddl)


def _within(rows):
    """Place and prefix of each turn within its conversation's rows of this partition."""
    part, conv = TaskContext.get().partitionId(), None
    for c, _, digest, words in rows:
        if c != conv:
            conv, pos, total, power = c, 0, 0, 1
        total = (total + (_number(digest) + 1) * power) % _P
        power = power * _BASE % _P
        yield part, c, pos, digest, words, _binary(total)
        pos += 1


def placed(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, pos, digest, words, prefix`` (pos from 0; prefix: of the turns up to
    this one), and the staged table it reads."""
    spark = conversations.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    sorted_ = (turns(conversations).repartitionByRange(n, "conv_id", F.col("turn").asc_nulls_first())
               .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "digest"))
    runs = stage(streamed(sorted_, _within, "part int, conv_id long, pos long, digest binary, words long, prefix binary"), "trie-turns")
    # conversations that span partitions: fewer than partitions, so their runs are at most twice as many
    spans = (runs.groupBy("conv_id").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select("conv_id"))
    ends = (runs.join(F.broadcast(spans), "conv_id", "left_semi").groupBy("conv_id", "part")
            .agg(F.max(F.struct("pos", "prefix")).alias("end")).orderBy("conv_id", "part").collect())
    before, conv = {}, None
    for r in ends:
        if r["conv_id"] != conv:
            conv, count, total = r["conv_id"], 0, 0
        before[conv, r["part"]] = (count, total)
        total = (total + _number(r["end"]["prefix"]) * pow(_BASE, count, _P)) % _P
        count += r["end"]["pos"] + 1
    if not before:
        return runs.drop("part"), runs

    def complete(part, c, pos, digest, words, prefix):
        count, total = before.get((c, part), (0, 0))
        if count:
            prefix = _binary((total + _number(prefix) * pow(_BASE, count, _P)) % _P)
        return c, pos + count, digest, words, prefix

    return map_rows(runs, complete, "conv_id long, pos long, digest binary, words long, prefix binary"), runs


# ---- 2. rebuilt conversations ------------------------------------------------------

PATH = "conv_id long, depth long, node binary, parent binary, words long, below long, heads array<binary>"


def _start(own: list, n: int, base: list, h: int) -> tuple[list, int, int]:
    """First turns of a rebuilt conversation as (digest, words), the number taken
    from the base, and the rebuilt length."""
    taken = min(h, len(base))
    start = [(t["digest"], t["words"]) for t in base[:taken]] + [(t["digest"], t["words"]) for t in own[h:]]
    return start, taken, taken + max(0, n - h)


def _prefixes(digests: list[bytes]) -> list[int]:
    out, power = [0], 1
    for d in digests:
        out.append((out[-1] + (_number(d) + 1) * power) % _P)
        power = power * _BASE % _P
    return out


def _first_rows(c, own, n, base, h):
    """Path rows of the root and of the turns taken from the base."""
    start, taken, length = _start(own, n, base, h)
    sums = [_binary(s) for s in _prefixes([d for d, _ in start])]
    for d in range(taken + 1):
        yield c, d, sums[d], sums[d - 1] if d else None, start[d - 1][1] if d else 0, length - d, sums[1:min(d, HEAD) + 1]


_first_rows.many = True


def _own_row(c, pos, digest, words, prefix, own, n, base, h):
    """Path row of an own turn: its prefix without the first h turns, shifted behind
    those of the base."""
    start, taken, length = _start(own, n, base, h)
    sums = _prefixes([d for d, _ in start])
    skipped = _prefixes([t["digest"] for t in own[:h]])[-1]
    shift = pow(_BASE if taken >= h else _INVERSE, abs(taken - h), _P)
    here = (sums[taken] + (_number(prefix) - skipped) * shift) % _P
    depth = pos - h + taken + 1
    above = (here - (_number(digest) + 1) * pow(_BASE, depth - 1, _P)) % _P
    return c, depth, _binary(here), _binary(above), words, length - depth, [_binary(s) for s in sums[1:min(depth, HEAD) + 1]]


def rebuilt(turns_: DataFrame) -> DataFrame:
    """One row for each rebuilt conversation and depth: ``conv_id, depth, node, parent,
    words`` (of the last turn), ``below`` (turns that follow) and ``heads`` (its first
    nodes below the root, at most ``HEAD``)."""
    first = F.when(F.col("pos") < HEADS - 1 + HEAD, F.struct("pos", "digest", "words"))
    convs = turns_.groupBy("conv_id").agg(F.array_sort(F.collect_list(first)).alias("own"), F.count(F.lit(1)).alias("n"))
    h = F.expr(f"cast(crc32(cast(cast(conv_id AS string) AS binary)) % {HEADS} AS int)")
    base = convs.select(F.col("conv_id").alias("base_id"), F.slice("own", 1, HEADS - 1).alias("base"))
    built = (convs.withColumn("h", h).withColumn("base_id", F.col("conv_id") - F.col("conv_id") % GROUP)
             .join(base, "base_id", "left").select("conv_id", "own", "n", F.coalesce("base", F.slice("own", 1, 0)).alias("base"), "h"))
    top = map_rows(built, _first_rows, PATH)
    own = (turns_.join(built, "conv_id").where(F.col("pos") >= F.col("h"))
           .select("conv_id", "pos", "digest", "words", "prefix", "own", "n", "base", "h"))
    return top.unionByName(map_rows(own, _own_row, PATH))


# ---- 3. nodes ----------------------------------------------------------------------

def nodes(paths: DataFrame) -> DataFrame:
    """``depth, node, conv_id`` (smallest member), ``n_convs, parent, words, heads``,
    ``n_ends`` (members that end here) and ``end_id`` (the smallest of these)."""
    ends = F.col("below") == 0
    return paths.groupBy("depth", "node").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("parent").alias("parent"),
        F.first("words").alias("words"), F.first("heads").alias("heads"), F.count_if(ends).alias("n_ends"),
        F.min(F.when(ends, F.col("conv_id"))).alias("end_id"))


def end_digests(paths: DataFrame) -> DataFrame:
    """``depth, node, ends_sha256`` of the nodes at which more than one conversation ends."""
    ends = paths.where("below = 0").select("depth", "node", "conv_id")
    several = ends.groupBy("depth", "node").count().where("count > 1").select("depth", "node")
    n = max(int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")), paths.sparkSession.sparkContext.defaultParallelism)
    sorted_ = (ends.join(several, ["depth", "node"], "left_semi").repartitionByRange(n, "depth", "node", "conv_id")
               .sortWithinPartitions("depth", "node", "conv_id"))

    pieces = streamed(sorted_, _join_ids, "depth long, node binary, first long, ids string", 256)
    in_order = pieces.repartition("depth", "node").sortWithinPartitions("depth", "node", "first")
    return streamed(in_order, _digest_pieces, "depth long, node binary, ends_sha256 string")


def _join_ids(rows):
    """Pieces of up to ``IDS`` ids of one node, joined by commas."""
    for (depth, node), group in groupby(rows, key=itemgetter(0, 1)):
        while ids := [r[2] for r in islice(group, IDS)]:
            yield depth, node, ids[0], ",".join(map(str, ids))


def _digest_pieces(rows):
    for (depth, node), group in groupby(rows, key=itemgetter(0, 1)):
        sha = hashlib.sha256(next(group)[3].encode())
        for r in group:
            sha.update(b"," + r[3].encode())
        yield depth, node, sha.hexdigest()


# ---- 4. time-forward processing ------------------------------------------------------

class SpillingQueue:
    """Priority queue of (key, value) pairs.  Beyond ``limit`` pairs in memory, they
    are written as one sorted run to an anonymous temporary file and come back, block
    by block, as the smallest keys are asked for."""

    def __init__(self, limit: int = QUEUE, block: int = 1024):
        self.limit, self.block, self.heap, self.runs, self.file, self.count = limit, block, [], [], None, 0
        self.spilled = 0

    def push(self, key, value) -> None:
        heapq.heappush(self.heap, (key, self.count, value, None))
        self.count += 1
        if len(self.heap) - len(self.runs) > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        kept = [x for x in self.heap if x[3] is not None]       # heads of earlier runs stay
        run = sorted(x[:3] for x in self.heap if x[3] is None)
        blocks = []
        self.file.seek(0, 2)
        for at in range(0, len(run), self.block):
            blocks.append(self.file.tell())
            pickle.dump(run[at:at + self.block], self.file, pickle.HIGHEST_PROTOCOL)
        self.spilled += len(run)
        self.heap = kept
        heapq.heapify(self.heap)
        state = [iter(()), blocks, len(self.runs)]
        self.runs.append(state)
        self._advance(state)

    def _advance(self, state) -> None:
        item = next(state[0], None)
        if item is None and state[1]:
            self.file.seek(state[1].pop(0))
            state[0] = iter(pickle.load(self.file))
            item = next(state[0])
        if item is not None:
            heapq.heappush(self.heap, (*item, state))

    def take(self, key):
        """Values under ``key``, which must not be greater than any key left."""
        if self.heap and self.heap[0][0] < key:
            raise ValueError("a message whose receiver is not among the rows")
        while self.heap and self.heap[0][0] == key:
            _, _, value, state = heapq.heappop(self.heap)
            if state is not None:
                self._advance(state)
            yield value

    def __len__(self) -> int:
        return len(self.heap)


def forward(rows, limit: int = QUEUE):
    """Subtree totals of ``(shard, depth, node, parent, root depth, saved)`` rows that
    come by shard in reverse level order: ``(shard, depth, node, children, leaves,
    saved)``."""
    shard, queue = None, None
    for of, depth, node, parent, root, saved in rows:
        if of != shard:
            shard, queue = of, SpillingQueue(limit)
        children = leaves = 0
        for more_leaves, more_saved in queue.take((-depth, node)):
            children += 1
            leaves += more_leaves
            saved += more_saved
        leaves = leaves or 1
        if depth > root:
            queue.push((1 - depth, parent), (leaves, saved))
        yield of, depth, node, children, leaves, saved


def with_shards(forest: DataFrame, shard_nodes: int) -> DataFrame:
    """``forest`` with ``s``, the depth of its shard's root: the first at which the
    subtree has at most ``shard_nodes`` nodes, ``HEAD`` at the latest; null above it."""
    out = forest.withColumn("s", F.lit(None).cast("int"))
    for s in range(1, HEAD):
        large = (forest.where(F.size("heads") >= s).groupBy(F.get("heads", F.lit(s - 1)).alias("large")).count()
                 .where(F.col("count") > shard_nodes).select("large"))
        out = (out.withColumn("head", F.get("heads", F.lit(s - 1))).join(large, F.col("head") == F.col("large"), "left")
               .withColumn("s", F.coalesce("s", F.when(F.col("head").isNotNull() & F.col("large").isNull(), F.lit(s))))
               .drop("head", "large"))
    return out.withColumn("s", F.coalesce("s", F.when(F.size("heads") >= HEAD, F.lit(HEAD))))


def totals(forest: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """``depth, node, n_children, n_leaves, saved_tokens`` of nodes ``depth, node, parent,
    heads, saved`` that are closed upwards: the parent of each is among them."""
    sharded = with_shards(forest, shard_nodes)
    below = (sharded.where("s IS NOT NULL")
             .select(F.get("heads", F.col("s") - 1).alias("shard"), F.col("depth"), "node", "parent", F.col("s").alias("root"), "saved"))
    in_order = below.repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "node")
    done = stage(streamed(in_order, forward, "shard binary, depth long, node binary, n_children long, n_leaves long, saved_tokens long"), "trie-totals")
    # across shard roots: to every node above, the root of the trie first
    roots = (done.where("node = shard").join(sharded.where("depth = s").select("depth", "node", "heads"), ["depth", "node"])
             .select(F.posexplode(F.concat(F.array(F.lit(ROOT)), F.slice("heads", 1, F.col("depth").cast("int") - 1))).alias("at", "above"),
                     F.when(F.col("at") == F.col("depth") - 1, 1).otherwise(0).alias("children"), "n_leaves", "saved_tokens"))
    tops = sharded.where("s IS NULL")
    # a node above the shards counts itself as well: all nodes above it get what it saves
    own = tops.select(F.posexplode(F.concat(F.array(F.lit(ROOT)), "heads")).alias("at", "above"),
                      F.when(F.col("at") == F.col("depth") - 1, 1).otherwise(0).alias("children"), F.lit(0).alias("n_leaves"),
                      F.col("saved").alias("saved_tokens"))
    sums = (roots.unionByName(own).groupBy(F.col("at").cast("long").alias("depth"), F.col("above").alias("node"))
            .agg(F.sum("children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    # no node above the shards is childless but a root that stands alone
    above = sums.withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")))
    return done.drop("shard").unionByName(above.select("depth", "node", "n_children", "n_leaves", "saved_tokens"))


def trie(conversations: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """One row a node: ``node`` and ``parent`` (prefix digests), ``depth``, ``conv_id``,
    ``parent_conv_id``, ``n_convs``, ``n_ends``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``."""
    turns_, runs = placed(conversations)
    paths = stage(rebuilt(turns_), "trie-paths")
    unstage(runs)
    every = stage(nodes(paths), "trie-nodes")
    single = (F.col("n_convs") == 1) & (F.col("depth") > 0)
    shared = every.where(~single)
    chains = every.where(single).groupBy("conv_id").agg(F.min(F.struct("depth", "node", "parent", "heads")).alias("top"))
    forest = stage(shared.select("depth", "node", "parent", "heads", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
                   .unionByName(chains.select("top.*", F.lit(0).cast("long").alias("saved"))), "trie-forest")
    summed = totals(forest, shard_nodes)
    parents = shared.select((F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    digests = (F.when(F.col("n_ends") == 0, F.sha2(F.lit(""), 256)).when(F.col("n_ends") == 1, F.sha2(F.col("end_id").cast("string"), 256))
               .otherwise(F.col("ends_sha256")))
    return (every.join(parents, ["depth", "parent"], "left").join(summed, ["depth", "node"], "left")
            .join(end_digests(paths), ["depth", "node"], "left")
            .select("depth", "node", "parent", "conv_id",
                    F.when(F.col("depth") > 0, F.coalesce("above", "conv_id")).alias("parent_conv_id"), "n_convs", "n_ends",
                    F.when(single, 1 - F.col("n_ends")).otherwise(F.col("n_children")).alias("n_children"),
                    F.when(single, F.lit(1)).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
                    F.when(single, F.lit(0)).otherwise(F.col("saved_tokens")).cast("long").alias("saved_tokens"),
                    digests.alias("ends_sha256")))


def op13_prefix_trie(conversations: DataFrame) -> DataFrame:
    return trie(conversations).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
