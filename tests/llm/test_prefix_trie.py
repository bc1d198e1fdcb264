"""op13 against a trie built in plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import prefix_trie as P

from helpers import SF

DDL = "conv_id long, turn long, role string, text string, node string, parent int, depth long"


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            convs[c].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [x[2] for x in sorted(v, key=lambda x: x[:2])] for c, v in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[x] for x in children[node])
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else -10**9, len(m), len(children[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest()) for n, m in members.items())


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], DDL)


def check(spark, rows, shard_nodes=P.SHARD_NODES):
    got = P.trie(table(spark, rows), shard_nodes).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()
    assert sorted(tuple(-10**9 if v is None else v for v in r) for r in got) == brute(rows)


def random_rows(seed, convs=120, turns=9, texts=3):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["one word", "two  more\tword", None][:texts] + ["", "x"]))
            for c in rng.sample(range(-40, 400), convs) for t in range(rng.randint(1, turns))]


def test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)


@pytest.mark.parametrize("shard_nodes", [1, 7, 10**6])
def test_random_tries(spark, shard_nodes):
    check(spark, random_rows(shard_nodes), shard_nodes)


def test_common_starts_copies_and_a_conversation_over_many_partitions(spark):
    start = [("system", "be kind"), ("user", "hello there"), ("assistant", "hi"), ("user", "a b c"), ("assistant", "d")]
    rows = [(c, t, *x) for c in range(200) for t, x in enumerate(start)]
    rows += [(c, 5 + t, "user", f"{c} {t}") for c in range(0, 200, 3) for t in range(c % 5)]
    rows += [(300, t, "user", f"t {t}") for t in range(4000)] + [(320, t, "user", f"t {t}") for t in range(3990)]
    random.Random(1).shuffle(rows)
    check(spark, rows, 20)


def test_nulls_ties_repeated_rows_and_absent_bases(spark):
    rows = [(None, 1, "user", "x"), (1, None, None, None), (1, None, "user", "a"), (1, 2, "user", "b"), (1, 2, "user", "b"), (1, 2, "zz", "b"),
            (2, 1, "user", "only"), (5, 1, "", ""), (6, 1, None, None), (25, 1, "user", "x y"), (20, 1, "user", "x y"), (45, 3, "user", " "),
            (-3, 1, "user", "neg"), (-20, 1, "user", "neg"), (7, 1, "user", "ab"), (27, 1, "use", "rab"), (0, 1, "user", "w " * 5000)]
    check(spark, rows)


def test_empty_tables(spark):
    assert P.op13_prefix_trie(table(spark, [])).collect() == []
    assert P.op13_prefix_trie(table(spark, [(None, 1, "user", "x")])).collect() == []
    check(spark, [(3, 1, "user", "x")])     # turns that the rebuilding drops leave the root


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers()), max_size=300), st.integers(1, 40), st.integers(1, 7))
def test_spilling_queue_gives_all_in_order(pairs, limit, block):
    queue = P.SpillingQueue(limit, block)
    for key, value in pairs:
        queue.push(key, value)
    assert (queue.spilled > 0) == (len(pairs) > limit)
    got = [(key, sorted(queue.take(key))) for key in range(31)]
    assert got == [(key, sorted(v for k, v in pairs if k == key)) for key in range(31)] and len(queue) == 0


def test_forward_with_a_spilling_queue_equals_recursion():
    rng = random.Random(4)
    parent = {i: rng.randrange(i) for i in range(1, 3000)}
    depth = {0: 0}
    for i in range(1, 3000):
        depth[i] = depth[parent[i]] + 1
    rows = sorted(((b"s", depth[i], i.to_bytes(4, "big"), parent.get(i, 0).to_bytes(4, "big"), 0, i) for i in range(3000)), key=lambda r: (-r[1], r[2]))
    total, leaves, children = [*range(3000)], [0] * 3000, [0] * 3000
    for i in range(2999, -1, -1):
        leaves[i] = leaves[i] or 1
        if i:
            total[parent[i]] += total[i]
            leaves[parent[i]] += leaves[i]
            children[parent[i]] += 1
    got = {int.from_bytes(node, "big"): (c, le, s) for _, _, node, c, le, s in P.forward(rows, limit=64)}
    assert got == {i: (children[i], leaves[i], total[i]) for i in range(3000)}
    with pytest.raises(ValueError):
        list(P.forward([(b"s", 3, b"a", b"p", 0, 1), (b"s", 1, b"q", b"r", 0, 1)]))
