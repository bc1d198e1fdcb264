import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from helpers import ODD, by_id, documents, empty, sf_documents
from shelfwise.llm import graph
from shelfwise.llm import jaccard_join as J


def shingles(text):
    words = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in sets}


def check(df):
    want = brute([(r["doc_id"], r["text"]) for r in df.collect()])
    got = {i: (r["n_shingles"], r["component_id"]) for i, r in by_id(J.op3_jaccard_join(df)).items()}
    assert got == want
    return want


def near_copies(seed, groups=12, size=12, words=120, edits=3, passage=0):
    """Groups of edited copies, some chained, and unlike texts with a passage in common."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6)))
    shared = [word() for _ in range(passage)]
    out = []
    for _ in range(groups):
        base = [word() for _ in range(rng.randrange(5, words))] + shared
        for _ in range(rng.randrange(1, size)):
            t = list(base)
            for _ in range(rng.randrange(edits + 1)):
                at = rng.randrange(len(t))
                t[at:at + rng.randrange(2)] = [word()]
            out.append(" ".join(t))
            base = t if rng.random() < 0.5 else base
    rng.shuffle(out)
    return out


def test_whole_table(spark):
    check(sf_documents(spark))


@pytest.mark.parametrize("seed,passage", [(1, 0), (2, 60), (3, 30)])
def test_edited_copies_and_passages(spark, seed, passage):
    want = check(documents(spark, near_copies(seed, passage=passage) + ODD))
    assert len({c for _, c in want.values()}) < len(want) - 20


def test_a_large_group_of_near_copies(spark):
    """Many rounds: copies of copies at growing distances in shared regions."""
    check(documents(spark, near_copies(4, groups=2, size=160, words=60, edits=2)))


def test_copies_with_edits_of_their_own_are_not_paired(spark, monkeypatch):
    """Unlinked copies of one text, some with near copies: few pairs are measured."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(150)]
    texts = [" ".join(base)]
    for i in range(160):
        t = list(base)
        for at in rng.sample(range(150), 7):
            t[at] = f"e{i}x{at}"
        texts.append(" ".join(t))
        if i % 8 == 0:
            t[rng.randrange(150)] = f"n{i}"
            texts.append(" ".join(t))
    measured, plain = [], J.distances
    monkeypatch.setattr(J, "distances", lambda pairs, sets: (measured.append(pairs.count()), plain(pairs, sets))[1])
    want = check(documents(spark, texts))
    n = len(texts)
    assert len({c for _, c in want.values()}) > n // 2 and sum(measured) < n * n // 10


def test_border_of_the_similarity(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[:n]) for n in (104, 84, 83, 85, 105, 130, 129, 131, 8, 9, 10, 5, 4, 3)]
    texts += [" ".join(words[200:200 + n] + ["x"] * k) for n in (20, 24, 28) for k in (0, 1, 2, 3)]
    check(documents(spark, texts + [t.upper() for t in texts[:4]]))


def test_repeated_rows_null_ids_empty(spark):
    docs = documents(spark, ["a b c d e f g", "a b c d e f g", "z y"])
    twice = docs.unionByName(docs)
    assert sorted((r["doc_id"], r["component_id"]) for r in J.op3_jaccard_join(twice).collect()) == [(0, 0), (0, 0), (1, 0), (1, 0), (2, 2), (2, 2)]
    nulls = docs.selectExpr("cast(null as long) doc_id", "text", "lang", "source", "n_chars", "blob", "key", "node")
    got = J.op3_jaccard_join(docs.unionByName(nulls)).collect()
    assert len(got) == 6 and {r["component_id"] for r in got} == {0, 2}
    assert J.op3_jaccard_join(empty(spark)).collect() == []


def test_one_document_of_each_group_stays(spark):
    texts = near_copies(5) + ODD
    docs = documents(spark, texts)
    want = brute(list(enumerate(texts)))
    kept = J.one_per_group(docs.unionByName(docs.limit(5)))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in want.values()})


def test_one_row_of_each_group_whatever_its_ids(spark):
    a, near = " ".join(f"a{i}" for i in range(40)), " ".join(f"a{i}" for i in range(39))
    c, d, e = "other words that nothing else is linked to", "text without any id at all", "d e f g h i"
    rows = [(1, a), (1, a), (1, c), (2, near), (None, a), (None, d), (None, d), (None, ""), (None, ""), (3, ""), (3, None), (3, ""), (2, e), (4, e)]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, n int")
    got = J.one_per_group(docs)
    assert got.columns == docs.columns
    key = lambda r: (r[0] or 0, r[1] or "-")
    want = [(1, a), (1, c), (None, d), (None, ""), (None, ""), (3, ""), (3, None), (2, e)]
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=key) == sorted(want, key=key)


def test_linked_sets_share_enough_keys():
    """The bound on common keys holds for random linked pairs of all sizes."""
    rng = np.random.default_rng(6)
    for n in [5, 6, 9, 12, 20, 33, 64, 100, 257, 700, 3000] * 4:
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        drop = rng.integers(0, n // 9 + 1)
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**64, rng.integers(0, n // 9 + 1), dtype=np.uint64)]))
        common, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if 100 * common < 80 * union or np.array_equal(a, b):
            continue
        x, y = ({ring: (least, set(k.tolist())) for ring, least, k in J.cell_keys(s)} for s in (a, b))
        ring = J.rings_of(max(len(a), len(b)))[0]
        assert ring in x and ring in y, (len(a), len(b))
        shared = len(x[ring][1] & y[ring][1])
        assert shared >= max(1, x[ring][0], y[ring][0])


def crowded_pairs(count):
    """Texts of 8 words whose shingles hash to one cell of their ring, and the same
    with a word more, whose shingles lie in two: similarity 0.8."""
    out, i = [], 0
    while len(out) < 2 * count:
        words = [f"q{i}x{k}" for k in range(9)]
        i += 1
        short, long = (J.shingle_set(" ".join(words[:n])) for n in (8, 9))
        ring = J.rings_of(len(long))[0]
        keys = [{r: len(k) for r, _, k in J.cell_keys(s)}[ring] for s in (short, long)]
        if keys == [7, 2]:
            out += [" ".join(words[:8]), " ".join(words)]
    return out


def test_pairs_with_one_member_at_the_bound_of_cells(spark):
    texts = crowded_pairs(3)
    # a pair alone: several of these share empty cells with each other
    want = check(documents(spark, texts[:2]))
    assert [c for _, c in want.values()] == [0, 0]
    for a, b in zip(texts[::2], texts[1::2], strict=True):
        x, y = ({ring: (least, {*k.tolist()}) for ring, least, k in J.cell_keys(J.shingle_set(t))} for t in (a, b))
        ring = J.rings_of(5)[0]
        assert len(x[ring][1] & y[ring][1]) >= max(x[ring][0], y[ring][0])


def test_components_against_union_find(spark):
    rng = random.Random(8)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    near = defaultdict(set)
    for a, b in pairs:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    want = {}
    for start in sorted(near):
        if start not in want:
            todo = [start]
            while todo:
                x = todo.pop()
                if x not in want:
                    want[x] = start
                    todo += near[x]
    assert got == want


def test_words_that_collide_as_polynomials_are_not_linked(spark):
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    got = J.op3_jaccard_join(spark.createDataFrame([(1, word), (2, other), (3, word)], "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 2, 3: 1}
