import re
from collections import Counter

from helpers import ODD, by_id, documents, empty, sf_documents
from shelfwise.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 8)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 20 or 100 * len(covered) > 30 * n)


def check(df):
    for r in Q.op1_quality_rules(df).join(df.select("doc_id", "text"), "doc_id").collect():
        assert tuple(r[1:7]) == brute(r["text"]), r["doc_id"]
        assert not (r["base_failed"] and r["kept"])


def test_base_columns_against_brute_force(spark):
    check(sf_documents(spark))


def test_odd_texts(spark):
    long = [" ".join(f"w{i % 50}" for i in range(400)), "a b c d e f g h " * 3, "a b c d e f g h i j k l m n o p q r s t u"]
    check(documents(spark, ODD + long))


def test_empty_table(spark):
    assert Q.op1_quality_rules(empty(spark)).collect() == []


def test_verdicts_follow_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    rows = Q.op1_quality_rules(docs).join(labels, "doc_id").where("not base_failed").collect()
    bad = [r for r in rows if r["quality"] == 0]
    good = [r for r in rows if r["quality"] == 1]
    assert sum(not r["kept"] for r in bad) >= 0.9 * len(bad) > 0
    assert sum(r["kept"] for r in good) >= 0.99 * len(good) > 0


def test_em_recovers_known_accuracies():
    """Votes drawn from known accuracies: the estimates come near them."""
    import numpy as np

    rng = np.random.default_rng(5)
    rules = tuple(Q.Rule(f"r{j}", "", "") for j in range(5))
    y = rng.random(20000) < 0.8
    right_good, right_bad = [0.95, 0.9, 0.85, 0.9, 0.95], [0.9, 0.8, 0.7, 0.8, 0.9]
    pats = Counter()
    for good in y:
        pats[tuple(None if rng.random() < 0.2 else int(good if rng.random() < (right_good if good else right_bad)[j] else not good)
                   for j in range(5))] += 1
    model = Q.fit(list(pats.items()), rules, {"bad": tuple(r.name for r in rules)})
    assert abs(model.shares[0] - 0.8) < 0.03
    for j, (g, b) in model.accuracies().items():
        assert abs(g - right_good[j]) < 0.04 and abs(b - right_bad[j]) < 0.06


def test_a_rule_alone_does_not_decide(spark):
    """Posterior, not all-must-pass: one weak bad vote can be outvoted."""
    rows = by_id(Q.quality(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))
    names = [f"v_{r.name}" for r in Q.RULES]
    assert any(r["kept"] and 0 in [r[n] for n in names] for r in rows.values())


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_that_collide_as_polynomials_are_told_apart(spark):
    """The Thue-Morse word and its complement: equal modulo 2^64 for any base."""
    from shelfwise.llm.common import word_hashes

    for n in (1024, 4096, 1 << 21):
        word = thue_morse(n)
        other = word.translate(str.maketrans("ab", "ba"))
        assert len(set(word_hashes(f"{word} {other} {word}\n{other}x".encode()).tolist())) == 3
    word = thue_morse(1024)
    other = word.translate(str.maketrans("ab", "ba"))
    text = " ".join([word] * 8 + [other] * 8)
    got = Q.op1_quality_rules(spark.createDataFrame([(1, text), (2, " ".join([word, other] * 8))], "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_repeat_words"] for r in got} == {1: 0, 2: 16}
