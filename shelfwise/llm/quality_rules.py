"""Quality rules by weak supervision.

Each rule looks at one measure of a text and votes good (1), bad (0) or
abstains (null).  No rule decides alone: expectation-maximisation estimates,
without labels, how often each rule is right, and a document is kept when the
posterior probability that it is good reaches the threshold.

The corpus is read once.  Votes of a document form a pattern; Spark counts the
patterns of all documents, at most ``3 ** len(RULES)`` rows however large the
corpus is, and EM runs over those counts.  The posterior is then a column
expression.

Defined cases: a null or empty text has no words, fails the base rule and is
not kept; repeated rows are measured alike; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import SPACE_CHARS, map_rows, stage, window_hashes, word_hashes

SYMBOLS = b"#*$%&|<>"
MARKS = b"!\"#$%&'()*+-./:;<=>?@[\\]^_`{|}~"
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))

MEASURES = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "n_lines long, n_marks long, n_upper long, n_letters long, top_word long, n_distinct long")


def measure(doc_id, text):
    """Counts of one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = word_hashes(raw)
    n = len(words)
    spaces = len(raw) - len(raw.translate(None, SPACE_CHARS.encode()))
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if line.strip(SPACE_CHARS):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    # words inside 8-word windows that occur twice or more (equality by 64-bit window hash)
    repeat = 0
    windows = window_hashes(words, REPEAT_WINDOW)
    if len(windows) > 1:
        _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
        starts = counts[inverse] > 1
        if starts.any():
            cover = np.zeros(n + 1, dtype=np.int64)
            cover[:len(starts)] += starts
            cover[REPEAT_WINDOW:] -= starts[:n + 1 - REPEAT_WINDOW]
            repeat = int((np.cumsum(cover)[:n] > 0).sum())
    counts = np.unique(words, return_counts=True)[1] if n else np.zeros(1, dtype=np.int64)
    size = len(raw)
    upper = size - len(raw.translate(None, _UPPER))
    lower = size - len(raw.translate(None, _LOWER))
    return (doc_id, n, len(text) - spaces, size - len(raw.translate(None, SYMBOLS)), dup, repeat, lines,
            size - len(raw.translate(None, MARKS)), upper, upper + lower, int(counts.max()), len(counts) if n else 0)


@dataclass(frozen=True)
class Rule:
    """Votes good when ``good`` holds, bad when ``bad`` holds, else abstains."""

    name: str
    good: str
    bad: str


#: Measures per word do not depend on the language.
RULES = (
    Rule("length", "n_words >= 40", f"n_words < {MIN_WORDS}"),
    Rule("repeats", f"n_words >= {MIN_WORDS} AND 100 * n_repeat_words <= 10 * n_words",
         f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
    Rule("symbols", "50 * n_symbols <= n_words", "5 * n_symbols > n_words"),
    Rule("lines", "n_lines > 1 AND 10 * n_dup_lines <= n_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("word_length", "word_chars BETWEEN 3 * n_words AND 10 * n_words", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    Rule("case", "5 * n_upper <= n_letters", "5 * n_upper > 2 * n_letters"),
    Rule("marks", "5 * n_marks <= 2 * n_words", "10 * n_marks > 7 * n_words"),
    Rule("top_word", f"n_words >= {MIN_WORDS} AND 8 * top_word <= n_words", f"n_words >= {MIN_WORDS} AND 4 * top_word > n_words"),
    Rule("variety", f"n_words >= {MIN_WORDS} AND 10 * n_distinct >= 4 * least(n_words, 1000)",
         f"n_words >= {MIN_WORDS} AND 10 * n_distinct < 2 * least(n_words, 1000)"),
)


#: Bad texts come in kinds, and a rule is blind to the kinds that it was not made for.
KINDS = {"repetition": ("repeats", "lines", "variety"), "shape": ("symbols", "word_length", "case", "marks", "top_word"),
         "size": ("length",)}


@dataclass(frozen=True)
class RuleModel:
    """Shares of the classes (good first, then the kinds of bad) and, by class
    and rule, the probability that a vote is "bad"."""

    shares: tuple[float, ...]
    votes_bad: tuple[tuple[float, ...], ...]

    def accuracies(self) -> dict[int, tuple[float, float]]:
        """Per rule: how often it is right on good and on bad documents."""
        bad = np.array(self.shares[1:]) / sum(self.shares[1:])
        table = np.array(self.votes_bad)
        return {j: (float(1 - table[0, j]), float(bad @ table[1:, j])) for j in range(table.shape[1])}


def votes(rules=RULES) -> list[Column]:
    return [F.expr(f"CASE WHEN {r.bad} THEN 0 WHEN {r.good} THEN 1 END").alias(f"v_{r.name}") for r in rules]


def fit(patterns: list[tuple[tuple[int | None, ...], int]], rules=RULES, kinds=None, rounds: int = 200,
        strength: float = 0.002) -> RuleModel:
    """EM over counted vote patterns.

    A prior worth ``strength`` of the corpus starts each kind of bad with its
    own rules right and the others blind.  Throughout, a rule votes "bad" on
    good documents less often than on the kind it was made for, so the classes
    cannot swap their meaning.
    """
    kinds = KINDS if kinds is None else kinds
    total = sum(c for _, c in patterns) or 1
    voted_bad = np.array([[v == 0 for v in p] for p, _ in patterns], dtype=float).reshape(-1, len(rules))
    voted = np.array([[v is not None for v in p] for p, _ in patterns], dtype=float).reshape(-1, len(rules))
    count = np.array([c for _, c in patterns], dtype=float)
    own = np.array([[r.name in names for r in rules] for names in kinds.values()])
    first = np.vstack([np.full(len(rules), 0.05), np.where(own, 0.8, 0.05)])
    first_shares = np.array([0.8] + [0.2 / len(kinds)] * len(kinds))
    pseudo = 1 + strength * total
    shares, table = first_shares, first
    for _ in range(rounds):
        post = _posteriors(shares, table, voted, voted_bad)
        weight = post * count[:, None]
        new = (weight.T @ voted_bad + first * pseudo) / (weight.T @ voted + pseudo)
        new[0] = np.clip(new[0], 0.01, 0.45)
        new[1:] = np.clip(new[1:], np.where(own, new[0] + 0.02, 0.01), 0.99)
        new_shares = (weight.sum(axis=0) + first_shares * pseudo) / (total + pseudo)
        done = np.abs(new - table).sum() + np.abs(new_shares - shares).sum() < 1e-9
        shares, table = new_shares, new
        if done:
            break
    return RuleModel(tuple(map(float, shares)), tuple(tuple(map(float, r)) for r in table))


def _posteriors(shares, table, voted, voted_bad):
    like = np.log(shares) + voted_bad @ np.log(table).T + (voted - voted_bad) @ np.log(1 - table).T
    like = np.exp(like - like.max(axis=1, keepdims=True))
    return like / like.sum(axis=1, keepdims=True)


def posterior(model: RuleModel, rules=RULES) -> Column:
    """Probability that a document is good, given its votes."""
    odds = []       # of each kind of bad against good
    for share, row in zip(model.shares[1:], model.votes_bad[1:], strict=True):
        o = F.lit(math.log(share / model.shares[0]))
        for rule, bad, bad_if_good in zip(rules, row, model.votes_bad[0], strict=True):
            vote = F.col(f"v_{rule.name}")
            o = o + (F.when(vote == 0, F.lit(math.log(bad / bad_if_good)))
                     .when(vote == 1, F.lit(math.log((1 - bad) / (1 - bad_if_good)))).otherwise(F.lit(0.0)))
        odds.append(F.exp(o))
    return F.lit(1.0) / (F.lit(1.0) + sum(odds[1:], odds[0]))


def quality(documents: DataFrame, rules=RULES, threshold: float = 0.5) -> DataFrame:
    """One row per document: measures, votes, ``base_failed``, ``p_good`` and
    ``kept`` (false where the base rule fails, else ``p_good >= threshold``)."""
    measures = stage(map_rows(documents.select("doc_id", "text"), measure, MEASURES), "quality")
    voted = measures.select("*", *votes(rules))
    names = [f"v_{r.name}" for r in rules]
    patterns = [(tuple(r[:-1]), r[-1]) for r in voted.groupBy(*names).agg(F.count("*").alias("c")).collect()]
    model = fit(patterns, rules)
    failed = F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")
    return (voted.withColumn("base_failed", failed).withColumn("p_good", posterior(model, rules))
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold)))


def op1_quality_rules(documents: DataFrame) -> DataFrame:
    return quality(documents).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                     "base_failed", "kept", "p_good")
