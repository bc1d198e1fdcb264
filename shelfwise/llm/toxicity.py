"""Toxicity by a subsequence string-kernel support vector machine.

Two strings are alike as far as they share subsequences of ``ORDER`` letters;
an occurrence that spans s letters counts ``DECAY ** s``, so letters inserted
into or left out of an insult lower the likeness a little and do not destroy
it.  Spans are bounded by ``SPAN``; strings are words with their punctuation
removed (``i.d.i.o.t`` is one word, and so are single letters set apart), long
ones in overlapping windows.

Only documents are labelled.  A toxic one holds some toxic sentence, and a
sentence is as toxic as its worst word or phrase; all sentences of clean documents
are clean.  Words that explain most toxic training documents, and are rare in the
others, are the toxic side of the machine, which is trained on words in the space
of Nystrom landmarks, then again with the highest-scoring words of clean documents
added.  Toxic documents below its border hold some other toxic sentence: a second
machine is trained in the same way on the phrases (``PHRASE`` words in a row) of
their sentences that no clean sentence, or hardly one, holds, against phrases of
clean sentences.  Without such phrases there is no second machine; with them, words
found in fewer than three toxic documents that the phrases leave unexplained go.
The kernel is a product of explicit subsequence weights, so a trained machine
is one bounded table, and a text is scored whole at a few lookups per letter.

Training takes a sample of labelled documents of bounded size (``SAMPLE``);
everything else covers all rows.

Defined cases: null and empty texts have no words and the lowest score; without
toxic training rows all scores are 0; several labels of a document count as
toxic if one is; labels without document and documents without label are
ignored in training; a null doc_id is not held out; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Shared, map_batches, map_rows, map_slices, stage, unstage

ORDER = 4
SPAN = 7
DECAY = 0.7
SLOTS = 1 << 20
LONGEST = 20        # longer words are scored in windows
#: Labelled documents in the training sample, words taken to the driver, landmarks.
SAMPLE = 20_000
CANDIDATES = 1_500
CLEAN_WORDS = 3_000
LANDMARKS = 128
HARD = 1_500
#: Words of a phrase; longer sentences are read in overlapping pieces.
PHRASE = (2, 3)
PIECE = 2_000

_CLASS = np.zeros(256, dtype=np.uint32)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[48:58] = 27
_CLASS[128:] = 28 + (np.arange(128) % 32)
_EDGE = 63
_CLASS[32] = _EDGE      # between the words of a phrase
_ENDS = re.compile(r"[.!?\u2026]+(?=\s)|[\n\r\u3002\uff01\uff1f]+")
_DROP = bytes(b for b in range(128) if not (97 <= b < 123 or 48 <= b < 58 or b in (9, 10, 11, 12, 13, 32)))
_STEPS = [(a, b, c) for a, b, c in combinations(range(1, SPAN), ORDER - 1)]


def words_of(text: str | None) -> set[bytes]:
    """Distinct words without punctuation; runs of three or more single
    characters are read as one word too."""
    if not text:
        return set()
    tokens = text.lower().encode("utf-8", "surrogatepass").translate(None, _DROP).split()
    out = set(tokens)
    run: list[bytes] = []
    if any(len(t) == 1 for t in out):
        for t in [*tokens, b""]:
            if len(t) == 1:
                run.append(t)
            else:
                if len(run) >= 3:
                    out.add(b"".join(run))
                run = []
    for t in [t for t in out if len(t) > LONGEST]:
        out.discard(t)
        out.update(t[i:i + LONGEST] for i in range(0, len(t) - LONGEST + LONGEST // 2, LONGEST // 2))
    return out


def sentences_of(text: str | None) -> list[list[bytes]]:
    """Sentences of two or more words without punctuation, long words cut."""
    out = []
    for sentence in _ENDS.split((text or "").lower()):
        words = [w[:LONGEST] for w in sentence.encode("utf-8", "surrogatepass").translate(None, _DROP).split()]
        step = PIECE - max(PHRASE) + 1
        out += [words[i:i + PIECE] for i in range(0, max(1, len(words) - max(PHRASE) + 1), step) if len(words) > 1]
    return out


def phrases_of(text: str | None) -> set[bytes]:
    """Distinct phrases of the sentences."""
    return {b" ".join(s[i:i + q]) for s in sentences_of(text) for q in PHRASE for i in range(len(s) - q + 1)}


def _slots(words: list[bytes]):
    """For words of one length: (slot matrix, weight) per subsequence shape."""
    n, size = len(words), len(words[0])
    codes = np.full((n, size + 2), _EDGE, dtype=np.uint32)
    codes[:, 1:-1] = _CLASS[np.frombuffer(b"".join(words), dtype=np.uint8).reshape(n, size)]
    width = size + 2
    for a, b, c in _STEPS:
        m = width - c
        if m > 0:
            key = ((codes[:, :m] * np.uint32(64) + codes[:, a:a + m]) * np.uint32(64) + codes[:, b:b + m]) * np.uint32(64) + codes[:, c:c + m]
            yield (key * np.uint32(2654435761)) >> np.uint32(12), DECAY ** (c + 1)


def _norm(size: int) -> float:
    return math.sqrt(sum(max(0, size + 2 - c) * DECAY ** (2 * (c + 1)) for _, _, c in _STEPS)) or 1.0


def _by_length(words):
    groups = defaultdict(list)
    for i, w in enumerate(words):
        groups[len(w)].append(i)
    return groups.items()


def table_scores(words: list[bytes], table: np.ndarray) -> np.ndarray:
    """Sum of table values over the weighted subsequences of each word."""
    out = np.zeros(len(words))
    for size, where in _by_length(words):
        for at in range(0, len(where), 20_000):
            part = where[at:at + 20_000]
            total = np.zeros(len(part))
            for slots, weight in _slots([words[i] for i in part]):
                total += weight * table[slots].sum(axis=1)
            out[part] = total / _norm(size)
    return out


def subsequences(word: bytes) -> dict[int, float]:
    """Explicit kernel features of one word."""
    out: dict[int, float] = defaultdict(float)
    for slots, weight in _slots([word]):
        for s in slots[0].tolist():
            out[s] += weight
    norm = _norm(len(word))
    return {s: v / norm for s, v in out.items()}


def kernel(words: list[bytes], landmarks: list[bytes]) -> np.ndarray:
    """Kernel values, words x landmarks."""
    column = np.zeros(SLOTS, dtype=np.int32)
    features = [subsequences(m) for m in landmarks]
    used = sorted({s for f in features for s in f})
    column[used] = np.arange(1, len(used) + 1)
    values = np.zeros((len(used) + 1, len(landmarks)), dtype=np.float32)
    for j, f in enumerate(features):
        values[column[list(f)], j] = list(f.values())
    out = np.zeros((len(words), len(landmarks)))
    for size, where in _by_length(words):
        for at in range(0, len(where), 1000):
            part = where[at:at + 1000]
            for slots, weight in _slots([words[i] for i in part]):
                for c in column[slots].T:
                    hit = np.flatnonzero(c)
                    if len(hit):
                        out[np.array(part)[hit]] += weight * values[c[hit]]
            out[part] /= _norm(size)
    return out


def _spread(weights: dict[int, float]) -> np.ndarray:
    table = np.zeros(SLOTS, dtype=np.float32)
    if weights:
        table[list(weights)] = list(weights.values())
    return table


def train_machine(words: list[bytes], y: np.ndarray, weight: np.ndarray, landmarks: list[bytes], cost: float = 20.0):
    """Squared-hinge linear machine on Nystrom features: (table, bias)."""
    k = kernel(landmarks, landmarks)
    values, vectors = np.linalg.eigh((k + k.T) / 2)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    z = np.hstack([kernel(words, landmarks) @ root, np.ones((len(words), 1))])
    weight = weight * cost / weight.sum()
    ridge = np.eye(z.shape[1]) / len(words)
    ridge[-1, -1] = 1e-9
    v = np.zeros(z.shape[1])
    for _ in range(50):     # Newton steps on the active set
        active = y * (z @ v) < 1
        za = z[active]
        new = np.linalg.solve(ridge + za.T @ (za * weight[active, None]), za.T @ (weight[active] * y[active]))
        if np.abs(new - v).max() < 1e-9:
            break
        v = new
    table = np.zeros(SLOTS, dtype=np.float32)
    for m, b in zip(landmarks, root @ v[:-1], strict=True):
        for s, x in subsequences(m).items():
            table[s] += b * x
    return table, float(v[-1])


@dataclass
class ToxicityModel:
    """Table and bias of the machine, and the line that turns the margin of a
    text's worst word into a probability; and the machine of phrases, if any."""

    table: np.ndarray
    bias: float
    line: tuple[float, float] = (4.0, 0.0)
    lowest: float = -2.0
    phrases: ToxicityModel | None = None

    def __post_init__(self):
        self.cache: dict[bytes, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "cache": {}}

    def worst(self, texts: list[str | None]) -> list[tuple[float, bytes]]:
        """Per text its margin, which is that of its worst word, and that word.
        The new words of all texts are scored together."""
        found = [words_of(t) for t in texts]
        if len(self.cache) > 300_000:
            self.cache.clear()
        cache = self.cache
        new = list({w for words in found for w in words if w not in cache})
        if new:
            cache.update(zip(new, np.clip(table_scores(new, self.table) + self.bias, self.lowest, 2.0).tolist(), strict=True))
        return [max((cache[w], w) for w in words) if words else (self.lowest, b"") for words in found]

    def worst_phrase(self, texts: list[str | None]) -> list[tuple[float, bytes]]:
        """Per text the margin of its worst phrase, and that phrase."""
        best = [(self.lowest, b"")] * len(texts)
        block, size = [], 0
        for i, text in enumerate(texts):
            for sentence in sentences_of(text):
                block.append((i, sentence))
                size += len(sentence)
                if size >= 20_000:
                    self._phrases_of_block(block, best)
                    block, size = [], 0
        if block:
            self._phrases_of_block(block, best)
        return best

    def _phrases_of_block(self, block: list[tuple[int, list[bytes]]], best: list[tuple[float, bytes]]) -> None:
        """Table sums of all phrases out of running sums, one for each span."""
        words = [w for _, s in block for w in s]
        raw = b" " + b" ".join(words) + b" "
        codes = _CLASS[np.frombuffer(raw, dtype=np.uint8)]
        sums = {c: np.zeros(len(codes) + 1) for c in range(ORDER - 1, SPAN)}
        for a, b, c in _STEPS:
            m = len(codes) - c
            if m > 0:
                key = ((codes[:m] * np.uint32(64) + codes[a:a + m]) * np.uint32(64) + codes[b:b + m]) * np.uint32(64) + codes[c:c + m]
                sums[c][1:m + 1] += DECAY ** (c + 1) * self.table[(key * np.uint32(2654435761)) >> np.uint32(12)]
        sums = {c: np.cumsum(v) for c, v in sums.items()}
        norms = np.array([_norm(n) for n in range(max(PHRASE) * (LONGEST + 1) + 1)])
        lengths = np.array([len(w) for w in words])
        end = np.cumsum(lengths + 1) + 1                      # behind the border after each word
        start = end - lengths - 2
        sentence = np.repeat(np.arange(len(block)), [len(s) for _, s in block])
        owner = np.array([i for i, _ in block])[sentence]
        for q in PHRASE:
            at = np.flatnonzero(sentence[:len(words) - q + 1] == sentence[q - 1:])
            if not len(at):
                continue
            left, right = start[at], end[at + q - 1]
            total = sum(v[np.maximum(right - c, left)] - v[left] for c, v in sums.items())
            margins = np.clip(total / norms[right - left - 2] + self.bias, self.lowest, 2.0)
            mine = owner[at]
            borders = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
            tops = np.maximum.reduceat(margins, borders)
            for k, top in zip(borders.tolist(), tops.tolist(), strict=True):
                i = int(mine[k])
                if top > best[i][0]:
                    w = k + int(np.argmax(margins[k:] == top))
                    best[i] = (top, raw[left[w] + 1:right[w] - 1])

    def scores(self, texts: list[str | None]) -> list[float]:
        slope, shift = self.line
        lines = [slope * m + shift for m, _ in self.worst(texts)]
        if self.phrases is not None:
            slope, shift = self.phrases.line
            lines = [max(x, slope * m + shift) for x, (m, _) in zip(lines, self.phrases.worst_phrase(texts), strict=True)]
        return [1 / (1 + math.exp(-max(-30.0, min(30.0, x)))) for x in lines]

    def score(self, text: str | None) -> float:
        return self.scores([text])[0]


def witnesses(pairs, toxic_docs: int, least: int = 3) -> dict[bytes, int]:
    """Words that between them explain most toxic documents: again and again the
    word in most documents not yet explained.  ``pairs`` are (document, word)."""
    docs = defaultdict(set)
    for doc, word in pairs:
        docs[word].add(doc)
    chosen: dict[bytes, int] = {}
    explained: dict = defaultdict(int)
    while docs:
        gains = {w: sum(1 for d in ds if explained[d] < 2) for w, ds in docs.items()}
        word = max(sorted(gains), key=gains.get)
        if gains[word] < least:
            break
        chosen[word] = len(docs[word])
        for d in docs.pop(word):
            explained[d] += 1
    return chosen


def sample_labelled(documents: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """Staged ``text, toxic`` of about ``sample`` labelled documents, chosen by
    hash; equal texts once.  Documents outside the sample are dropped before
    anything is shuffled."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    n = known.count()
    share = min(1.0, sample / n) if n else 0.0
    chosen = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    docs = documents.select("doc_id", "text").where(chosen & F.col("text").isNotNull())
    return stage(docs.join(known.where(chosen), "doc_id").withColumn("__t", F.xxhash64("text")).dropDuplicates(["__t"])
                 .select("doc_id", "text", "toxic"), "toxic-sample")


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel | None:
    """Model from the given labelled documents; None without both labels."""
    rows = sample_labelled(documents, labels, sample)
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return None
    split = lambda d, text, toxic: ((d, w, toxic) for w in words_of(text))
    split.many = True
    pairs = map_rows(rows.select("doc_id", "text", "toxic"), split, "doc_id long, word binary, toxic int", 8192)
    counts = stage(pairs.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")), "toxic-words")
    # more than ten times as frequent in toxic documents
    lift = (F.col("t") / n[1]) > 10 * (F.col("c") + 0.5) / n[0]
    top = (counts.where((F.col("t") >= 3) & lift).orderBy(F.desc("t"), "word").limit(CANDIDATES).select("word").collect())
    candidates = [bytes(r["word"]) for r in top]
    if not candidates:
        phrases = train_phrases(rows, n, None)
        if phrases is not None:
            unstage(rows, counts)
            return _without_words(phrases)
        candidates = [bytes(r["word"]) for r in counts.where("t > 0").orderBy("c", F.desc("t"), "word").limit(50).select("word").collect()]
    hits = _hits(rows.where("toxic = 1"), candidates, words_of)
    bad = witnesses(hits, n[1]) or witnesses(hits, n[1], 1)
    if not bad:
        return None
    clean = [bytes(r["word"]) for r in counts.where("c > 0").orderBy(F.desc("c"), "word").limit(CLEAN_WORDS // 2).select("word").collect()]
    clean += [bytes(r["word"]) for r in counts.where("c > 0").orderBy(F.xxhash64("word")).limit(CLEAN_WORDS // 2).select("word").collect()]
    clean = [w for w in dict.fromkeys(clean) if w not in bad]
    model = _harden(rows, bad, clean, ToxicityModel.worst)
    _calibrate(rows, model, ToxicityModel.worst)
    phrases = train_phrases(rows, n, model)
    if phrases is not None:
        # words that explain hardly a document beside those of the phrases came by chance
        rest = stage(_below(rows.where("toxic = 1"), _without_words(phrases)), "toxic-rest")
        left = {r["doc_id"] for r in rest.select("doc_id").collect()}
        alone = defaultdict(set)
        for doc, word in hits:
            if doc in left:
                alone[word].add(doc)
        kept = {w: c for w, c in bad.items() if len(alone[w]) >= 3}
        if not kept:
            model = _without_words(phrases)
        elif len(kept) < len(bad):
            model = _harden(rows, kept, clean, ToxicityModel.worst)
            _calibrate(rest.unionByName(rows.where("toxic = 0").select("doc_id", "text", "toxic")), model, ToxicityModel.worst)
        unstage(rest)
        model.phrases = phrases
    unstage(rows, counts)
    return model


def _without_words(phrases: ToxicityModel) -> ToxicityModel:
    return ToxicityModel(np.zeros(SLOTS, dtype=np.float32), ToxicityModel.lowest, phrases=phrases)


def _below(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows ``doc_id, text, toxic`` that score under 0.5."""
    shared = Shared(rows.sparkSession, model)
    run = lambda d, t, y: [r for r, s in zip(zip(d, t, y, strict=True), shared.value.scores(t), strict=True) if s < 0.5]
    return map_slices(rows.select("doc_id", "text", "toxic"), run, "doc_id long, text string, toxic int")


def _hits(rows: DataFrame, candidates: list[bytes], parts) -> list[tuple[int, bytes]]:
    """(document, candidate) pairs of the rows."""
    inside = {*candidates}
    found = lambda d, text: ((d, w) for w in parts(text) & inside)
    found.many = True
    return [(r["doc_id"], bytes(r["word"])) for r in map_rows(rows.select("doc_id", "text"), found, "doc_id long, word binary").collect()]


def _harden(rows: DataFrame, bad: dict[bytes, int], clean: list[bytes], worst) -> ToxicityModel:
    """Machine trained again and again with its worst errors on clean documents."""
    clean = [*clean]
    for _ in range(3):
        hard = _hard_words(rows, _machine(bad, clean), bad, worst)
        fresh = [w for w in hard if w not in clean]
        if not fresh:
            break
        clean += fresh
    return _machine(bad, clean)


def train_phrases(rows: DataFrame, n: dict[int, int], model: ToxicityModel | None) -> ToxicityModel | None:
    """Machine of phrases, from the sentences of toxic documents that the machine
    of words finds clean (all toxic ones without it); None without such phrases."""
    missed = rows.where("toxic = 1").select("doc_id", "text", "toxic")
    if model is not None:
        missed = _below(missed, model)
    missed = stage(missed, "toxic-missed")
    split = lambda text: ((p,) for p in phrases_of(text))
    split.many = True
    phrases = lambda df: map_rows(df.select("text"), split, "phrase binary", 8192)
    often = stage(phrases(missed).groupBy("phrase").agg(F.count("*").alias("t")).where("t >= 3"), "toxic-phrases")
    if often.isEmpty():
        unstage(missed, often)
        return None
    clean_rows = rows.where("toxic = 0")
    c = phrases(clean_rows).join(F.broadcast(often.select("phrase")), "phrase").groupBy("phrase").agg(F.count("*").alias("c"))
    lift = (F.col("t") / n[1]) > 10 * (F.coalesce("c", F.lit(0)) + 0.5) / n[0]
    top = often.join(c, "phrase", "left").where(lift).orderBy(F.desc("t"), "phrase").limit(CANDIDATES).select("phrase").collect()
    bad = witnesses(_hits(missed, [bytes(r["phrase"]) for r in top], phrases_of), n[1])
    machine = None
    if bad:
        drawn = phrases(clean_rows).where(F.pmod(F.xxhash64("phrase"), F.lit(16)) == 0).distinct()
        clean = [bytes(r["phrase"]) for r in drawn.orderBy(F.xxhash64("phrase")).limit(CLEAN_WORDS).collect()]
        machine = _harden(rows, bad, [p for p in clean if p not in bad], ToxicityModel.worst_phrase)
        _calibrate(missed.unionByName(clean_rows.select("doc_id", "text", "toxic")), machine, ToxicityModel.worst_phrase)
    unstage(missed, often)
    return machine


def _machine(bad: dict[bytes, int], clean: list[bytes]) -> ToxicityModel:
    """Machine of toxic against clean words, both sides weighing the same."""
    words = [*bad, *clean]
    y = np.array([1.0] * len(bad) + [-1.0] * len(clean))
    weight = np.array([1 / len(bad)] * len(bad) + [1 / max(1, len(clean))] * len(clean))
    first = sorted(bad, key=lambda w: (-bad[w], w))[:LANDMARKS * 3 // 4]
    rest = clean[-(LANDMARKS - len(first)) // 2:] + clean[:(LANDMARKS - len(first)) // 2]
    return ToxicityModel(*train_machine(words, y, weight, [*first, *dict.fromkeys(rest)]))


def _hard_words(rows: DataFrame, model: ToxicityModel, bad, worst_of) -> list[bytes]:
    """Worst words (or phrases) of clean documents with the highest margins."""
    shared = Shared(rows.sparkSession, model)
    worst = map_slices(rows.where("toxic = 0").select("text"), lambda t: worst_of(shared.value, t), "margin double, word binary")
    got = worst.where("margin > -0.5").groupBy("word").agg(F.max("margin").alias("margin")).orderBy(F.desc("margin"), "word").limit(HARD).collect()
    return [bytes(r["word"]) for r in got if bytes(r["word"]) not in bad]


def _calibrate(rows: DataFrame, model: ToxicityModel, worst_of) -> None:
    """Sets score 0.5 where the sample errs least (one number a document)."""
    shared = Shared(rows.sparkSession, model)
    got = map_slices(rows.select("text", "toxic"), lambda t, y: [(m, label) for (m, _), label in zip(worst_of(shared.value, t), y, strict=True)],
                     "margin double, toxic int").collect()
    border = boundary(np.array([r["margin"] for r in got]), np.array([r["toxic"] for r in got]))
    model.line = (4.0, -4.0 * border)


def boundary(margins: np.ndarray, toxic: np.ndarray) -> float:
    """The border between margins with the fewest errors, the widest of equals;
    a quarter up from its lower end, for spoiled insults fall below whole ones."""
    order = np.argsort(margins, kind="stable")
    x, y = margins[order], toxic[order]
    missed = np.concatenate([[0], np.cumsum(y)])                          # toxic ones below border i
    false = np.concatenate([[0], np.cumsum(1 - y)])
    errors = missed + (false[-1] - false)
    edges = np.concatenate([[x[0] - 1], x, [x[-1] + 1]])
    gaps = np.diff(edges)
    errors = np.where(gaps > 0, errors, len(x) + 1)
    best = np.flatnonzero(errors == errors.min())
    i = best[np.argmax(gaps[best])]
    return float(edges[i] + 0.25 * gaps[i])


def score_documents(documents: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """``doc_id, score`` of every whole text."""
    if model is None:
        return documents.select("doc_id", F.lit(0.0).alias("score"))
    shared = Shared(documents.sparkSession, model)     # SLOTS numbers
    return map_slices(documents.select("doc_id", "text"), lambda d, t: list(zip(d, shared.value.scores(t), strict=True)), "doc_id long, score double")


def drop_toxic(documents: DataFrame, model: ToxicityModel | None, threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, with all their columns.
    Batches are filtered as they pass; no row is rebuilt or moved."""
    if model is None:
        return documents
    shared = Shared(documents.sparkSession, model)
    at = documents.columns.index("text")

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield part.filter(pa.array([s < threshold for s in shared.value.scores(part.column(at).to_pylist())], type=pa.bool_()))

    return map_batches(documents, run)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def train_on_open_rows(documents: DataFrame, labels: DataFrame) -> ToxicityModel | None:
    return train(documents.where(~held_out()), labels.where(~held_out()))


def op4_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_documents(documents, train_on_open_rows(documents, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
