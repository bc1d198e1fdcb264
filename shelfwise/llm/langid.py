"""Language identification with error-correcting output codes.

Every language gets a codeword of bits.  For each bit a binary classifier on
byte n-grams says whether a text belongs to the languages with that bit set:
the weight of an n-gram is the log-ratio of its frequency on both sides.  A text
is decoded to the codeword with the smallest weighted loss of the bit margins;
bits that separate their sides well weigh more, so a few wrong bits are
outvoted.  Where two codewords are nearly as near, the text is flagged
``ambiguous``.

Training is one pass: n-gram counts per language over all training documents,
added up in tasks and then by Spark.  What reaches the driver is languages x
features numbers, whatever the size of the corpus.

Defined cases: null text and text without a letter give ``und`` and score 0;
without any training language every text is ``und``; with one, every text with
a letter gets it; rows without lang do not train; a null doc_id trains and is
not held out; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Shared, _batch, arrow_schema, map_rows

TRIGRAMS = 1 << 15
BIGRAMS = 1 << 13
FEATURES = TRIGRAMS + BIGRAMS
BLOCK = 1 << 10
PIECE = 1 << 20
UNDETERMINED = "und"

_FOLD = np.full(256, 32, dtype=np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def features(text: str) -> np.ndarray:
    """Counts of hashed byte bigrams and trigrams of the lower-cased text; all
    that is no letter counts as a space.  Whole texts, piece by piece."""
    raw = text.lower().encode("utf-8", "surrogatepass")
    out = np.zeros(FEATURES, dtype=np.float64)
    for at in range(0, max(1, len(raw)), PIECE):
        data = np.frombuffer(raw[max(0, at - 2):at + PIECE], dtype=np.uint8)
        codes = _FOLD[data]
        if at == 0:
            codes = np.concatenate([_FOLD[32:33], codes])
        if at + PIECE >= len(raw):
            codes = np.concatenate([codes, _FOLD[32:33]])
        if len(codes) < 2:
            continue
        two = codes[:-1] * np.uint32(256) + codes[1:]
        three = two[:-1] * np.uint32(256) + codes[2:]
        # a later piece repeats two codes of the one before: skip the bigram and no trigram seen there
        two = two[1:] if at else two
        two, three = two[two != 0x2020], three[three != 0x202020]
        out[:TRIGRAMS] += np.bincount((three * np.uint32(2654435761)) >> np.uint32(17), minlength=TRIGRAMS)
        out[TRIGRAMS:] += np.bincount((two * np.uint32(2654435761)) >> np.uint32(19), minlength=BIGRAMS)
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """k rows of +1 / -1.  Up to 7 languages: every split into two sides once
    (2^(k-1) - 1 bits); beyond: random bits, the best of several draws by
    smallest distance between rows."""
    if k <= 1:
        return np.ones((k, 0))
    if k <= 7:
        columns = [[1 if i == 0 or not (b >> (i - 1)) & 1 else -1 for i in range(k)] for b in range(1, 1 << (k - 1))]
        return np.array(columns, dtype=float).T
    rng = np.random.default_rng(seed)
    bits = math.ceil(10 * math.log2(k))
    draws = [rng.choice([-1.0, 1.0], size=(k, bits)) for _ in range(20)]
    draws = [d[:, np.abs(d.sum(axis=0)) < k] for d in draws]

    def distance(d):
        near = (d.shape[1] - d @ d.T) / 2
        return near[~np.eye(k, dtype=bool)].min()
    return max(draws, key=distance)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    codes: np.ndarray       # languages x bits
    weights: np.ndarray     # features x bits
    middle: np.ndarray      # bits: margin 0
    scale: np.ndarray       # bits: margin 1
    trust: np.ndarray       # bits

    def margins(self, counts: np.ndarray) -> np.ndarray:
        n = counts.sum()
        return (counts @ self.weights / (n or 1) - self.middle) / self.scale

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        margins = self.margins(features(text))
        loss = (self.trust * np.maximum(0, 1 - self.codes * margins) ** 2).sum(axis=1)
        order = np.argsort(loss, kind="stable")
        best, second = float(loss[order[0]]), float(loss[order[1]])
        score = (second - best) / (second + best) if second + best else 0.0
        return self.languages[order[0]], min(1.0, max(0.0, score)), score < 0.2


def train(counts: dict[str, np.ndarray]) -> LanguageModel:
    """Model from n-gram counts per language."""
    languages = tuple(sorted(counts))
    codes = codewords(len(languages))
    p = np.array([(counts[c] + 0.5) / (counts[c].sum() + 0.5 * FEATURES) for c in languages]).reshape(-1, FEATURES)
    if len(languages) < 2:
        return LanguageModel(languages, codes, np.zeros((FEATURES, 0)), np.zeros(0), np.ones(0), np.ones(0))
    on, off = codes > 0, codes < 0
    weights = (np.log(on.T @ p / on.sum(axis=0)[:, None]) - np.log(off.T @ p / off.sum(axis=0)[:, None])).T
    mean = p @ weights                      # expected margin per n-gram, languages x bits
    spread = np.sqrt(np.maximum(p @ weights ** 2 - mean ** 2, 1e-12))
    low = np.where(on, mean, np.inf).min(axis=0)
    high = np.where(off, mean, -np.inf).max(axis=0)
    middle = (low + high) / 2
    scale = np.maximum((low - high) / 2, 1e-6)
    trust = (scale / spread.mean(axis=0)) ** 2
    return LanguageModel(languages, codes, weights, middle, scale, trust / trust.sum())


def count_ngrams(texts: DataFrame) -> dict[str, np.ndarray]:
    """N-gram counts per language of a table ``lang, text``: summed in each
    task, then by Spark in blocks of features."""
    ddl = "lang string, block int, counts array<double>"
    schema = arrow_schema(ddl)

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    counts = features(text)
                    if lang in sums:
                        sums[lang] += counts
                    else:
                        sums[lang] = counts
        for lang, counts in sums.items():
            yield _batch([(lang, b, counts[b * BLOCK:(b + 1) * BLOCK]) for b in range(FEATURES // BLOCK)], schema)

    parts = texts.select("lang", "text").mapInArrow(run, ddl)
    out: dict[str, np.ndarray] = {}
    for r in (parts.select("lang", "block", F.posexplode("counts").alias("i", "c")).groupBy("lang", "block", "i").agg(F.sum("c").alias("c"))
              .groupBy("lang", "block").agg(F.sort_array(F.collect_list(F.struct("i", "c"))).alias("cs")).collect()):
        out.setdefault(r["lang"], np.zeros(FEATURES))[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = [c["c"] for c in r["cs"]]
    return out


def identify(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` of every text."""
    shared = Shared(documents.sparkSession, model)     # features x bits numbers
    return map_rows(documents.select("doc_id", "text"), lambda d, t: (d, *shared.value.predict(t)),
                    "doc_id long, lang_pred string, score double, ambiguous boolean")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def op7_language_id(documents: DataFrame) -> DataFrame:
    model = train(count_ngrams(documents.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())))
    return identify(documents, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
