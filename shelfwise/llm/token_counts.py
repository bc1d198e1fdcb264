"""Token counts under a public tokenizer file, huge documents in overlapping chunks.

A text of up to ``chunk`` code points is encoded where it lies.  A longer one is
cut into chunks that reach ``overlap`` code points into both neighbours; each chunk
is a unit of work of its own, encoded with offsets by whichever task gets it.  Two
neighbours are spliced at the first offset of their overlap that is a pre-token
start in both and provably stable:

* the pattern of the pre-tokenizer never looks back, so two scans that both begin a
  match at one offset agree from there on;
* the code point there is one that normalisation leaves alone and never merges with
  what precedes it (``stable_start``), so both sides normalise as the whole does;
* a special token holds its first character nowhere else (checked when the file is
  loaded), so its finds do not depend on where the scan began, and the left chunk
  reaches at least ``margin`` code points beyond the offset: whatever could cover
  it has been seen whole.

A file whose normaliser or pattern is another than the one this was proven for is
refused.

By induction from the first chunk, whose start is that of the text, every splice is
a boundary of the whole text, and a document's count is the sum of its pieces'.  Only
counts and the boundaries of the overlaps are brought together by document.  Where an
overlap holds no common boundary (a run without spaces longer than it), its
document is encoded anew with overlaps eight times as wide and chunks to fit, until
all its neighbours meet; at the latest one chunk holds the whole text.

Short texts need only their counts.  No pre-token or special token holds a space and
no code point merges with one, so the words between spaces are counted by the library
once and remembered, within ``MEMO`` code points a worker.

Defined cases: a null text is empty and has no tokens; equal long texts are encoded
once; repeated rows and null doc_ids keep their rows; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import unicodedata
from bisect import bisect_left
from itertools import chain

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import map_rows, map_slices, stage

CHUNK = 1 << 14
OVERLAP = 256
WIDEN = 8
LIMIT = 2048
MEMO = 1 << 23
# The steps the proof above holds for
_NORMALISE = ({"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"})
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
# Ranges of code points at which a splice may lie if stable_start agrees
_RANGES = ((0x21, 0x2FF), (0x370, 0x482), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3))


def stable_start(char: str) -> bool:
    """Normalisation keeps ``char`` as one code point whatever precedes it."""
    return (any(a <= ord(char) <= b for a, b in _RANGES) and not char.isspace() and not unicodedata.combining(char)
            and unicodedata.normalize("NFC", char) == char and len(char.lower()) == 1)


class TokenCounter:
    """A tokenizer file, shipped to executors once as a broadcast (its size is that
    of the vocabulary file) and built once per worker."""

    def __init__(self, source: Broadcast, margin: int):
        self.source, self.margin, self._built = source, margin, None
        self._known, self._held = {}, 0

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TokenCounter":
        with open(path, encoding="utf-8") as f:
            text = f.read()
        spec = json.loads(text)
        added = spec.get("added_tokens") or []
        split = {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True}
        if (spec.get("normalizer") != {"type": "Sequence", "normalizers": list(_NORMALISE)}
                or spec.get("pre_tokenizer") != {"type": "Sequence", "pretokenizers": [split, _BYTES]}):
            raise ValueError("no splice is proven for this normaliser or pre-tokenizer")
        if any(t[k] for t in added for k in ("lstrip", "rstrip", "single_word", "normalized")) or any(" " in t["content"] for t in added):
            raise ValueError("no splice is proven for special tokens that depend on what is around them")
        added = [t["content"] for t in added]
        if any(a[1:].find(b[0]) >= 0 for a in added for b in added):
            raise ValueError("special tokens that can overlap make no provable splice")
        return cls(spark.sparkContext.broadcast(text), 2 + max([8, *map(len, added)]))

    def __getstate__(self):
        return {"source": self.source, "margin": self.margin, "_built": None, "_known": {}, "_held": 0}

    @property
    def tokenizer(self):
        if self._built is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
            from tokenizers import Tokenizer

            self._built = Tokenizer.from_str(self.source.value)
            self._built.no_truncation()
            self._built.no_padding()
        return self._built

    def counts(self, texts: list[str]) -> list[int]:
        words = [t.split(" ") for t in texts]
        new = list(set(chain.from_iterable(words)).difference(self._known))
        self._known.update(zip(new, map(len, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)), strict=True))
        counts = [sum(map(self._known.__getitem__, w)) for w in words]
        self._held += sum(map(len, new))
        if self._held > MEMO:
            self._known, self._held = {}, 0
        return counts

    def boundaries(self, text: str, spans: list[tuple[int, int]]) -> tuple[int, list[list[tuple[int, int]]]]:
        """Number of tokens, and for each span of offsets its stable pre-token
        starts with the number of tokens before them."""
        encoding = self.tokenizer.encode(text, add_special_tokens=False)
        starts, words = [a for a, _ in encoding.offsets], encoding.word_ids
        found = []
        for low, high in spans:
            here, t = [], bisect_left(starts, low)
            while t < len(starts) and starts[t] < high:
                if (t == 0 or words[t] != words[t - 1] and starts[t] != starts[t - 1]) and stable_start(text[starts[t]]):
                    here.append((starts[t], t))
                t += 1
            found.append(here)
        return len(starts), found


def _cut(chunk: int, overlap: int):
    """(key, text) -> (key, k, last, at, the chunk with its overlaps)."""
    def cut(key, text):
        last = (len(text) - 1) // chunk
        for k in range(last + 1):
            at = max(0, k * chunk - overlap)
            yield key, k, last, at, text[at:(k + 1) * chunk + overlap]
    cut.many = True
    return cut


_MARKS = "array<struct<at:long,before:long>>"


def _encode(counter: TokenCounter, chunk: int, overlap: int):
    def encode(key, k, last, at, text):
        left = (0, k * chunk + overlap - at) if k else (0, 0)
        right = ((k + 1) * chunk - overlap - at, len(text) - counter.margin) if k < last else (0, 0)
        n, (before, after) = counter.boundaries(text, [left, right])
        return key, k, last, n, [(at + p, t) for p, t in before], [(at + p, t) for p, t in after]
    return encode


def splice(texts: DataFrame, counter: TokenCounter, chunk: int, overlap: int) -> DataFrame:
    """``key, k, begin, end, n_tokens`` of the pieces of a table ``key, text``; equal
    keys have equal texts.  ``n_tokens`` is null where a neighbour was not met, and
    ``begin``, ``end`` are null at the ends of the text and there."""
    if chunk <= 2 * overlap or overlap <= counter.margin:
        raise ValueError("a chunk holds more than two overlaps, an overlap more than the margin")
    cut = map_rows(texts.select("key", "text"), _cut(chunk, overlap), "key string, k int, last int, at long, text string", 64)
    # one row a chunk: copies of a text meet before the shuffle, chunks of a text in different tasks
    once = cut.groupBy("key", "k", "last", "at").agg(F.first("text").alias("text")).select("key", "k", "last", "at", "text")
    marks = map_rows(once, _encode(counter, chunk, overlap), f"key string, k int, last int, n long, left {_MARKS}, right {_MARKS}", 256)
    order = Window.partitionBy("key").orderBy("k")      # at most 2^31 / chunk small rows a key
    meet = F.array_min(F.array_intersect("right.at", F.lead("left.at").over(order)))
    met = (marks.withColumn("end", F.when(F.col("k") < F.col("last"), meet))
           .withColumn("begin", F.lag("end").over(order)))
    before = lambda side, at: F.get(F.filter(side, lambda m: m["at"] == F.col(at)), F.lit(0))["before"]
    first = F.when(F.col("k") == 0, F.lit(0)).otherwise(before("left", "begin"))
    after = F.when(F.col("k") == F.col("last"), F.col("n")).otherwise(before("right", "end"))
    return met.select("key", "k", "begin", "end", (after - first).alias("n_tokens"))


def count_long(texts: DataFrame, counter: TokenCounter, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``key, n_tokens`` of the distinct texts of a table ``key, text``."""
    rest, counted = texts, None
    while True:
        pieces = stage(splice(rest, counter, chunk, overlap), "token-pieces")
        whole = pieces.groupBy("key").agg(F.sum("n_tokens").alias("n_tokens"), F.count_if(F.col("n_tokens").isNull()).alias("gaps"))
        done = whole.where("gaps = 0").select("key", "n_tokens")
        counted = done if counted is None else counted.unionByName(done)
        open_ = pieces.where("n_tokens IS NULL").select("key").distinct()
        if open_.isEmpty():
            return counted
        rest = rest.join(open_, "key", "left_semi")
        overlap *= WIDEN
        chunk = max(chunk, 4 * overlap)


def count_documents(documents: DataFrame, counter: TokenCounter, limit: int = LIMIT, chunk: int = CHUNK,
                    overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document."""
    text = F.coalesce("text", F.lit(""))
    docs = documents.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    short = map_slices(docs.where(F.length("text") <= chunk),
                       lambda ids, sizes, texts: list(zip(ids, sizes, counter.counts(texts), strict=True)),
                       "doc_id long, n_bytes long, n_tokens long", 64)
    long = docs.where(F.length("text") > chunk).withColumn("key", F.sha2("text", 256))
    counts = count_long(long.select("key", "text"), counter, chunk, overlap)
    joined = long.select("doc_id", "n_bytes", "key").join(counts, "key").select("doc_id", "n_bytes", "n_tokens")
    return short.unionByName(joined).withColumn("over_limit", F.col("n_tokens") > limit)


def public_counter(spark: SparkSession, name: str = "word_bpe_49k.json") -> TokenCounter:
    import public_tokenizers

    return TokenCounter.load(spark, public_tokenizers.path(name))


def op12_token_counts(documents: DataFrame) -> DataFrame:
    return count_documents(documents, public_counter(documents.sparkSession))
