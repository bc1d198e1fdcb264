"""Byte-level BPE encoding and decoding with a public rank file.

Pre-tokens are the matches of a pattern; byte-pair merges never cross them.  A
text of up to ``chunk`` code points is encoded where it lies.  A longer one is
cut into overlapping chunks that separate tasks pre-tokenise.  A chunk that
starts inside a pre-token soon agrees with its left neighbour: from the first
boundary that both find in their overlap on, they find the same boundaries, for
the pattern only looks right.  The pieces between such boundaries are encoded in
parallel and their ids are joined in order.  Where an overlap holds no common
boundary (one pre-token longer than the overlap), the text is encoded whole.

Decoding concatenates the raw bytes of the ids.

Defined cases: a null text is empty; an empty text has no ids; equal long texts
are encoded once; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib

import regex
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import map_rows

CHUNK = 1 << 16
OVERLAP = 256
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Codec:
    """Rank file and pattern, shipped to executors once as a broadcast (its size
    is that of the vocabulary file)."""

    def __init__(self, ranks: Broadcast, pattern: str):
        self.ranks, self.pattern, self._encoding = ranks, pattern, None

    @classmethod
    def load(cls, spark: SparkSession, path: str, pattern: str) -> "Codec":
        with open(path, "rb") as f:
            return cls(spark.sparkContext.broadcast(f.read()), pattern)

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern, "_encoding": None}

    @property
    def encoding(self) -> tiktoken.Encoding:
        if self._encoding is None:
            ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in self.ranks.value.splitlines() if line)}
            self._encoding = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return self._encoding

    def encode(self, text: str | None) -> list[int]:
        return self.encoding.encode_ordinary(text or "")

    def decode(self, ids) -> bytes:
        return self.encoding.decode_bytes(ids)


def _digest(codec: Codec, ids) -> tuple[int, str, str]:
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(codec.decode(ids)).hexdigest())


def chunks(chunk: int, overlap: int):
    """(key, text) -> (key, k, last, offset, text of the chunk with its overlaps)."""
    def cut(key, text):
        last = (len(text) - 1) // chunk
        for k in range(last + 1):
            at = max(0, k * chunk - overlap)
            yield key, k, last, at, text[at:(k + 1) * chunk + overlap]
    cut.many = True
    return cut


def boundaries(pattern: str, chunk: int, overlap: int):
    """Adds to a chunk the pre-token starts in its left and in its right overlap
    (offsets in the text).  The last two starts of a cut chunk are left out:
    what follows the cut may change them."""
    compiled = regex.compile(pattern)

    def find(key, k, last, at, text):
        starts = [at + m.start() for m in compiled.finditer(text)]
        if k < last:
            starts = starts[:-2]
        left, right = k * chunk + overlap, (k + 1) * chunk - overlap
        return (key, k, last, at, text, [s for s in starts if s < left] if k else [],
                [s for s in starts if s >= right] if k < last else [])

    return find


def encode_long(texts: DataFrame, codec: Codec, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``key, ids`` of the distinct texts of a table ``key, text``."""
    assert chunk > 2 * overlap
    cut = map_rows(texts.select("key", "text"), chunks(chunk, overlap), "key string, k int, last int, at long, text string")
    # one chunk is one unit of work, wherever its text came from
    cut = cut.repartition("key", "k")
    found = map_rows(cut, boundaries(codec.pattern, chunk, overlap),
                     "key string, k int, last int, at long, text string, left array<long>, right array<long>", 16)
    by_key = Window.partitionBy("key")
    order = by_key.orderBy("k")
    meets = F.array_min(F.array_intersect("right", F.lead("left").over(order)))
    pieces = (found.withColumn("end", F.when(F.col("k") < F.col("last"), meets))
              .withColumn("start", F.when(F.col("k") == 0, F.lit(0)).otherwise(F.lag("end").over(order)))
              .withColumn("split", F.count(F.when((F.col("k") < F.col("last")) & F.col("end").isNull(), 1)).over(by_key) == 0))
    encode = lambda key, k, text: (key, k, codec.encode(text))
    cut_text = F.expr("CASE WHEN end IS NULL THEN substring(text, cast(start - at + 1 AS int)) "
                      "ELSE substring(text, cast(start - at + 1 AS int), cast(end - start AS int)) END")
    good = pieces.where("split").select("key", "k", cut_text.alias("text"))
    whole = pieces.where(~F.col("split") & (F.col("k") == 0)).select("key").join(texts, "key").select("key", F.lit(0).alias("k"), "text")
    ids = map_rows(good.unionByName(whole), encode, "key string, k int, ids array<int>", 16)
    return (ids.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts"))
            .select("key", F.flatten(F.col("parts.ids")).alias("ids")))


def encode_documents(documents: DataFrame, codec: Codec, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, ids`` of every document."""
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    short = map_rows(docs.where(F.length("text") <= chunk), lambda d, t: (d, codec.encode(t)), "doc_id long, ids array<int>", 128)
    long = docs.where(F.length("text") > chunk).withColumn("key", F.sha2("text", 256))
    ids = encode_long(_distinct(long), codec, chunk, overlap)
    return short.unionByName(long.select("doc_id", "key").join(ids, "key").select("doc_id", "ids"))


def decode_documents(ids: DataFrame, codec: Codec) -> DataFrame:
    """``doc_id, bytes`` of ``doc_id, ids``."""
    return map_rows(ids.select("doc_id", "ids"), lambda d, i: (d, codec.decode(i)), "doc_id long, bytes binary", 128)


def _distinct(long: DataFrame) -> DataFrame:
    return long.groupBy("key").agg(F.first("text").alias("text"))


def digest_documents(documents: DataFrame, codec: Codec, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Token count, digest of the ids and digest of the decoded bytes."""
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    short = map_rows(docs.where(F.length("text") <= chunk), lambda d, t: (d, *_digest(codec, codec.encode(t))), DIGEST)
    long = docs.where(F.length("text") > chunk).withColumn("key", F.sha2("text", 256))
    ids = encode_long(_distinct(long), codec, chunk, overlap)
    digests = map_rows(ids, lambda key, i: (key, *_digest(codec, i)),
                       DIGEST.replace("doc_id long", "key string"), 64)
    return short.unionByName(long.select("doc_id", "key").join(digests, "key")
                             .select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))


def public_codec(spark: SparkSession, name: str = "byte_bpe_multi_50k.tiktoken") -> Codec:
    import public_tokenizers

    return Codec.load(spark, public_tokenizers.path(name), public_tokenizers.PATTERN)


def op6_byte_bpe(documents: DataFrame) -> DataFrame:
    return digest_documents(documents, public_codec(documents.sparkSession))
