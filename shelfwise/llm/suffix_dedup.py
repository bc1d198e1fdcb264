"""Removal of long repeated byte strings by induced suffix sorting.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts anywhere
else in the corpus.  Shards of text are sorted by suffix (induced sorting), and
the permuted common-prefix array tells which positions begin such a string.

No shard could hold a corpus, so equal strings must first come to one shard.

1. *Anchors.*  Every window of LENGTH bytes has an anchor: its 64-byte gram with
   the smallest hash, the leftmost of equals.  Equal windows have equal anchors
   at the same offset.  The windows of one anchor form a segment.
2. *Groups* of anchors by gram hash.  A gram that occurs once has no repeated
   window.  Segments that are equal as a whole are repeated throughout and need
   no sorting.  The rest are cut out of the texts, one of each content.
3. *Shards* of whole groups are sorted, and the windows that occur in two
   segments (or twice in one) are repeated.  A group too large for a shard is
   resolved by counting the digests of its windows.

Hashes that decide an equality are 128 bits wide.

Defined cases: null is the empty text; texts shorter than LENGTH lose nothing;
equal texts (repeated rows too) repeat each other; matches never cross texts; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import _BYTE, _Tables, _batch, arrow_schema, map_rows, mix64, stage, unstage

LENGTH = 200
GRAM = 64
BLOCK = 1 << 19
#: Bytes sorted as one shard, and segments of a group beyond which its windows are counted instead.
SHARD_BYTES = 1 << 20
SHARD_SEGMENTS = 8_000


# ---- induced sorting ------------------------------------------------------------

def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of small integers whose last element is a unique smallest.

    Suffixes are S (smaller than the next) or L.  Leftmost S suffixes are sorted
    by their substrings, recursively where substrings repeat; from them first all
    L, then all S suffixes are induced, bucket by bucket.
    """
    n = len(text)
    if n < 2:
        return np.arange(n)
    step = np.sign(np.diff(text.astype(np.int64)))
    at = np.where(step != 0, np.arange(n - 1), n)
    ahead = np.minimum.accumulate(at[::-1])[::-1]       # the next change decides a run of equals
    small = np.ones(n, dtype=bool)
    small[:-1] = step[np.minimum(ahead, n - 2)] > 0
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    order = _induce(text, leftmost)
    is_leftmost = np.zeros(n, dtype=bool)
    is_leftmost[leftmost] = True
    by_substring = order[is_leftmost[order]]
    names, distinct = _name(text, leftmost, by_substring)
    if distinct == len(leftmost):
        return _induce(text, by_substring)
    return _induce(text, leftmost[_sort_names(names, distinct)])


def _sort_names(names: np.ndarray, distinct: int) -> np.ndarray:
    """Suffix order of the string of names: recursion while buckets are few,
    doubling of compared lengths where they are many."""
    if distinct <= 512:
        return suffix_array(names)
    rank, width = names.astype(np.int64), 1
    while True:
        follow = np.zeros_like(rank)
        follow[:-width] = rank[width:] + 1
        key = rank * (len(rank) + 1) + follow
        order = np.argsort(key, kind="stable")
        new = np.zeros_like(rank)
        new[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank, width = new, width * 2
        if rank.max() == len(rank) - 1 or width >= len(rank):
            return np.argsort(rank, kind="stable")


def _name(text: np.ndarray, leftmost: np.ndarray, by_substring: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks of the leftmost-S substrings, equal ones alike, in text order."""
    ends = np.empty(len(text), dtype=np.int64)
    ends[leftmost] = np.append(leftmost[1:], len(text) - 1)
    a, b = by_substring[:-1], by_substring[1:]
    sizes = ends[a] - a
    same = sizes == ends[b] - b
    open_ = np.flatnonzero(same)
    k = 0
    while len(open_):
        differ = text[a[open_] + k] != text[b[open_] + k]
        same[open_[differ]] = False
        open_ = open_[~differ & (sizes[open_] > k)]
        k += 1
    rank = np.concatenate([[0], np.cumsum(~same)])
    names = np.empty(len(text), dtype=np.int64)
    names[by_substring] = rank
    return names[leftmost], int(rank[-1]) + 1


def _induce(text: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """Order of all suffixes induced from leftmost-S suffixes in the given order."""
    top = int(text.max()) + 1
    ordered = leftmost[np.argsort(text[leftmost], kind="stable")]
    cuts = np.searchsorted(text[ordered], np.arange(top + 1))
    waiting: list[list[np.ndarray]] = [[] for _ in range(top)]
    large: list[np.ndarray] = []
    none = np.zeros(0, dtype=np.int64)
    for c in range(top):                # L suffixes, from the left
        parts = _runs(text, waiting[c], c)
        large.append(np.concatenate(parts) if parts else none)
        _hand_on(text, np.concatenate([large[c], ordered[cuts[c]:cuts[c + 1]]]), waiting, lambda t, c=c: t > c)
    waiting = [[] for _ in range(top)]
    out: list[np.ndarray] = []
    for c in range(top - 1, -1, -1):    # S suffixes, from the right
        if c == 0:                      # the unique smallest element is a suffix of its own
            waiting[0] = [np.array([len(text) - 1])]
        parts = _runs(text, waiting[c], c)
        small = np.concatenate(parts) if parts else none
        from_right = np.concatenate([small, large[c][::-1]])
        out.append(from_right)
        _hand_on(text, from_right, waiting, lambda t, c=c: t < c)
    return np.concatenate(out)[::-1]


def _runs(text: np.ndarray, parts: list[np.ndarray], c: int) -> list[np.ndarray]:
    """The suffixes waiting for bucket c and, after them, those that continue a
    run of c to the left."""
    if not parts:
        return []
    parts = [np.concatenate(parts)]
    while True:
        before = parts[-1] - 1
        before = before[before >= 0]
        before = before[text[before] == c]
        if not len(before):
            return parts
        parts.append(before)


def _hand_on(text: np.ndarray, scanned: np.ndarray, waiting: list[list[np.ndarray]], keep) -> None:
    """Suffixes one to the left of the scanned ones join their buckets, in order."""
    before = scanned - 1
    before = before[before >= 0]
    chars = text[before]
    kept = keep(chars)
    before, chars = before[kept], chars[kept]
    if not len(before):
        return
    order = np.argsort(chars, kind="stable")
    before, chars = before[order], chars[order]
    cuts = np.flatnonzero(np.concatenate([[True], chars[1:] != chars[:-1]]))
    for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(chars)], strict=True):
        waiting[int(chars[i])].append(before[i:j])


def permuted_prefixes(text: np.ndarray, suffixes: np.ndarray, most: int) -> np.ndarray:
    """For each position, in text order, the common prefix (up to ``most``) with
    the suffix before it in the suffix array."""
    n = len(text)
    before = np.full(n, -1, dtype=np.int64)
    before[suffixes[1:]] = suffixes[:-1]
    out = np.zeros(n, dtype=np.int64)
    padded = np.concatenate([text.astype(np.uint64), np.zeros(8, dtype=np.uint64)])
    words = np.zeros(n, dtype=np.uint64)
    for k in range(4):                  # four elements of 16 bits in a word
        words = (words << np.uint64(16)) | padded[k:k + n]
    open_ = np.flatnonzero(before >= 0)
    k = 0
    while len(open_) and k < most:
        i, j = open_ + k, before[open_] + k
        inside = (i < n - 3) & (j < n - 3)
        equal = np.zeros(len(open_), dtype=bool)
        equal[inside] = words[i[inside]] == words[j[inside]]
        ended = open_[~equal]
        for m in range(4):              # the last word element by element
            i, j = ended + k + m, before[ended] + k + m
            ok = (i < n) & (j < n)
            ok[ok] = text[i[ok]] == text[j[ok]]
            ended = ended[ok]
            out[ended] = k + m + 1
        open_ = open_[equal]
        k += 4
        out[open_] = k
    return np.minimum(out, most)


def repeated_starts(segments: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Per segment, the starts of its ``length``-byte strings that start anywhere
    else in the segments."""
    size = sum(len(s) + 1 for s in segments)
    text = np.ones(size + 1, dtype=np.uint16)       # 0 ends the text, 1 a segment
    text[-1] = 0
    at, where = 0, []
    for s in segments:
        text[at:at + len(s)] = np.frombuffer(s, dtype=np.uint8).astype(np.uint16) + 2
        where.append(at)
        at += len(s) + 1
    order = suffix_array(text)
    prefixes = permuted_prefixes(text, order, length)
    long = prefixes >= length
    follows = np.zeros(len(text), dtype=bool)       # ... with the suffix after it
    follows[order[:-1]] = long[order[1:]]
    repeated = long | follows
    return [np.flatnonzero(repeated[a:a + max(0, len(s) - length + 1)]) for a, s in zip(where, segments, strict=True)]


# ---- anchors ---------------------------------------------------------------------

def _sums(data: np.ndarray) -> np.ndarray:
    up, _ = _Tables.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=sums[1:])
    return sums


def _span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return (sums[ends] - sums[starts]) * _Tables.get(len(sums))[1][starts]


def anchors(raw: bytes, length: int = LENGTH, gram: int = GRAM):
    """Anchors of all windows of a text: gram hash, segment hash, first and last
    window start."""
    out = []
    for at in range(0, max(0, len(raw) - length + 1), BLOCK):
        data = np.frombuffer(raw[at:at + BLOCK + length - 1], dtype=np.uint8)
        sums = _sums(data)
        n = len(data) - gram + 1
        hashes = mix64(_span_hashes(sums, np.arange(n), np.arange(gram, gram + n)))
        low = np.uint64(20)
        best = (hashes >> low << low) | np.arange(n, dtype=np.uint64)
        span, done = length - gram + 1, 1
        while done * 2 <= span:
            best, done = np.minimum(best[:-done], best[done:]), done * 2
        if span > done:
            best = np.minimum(best[:len(best) - (span - done)], best[span - done:])
        gram_at = (best & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], gram_at[1:] != gram_at[:-1]]))
        last = np.append(first[1:], len(gram_at)) - 1
        q = gram_at[first]
        shape = (q - first).astype(np.uint64) * np.uint64(1 << 20) + (last - first).astype(np.uint64)
        segment = mix64(_span_hashes(sums, first, last + length) + mix64(shape + np.uint64(1)))
        out.append((hashes[q], segment, first + at, last + at))
    if not out:
        return [np.zeros(0, dtype=np.int64)] * 4
    return [np.concatenate(c).astype(np.uint64).view(np.int64) for c in zip(*out, strict=True)]


MARKS = "doc_id long, digest string, n_bytes long, gram array<long>, segment array<long>, first array<long>, last array<long>, more array<int>, own array<long>"


def mark(doc_id, text):
    """Anchors of one text, each content once: ``more`` tells how many more
    there are in the text, ``own`` the first starts and last starts of those that
    repeat inside the text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    gram, segment, first, last = anchors(raw)
    both = np.stack([gram, segment], axis=1)
    _, index, inverse, counts = np.unique(both, axis=0, return_index=True, return_inverse=True, return_counts=True) if len(gram) else (None, *[np.zeros(0, dtype=int)] * 3)
    twice = counts[inverse] > 1 if len(gram) else np.zeros(0, dtype=bool)
    own = np.concatenate([first[twice], last[twice]])
    return (doc_id, hashlib.sha256(raw).hexdigest(), len(raw), gram[index], segment[index], first[index], last[index],
            (counts - 1).astype(np.int32), own)


# ---- corpus ----------------------------------------------------------------------

def _cut(digest, text, wanted):
    """Segments of one text, cut out."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    for w in wanted:
        yield w["gram"], w["segment"], w["row"], w["first"], w["lone"], raw[w["first"]:w["last"] + LENGTH]


_cut.many = True

FOUND = "row long, starts array<long>"


def sort_shards(segments: DataFrame) -> DataFrame:
    """``row, starts`` (starts of repeated windows) of the lone segments of a
    table of cut-out segments: shards of whole groups, streamed in gram order."""
    schema = arrow_schema(FOUND)

    def resolve(shard):
        out = []
        for (row, first, lone, _), starts in zip(shard, repeated_starts([s[3] for s in shard]), strict=True):
            if lone and len(starts):
                out.append((row, (starts + first).tolist()))
        return out

    def run(batches):
        shard, group, seen, gram, size, out = [], [], set(), None, 0, []
        for batch in batches:
            for g, segment, row, first, lone, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if g != gram:
                    shard += group
                    if size >= SHARD_BYTES:
                        out += resolve(shard)
                        shard, size = [], 0
                    group, seen, gram = [], set(), g
                if segment not in seen:         # copies of a text bring a segment more than once
                    seen.add(segment)
                    group.append((row, first, lone, raw))
                    size += len(raw) + 1
            if out:
                yield _batch(out, schema)
                out = []
        shard += group
        if shard:
            out += resolve(shard)
        if out:
            yield _batch(out, schema)

    ordered = segments.repartition("gram").sortWithinPartitions("gram", "segment")
    return ordered.select("gram", "segment", "row", "first", "lone", "raw").mapInArrow(run, FOUND)


def _windows(gram, segment, row, first, lone, raw):
    """128-bit digests of the windows of one segment."""
    data = np.frombuffer(raw, dtype=np.uint8)
    for k in range(len(data) - LENGTH + 1):
        yield row, bool(lone), first + k, hashlib.blake2b(raw[k:k + LENGTH], digest_size=16).digest()


_windows.many = True


def count_windows(segments: DataFrame) -> DataFrame:
    """``row, starts`` as of ``sort_shards``, for groups of any size: windows are
    counted by digest, pre-aggregated before the shuffle."""
    one = segments.dropDuplicates(["gram", "segment"]).select("gram", "segment", "row", "first", "lone", "raw")
    windows = stage(map_rows(one, _windows, "row long, lone boolean, start long, digest binary", 8192), "windows")
    twice = windows.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    return windows.where("lone").join(twice, "digest").groupBy("row").agg(F.collect_list("start").alias("starts"))


def repeated_spans(documents: DataFrame, shard_segments: int = SHARD_SEGMENTS) -> tuple[DataFrame, DataFrame]:
    """(staged rows ``row, doc_id, digest, n_bytes, copies``, spans ``digest,
    first, end`` of distinct texts that occur once; spans may overlap)."""
    marks = stage(map_rows(documents.select("doc_id", "text"), mark, MARKS, 256)
                  .withColumn("row", F.monotonically_increasing_id()), "marks")
    copies = marks.groupBy("digest").agg(F.count("*").alias("copies"))
    rows = stage(marks.select("row", "doc_id", "digest", "n_bytes").join(copies, "digest"), "texts")
    anchor = marks.select("row", F.inline(F.arrays_zip("gram", "segment", "first", "last", "more")))
    grams = (anchor.groupBy("gram").agg(F.sum(F.col("more") + 1).alias("n"), F.min("segment").alias("s0"), F.max("segment").alias("s1"))
             .where("n > 1").select("gram", (F.col("s0") != F.col("s1")).alias("mixed")))
    shared = stage(anchor.join(grams, "gram"), "anchors")
    whole = shared.where(~F.col("mixed")).select("row", "first", "last")
    mixed = shared.where("mixed")
    kinds = stage(mixed.groupBy("gram", "segment").agg(F.sum(F.col("more") + 1).alias("n"), F.min("row").alias("rep")), "segments")
    groups = (kinds.groupBy("gram").agg(F.count("*").alias("kinds"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("lonely"))
              .where("kinds > 1 AND lonely > 0").select("gram", "kinds"))
    repeated = mixed.join(kinds.where("n > 1").select("gram", "segment"), ["gram", "segment"]).select("row", "first", "last")
    # one of each content, cut out of its text
    cut = (mixed.join(kinds.select("gram", "segment", (F.col("n") == 1).alias("lone"), F.col("rep").alias("row")), ["gram", "segment", "row"])
           .join(groups, "gram"))
    wanted = (cut.join(rows.select("row", "digest"), "row").groupBy("digest")
              .agg(F.collect_list(F.struct("gram", "segment", "row", "first", "last", "lone", "kinds")).alias("wanted")))
    texts = documents.select(F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("digest"), "text")
    parts = "gram long, segment long, row long, first long, lone boolean, raw binary"
    pieces = stage(map_rows(texts.join(wanted, "digest").select("digest", "text", "wanted"), _cut, parts, 1024)
                   .join(groups, "gram"), "pieces")
    found = sort_shards(pieces.where(F.col("kinds") <= shard_segments))
    crowded = pieces.where(F.col("kinds") > shard_segments)
    if not crowded.isEmpty():
        found = found.unionByName(count_windows(crowded))
    starts = found.select("row", F.explode("starts").alias("first")).withColumn("last", F.col("first"))
    half = F.expr("cast(size(own) / 2 as int)")
    own = (marks.where(F.size("own") > 0)
           .select("row", F.inline(F.arrays_zip(F.slice("own", F.lit(1), half).alias("first"), F.slice("own", half + 1, half).alias("last")))))
    spans = stage(whole.unionByName(repeated).unionByName(starts).unionByName(own), "spans")
    unstage(pieces, kinds, shared, marks)
    partly = rows.where("copies = 1").select("row", "digest")
    return rows, spans.join(partly, "row").select("digest", "first", (F.col("last") + LENGTH).alias("end"))


def merge_spans(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, end in sorted((s["first"], s["end"]) for s in spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return [tuple(s) for s in out]


def keep_rest(raw: bytes, spans) -> bytes:
    out, at = [], 0
    for first, end in spans:
        out.append(raw[at:first])
        at = end
    return b"".join([*out, raw[at:]])


def _digest_row(doc_id, text, spans):
    raw = text.encode("utf-8", "surrogatepass")
    merged = merge_spans(spans)
    return doc_id, len(raw), sum(b - a for a, b in merged), len(merged), hashlib.sha256(keep_rest(raw, merged)).hexdigest()


def remove_repeats(documents: DataFrame) -> DataFrame:
    """``doc_id, kept`` (bytes) of every text."""
    rows, spans = repeated_spans(documents)
    by_text = spans.groupBy("digest").agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    copied = rows.where(f"copies > 1 AND n_bytes >= {LENGTH}").select("digest", F.lit(True).alias("copied")).distinct()
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", F.sha2(F.encode("text", "UTF-8"), 256))
    joined = texts.join(by_text, "digest", "left").join(copied, "digest", "left").select("doc_id", "text", "spans", "copied")
    rest = lambda d, t, s, c: (d, b"" if c else keep_rest(t.encode("utf-8", "surrogatepass"), merge_spans(s or [])))
    return map_rows(joined, rest, "doc_id long, kept binary", 128)


def op8_suffix_dedup(documents: DataFrame) -> DataFrame:
    """Contract columns.  Texts are joined with their spans only where a part of
    them goes; wholly kept or removed ones need their digest and size."""
    rows, spans = repeated_spans(documents)
    by_text = stage(spans.groupBy("digest").agg(F.collect_list(F.struct("first", "end")).alias("spans")), "spans-by-text")
    texts = documents.select("doc_id", "text", F.sha2(F.encode("text", "UTF-8"), 256).alias("digest")).where("text IS NOT NULL")
    partly = map_rows(texts.join(by_text, "digest").select("doc_id", "text", "spans"), _digest_row,
                      "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    gone = F.expr(f"copies > 1 AND n_bytes >= {LENGTH}")
    other = (rows.join(by_text.select("digest"), "digest", "left_anti")
             .select("doc_id", "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(0).cast("long").alias("n_removed"),
                     F.when(gone, 1).otherwise(0).cast("long").alias("n_spans"),
                     F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("digest")).alias("kept_sha256")))
    return partly.unionByName(other)
