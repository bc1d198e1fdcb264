"""Queries of the llm operators, and their SQL where SQL can express them."""

from __future__ import annotations

from shelfwise.llm.bpe_codec import op6_byte_bpe
from shelfwise.llm.common import read_table
from shelfwise.llm.fingerprints import op10_fingerprints
from shelfwise.llm.jaccard_join import op3_jaccard_join
from shelfwise.llm.langid import op7_language_id
from shelfwise.llm.mixing import op5_source_mix
from shelfwise.llm.prefix_trie import op13_prefix_trie
from shelfwise.llm.quality_rules import op1_quality_rules
from shelfwise.llm.secret_ledger import op2_secret_scan
from shelfwise.llm.sharding import op9_sharding
from shelfwise.llm.suffix_dedup import op8_suffix_dedup
from shelfwise.llm.token_counts import op12_token_counts
from shelfwise.llm.toxicity import op4_toxicity
from shelfwise.llm.whitening import op11_whitening


def _on(table, op):
    def run(spark, sf_dir):
        return op(read_table(spark, sf_dir, table))
    run.__doc__ = op.__doc__
    run.__name__ = op.__name__
    return run


def _on_documents(op):
    return _on("documents", op)


def _toxicity(spark, sf_dir):
    return op4_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


LLM_QUERIES = {
    "op1_quality_rules": _on_documents(op1_quality_rules),
    "op2_secret_scan": _on_documents(op2_secret_scan),
    "op3_jaccard_join": _on_documents(op3_jaccard_join),
    "op4_toxicity": _toxicity,
    "op5_source_mix": _on_documents(op5_source_mix),
    "op6_byte_bpe": _on_documents(op6_byte_bpe),
    "op7_language_id": _on_documents(op7_language_id),
    "op8_suffix_dedup": _on_documents(op8_suffix_dedup),
    "op9_sharding": _on_documents(op9_sharding),
    "op10_fingerprints": _on_documents(op10_fingerprints),
    "op11_whitening": _on("embeddings", op11_whitening),
    "op12_token_counts": _on_documents(op12_token_counts),
    "op13_prefix_trie": _on("conversations", op13_prefix_trie),
}

# CRC-32 of the decimal conversation id: each digit is one xor and eight shifts.
_CRC32 = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"""

#: Rebuilt conversations as lists of turns; a node is a prefix of them, and each node adds
#: what it holds to all its prefixes.
_TRIE_SQL = f"""WITH turns AS (
  SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(t ORDER BY pos) AS path, CAST({_CRC32} % 4 AS BIGINT) AS h FROM turns GROUP BY conv_id),
built AS (SELECT o.conv_id, list_concat(coalesce(b.path[1:o.h], o.path[1:0]), o.path[o.h + 1:]) AS path
          FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
members AS (SELECT conv_id, depth, path[1:depth] AS node, depth = len(path) AS ends
            FROM (SELECT conv_id, path, unnest(generate_series(0, len(path))) AS depth FROM built)),
nodes AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
          FROM members GROUP BY node, depth),
children AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
valued AS (SELECT n.*, coalesce(c.n, 0) AS n_children, CASE WHEN depth = 0 THEN 0
             ELSE (n_convs - 1) * len(regexp_extract_all(n.node[depth].text, '[^\\x20\\x09-\\x0D]+')) END AS saved
           FROM nodes n LEFT JOIN children c ON c.node = n.node),
sums AS (SELECT above AS node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
         FROM (SELECT node[1:k] AS above, n_children, saved FROM (SELECT *, unnest(generate_series(0, depth)) AS k FROM valued)) GROUP BY 1)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
FROM valued v JOIN sums s ON s.node = v.node LEFT JOIN nodes p ON v.depth > 0 AND p.depth = v.depth - 1 AND p.node = v.node[1:v.depth - 1]"""

LLM_SQL: dict[str, str] = {"op13_prefix_trie": _TRIE_SQL}
