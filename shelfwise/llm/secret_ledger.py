"""Secret scans through an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its text).  A
ledger remembers which rule versions each blob has been scanned with, so a run
scans only unseen (blob, rule version) pairs, once however many paths and
versions hold the blob.  Findings are stored per blob and joined back to all
paths.

Defined cases: a null text is an empty blob without findings; equal texts share
one blob; an empty table gives an empty result; spans are code points with an
exclusive end, in the blob as given; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import map_batches, map_rows, packed, stage


@dataclass(frozen=True)
class SecretRule:
    """A pattern with the version that the ledger remembers.  ``group`` with
    fewer than ``least`` characters drops a match; ``hints`` are lower-case
    strings of which a matching text holds at least one."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    hints: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The first three are the base rules; their order is the order of kinds.
BASE_KINDS = ("assign", "access", "hex")
RULES = (
    SecretRule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               2, 6, ("passw", "secret", "token", "api_key", "apikey")),
    SecretRule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, ("akia",)),
    SecretRule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
    SecretRule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?", 0, 0, ("private key-----",)),
    SecretRule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0, ("eyj",)),
    SecretRule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    SecretRule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0, ("xox",)),
    SecretRule("url_login", 1, r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,64}:[^\s:/@]{3,64}@", 0, 0, ("://",)),
)

FINDINGS = "array<struct<kind:string,start:int,end:int>>"


def scanner(rules=RULES):
    """Function of (blob, text, pending rule keys) giving the blob's findings."""
    compiled = [(r, re.compile(r.pattern, re.ASCII)) for r in rules]

    def scan(blob, text, pending):
        found = []
        lowered = None
        for rule, pattern in compiled:
            if rule.key not in pending:
                continue
            if rule.hints:
                lowered = text.lower() if lowered is None else lowered
                if not any(h in lowered for h in rule.hints):
                    continue
            for m in pattern.finditer(text):
                if len(m.group(rule.group)) >= rule.least:
                    found.append((rule.kind, m.start(), m.end()))
        return blob, pending, [{"kind": k, "start": s, "end": e} for k, s, e in found]

    return scan


def blob_id(text_col: str = "text"):
    return F.sha2(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8"), 256)


def empty_ledger(spark) -> DataFrame:
    return spark.createDataFrame([], f"blob string, rules array<string>, findings {FINDINGS}")


def update_ledger(versions: DataFrame, ledger: DataFrame | None, rules=RULES) -> DataFrame:
    """Scan what ``ledger`` has not seen of ``versions`` (column ``text``, any
    others) and return the new ledger rows ``blob, rules, findings``; append
    them to the ledger.

    Equal texts are reduced to one before and after the shuffle, so a blob that
    a third of all rows share travels once per task.
    """
    wanted = F.array(*[F.lit(r.key) for r in rules])
    blobs = (versions.select(blob_id().alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
             .groupBy("blob").agg(F.first("text").alias("text")))
    if ledger is None:
        todo = blobs.select("blob", "text", wanted.alias("pending"))
    else:
        seen = (ledger.select("blob", F.explode("rules").alias("rule")).distinct()
                .groupBy("blob").agg(F.collect_set("rule").alias("seen")))
        todo = (blobs.join(seen, "blob", "left")
                .select("blob", "text", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))).alias("pending"))
                .where(F.size("pending") > 0))
    return map_rows(todo, scanner(rules), f"blob string, rules array<string>, findings {FINDINGS}")


def findings_by_blob(ledger: DataFrame, rules=RULES) -> DataFrame:
    """Current findings per blob with any: of the given rules only, by start,
    then kind in rule order."""
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    one = (ledger.where(F.size("findings") > 0).select("blob", F.explode("findings").alias("f"))
           .select("blob", "f.kind", "f.start", "f.end").where(F.col("kind").isin([r.kind for r in rules])).distinct())
    return (one.groupBy("blob")
            .agg(F.array_sort(F.collect_list(F.struct("start", rank["kind"].alias("rank"), "kind", "end"))).alias("findings")))


def scan_documents(documents: DataFrame, ledger: DataFrame | None = None, rules=RULES) -> tuple[DataFrame, DataFrame]:
    """(documents with ``blob`` and ``findings``, staged new ledger rows)."""
    fresh = stage(update_ledger(documents, ledger, rules), "ledger")
    known = fresh if ledger is None else fresh.unionByName(ledger)
    found = findings_by_blob(known, rules)
    return documents.withColumn("__blob", blob_id()).join(found.withColumnRenamed("blob", "__blob")
                                                          .withColumnRenamed("findings", "__findings"), "__blob", "left"), fresh


def _digest(findings):
    return F.concat_ws(",", F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))))


def op2_secret_scan(documents: DataFrame) -> DataFrame:
    """Contract columns of the secret scan of all documents."""
    hits, _ = scan_documents(documents.select("doc_id", "text"))
    found = F.coalesce("__findings", F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>"))
    rows = hits.select("doc_id", found.alias("f"))
    kinds = [F.expr(f"cast(size(filter(f, x -> x.kind = '{k}')) as long)").alias(f"n_{k}") for k in BASE_KINDS]
    base = F.filter("f", lambda x: x["kind"].isin(list(BASE_KINDS)))
    return rows.select("doc_id", *kinds, F.sha2(_digest(base), 256).alias("base_sha256"), _digest(F.col("f")).alias("spans"))


def redact(text, findings):
    """Text with every span replaced by ``[kind]``; overlapping spans merge."""
    if text is None or not findings:
        return text
    out, at = [], 0
    for f in sorted(findings, key=lambda f: (f["start"], -f["end"])):
        if f["start"] >= at:
            out += [text[at:f["start"]], f"[{f['kind']}]"]
        at = max(at, f["end"])
    return "".join(out) + text[at:]


def redact_documents(documents: DataFrame, rules=RULES) -> DataFrame:
    """The documents with secrets replaced in ``text``; a column ``n_chars``
    follows the new text.  Documents without findings pass unchanged: findings
    are joined by blob, and only rows that have some go through Python."""
    columns = documents.columns
    found, _ = scan_documents(packed(documents, "text"), rules=rules)
    clean = found.where("__findings IS NULL").select("row.*")
    dirty = found.where("__findings IS NOT NULL").select("row.*", "__findings")
    at = columns.index("text")
    # a column of that name that holds no numbers is another column
    length = columns.index("n_chars") if dict(documents.dtypes).get("n_chars") in ("int", "bigint") else None

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                *kept, spans = part.columns
                texts = [redact(t, f) for t, f in zip(kept[at].to_pylist(), spans.to_pylist(), strict=True)]
                kept[at] = pa.array(texts, type=kept[at].type)
                if length is not None:
                    old = kept[length].to_pylist()
                    kept[length] = pa.array([n if t is None else len(t) for n, t in zip(old, texts, strict=True)], type=kept[length].type)
                yield pa.RecordBatch.from_arrays(kept, names=part.schema.names[:-1])

    return clean.union(map_batches(dirty, run, len(columns)))
