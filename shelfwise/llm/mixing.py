"""Mixing sources to target weights by pivotal dependent rounding.

A source's share of the mix fixes how often its documents are taken on average:
``rate = target / source size``.  Every document is taken ``floor(rate)`` times
and once more with the fractional probability.  These probabilities are rounded
two at a time: a pair moves words from one document to the other, in a random
direction drawn so that both expectations hold, until one of them is taken or
left for certain; the other carries the rest on.  The words of a pair do not
change, so a source ends within one document of its target.

Groups of documents round among themselves and pass on what is left, one
document each; the left-overs form the next level of groups, up to one document
per source, which a last draw decides (a distributed reduction tree).

DataFrame functions only.  The draws are hashes of the documents, so reruns
agree.

Defined cases: a null source is a source, the last; a null text has no words;
documents without words take nothing; equal rows round apart like any other; an
empty table gives an empty result; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import packed, stage
from shelfwise.llm.sharding import one_row_per_copy

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1.0, 2.0, 3.0)
MAX_COPIES = 3
SEED = 20240607
#: Documents that one group rounds at once.
GROUP = 256


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: float = MAX_COPIES) -> DataFrame:
    """``source, source_size, target`` of a staged table ``source, source_size``.

    Weights repeat over the sources by code point, null last.  Shares above
    ``most`` times the source are cut and the rest is shared again by weight,
    until none is above; each round is one small aggregate.
    """
    ordered = sizes.select("source", "source_size", *_rank(sizes)).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int")))
    ordered = stage(ordered.select("source", "source_size", "weight", (F.col("source_size") * most).cast("double").alias("cap")), "sources")
    total = ordered.agg(F.sum("source_size")).first()[0] or 0
    cut = F.lit(False)
    level = 0.0
    while True:
        fixed, weight, above = ordered.agg(F.sum(F.when(cut, F.col("cap")).otherwise(0.0)), F.sum(F.when(cut, 0.0).otherwise(F.col("weight"))),
                                           F.count("*")).first()
        if not weight:
            break
        new_level = (total - fixed) / weight
        newly = ordered.where(~cut & (F.col("cap") < F.col("weight") * new_level)).limit(1).count()
        level = new_level
        if not newly:
            break
        cut = F.col("cap") < F.col("weight") * level
    return ordered.select("source", "source_size", F.when(cut, F.col("cap")).otherwise(F.col("weight") * level).alias("target"))


def _rank(sizes: DataFrame) -> list[Column]:
    """Place among all sources by code point, null last.  The table has one row
    per source, which one window can sort."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    return [(F.row_number().over(order) - 1).cast("long").alias("rank")]


def _draw(seed: int, *parts) -> Column:
    """Uniform in (0, 1) from a hash."""
    return (F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def _meet(a: Column, x: Column) -> Column:
    """One step of a group: the carried document (probability cp, size cs) meets x.

    ``up`` words can flow from x to the carried one and ``down`` words the other
    way.  The flow goes up with probability down / (up + down), which keeps both
    expectations; afterwards one of the two stands at 0 or 1 and is decided.
    """
    lift, give = (1 - a["cp"]) * a["cs"], x["p"] * x["size"]
    drop, room = a["cp"] * a["cs"], (1 - x["p"]) * x["size"]
    up, down = F.least(lift, give), F.least(drop, room)
    rise = x["u"] * (up + down) < down
    carried_done = F.when(rise, lift <= give).otherwise(drop <= room)
    left = F.when(carried_done, x["p"] + F.when(rise, -lift).otherwise(drop) / x["size"]).otherwise(
        a["cp"] + F.when(rise, give).otherwise(-room) / a["cs"])
    return F.struct(F.when(carried_done, x["id"]).otherwise(a["cid"]).alias("cid"),
                    F.greatest(F.lit(0.0), F.least(F.lit(1.0), left)).alias("cp"),
                    F.when(carried_done, x["size"]).otherwise(a["cs"]).alias("cs"),
                    F.concat(a["out"], F.array(F.struct(F.when(carried_done, a["cid"]).otherwise(x["id"]).alias("id"),
                                                        (carried_done == rise).cast("int").alias("take")))).alias("out"))


def round_group(docs: Column, id_type: str) -> Column:
    """Pivotal rounding of an array of ``struct<u, id, p, size>``: a struct of
    the decided documents ``out`` and the carried one ``cid, cp, cs``."""
    first = F.struct(docs[0]["id"].alias("cid"), docs[0]["p"].alias("cp"), docs[0]["size"].alias("cs"),
                     F.array().cast(f"array<struct<id:{id_type},take:int>>").alias("out"))
    return F.aggregate(F.slice(docs, 2, F.size(docs)), first, _meet)


def dependent_rounding(docs: DataFrame, seed: int = SEED, group: int = GROUP) -> DataFrame:
    """``source, id, take`` (0 or 1) of a table ``source, id, p, size`` with
    size > 0 and unique ids: per source, sum(take * size) is sum(p * size) up to
    one document."""
    docs = docs.select("source", "id", F.col("p").cast("double"), F.col("size").cast("long"))
    id_type = docs.schema["id"].dataType.simpleString()
    level = 0
    decided = []
    while True:
        counts = docs.groupBy("source").agg(F.ceil(F.count("*") / group).alias("groups"))
        draws = docs.withColumn("u", _draw(seed + 2 * level, "id"))
        # sources are few beside documents; the join is left to Spark's own size check
        placed = (draws.join(counts.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
                  .withColumn("part", F.pmod(F.xxhash64(F.lit(seed + 2 * level + 1), "id"), F.col("groups"))))
        grouped = (placed.groupBy("source", "part")
                   .agg(F.array_sort(F.collect_list(F.struct("u", "id", "p", "size"))).alias("docs"), F.max("groups").alias("groups")))
        done = stage(grouped.select("source", "groups", round_group(F.col("docs"), id_type).alias("r")), f"pivotal{level}")
        decided.append(done.select("source", F.explode("r.out").alias("o")).select("source", "o.id", "o.take"))
        carried = done.select("source", F.col("r.cid").alias("id"), F.col("r.cp").alias("p"), F.col("r.cs").alias("size"))
        if done.where("groups > 1").isEmpty():
            last = carried.select("source", "id", (_draw(seed - 1, "id") < F.col("p")).cast("int").alias("take"))
            decided.append(last)
            break
        docs, level = carried, level + 1
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    return out


def mix(sized: DataFrame, weights=WEIGHTS, most: float = MAX_COPIES, seed: int = SEED) -> DataFrame:
    """``doc_id, source, size, copy, source_size, target, copies`` of a table
    ``doc_id, source, size``.  Equal rows differ by ``copy``."""
    rows = stage(one_row_per_copy(sized.select("doc_id", "source", "size")).withColumnRenamed("__copy", "copy"), "sized")
    sizes = stage(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source_sizes")
    targets = source_targets(sizes, weights, most).withColumnRenamed("source", "__source")
    rated = (rows.join(targets, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
             .withColumn("rate", F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0))
             .withColumn("whole", F.floor(F.col("rate") + 1e-9).cast("int"))
             .withColumn("p", F.greatest(F.lit(0.0), F.col("rate") - F.col("whole"))))
    open_docs = rated.where("p > 0 AND size > 0").select("source", F.struct("doc_id", "size", "copy").alias("id"), "p", "size")
    taken = dependent_rounding(open_docs, seed).select(F.col("source").alias("__s"), F.col("id.doc_id").alias("__d"), F.col("id.size").alias("__z"),
                                                       F.col("id.copy").alias("__c"), "take")
    same = (F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("copy") == F.col("__c")) & (F.col("size") == F.col("__z"))
            & F.col("source").eqNullSafe(F.col("__s")))
    return (rated.join(taken, same, "left")
            .select("doc_id", "source", "size", "copy", "source_size", "target",
                    F.when(F.col("size") > 0, F.col("whole") + F.coalesce("take", F.lit(0))).otherwise(0).alias("copies")))


def mix_documents(documents: DataFrame, weights=WEIGHTS, most: float = MAX_COPIES, seed: int = SEED) -> DataFrame:
    """The mix itself: every document as many times as it is taken."""
    rows = packed(documents, "doc_id", "source", "text").withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
    copies = mix(rows.select("doc_id", "source", "size"), weights, most, seed).where("copies > 0").select(
        F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("size").alias("z"), F.col("copy").alias("c"), "copies")
    numbered = Window.partitionBy("doc_id", "source", "size").orderBy("text")
    placed = rows.withColumn("place", (F.row_number().over(numbered) - 1).cast("long"))
    same = (F.col("doc_id").eqNullSafe(F.col("d")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
            & (F.col("place") == F.col("c")))
    return placed.join(copies, same).select("row", F.explode(F.expr("sequence(1, copies)"))).select("row.*")


def op5_source_mix(documents: DataFrame) -> DataFrame:
    sized = documents.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    return mix(sized).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "source")
