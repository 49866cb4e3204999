"""Mixing sources to target weights by hash thresholds, without sorting.

Every document has a hash (60 bits of its id's MD5), so that a source's documents have a fixed random order. Sizes are summed by source and hash
bucket (12 bits); running sums find the bucket in which a source's budget ends, and only that bucket's documents are
summed again by the next 12 bits, until it holds one hash. What lies below the threshold is taken: a filter.
Thresholds are nested: a smaller budget takes a subset of what a larger one takes. Documents are only hash-aggregated; what is
sorted are the sums, at most 4096 for each source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import written
from ._skew import lookup, small

BITS, STEP = 60, 12
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """``sizes`` (source, source_size, others) with ``target``.

    Sources by code point, null last, have the weights in turn and share ``share`` times all sizes; a target stops at ``most`` times the
    source's size, and the rest is shared again by weight until none is above. Sources whose limit over weight is
    least reach it first, so that one pass in that order finds them. Sources are aggregated rows, few next to the documents: one task orders them.
    """
    one = Window.partitionBy()
    by_name = one.orderBy(F.asc_nulls_last("source"))
    by_ratio = one.orderBy("ratio", "i")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("i") % len(weights) + 1).cast("int"))
    df = sizes.withColumn("i", F.row_number().over(by_name) - 1).withColumns({"w": weight, "cap": F.col("source_size") * F.lit(float(most))})
    df = df.withColumns({"budget": F.sum("source_size").over(one) * F.lit(float(share)), "ratio": F.col("cap") / F.col("w")})
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    df = df.withColumns({"before": before, "rest": F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))})
    df = df.withColumn("full", F.col("cap") <= F.col("w") * (F.col("budget") - F.col("before")) / F.col("rest"))
    used = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(one)
    free = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(one)
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.try_divide(F.col("w") * (F.col("budget") - used), free))
    return df.select(*sizes.columns, target.alias("target"))


def thresholds(marks: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` (key, source_size, target, ...) with ``rounds``, ``edge`` and ``edge_in``.

    A source is taken ``rounds`` times whole, and once more below hash ``edge``; documents with that very hash are taken if
    that comes as near or nearer to the target. ``marks`` has the key of the source, the size and the hash of every document.
    """
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("rounds", rounds.cast("long")).withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size"))
    state = plan.select("key", "rest", F.lit(0).cast("long").alias("base"))
    inside, edges, bits = marks, None, 0
    while True:
        bits += STEP
        bucket = F.shiftright("hash", BITS - bits).alias("bucket")
        sums = inside.groupBy("key", bucket).agg(F.sum("size").alias("size"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        order = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0))).join(small(state), "key").withColumn("base", F.col("base") + F.col("before"))
        found = written(sums.filter((F.col("base") <= F.col("rest")) & (F.col("rest") < F.col("base") + F.col("size"))), "mixing")
        ended = found.filter("low = high").select("key", F.col("low").alias("edge"), (F.col("base") + F.col("size") / 2 <= F.col("rest")).alias("edge_in"))
        edges = ended if edges is None else edges.unionByName(ended)
        open_ones = found.filter("low <> high")
        if open_ones.isEmpty():
            break
        state = open_ones.select("key", "rest", "base")
        at = small(open_ones.select("key", "bucket"))
        inside = written(inside.withColumn("bucket", bucket).join(at, ["key", "bucket"], "left_semi").drop("bucket"), "mixing")
    return written(plan.drop("rest").join(edges, "key", "left"), "mixing")


def mix(docs: DataFrame, size: Column | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, keep: tuple[str, ...] = (), prefix: bool = False) -> DataFrame:
    """Every document's id, source, columns ``keep`` (their names led by ``keep_`` if ``prefix``), ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (copies times size).

    ``size`` is the number of words unless given. A null id hashes as ''; documents with equal ids are taken together, and so are those whose hashes tie.
    Null is a source of its own. Null and empty texts have size 0, and a copy each if they lie below the threshold; a source of size 0 has target 0.
    No document has more than ``most`` copies. Very long texts count whole. Repeated rows each have a result, extra columns are ignored unless kept, and an empty table gives an
    empty result. Reruns give the same mix.
    """
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    light = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        (word_count(F.col(text_col)) if size is None else size.cast("long")).alias("size"),
        F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long").alias("hash"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("key"),
        *[F.col(c).alias(f"keep_{c}") for c in keep],
    )
    stored = light if keep else written(light, "mixing")
    marks = written(light.select("key", "source", "size", "hash"), "mixing") if keep else stored
    sizes = marks.groupBy("key", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    plan = thresholds(marks.select("key", "size", "hash"), written(targets(sizes, weights, share, most), "mixing"))
    total = plan.agg(F.sum("n_docs")).first()[0] or 0
    joined = lookup(stored, plan.drop("source"), "key", "n_docs", max(1, total))
    below = (F.col("hash") < F.col("edge")) | ((F.col("hash") == F.col("edge")) & F.col("edge_in"))
    copies = F.least(F.lit(int(most)).cast("long"), F.col("rounds") + F.coalesce(below, F.lit(False)).cast("long"))
    out = joined.withColumn("copies", copies)
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), *[F.col(f"keep_{c}").alias(f"keep_{c}" if prefix else c) for c in keep], "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken (``most`` times at most), with the columns of ``docs`` and no others.

    Rows that repeat one another are each taken; nulls, empty and very long texts, ties and an empty table as in :func:`mix`. Columns whose names are those of added ones are kept as they are.
    """
    out = mix(docs, id_col=id_col, source_col=source_col, keep=tuple(docs.columns), prefix=True, **options)
    return out.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*[F.col(f"keep_{c}").alias(c) for c in docs.columns])
