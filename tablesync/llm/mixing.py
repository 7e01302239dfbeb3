"""Mixing sources to target weights: Efraimidis-Spirakis sampling. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import WORD_PATTERN, partitions, running_total, stored, text_or_empty

SYMBOLS = "#*$%&|<>"


def word_count(text_col: str) -> Column:
    return F.regexp_count(text_or_empty(text_col), F.lit(WORD_PATTERN)).cast("long")


def plain_share(text_col: str) -> Column:
    """A quality weight from 0.05 to 1 that falls with the share of the symbols ``#*$%&|<>``."""
    text = text_or_empty(text_col)
    symbols = 1 - F.length(F.translate(text, SYMBOLS, "")) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(0.05), 1 - 8 * symbols)


def source_targets(sizes: DataFrame, weights: Sequence[float], max_epochs: int) -> DataFrame:
    """Targets of sources: shares of the whole size by weight, none above ``max_epochs`` of its own.

    ``sizes`` has one row per source (``skey`` in order, ``source_size``): a dimension table. What a
    capped source leaves is shared by weight among the rest until none is above its cap; sorted
    by cap per weight, that is one pass: a source is capped if the share per weight that is left for
    it and all later ones reaches its cap.
    """
    everything = Window.partitionBy()
    by_cap = Window.orderBy("ratio", "skey").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.row_number().over(Window.orderBy(F.col("skey").isNull(), "skey"))
    ranked = (
        sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank - 1) % len(weights) + 1))
        .withColumn("cap", F.col("source_size").cast("double") * max_epochs)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    left = F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("cap").over(by_cap), F.lit(0.0))
    share = left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_cap), F.lit(0.0)))
    capped = ranked.withColumn("capped", F.col("ratio") <= share)
    over = lambda value: F.sum(F.when(~F.col("capped"), F.col(value)).otherwise(0.0)).over(everything)
    kept = F.sum(F.col("source_size").cast("double")).over(everything) - F.sum(
        F.when(F.col("capped"), F.col("cap")).otherwise(0.0)
    ).over(everything)
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * kept / over("weight"))
    return capped.withColumn("target", F.least(target, F.col("cap"))).select("skey", "source_size", "target")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    max_epochs: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    quality: Column | None = None,
    seed: int = 7,
    cut_last: bool = True,
    with_row: bool = False,
) -> DataFrame:
    """Say how many words of every document a mix takes so that each source meets its target.

    Sources in code point order (null last) get the weights in turn. A source that is below its target
    is taken whole ``floor(target / size)`` times; the rest of the target is filled from its documents in the order
    of ``-ln(u) / quality``, ``u`` a hash of seed, id and text in (0, 1): weighted sampling without
    replacement. The document at the limit gives the words that are still missing, or, without
    ``cut_last``, all or none of its words, whichever is nearer.

    The order within a source is one of (bucket of the key, key): buckets are summed first and each
    is then summed by itself, so a source with most of the rows is split over all tasks.

    Returns ``id_col``, source, size, source_size, target, quality, taken and, if asked for, ``row``
    (the whole input row). Defined cases: a null text has size 0 and is never taken; a null source is a source of its own, the
    last; rows that are alike in id and text share one key and are taken one after the other; an empty
    table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    spread = partitions(spark)
    weight = F.greatest(plain_share(text_col) if quality is None else quality.cast("double"), F.lit(1e-9))
    noise = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), text_or_empty(text_col)), 11) + 0.5) / F.lit(2.0**53)
    base = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.col(source_col).cast("string").alias("skey"),
        word_count(text_col).alias("size"),
        F.coalesce(weight, F.lit(1e-9)).alias("quality"),
        noise.alias("noise"),
        *([F.struct(*[F.col(c) for c in docs.columns]).alias("row")] if with_row else []),
    )
    base = base.withColumn("key", -F.log("noise") / F.col("quality")).drop("noise")
    # Any rising function of the key keeps the order; this one spreads it evenly.
    base = base.withColumn("bucket", F.least(F.floor((1 - F.exp(-F.col("key") * 0.7)) * spread), F.lit(spread - 1)).cast("int"))
    counted = base.drop("row") if with_row else stored(base, "mixing")
    base = base if with_row else counted
    buckets = stored(counted.groupBy("skey", "bucket").agg(F.sum("size").alias("n")), "mixing-sums")
    sizes = buckets.groupBy("skey").agg(F.sum("n").alias("source_size"))
    plan = running_total(buckets, ["skey"], "bucket", "n", "before").join(
        source_targets(sizes, weights, max_epochs).withColumnRenamed("skey", "tkey"), F.col("skey").eqNullSafe(F.col("tkey"))
    )
    plan = plan.select(F.col("skey").alias("pkey"), F.col("bucket").alias("pbucket"), "before", "source_size", "target")
    order = Window.partitionBy("skey", "bucket").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    left = F.col("rest") - F.col("before") - F.col("inner")
    part = (
        F.greatest(F.lit(0), F.least(F.col("size"), F.col("left")))
        if cut_last
        else F.when(F.col("left") * 2 >= F.col("size"), F.col("size")).otherwise(0)
    )
    return (
        base.withColumn("inner", F.coalesce(F.sum("size").over(order), F.lit(0)))
        .join(plan, F.col("skey").eqNullSafe(F.col("pkey")) & (F.col("bucket") == F.col("pbucket")))
        .withColumn("epochs", epochs)
        .withColumn("rest", rest)
        .withColumn("left", left)
        .select(
            F.col("id").alias(id_col),
            F.col("source").alias(source_col),
            "size",
            "source_size",
            "target",
            "quality",
            (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
            *(["row"] if with_row else []),
        )
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The input rows as often as the mix takes them, documents whole. One that it does not take goes.

    Documents without words are never taken; null sources are one source; repeated rows are documents of their own; all columns
    stay; an empty table gives no rows.
    """
    taken = mix_sources(docs, cut_last=False, with_row=True, **options).where("taken > 0")
    times = F.round(F.col("taken") / F.col("size")).cast("int")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), times))).select("row.*")
