"""References to rows that do not exist, are gone, or come later.

A Bloom filter of the target names, of bounded size whatever the number of
targets, is broadcast: a name it does not hold is an orphan for certain. Only
the rest is looked up exactly. Whether any target row is live at a moment is a
running maximum of end times over start order, taken in two levels (hour
buckets, then inside the hour), so that no name gathers in one task.

Edge cases: null and empty references are none; a target row with a null start
exists but is never live; a reference with a null time has no live target
(reason `missing` or `deleted`, null period); repeated rows count once; an
empty target table makes every reference `missing`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.names import file_key
from folioflow.session import cut_lineage

#: Bits of the filter at most: 8 MB to broadcast and at most 1,048,576 words to gather. Twelve bits a name up to 5.6 million names; beyond, more references are left to the exact join.
MAX_BITS = 1 << 26
HASHES = 4
FOREVER = "9999-12-31 00:00:00"


def _positions(h: Column, bits: int) -> Column:
    low = h.bitwiseAND(F.lit(bits - 1))
    step = F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1)).bitwiseOR(F.lit(1))
    return F.array(*[(low + step * F.lit(i)).bitwiseAND(F.lit(bits - 1)) for i in range(HASHES)])


def bloom_words(keys: DataFrame, column: str, max_bits: int = MAX_BITS) -> np.ndarray:
    """The filter as 64-bit words. Its size follows the number of keys up to max_bits."""
    n = keys.count()
    bits = 1 << max(10, min(max_bits, 12 * n + 1).bit_length() - 1)
    at = F.explode(_positions(F.xxhash64(column).cast("long"), bits)).alias("at")
    rows = (
        keys.select(at)
        .select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .collect()  # at most max_bits / 64 rows
    )
    words = np.zeros(bits // 64, np.int64)
    for r in rows:
        words[r.word] = r.bits
    return words


def might_hold(words: np.ndarray, spark, column: str) -> Column:
    """False only where the filter proves the key is not among the targets."""
    shared = spark.sparkContext.broadcast(words)
    bits = len(words) * 64

    @F.pandas_udf("boolean")
    def test(hashes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = shared.value
        for s in hashes:
            h = s.to_numpy(np.int64)
            low, step = h & (bits - 1), (h.view(np.uint64) >> np.uint64(32)).astype(np.int64) & (bits - 1) | 1
            ok = np.ones(len(h), bool)
            for i in range(HASHES):
                at = (low + step * i) & (bits - 1)
                ok &= (w[at >> 6] >> (at & 63)) & 1 == 1
            yield pd.Series(ok)

    return test(F.xxhash64(column).cast("long"))


def liveness(moments: DataFrame, targets: DataFrame) -> DataFrame:
    """For distinct (key, at): whether the key has targets, any live at `at`, any started by then.

    targets: (key, start, end), end null for still live.
    """
    t = targets.select("key", F.col("start").alias("at"), F.coalesce("end", F.lit(FOREVER).cast("timestamp_ntz")).alias("until"), F.lit(0).alias("asks"))
    m = moments.select("key", "at", F.lit(None).cast("timestamp_ntz").alias("until"), F.lit(1).alias("asks"))
    both = t.unionByName(m).withColumn("hour", F.date_trunc("hour", "at"))
    by_hour = both.groupBy("key", "hour").agg(F.max("until").alias("until_h"), F.min(F.when(F.col("asks") == 0, F.col("at"))).alias("first_h"), F.sum(1 - F.col("asks")).alias("n_h"))
    before = Window.partitionBy("key").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("key")
    carry = by_hour.select(
        "key", F.col("hour").alias("hour"), F.max("until_h").over(before).alias("carried"), F.min("first_h").over(whole).alias("first"), F.sum("n_h").over(whole).alias("n")
    )
    inside = Window.partitionBy("key", "hour").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, 0)
    run = both.withColumn("ran", F.max("until").over(inside)).filter("asks = 1").select("key", "hour", "at", "ran")
    ran = run.join(carry.withColumnRenamed("key", "k").withColumnRenamed("hour", "h"), (F.col("key") == F.col("k")) & F.col("hour").eqNullSafe(F.col("h")), "left")
    live = F.coalesce(F.greatest("ran", "carried") > F.col("at"), F.lit(False))
    return ran.select("key", "at", live.alias("live"), (F.col("n") > 0).alias("known"), F.coalesce(F.col("first") > F.col("at"), F.lit(False)).alias("ahead"))


def dangling(refs: DataFrame, targets: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """refs (src, rec_id, pos, key, at) without a live target, with reason and period."""
    targets = targets.distinct()
    words = bloom_words(targets.select("key").distinct(), "key", max_bits)
    # written once: the branches below read it four times, and would each read and decode the references anew
    refs = cut_lineage(refs.distinct().withColumn("maybe", might_hold(words, refs.sparkSession, "key")))
    period = F.date_format("at", "yyyy-MM").alias("period")
    certain = refs.filter(~F.col("maybe")).select("src", "rec_id", "pos", F.lit("missing").alias("reason"), period)
    open_ = refs.filter("maybe")
    seen = liveness(open_.select("key", "at").distinct(), targets).withColumnRenamed("key", "k").withColumnRenamed("at", "t")
    reason = F.when(~F.col("known"), "missing").when(F.col("ahead"), "late").otherwise("deleted")
    rest = (
        open_.join(seen, (F.col("key") == F.col("k")) & F.col("at").eqNullSafe(F.col("t")))
        .filter(~F.col("live"))
        .select("src", "rec_id", "pos", reason.alias("reason"), period)
    )
    return certain.unionByName(rest)


def figure_references(parts: DataFrame) -> DataFrame:
    at = parts.select(F.lit("parts").alias("src"), F.col("part_id").alias("rec_id"), F.posexplode("diagrams").alias("i", "ref"), F.col("loaded_at").alias("at"))
    return at.select("src", "rec_id", (F.col("i") + 1).alias("pos"), file_key(F.col("ref")).alias("key"), "at").filter("key <> ''")


def source_references(datasets: DataFrame) -> DataFrame:
    key = file_key(F.col("source_pdf")).alias("key")
    return datasets.select(F.lit("datasets").alias("src"), F.col("dataset_id").alias("rec_id"), F.lit(0).alias("pos"), key, F.col("loaded_at").alias("at")).filter("key <> ''")


def target_rows(df: DataFrame, name: str, start: str, end: str) -> DataFrame:
    return df.select(file_key(F.col(name)).alias("key"), F.col(start).alias("start"), F.col(end).alias("end")).filter("key <> ''")


def dangling_references(parts: DataFrame, assets: DataFrame, datasets: DataFrame, sources: DataFrame) -> DataFrame:
    figures = dangling(figure_references(parts), target_rows(assets, "asset_name", "stored_at", "deleted_at"))
    files = dangling(source_references(datasets), target_rows(sources, "source_pdf", "registered_at", "withdrawn_at"))
    return figures.unionByName(files)
