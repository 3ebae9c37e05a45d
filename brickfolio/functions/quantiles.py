"""Exact quantiles of columns that are too large for one task.

The built-in exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer. Here values are counted per ordered logarithmic bucket,
which combines before the shuffle and leaves a small table, which is written. The
few buckets that hold a wanted rank are read back; where they hold ``_FEW`` values
at most, these are ordered as they are. Larger ones are cut into equal parts and
counted again, twice, so that a part is at most 2**-34 of its values wide: it
holds under 200,000 different doubles, however many rows crowd around one value.
Only the values of the parts that hold a wanted rank are ordered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from brickfolio.session import write_and_reread

_PER_OCTAVE = 1024
_SHIFT = 1100 * _PER_OCTAVE  # above the bucket number of the smallest positive double
_PARTS = 4096
_REFINEMENTS = 2
_FEW = 1 << 20


def ordered_bucket(v: Column) -> Column:
    """A whole number that never decreases as ``v`` grows, for any finite double."""
    level = F.floor(F.log2(F.abs(v)) * _PER_OCTAVE) + _SHIFT
    return F.when(v > 0, level).when(v < 0, -level).otherwise(F.lit(0).cast("bigint"))


def _counted(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.sum("_n").alias("_bn"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))


def _holding(counted: DataFrame, key: list[str]) -> DataFrame:
    """The buckets that hold a wanted rank, with those ranks."""
    inside = F.filter("_ranks", lambda r: (r["rank"] >= F.col("_before")) & (r["rank"] < F.col("_before") + F.col("_bn")))
    return counted.withColumn("_ranks", inside).filter(F.size("_ranks") > 0).select(*key, "_low", "_high", "_before", "_ranks")


def exact_quantiles(values: DataFrame, group: list[str], value: str, quantiles: dict[str, float],
                    weight: str | None = None) -> DataFrame:
    """One row per group with the named quantiles, linearly interpolated.

    Meant for few, large groups (splits, features, folds, models). Null values
    are left out. ``weight`` may name a column of repeat counts.
    """
    v = F.col(value).cast("double")
    rows = values.filter(F.col(value).isNotNull()).select(
        *group, v.alias("_v"), (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("_n"),
        ordered_bucket(v).alias("_k0"))
    key = [*group, "_k0"]
    in_group = Window.partitionBy(*group)
    counted = write_and_reread(_counted(rows, key), "quantile-buckets").withColumn("_total", F.sum("_bn").over(in_group)).withColumn(
        "_before", F.sum("_bn").over(in_group.orderBy("_k0")) - F.col("_bn"))
    positions = F.array(*[
        F.struct(F.lit(name).alias("name"), ((F.col("_total") - 1) * F.lit(float(p))).alias("at"))
        for name, p in quantiles.items()])
    ranks = F.flatten(F.transform(positions, lambda s: F.array(
        F.struct(s["name"].alias("name"), F.lit(0).alias("side"), F.floor(s["at"]).alias("rank"),
                 (s["at"] - F.floor(s["at"])).alias("part")),
        F.struct(s["name"].alias("name"), F.lit(1).alias("side"), F.ceil(s["at"]).alias("rank"),
                 (s["at"] - F.floor(s["at"])).alias("part")))))
    # plain comparisons drop nearly all buckets before the arrays are built
    first, behind = F.col("_before"), F.col("_before") + F.col("_bn")
    places = [side((F.col("_total") - 1) * F.lit(float(p))) for p in quantiles.values() for side in (F.floor, F.ceil)]
    hit = reduce(lambda x, y: x | y, [(r >= first) & (r < behind) for r in places])
    wanted = _holding(counted.filter(hit).withColumn("_ranks", ranks), key)
    crowded = (counted.filter(hit).agg(F.max("_bn")).first()[0] or 0) > _FEW
    for level in range(1, _REFINEMENTS + 1 if crowded else 1):
        # ``wanted`` has at most two rows per quantile and group, so it is broadcast
        bounds = F.broadcast(wanted.select(*key, "_low", "_high"))
        width = F.col("_high") - F.col("_low")
        part = F.when(width > 0, F.least(F.floor((F.col("_v") - F.col("_low")) / width * _PARTS), F.lit(_PARTS - 1))).otherwise(F.lit(0))
        rows = rows.join(bounds, key).withColumn(f"_k{level}", part.cast("bigint")).drop("_low", "_high")
        inside = Window.partitionBy(*key).orderBy(f"_k{level}")
        counted = _counted(rows, [*key, f"_k{level}"]).join(
            F.broadcast(wanted.select(*key, F.col("_before").alias("_base"), "_ranks")), key).withColumn(
            "_before", F.col("_base") + F.sum("_bn").over(inside) - F.col("_bn"))
        key = [*key, f"_k{level}"]
        wanted = _holding(counted, key)
    in_bucket = Window.partitionBy(*key).orderBy("_v")
    kept = rows.join(F.broadcast(wanted.select(*key)), key, "left_semi").groupBy(*key, "_v").agg(F.sum("_n").alias("_n"))
    ordered = kept.join(F.broadcast(wanted), key, "inner").withColumn(
        "_end", F.col("_before") + F.sum("_n").over(in_bucket))
    hits = ordered.withColumn("_hit", F.explode(F.filter("_ranks", lambda r: (
        r["rank"] < F.col("_end")) & (r["rank"] >= F.col("_end") - F.col("_n")))))
    outputs = []
    for name in quantiles:
        def pick(side, what):
            return F.max(F.when((F.col("_hit.name") == name) & (F.col("_hit.side") == side), what))
        low, high = pick(0, F.col("_v")), pick(1, F.col("_v"))
        outputs.append((low + (high - low) * pick(0, F.col("_hit.part"))).alias(name))
    return hits.groupBy(*group).agg(*outputs)
