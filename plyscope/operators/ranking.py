"""Row numbers that never sort a whole hot key in one task.

A plain ``row_number`` sends every row of a key to one task. Here the key is cut into
buckets that follow the sort order, rows are numbered inside (key, bucket), and the
sizes of the earlier buckets are added. The numbers equal the plain ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def bucket_offsets(sizes: DataFrame, keys: list[str], bucket: str) -> DataFrame:
    """Per (key, bucket): rows of the key in earlier buckets, and in all buckets."""
    by_key = Window.partitionBy(*keys)
    earlier = by_key.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        *keys,
        bucket,
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_size").over(by_key).alias("_total"),
    )


def bucketed_row_number(
    df: DataFrame,
    keys: list[str],
    bucket: Column,
    order: list[Column],
    name: str,
    total: str | None = None,
) -> DataFrame:
    """Row number per key (from 1) by ``order``; ``bucket`` must not decrease along it.

    ``total`` also returns the key's row count. The offsets hold one row per
    (key, bucket); whether they are broadcast is left to their measured size.
    """
    marked = df.withColumn("_bucket", bucket)
    sizes = marked.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    local = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    joined = marked.withColumn("_local", local).join(
        bucket_offsets(sizes, keys, "_bucket"), [*keys, "_bucket"]
    )
    out = joined.withColumn(name, F.col("_local") + F.col("_offset"))
    if total:
        out = out.withColumnRenamed("_total", total)
    return out.drop("_bucket", "_local", "_offset", "_total")


def md5_row_number(
    df: DataFrame, keys: list[str], parts: list, name: str, total: str | None = None, ties=()
) -> DataFrame:
    """Row number per key in md5 order of ``parts``: a reproducible shuffle.

    The first three hex digits spread each key evenly over 4,096 buckets.
    """
    text = F.concat_ws(
        "|", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    )
    df = df.withColumn("_digest", F.md5(text))
    ranked = bucketed_row_number(
        df, keys, F.substring("_digest", 1, 3), [F.col("_digest"), *ties], name, total
    )
    return ranked.drop("_digest")
