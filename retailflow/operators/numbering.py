"""Global row numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

# monotonically_increasing_id keeps the row's place in its partition in the low 33 bits.
PLACE_BITS = 33


def numbered(df: DataFrame, order: list[str], folder: str, name: str = "n") -> DataFrame:
    """``df`` with its 0-based position in ``order``, every step spread over the cluster.

    A range sort spreads the rows, each task numbers its own, and the start of each
    task's run comes from the row counts. ``df`` is written to ``folder`` first, as the
    sort reads its input twice; the sorted rows are written too, so the counts and the
    rows come from the same sort and a lost executor does not change it. The scan
    position ends the sort key, so equal rows spread over tasks as well.
    """
    spark = df.sparkSession
    df.write.parquet(f"{folder}/rows")
    (
        spark.read.schema(df.schema)
        .parquet(f"{folder}/rows")
        .withColumn("_tie", F.monotonically_increasing_id())
        .orderBy(*order, "_tie")
        .drop("_tie")
        .withColumn("_place", F.monotonically_increasing_id())
        .write.parquet(f"{folder}/sorted")
    )
    schema = T.StructType([*df.schema, T.StructField("_place", T.LongType())])
    rows = spark.read.schema(schema).parquet(f"{folder}/sorted")
    run = F.shiftright("_place", PLACE_BITS)
    # One row per sort task: at most spark.sql.shuffle.partitions of them.
    sizes = rows.groupBy(run.alias("_run")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_run", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    place = F.col("_place") - F.shiftleft("_run", PLACE_BITS)
    return (
        rows.withColumn("_run", run)
        .join(F.broadcast(starts), "_run")
        .withColumn(name, F.col("_start") + place)
        .drop("_run", "_start", "_place")
    )
