"""Daily comparisons from partial states: a late event adds to its own unit's state, and its day is not computed again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.experiments import compare_arms
from tidemill.operators.skew import small_side
from tidemill.session import materialize, path_exists

#: squares of totals keep all their digits up to this scale
MOST_SCALE = 3
_KEY = ["ds", "unit", "group"]


def add_to_states(joined: DataFrame, value: str, path: str, batch_id: int, unit: str = "unit", group: str = "group", time: str = "ts") -> None:
    """Add a batch of events to the states below ``path``.

    Two things are written for a batch: its total per day, unit and group, and per day and group by how much it changes the number of active units, the
    sum of their totals and the sum of squares.  For the latter, what earlier batches hold of the same units is looked up in the same days; nothing
    older is written again.  Batches are added in ascending order; doing the last one again replaces it.  ``value`` is a whole number or a decimal of
    at most three places, so sums are exact in any order; units whose
    values are all NULL are no active ones, but their group is there.  A batch's days reach the driver.
    """
    kind = joined.schema[value].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        kind = T.DecimalType(18, 0)
    if not isinstance(kind, T.DecimalType) or kind.scale > MOST_SCALE:
        raise ValueError(f"whole numbers or decimals of at most {MOST_SCALE} places add up exactly, not {kind.simpleString()}")
    spark, total = joined.sparkSession, T.DecimalType(28, kind.scale)
    fresh = joined.groupBy(F.to_date(time).alias("ds"), F.col(unit).alias("unit"), F.col(group).alias("group")).agg(
        F.sum(F.col(value).cast(kind)).cast(total).alias("total")
    )
    fresh = materialize(fresh)
    days = [r.ds for r in fresh.select("ds").distinct().collect()]
    held = _stored(spark, path, "units", fresh.schema)
    touched = fresh.withColumn("old", F.lit(None).cast(total)).withColumnRenamed("total", "new")
    if held is not None:
        keys = fresh.select(*[F.col(c).alias(f"_{c}") for c in _KEY])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _KEY]
        among = F.col("ds").isin([d for d in days if d is not None]) | (F.col("ds").isNull() if None in days else F.lit(False))
        older = held.filter((F.col("batch_id") < batch_id) & among).join(small_side(keys) or keys, same, "left_semi")
        older = older.select(*_KEY, F.lit(None).cast(total).alias("new"), F.col("total").alias("old"))
        touched = touched.unionByName(older).groupBy(*_KEY).agg(F.sum("new").cast(total).alias("new"), F.sum("old").cast(total).alias("old"))
    was = F.coalesce("old", F.lit(0).cast(total))
    now = (was + F.coalesce("new", F.lit(0).cast(total))).cast(total)
    changes = touched.groupBy("ds", "group").agg(
        F.count_if(F.col("old").isNull() & F.col("new").isNotNull()).alias("units"), F.sum("new").cast(T.DecimalType(38, kind.scale)).alias("total"),
        F.sum(F.when(F.col("new").isNotNull(), now * now - was * was)).alias("squares"),
    )
    changes = materialize(changes)
    fresh.write.mode("overwrite").partitionBy("ds").parquet(f"{path}/units/batch_id={batch_id}")
    changes.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")  # a batch counts once its units are there


def state_moments(spark: SparkSession, path: str) -> DataFrame:
    """(ds, group, n, mean, variance) of all batches, from their changes alone."""
    changes = spark.read.parquet(f"{path}/changes")
    sums = changes.groupBy("ds", "group").agg(F.sum("units").alias("n"), F.sum("total").cast("double").alias("_sum"), F.sum("squares").cast("double").alias("_squares"))
    spread = F.greatest(F.col("_squares") - F.col("_sum") * F.col("_sum") / F.nullif("n", F.lit(0)), F.lit(0.0))
    return sums.select("ds", "group", "n", (F.col("_sum") / F.nullif("n", F.lit(0))).alias("mean"), F.when(F.col("n") > 1, spread / (F.col("n") - 1)).alias("variance"))


def pulse_from_states(spark: SparkSession, path: str, control: str, test: str, confidence: float = 0.95) -> DataFrame:
    """``daily_pulse`` of all events of all batches."""
    return compare_arms(state_moments(spark, path), control, test, confidence, ["ds"])


def _stored(spark: SparkSession, path: str, name: str, schema: T.StructType) -> DataFrame | None:
    folder = f"{path}/{name}"
    if not path_exists(spark, folder):
        return None
    return spark.read.schema(T.StructType([*schema, T.StructField("batch_id", T.LongType())])).parquet(folder)
