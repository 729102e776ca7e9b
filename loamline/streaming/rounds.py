"""Growth rounds as micro-batches: candidates in, new ones committed once, keys known ever after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamline.functions.text import norm, previous_week, url_key
from loamline.operators.merge import first_kept


def committed(spark: SparkSession, folder: str, schema: str, before: int | None = None) -> DataFrame:
    """What earlier batches accepted; batches are folders, so a batch that runs again replaces its own."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    if not there:
        return spark.createDataFrame([], f"{schema}, batch int")
    rows = spark.read.schema(f"{schema}, batch int").parquet(folder)
    return rows if before is None else rows.where(F.col("batch") < before)


def commit_round(folder: str, schema: str, order: list[str]):
    """A foreachBatch function that keeps candidates (url, title, ...) unknown to earlier batches.

    It is idempotent: a batch sees only batches before it, and overwrites what it wrote itself.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = committed(spark, folder, schema, before=number)
        keyed = batch.withColumns({"_u": url_key(F.col("url")), "_t": norm(F.col("title"))})
        fresh = keyed.join(known.select(url_key(F.col("url")).alias("_u")).distinct(), "_u", "left_anti").join(known.select(norm(F.col("title")).alias("_t")).distinct(), "_t", "left_anti").drop("_u", "_t")
        kept = first_kept(fresh.select(batch.columns), order)
        kept.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return run


def run_available(stream: DataFrame, folder: str, checkpoint: str, schema: str, order: list[str]) -> None:
    """Works off what the source has now and stops; starting again goes on from the checkpoint."""
    query = stream.writeStream.foreachBatch(commit_round(folder, schema, order)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


# --- pointers and breakers -----------------------------------------------------------------------


def advanced(pointers: DataFrame, succeeded: DataFrame) -> DataFrame:
    """Pointers (name, flag, next, step) moved on for backends that succeeded (name).

    A number grows by its step (1 if null); a week goes back to the one before.
    """
    won = succeeded.select("name", F.lit(True).alias("_won")).distinct()
    number = F.col("next").rlike(r"\A-?\d+\z")
    moved = F.when(number, (F.col("next").try_cast("long") + F.coalesce("step", F.lit(1))).cast("string")).otherwise(previous_week(F.col("next")))
    return pointers.join(F.broadcast(won), "name", "left").withColumn("next", F.when(F.col("_won"), moved).otherwise(F.col("next"))).drop("_won")


def breaker(requests: DataFrame, by: str, order: str, throttled: Column, threshold: int = 3) -> DataFrame:
    """The requests with streak (throttled answers in a row) and open: whether the circuit is broken.

    A circuit breaks at the threshold and stays so; other answers end a streak.
    """
    past = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = requests.withColumn("_hit", throttled).withColumn("_calm", F.sum(F.when(F.col("_hit"), 0).otherwise(1)).over(past))
    streak = F.sum(F.when(F.col("_hit"), 1).otherwise(0)).over(Window.partitionBy(by, "_calm").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("streak", streak.cast("long"))
    return rows.withColumn("open", F.max(F.col("streak") >= threshold).over(past)).drop("_hit", "_calm")


def retry_deadline(value: Column, now: Column) -> Column:
    """When a throttled backend may be asked again, in epoch seconds: a delay or a date; else null."""
    seconds = value.try_cast("long")
    date = F.try_to_timestamp(F.regexp_replace(value, r"\A\w{3}, ", ""), F.lit("dd MMM yyyy HH:mm:ss z"))
    return F.when(seconds.isNotNull(), now + F.greatest(seconds, F.lit(0))).otherwise(F.greatest(now, F.unix_timestamp(date).cast("double")))


def cooling(cooldowns: DataFrame, now: float) -> DataFrame:
    """Cooldowns (backend, until) that have not expired."""
    return cooldowns.where(F.col("until") > now)
