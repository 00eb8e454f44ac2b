"""Tables of failures and of statements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lattix.functions import props
from lattix.tables import written

#: Recovery by SQLSTATE, and by its class where all of a class share one.
RECOVERY_BY_CODE = {
    "40001": "safe", "40P01": "safe", "40003": "unknown", "08007": "unknown", "57P01": "reconnect", "57P02": "reconnect", "57P03": "reconnect", "57P05": "reconnect",
    "25P03": "reconnect", "53200": "backpressure", "53300": "backpressure", "55006": "backpressure", "55P03": "backpressure", "26000": "reset_state", "57014": "fatal",
}
RECOVERY_BY_CLASS = {"08": "reconnect", "53": "backpressure", "57": "reconnect"}
#: What a merge gets when another writer made its element first.
MADE_BY_ANOTHER = ["23505", "42P07"]


def classify_failures(df: DataFrame) -> DataFrame:
    """``recovery`` of each failure (sqlstate, wrote, merging).

    By its whole code, else by its class, else fatal; a failure without a code is a lost connection. A merge that came
    second is safe to run again; a connection lost after a write leaves the outcome unknown.
    """
    spark = df.sparkSession
    codes = spark.createDataFrame(list(RECOVERY_BY_CODE.items()), "sqlstate string, by_code string")
    classes = spark.createDataFrame(list(RECOVERY_BY_CLASS.items()), "class string, by_class string")
    own = df.join(F.broadcast(codes), "sqlstate", "left").withColumn("class", F.substring("sqlstate", 1, 2)).join(F.broadcast(classes), "class", "left")
    found = F.when(F.col("sqlstate").isNull(), "reconnect").otherwise(F.coalesce("by_code", "by_class", F.lit("fatal")))
    recovery = F.when(F.col("merging") & (found == "fatal") & F.col("sqlstate").isin(MADE_BY_ANOTHER), "safe").when(F.col("wrote") & (found == "reconnect"), "unknown").otherwise(found)
    return own.withColumn("recovery", recovery).drop("class", "by_code", "by_class")


def exact_quantiles(df: DataFrame, group: str, value: str, shares: list[float], bins: int = 1000) -> DataFrame:
    """(group, share, quantile): of each group's values the exact quantiles, with a fraction between two neighbours.

    Each rank that is asked for is found by histograms: the values between two bounds are counted in bins, and the bin
    that holds the rank gives the next bounds, until these are one value. A round reads the values once and shuffles a
    row a bin at most, so that no task holds the values of a group; the first bounds are the least and the greatest
    value, the rounds few since each divides the range by ``bins``. Nulls are left out, and groups without values; ties are one value.
    """
    held = props.refuse_non_finite(df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).where("v IS NOT NULL"), "v")
    sizes = written(held.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")))
    asked = sizes.select("g", "n", "low", "high", F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share")).withColumn("h", F.col("share") * (F.col("n") - 1))
    bounds = written(asked.select("g", "low", "high", F.explode(F.array(F.floor("h"), F.ceil("h"))).alias("rank")).distinct().withColumn("before", F.lit(0).cast("long")))
    done = bounds.where("low = high")
    while True:
        open_ = bounds.where("low < high")
        if open_.isEmpty():
            break
        inside = held.withColumnRenamed("g", "__g").join(open_, F.col("__g").eqNullSafe(F.col("g"))).where("v >= low AND v <= high")
        bin_ = F.least(F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * bins), F.lit(bins - 1))
        counted = inside.groupBy("g", "rank", "before", bin_.alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        past = F.col("before") + F.sum("n").over(Window.partitionBy("g", "rank").orderBy("bin"))
        found = counted.withColumn("past", past).where("past > rank AND past - n <= rank")
        bounds = written(found.select("g", "low", "high", "rank", (F.col("past") - F.col("n")).alias("before")))
        done = done.unionAll(bounds.where("low = high"))
    at = lambda name: done.select(F.col("g").alias(f"{name}_g"), F.col("rank").alias(f"{name}_rank"), F.col("low").alias(name))
    met = asked.join(at("x"), F.col("g").eqNullSafe(F.col("x_g")) & (F.floor("h") == F.col("x_rank"))).join(at("y"), F.col("g").eqNullSafe(F.col("y_g")) & (F.ceil("h") == F.col("y_rank")))
    return met.select(F.col("g").alias(group), "share", (F.col("x") + (F.col("h") - F.floor("h")) * (F.col("y") - F.col("x"))).alias("quantile"))


def statement_stats(df: DataFrame) -> DataFrame:
    """Calls, failures, rows and exact quantiles of time of each statement."""
    counted = df.groupBy("statement").agg(F.count("*").alias("calls"), F.sum(F.col("failed").cast("long")).alias("failures"), F.sum("rows").alias("rows"))
    found = exact_quantiles(df, "statement", "elapsed", [0.5, 0.95]).groupBy(F.col("statement").alias("__s")).agg(*[F.max(F.when(F.col("share") == x, F.col("quantile"))).alias(name) for x, name in ((0.5, "p50"), (0.95, "p95"))])
    return counted.join(found, F.col("statement").eqNullSafe(F.col("__s")), "left").drop("__s")
