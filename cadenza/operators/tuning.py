"""Model selection: M7 silhouette, M8 elbow cost, M9 k sweep, A9 per-cluster quartiles."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.fixed import K_SWEEP, KMEANS_SEED
from cadenza.operators.vectors import squared_distance
from cadenza.session import checkpoint_dir


def silhouette(df: DataFrame, features: str = "standardized",
               prediction: str = "prediction") -> float:
    """M7: mean silhouette with squared Euclidean distance (MLlib's closed form, O(n*k))."""
    ev = ClusteringEvaluator(featuresCol=features, predictionCol=prediction,
                             metricName="silhouette", distanceMeasure="squaredEuclidean")
    return ev.evaluate(df)


def clustering_cost(df: DataFrame, features: str, prediction: str) -> DataFrame:
    """M8 for a given assignment: sum of squared distances to the cluster means.

    ``features`` is an ``array<double>`` column.  Cluster means are one
    aggregate (partial + final), joined back on the cluster id.
    """
    n = len(df.select(features).first()[0])
    means = df.groupBy(prediction).agg(
        F.array(*[F.avg(F.col(features)[i]) for i in range(n)]).alias("_m"))
    return (df.join(means, prediction)  # one row per cluster: Spark broadcasts it if it is small
            .agg(F.sum(squared_distance(F.col(features), F.col("_m"))).alias("cost")))


def k_sweep(df: DataFrame, ks: list[int] = K_SWEEP, seed: int = KMEANS_SEED,
            features: str = "standardized", parallelism: int = 8) -> DataFrame:
    """M9: one fit per k gives both curves (the original fitted every k twice).

    The input is persisted once and reused by every fit and evaluation; the
    independent fits are submitted from a few driver threads at once (as
    MLlib's ``CrossValidator(parallelism=...)`` does), so their jobs share the
    cluster instead of queueing.  Each fit is the same as a sequential one.
    """
    from concurrent.futures import ThreadPoolExecutor

    data = df.select(features).persist(StorageLevel.MEMORY_AND_DISK)
    data.count()

    def one(k: int):
        model = KMeans(featuresCol=features, k=k, seed=seed).fit(data)
        sil = silhouette(model.transform(data), features)
        return (k, float(sil), float(model.summary.trainingCost))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = list(pool.map(one, ks))
    data.unpersist()
    spark = df.sparkSession
    return spark.createDataFrame(rows, "k int, silhouette double, cost double")


def choose_k(sweep: DataFrame) -> DataFrame:
    """The sweep's rows with ``bend`` and ``chosen``: the knee of the cost curve.

    Both axes are scaled to [0, 1]; the bend of a k is how far its cost lies under the straight line from the
    curve's first point to its last, and the k that bends most is chosen (ties: the smaller k).  A curve
    without a bend (fewer than three points, or none below the line) falls back to the best silhouette.
    ``sweep`` is one row per k.
    """
    every = W.partitionBy(F.lit(1))  # a row per k
    ends = {"_c0": F.min_by("cost", "k").over(every), "_c1": F.max_by("cost", "k").over(every),
            "_k0": F.min("k").over(every), "_k1": F.max("k").over(every)}
    x = F.try_divide(F.col("k") - F.col("_k0"), F.col("_k1") - F.col("_k0"))
    y = F.try_divide(F.col("cost") - F.col("_c1"), F.col("_c0") - F.col("_c1"))
    bent = sweep.withColumns(ends).withColumn("bend", F.coalesce(F.round(F.lit(1.0) - x - y, 12), F.lit(0.0)))
    order = F.when(F.max("bend").over(every) > 0, F.col("bend")).otherwise(F.col("silhouette"))
    ranked = bent.withColumn("_order", order).withColumn("_nth", F.row_number().over(every.orderBy(F.col("_order").desc(), "k")))
    return ranked.select("k", "silhouette", "cost", "bend", (F.col("_nth") == 1).alias("chosen"))


def _ranked_values(df: DataFrame, cluster: str, features: list[str]) -> DataFrame:
    """``_c, _f, _v`` (cluster, feature, distinct value) with the ranks ``[_from, _to)`` of the
    value's rows in its group and the group's size ``_all``.

    Equal values are counted map-side and range-partitioned over all groups, so a large
    group is spread; ranks are running counts inside a partition plus the partition's offset.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    long = (df.select(F.col(cluster).alias("_c"), F.explode(F.array(*[
                F.struct(F.lit(f).alias("_f"), F.col(f).cast("double").alias("_v")) for f in features])).alias("_x"))
            .select("_c", "_x.*").where(F.col("_v").isNotNull()))
    order, group = ["_c", "_f", "_v"], ["_c", "_f"]
    local = W.partitionBy("_pid", *group).orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    # the range bounds are sampled, so counts and offsets are taken from one checkpointed copy
    rows = (long.groupBy(*order).agg(F.count(F.lit(1)).alias("_n"))
            .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
            .withColumn("_pid", F.spark_partition_id()).withColumn("_upto", F.sum("_n").over(local))
            .checkpoint(eager=True))
    parts = rows.groupBy("_pid", *group).agg(F.sum("_n").alias("_sum"))  # a row per partition and group
    before = W.partitionBy(*group).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(F.col("_pid").alias("_p"), F.col("_c").alias("_pc"), F.col("_f").alias("_pf"),
                         F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_off"),
                         F.sum("_sum").over(W.partitionBy(*group)).alias("_all"))
    on = (F.col("_pid") == F.col("_p")) & F.col("_c").eqNullSafe(F.col("_pc")) & (F.col("_f") == F.col("_pf"))
    return rows.join(parts, on).select(*order, "_all", (F.col("_off") + F.col("_upto") - F.col("_n")).alias("_from"),
                                       (F.col("_off") + F.col("_upto")).alias("_to"))


def cluster_quartiles(df: DataFrame, cluster: str, features: list[str],
                      exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Min, q1, median, q3, max of each feature per cluster (nulls are left out).

    ``exact`` (linear interpolation) picks values by their rank in a distributed running
    count, so a cluster of any size is spread over tasks; ``exact=False`` uses
    ``percentile_approx`` in one pass.
    """
    names = ["min", "q1", "median", "q3", "max"]
    if exact:
        def at(rank):
            return F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_to")), F.col("_v")))

        def quantile(q):
            place = F.lit(q) * (F.col("_all") - 1)
            low, high = at(F.floor(place)), at(F.ceil(place))
            return low + (high - low) * F.max(place - F.floor(place))

        per = (_ranked_values(df, cluster, features).groupBy("_c", "_f")
               .agg(F.array(*[quantile(i / 4) for i in range(5)]).alias("_q")))
        picked = per.groupBy("_c").agg(*[F.max(F.when(F.col("_f") == f, F.col("_q"))).alias(f"_{f}") for f in features])
        every = df.select(F.col(cluster)).distinct()  # a cluster without any value keeps its row
        out = every.join(picked, F.col(cluster).eqNullSafe(F.col("_c")), "left")
    else:
        out = df.groupBy(cluster).agg(*[
            F.percentile_approx(F.col(f).cast("double"), [i / 4 for i in range(5)], accuracy).alias(f"_{f}") for f in features])
    cols = [F.col(f"_{f}")[i].alias(f"{f}_{n}") for f in features for i, n in enumerate(names)]
    types = [df.schema[f].dataType for f in features for _ in names]
    cols = [c.cast(t).alias(f"{f}_{n}") if n in ("min", "max") else c
            for c, t, (f, n) in zip(cols, types, [(f, n) for f in features for n in names])]
    return out.select(cluster, *cols)
