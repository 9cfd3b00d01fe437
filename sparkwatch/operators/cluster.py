"""CLU: entities that fall into the smallest behaviour clusters."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sparkwatch.functions.times import AsOf, hour_within, trailing
from sparkwatch.session import written_table

USER_FEATURES = (
    "total_logins",
    "unique_ips",
    "unique_countries",
    "active_days",
    "avg_login_hour",
    "stddev_login_hour",
    "failure_rate",
    "after_hours_rate",
)


def user_features(
    df: DataFrame, key: str, ts: str, as_of: AsOf = None, history: str = "30 days", min_events: int = 5
) -> DataFrame:
    """D-13: one feature row per user with at least ``min_events`` events.

    After hours means 22 to 6 across midnight.
    """
    hour, n = F.hour(ts), F.count("*")
    return (
        df.where(trailing(df, ts, as_of, history))
        .groupBy(key)
        .agg(
            n.alias("total_logins"),
            F.count_distinct("source_ip").alias("unique_ips"),
            F.count_distinct("country").alias("unique_countries"),
            F.count_distinct(F.to_date(ts)).alias("active_days"),
            F.avg(hour).alias("avg_login_hour"),
            F.stddev_samp(hour).alias("stddev_login_hour"),
            (F.count_if(F.col("outcome") == "FAILURE") / n).alias("failure_rate"),
            (F.count_if(hour_within(ts, 22, 6)) / n).alias("after_hours_rate"),
        )
        .where(F.col("total_logins") >= min_events)
        .fillna({"stddev_login_hour": 0.0, "failure_rate": 0.0, "after_hours_rate": 0.0})
    )


def _fitted(features: DataFrame, cols: Sequence[str], k: int, seed: int, scale: bool):
    """The features, written once for the passes of the fit, and the model, or None without rows."""
    stored = written_table(features, "features")
    if not stored.take(1):
        return stored, None
    stages = [VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="skip")]
    if scale:
        stages.append(StandardScaler(inputCol="features", outputCol="scaled_features"))
    stages.append(KMeans(featuresCol="scaled_features" if scale else "features", k=k, seed=seed))
    return stored, Pipeline(stages=stages).fit(stored)


def cluster(
    features: DataFrame, cols: Sequence[str] = USER_FEATURES, k: int = 4, seed: int = 42, scale: bool = True
) -> DataFrame:
    """Add ``prediction``, the k-means cluster of the features, standardised or as they are.

    Fitting passes over the features several times, so they are written to the
    shared folder once instead of being aggregated again for each pass. Without rows there
    is nothing to fit and no row comes out.
    """
    stored, model = _fitted(features, cols, k, seed, scale)
    if model is None:
        return stored.withColumn("prediction", F.lit(None).cast("int"))
    return model.transform(stored).drop("features", "scaled_features")


def cluster_checks(
    features: DataFrame, cols: Sequence[str] = USER_FEATURES, k: int = 4, seed: int = 42, scale: bool = True
) -> DataFrame:
    """The features with ``nearest``, whether the assigned centre is the nearest one, and
    ``as_ruled``, whether a row is an outlier just if its cluster is at most twice the smallest."""
    stored, model = _fitted(features, cols, k, seed, scale)
    if model is None:
        return stored.withColumns({"nearest": F.lit(True), "as_ruled": F.lit(True)})
    rows = model.transform(stored)
    place = vector_to_array(F.col("scaled_features" if scale else "features"))
    distances = F.array(*[
        F.aggregate(
            F.zip_with(place, F.array(*[F.lit(float(x)) for x in centre]), lambda a, b: (a - b) * (a - b)),
            F.lit(0.0), lambda total, x: total + x,
        )
        for centre in model.stages[-1].clusterCenters()
    ])
    rows = rows.withColumn("_d", distances).withColumn(
        "nearest", F.element_at("_d", F.col("prediction") + 1) <= F.array_min("_d") + 1e-9
    )
    sizes = rows.groupBy("prediction").agg(F.count("*").alias("_n"))  # a row per cluster
    least = sizes.agg(F.min("_n").alias("_least"))
    found = cluster_outliers(rows.select("prediction")).select("prediction").distinct().withColumn("_found", F.lit(True))
    sizes = sizes.join(F.broadcast(least)).join(F.broadcast(found), "prediction", "left")
    ruled = F.coalesce("_found", F.lit(False)) == (F.col("_n") <= 2 * F.col("_least"))
    return rows.join(F.broadcast(sizes), "prediction").withColumn("as_ruled", ruled).select(
        *features.columns, "nearest", "as_ruled"
    )


def _usable(features: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Rows that have a key and finite features."""
    for c in cols:
        x = F.col(c).cast("double")
        features = features.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return features.where(F.col(key).isNotNull())


def _places(stored: DataFrame, cols: Sequence[str], scale: bool, grid: int) -> list[Column]:
    """The features as whole steps of a grid, centred and, with ``scale``, in standard deviations."""
    x = [F.col(c).cast("double") for c in cols]
    found = stored.agg(*[F.avg(v) for v in x], *[F.stddev_samp(v) for v in x]).first()
    out = []
    for v, mean, spread in zip(x, found[: len(x)], found[len(x):]):
        if not scale:
            out.append(F.floor((v - mean) * float(grid) + 0.5))
        elif spread and math.isfinite(spread):
            out.append(F.floor((v - mean) / spread * float(grid) + 0.5))
        else:
            out.append(F.lit(0).cast("long"))
    return out


def _nearest(place: Sequence[Column], centres: Sequence[Sequence[int]]) -> Column:
    """Squared distance ``d`` to the nearest centre and its number ``i``; the smaller number at equal distance."""
    def to(i, centre):
        squares = [(p - F.lit(c).cast("long")) * (p - F.lit(c).cast("long")) for p, c in zip(place, centre)]
        return F.struct(sum(squares[1:], squares[0]).alias("d"), F.lit(i).alias("i"))

    options = [to(i, centre) for i, centre in enumerate(centres)]
    return F.least(*options) if len(options) > 1 else options[0]


def cluster_rounds(
    features: DataFrame,
    key: str,
    cols: Sequence[str] = USER_FEATURES,
    k: int = 4,
    rounds: int = 20,
    scale: bool = True,
    grid: int = 1024,
) -> DataFrame:
    """Add ``prediction`` and ``distance``: k-means that gives the same clusters on every run and engine.

    Features, less their mean and with ``scale`` in standard deviations, are rounded to ``grid``
    steps a unit, so distances, sums and ties are whole numbers that do not depend on the order of rows.
    The first centre is the row nearest to the mean, each further one the row farthest from those
    before; ties go to the smaller key. Then up to ``rounds`` times each row takes its nearest
    centre, ties to the smaller number, and each centre moves to the rounded mean of its rows;
    rounds end early when no centre moves. A centre without rows stays. ``distance`` is that to the own
    centre, in the units of the grid's input.

    Each pass is one aggregate over the features, which are written once; ``k`` rows of sums
    come back to the driver. Fewer distinct places than ``k`` give fewer clusters. Rows without key or
    with a null or non-finite feature take no part; an empty table gives no rows. A feature that is the same
    everywhere counts nothing under ``scale``. Squares beyond a long raise an error: take a smaller ``grid``.
    """
    stored = written_table(_usable(features, key, cols), "features")
    first = stored.agg(F.count("*")).first()[0]
    if not first:
        return stored.withColumns({"prediction": F.lit(None).cast("int"), "distance": F.lit(None).cast("double")})
    names = [f"_p{j}" for j in range(len(cols))]
    place = [F.col(n) for n in names]
    placed = stored.withColumns(dict(zip(names, _places(stored, cols, scale, grid))))
    centres: list[list[int]] = []
    for _ in range(k):
        d = _nearest(place, centres)["d"] if centres else _nearest(place, [[0] * len(cols)])["d"]
        far = F.min(F.struct((-d if centres else d).alias("d"), F.col(key).alias("key"), *place)).alias("far")
        row = placed.agg(far).first()["far"]
        if centres and row["d"] == 0:
            break
        centres.append([row[n] for n in names])
    for _ in range(rounds):
        sums = (
            placed.groupBy(_nearest(place, centres)["i"].alias("i"))
            .agg(F.count("*").alias("n"), *[F.sum(n).alias(n) for n in names])
            .collect()  # a row per cluster
        )
        moved = list(centres)
        for row in sums:
            moved[row["i"]] = [(2 * row[n] + row["n"]) // (2 * row["n"]) for n in names]
        if moved == centres:
            break
        centres = moved
    return (
        placed.withColumn("_nearest", _nearest(place, centres))
        .withColumns({"prediction": F.col("_nearest.i"), "distance": F.sqrt("_nearest.d") / float(grid)})
        .drop("_nearest", *names)
    )


def cluster_outliers(clustered: DataFrame, size_factor: float = 2.0) -> DataFrame:
    """Members of clusters at most ``size_factor`` times the smallest one.

    The size table has one row per cluster, which bounds the broadcast.
    """
    sizes = (
        clustered.groupBy("prediction")
        .agg(F.count("*").alias("cluster_size"))
        .withColumn("_least", F.min("cluster_size").over(W.partitionBy()))
        .where(F.col("cluster_size") <= F.col("_least") * F.lit(size_factor))
        .drop("_least")
    )
    return clustered.join(F.broadcast(sizes), "prediction")
