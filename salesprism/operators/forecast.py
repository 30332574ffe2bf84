"""Daily revenue models and the recursive forecast, for many series at once.

One pooled model serves all series; the panel may hold one series or millions. The
models are trained by MLlib over the partitioned panel, and the forecast keeps one
state row per series, so every step runs over all series in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from salesprism.functions.exact import units
from salesprism.operators.scaling import Standardiser
from salesprism.operators.series import FEATURES, LAGS, ROLLS, split_by_time
from salesprism.session import checkpointed, materialised

TARGET = "daily_revenue"
HORIZON = 30
BAND = 0.15
CHECKPOINT_EVERY = 5
# fixed values: model settings
RIDGE_ALPHA = 10.0
FOREST = {"numTrees": 150, "maxDepth": 10, "minInstancesPerNode": 3, "seed": 42}
BOOSTING = {"maxIter": 150, "stepSize": 0.08, "maxDepth": 5, "seed": 42}
MODEL_NAMES = ("Linear Regression", "Ridge Regression", "Random Forest", "Gradient Boosting")
# fixed value: the smallest denominator of the absolute percentage error
_EPSILON = 2.220446049250313e-16


@dataclass(frozen=True)
class Trained:
    """A fitted model with the feature columns it reads."""

    name: str
    model: Model
    scaler: Standardiser | None

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction``; drops the helper columns."""
        columns = list(FEATURES)
        if self.scaler is not None:
            df, columns = self.scaler.transform(df), self.scaler.outputs()
        vectors = VectorAssembler(inputCols=columns, outputCol="features").transform(df)
        helpers = ["features", *(columns if self.scaler is not None else [])]
        return self.model.transform(vectors).drop(*helpers)


@dataclass(frozen=True)
class Panel:
    """Feature rows, written once, and their split by time; ``days`` are all days of each
    series, also those whose history is too short for features."""

    rows: DataFrame
    days: DataFrame

    @property
    def train(self) -> DataFrame:
        return self.rows.filter("is_train")

    @property
    def test(self) -> DataFrame:
        return self.rows.filter("not is_train")


def panel(featured: DataFrame, days: DataFrame | None = None) -> Panel:
    """``days`` are the dense days that the features come from; without them only days with
    features count as history."""
    rows = materialised(split_by_time(featured))
    if days is None:
        return Panel(rows, rows)
    by_day = Window.partitionBy("series").orderBy("date")
    dense = days.select(
        "series", "date", units("cents").alias(TARGET), F.col("orders").alias("daily_orders"),
        (F.row_number().over(by_day) - 1).alias("t"),
    )
    return Panel(rows, materialised(dense))


def _vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    return assembler.transform(df).select("features", TARGET).persist(StorageLevel.MEMORY_AND_DISK)


def ridge_penalty(alpha: float, train: DataFrame) -> float:
    """MLlib's penalty for a ridge with the given alpha: it divides the loss by the
    rows and works on a target scaled by its deviation."""
    row = train.agg(F.count(TARGET).alias("n"), F.stddev_pop(TARGET).alias("d")).first()
    return alpha * (row["d"] or 0.0) / row["n"]


def train(data: Panel, names: Sequence[str] = MODEL_NAMES) -> list[Trained]:
    """Fit the named models on the training rows; the linear ones on scaled features."""
    trained = []
    linear = [n for n in names if n in MODEL_NAMES[:2]]
    if linear:
        scaler = Standardiser.fit(data.train, FEATURES)
        scaled = _vectors(scaler.transform(data.train), scaler.outputs())
        for name in linear:
            penalty = ridge_penalty(RIDGE_ALPHA, data.train) if name == MODEL_NAMES[1] else 0.0
            learner = LinearRegression(
                labelCol=TARGET, regParam=penalty, elasticNetParam=0.0, standardization=False,
                solver="normal",
            )
            trained.append(Trained(name, learner.fit(scaled), scaler))
        scaled.unpersist()
    trees = [n for n in names if n in MODEL_NAMES[2:]]
    if trees:
        plain = _vectors(data.train, FEATURES)
        for name in trees:
            if name == MODEL_NAMES[2]:
                learner = RandomForestRegressor(labelCol=TARGET, featureSubsetStrategy="all", **FOREST)
            else:
                learner = GBTRegressor(labelCol=TARGET, **BOOSTING)
            trained.append(Trained(name, learner.fit(plain), None))
        plain.unpersist()
    return trained


def metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: MAE, RMSE, R2 and MAPE in percent."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    error = F.abs(y - p)
    sums = df.agg(
        F.count(y).alias("n"),
        F.avg(error).alias("mae"),
        F.sum(error * error).alias("sse"),
        F.var_pop(y).alias("spread"),
        F.avg(error / F.greatest(F.abs(y), F.lit(_EPSILON))).alias("ape"),
    )
    n = F.col("n").cast("double")
    return sums.select(
        F.round("mae", 2).alias("mae"),
        F.round(F.sqrt(F.try_divide(F.col("sse"), n)), 2).alias("rmse"),
        F.round(1 - F.try_divide(F.col("sse"), F.col("spread") * n), 4).alias("r2"),
        F.round(F.col("ape") * 100, 2).alias("mape_pct"),
    )


def comparison(data: Panel, trained: Sequence[Trained]) -> DataFrame:
    """Test metrics per model, best R2 first."""
    rows = None
    for one in trained:
        scored = metrics(one.predict(data.test), TARGET, "prediction").withColumn(
            "model", F.lit(one.name)
        )
        rows = scored if rows is None else rows.unionByName(scored)
    ranked = Window.orderBy(F.desc("r2"), "model")
    # one row per model
    return rows.withColumn("rank", F.row_number().over(ranked)).select(
        "rank", "model", "mae", "rmse", "r2", "mape_pct"
    ).orderBy("rank")


def feature_importance(data: Panel, forest: Trained, top: int = 10) -> DataFrame:
    """The features the forest relies on most."""
    weights = sorted(zip(FEATURES, forest.model.featureImportances.toArray()), key=lambda f: (-f[1], f[0]))
    rows = [(i, name, float(weight)) for i, (name, weight) in enumerate(weights[:top], 1)]
    return data.rows.sparkSession.createDataFrame(rows, "rank int, feature string, importance double")


def _state(rows: DataFrame) -> DataFrame:
    """One row per series: its means and its last days in time order. Only as many days
    as the longest lag are kept; earlier ones matter through the means alone."""
    newest_first = Window.partitionBy("series").orderBy(F.desc("date"))
    recent = F.when(F.col("_back") <= max(LAGS), F.struct("date", TARGET, "daily_orders"))
    steady = F.col("t") >= max(LAGS)  # the means leave out the days before full features

    def mean_of_steady(make):
        return F.coalesce(make(lambda c: F.when(steady, F.col(c))), make(F.col))

    grouped = rows.withColumn("_back", F.row_number().over(newest_first)).groupBy("series").agg(
        F.array_sort(F.collect_list(recent)).alias("days"),
        F.max("date").alias("last_date"),
        F.max("t").alias("last_t"),
        mean_of_steady(lambda c: F.avg(c(TARGET))).alias("mean_revenue"),
        mean_of_steady(lambda c: F.try_divide(F.sum(c(TARGET)), F.sum(c("daily_orders")).cast("double"))).alias("order_value"),
    )
    return grouped.select(
        "series", "last_date", "last_t", "mean_revenue", "order_value",
        F.transform("days", lambda d: d[TARGET]).alias("revenue"),
        F.transform("days", lambda d: d["daily_orders"].cast("double")).alias("orders"),
        F.array().cast("array<double>").alias("predicted"),
    )


def _step_features(step: int) -> list[str]:
    """Features of the day ``step`` after the last one, as SQL text over the state.
    History that is too short gives 0."""
    day = f"date_add(last_date, {step})"
    texts = [
        f"weekday({day}) as day_of_week",
        f"dayofmonth({day}) as day_of_month",
        f"weekofyear({day}) as week_number",
        f"month({day}) as month",
        f"quarter({day}) as quarter",
        f"cast(weekday({day}) >= 5 as int) as is_weekend",
        f"last_t + {step} as t",
    ]
    for k in LAGS:
        for what in ("revenue", "orders"):
            texts.append(
                f"if(size({what}) >= {k}, element_at({what}, -{k}), 0.0D) as {what}_lag_{k}"
            )
    for k in ROLLS:
        total = f"aggregate(slice(revenue, -{k}, {k}), 0.0D, (a, x) -> a + x)"
        texts.append(f"if(size(revenue) >= {k}, {total} / {k}.0D, 0.0D) as revenue_roll_{k}")
    return texts


# orders of a predicted day
_ORDERS = "coalesce(try_divide(greatest(prediction, 0.0D), order_value), 0.0D)"
_WHOLE_MULTIPLE = "cast(floor(try_divide(greatest(prediction, 0.0D), mean_revenue)) as double)"
_ORDERS_PARITY = f"coalesce(if({_WHOLE_MULTIPLE} = 0, 1.0D, {_WHOLE_MULTIPLE}), 0.0D)"


def recursive_forecast(
    data: Panel, best: Trained, horizon: int = HORIZON, parity: bool = False
) -> DataFrame:
    """Day after day, each prediction feeding the lags of the next.

    The orders of a predicted day are its revenue over the mean order value; with
    ``parity`` they are its whole multiples of the mean daily revenue, at least 1.
    The state is checkpointed every few steps, so the plan stays short.
    """
    orders = _ORDERS_PARITY if parity else _ORDERS
    state = checkpointed(_state(data.days))
    for step in range(1, horizon + 1):
        guessed = best.predict(state.selectExpr("*", *_step_features(step)))
        state = guessed.selectExpr(
            "series", "last_date", "last_t", "mean_revenue", "order_value",
            "concat(revenue, array(greatest(prediction, 0.0D))) as revenue",
            f"concat(orders, array({orders})) as orders",
            "concat(predicted, array(round(greatest(prediction, 0.0D), 2))) as predicted",
        )
        if step % CHECKPOINT_EVERY == 0 and step < horizon:
            state = checkpointed(state)
    return (
        state.select("series", "last_date", F.posexplode("predicted").alias("p", "predicted_revenue"))
        .select("series", F.date_add("last_date", F.col("p") + 1).alias("date"), "predicted_revenue")
    )


def with_band(forecast: DataFrame, share: float = BAND) -> DataFrame:
    """A fixed band around the forecast; it is no statistical interval."""
    value = F.col("predicted_revenue")
    return forecast.withColumns({"lo": value * (1 - share), "hi": value * (1 + share)})


def history_and_forecast(days: DataFrame, forecast: DataFrame) -> DataFrame:
    """Past days and forecast days in one table."""
    past = days.select(
        "series", "date", F.lit("actual").alias("kind"), F.col(TARGET).alias("revenue"),
        F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
    )
    future = with_band(forecast).select(
        "series", "date", F.lit("forecast").alias("kind"),
        F.col("predicted_revenue").alias("revenue"), "lo", "hi",
    )
    return past.unionByName(future)


def forecast_kpis(forecast: DataFrame, compared: DataFrame) -> DataFrame:
    """Per series: total, mean, best day, and the model with its error."""
    best = compared.filter(F.col("rank") == 1).select(F.struct("model", "mape_pct")).scalar()
    return forecast.groupBy("series").agg(
        F.round(F.sum("predicted_revenue"), 2).alias("total"),
        F.round(F.avg("predicted_revenue"), 2).alias("daily_mean"),
        F.max("predicted_revenue").alias("best_day"),
        F.max_by("date", F.struct("predicted_revenue", -F.datediff("date", F.lit("1970-01-01")))).alias("best_date"),
    ).withColumn("_b", best).select(
        "series", "total", "daily_mean", "best_day", "best_date",
        F.col("_b.model").alias("model_used"), F.col("_b.mape_pct").alias("mape_pct"),
    )
