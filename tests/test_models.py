"""Clusters and forecasts: invariants, closed forms and a brute-force recursion."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesprism.operators import forecast as fc, segmentation as sg, series as ts
from salesprism.operators.scaling import Standardiser


@pytest.fixture(scope="module")
def days(spark):
    """Two series with a weekly wave; the second starts later and misses days."""
    rows = []
    for name, start, gap in (("a", 0, 0), ("b", 10, 9)):
        for i in range(start, 120):
            if gap and i % gap == 0:
                continue
            cents = 100_000 + 20_000 * (i % 7) + 317 * ((i * 7919) % 101)
            rows.append((name, i, 3 + i % 5, cents, 7))
    df = spark.createDataFrame(rows, "series string, i int, orders long, cents long, qty long")
    return df.select(
        "series", F.date_add(F.lit("2022-01-01").cast("date"), F.col("i")).alias("date"), "orders",
        F.col("cents").cast("decimal(38,0)").alias("cents"), "qty",
    )


@pytest.fixture(scope="module")
def data(days):
    return fc.panel(ts.with_features(ts.densified(days)))


def test_densify_and_features(data, days):
    assert ts.densified(days).filter("series = 'b'").count() == 110
    rows = data.rows.filter("series = 'a'").orderBy("date").collect()
    assert rows[0]["t"] == 14 and len(rows) == 106
    assert sum(r["is_train"] for r in rows) == int(106 * 0.8)
    revenue = [r["daily_revenue"] for r in rows]
    assert rows[20]["revenue_lag_7"] == revenue[13]
    assert rows[20]["revenue_roll_3"] == pytest.approx(np.mean(revenue[17:20]))


def test_short_history_gives_no_rows(days):
    short = days.filter("date < '2022-01-11'")
    assert ts.with_features(ts.densified(short)).count() == 0


def test_standardiser_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "x double, c double")
    scaled = Standardiser.fit(df, ["x", "c"]).transform(df).collect()
    x = np.array([1.0, 2.0, 6.0])
    assert [r["z_x"] for r in scaled] == pytest.approx(((x - x.mean()) / x.std()).tolist())
    assert [r["z_c"] for r in scaled] == [0.0, 0.0, 0.0]


def test_ridge_equals_the_closed_form(data):
    ridge = fc.train(data, ["Ridge Regression"])[0]
    train = data.train.orderBy("series", "date").toPandas()
    x = train[list(fc.FEATURES)].to_numpy(float)
    mean, deviation = x.mean(0), x.std(0)
    z = (x - mean) / np.where(deviation == 0, 1, deviation)
    y = train[fc.TARGET].to_numpy(float)
    weights = np.linalg.solve(z.T @ z + 10.0 * np.eye(z.shape[1]), z.T @ (y - y.mean()))
    assert ridge.model.coefficients.toArray() == pytest.approx(weights, rel=1e-6, abs=1e-6)
    assert ridge.model.intercept == pytest.approx(y.mean())


def test_linear_predictions_equal_least_squares(data):
    linear = fc.train(data, ["Linear Regression"])[0]
    train = data.train.orderBy("series", "date").toPandas()
    x = np.column_stack([train[list(fc.FEATURES)].to_numpy(float), np.ones(len(train))])
    expected = x @ np.linalg.lstsq(x, train[fc.TARGET].to_numpy(float), rcond=None)[0]
    ours = linear.predict(data.train).orderBy("series", "date").toPandas()["prediction"]
    assert ours.to_numpy() == pytest.approx(expected, rel=1e-3)


def test_metrics(spark):
    df = spark.createDataFrame([(10.0, 12.0), (20.0, 19.0), (30.0, 33.0)], "y double, p double")
    row = fc.metrics(df, "y", "p").first()
    assert (row["mae"], row["rmse"], row["r2"], row["mape_pct"]) == (2.0, 2.16, 0.93, 11.67)


@pytest.mark.parametrize("parity", [False, True])
def test_recursion_equals_brute_force(data, parity):
    ridge = fc.train(data, ["Ridge Regression"])[0]
    horizon = 12
    ours = fc.recursive_forecast(data, ridge, horizon, parity).toPandas()
    weights, intercept = ridge.model.coefficients.toArray(), ridge.model.intercept
    for name in ("a", "b"):
        past = data.rows.filter(F.col("series") == name).orderBy("date").toPandas()
        revenue, orders = list(past[fc.TARGET]), list(past["daily_orders"].astype(float))
        mean, value = np.mean(revenue), np.sum(revenue) / np.sum(orders)
        expected = []
        for step in range(1, horizon + 1):
            day = np.datetime64(past["date"].iloc[-1]) + np.timedelta64(step, "D")
            d = day.astype(object)
            row = {
                "day_of_week": d.weekday(), "day_of_month": d.day, "week_number": d.isocalendar()[1],
                "month": d.month, "quarter": (d.month + 2) // 3, "is_weekend": int(d.weekday() >= 5),
                "t": past["t"].iloc[-1] + step,
                **{f"revenue_lag_{k}": revenue[-k] for k in ts.LAGS},
                **{f"orders_lag_{k}": orders[-k] for k in ts.LAGS},
                **{f"revenue_roll_{k}": np.mean(revenue[-k:]) for k in ts.ROLLS},
            }
            x = np.array([row[f] for f in fc.FEATURES], float)
            z = (x - np.array(ridge.scaler.means)) / np.where(
                np.array(ridge.scaler.deviations) == 0, 1, ridge.scaler.deviations)
            guess = max(0.0, float(z @ weights + intercept))
            expected.append(guess)
            revenue.append(guess)
            orders.append(float(int(guess // mean or 1)) if parity else guess / value)
        found = ours[ours["series"] == name].sort_values("date")["predicted_revenue"].to_numpy()
        assert found == pytest.approx(expected, rel=1e-6, abs=0.011)


def test_forecast_tables(data):
    ridge = fc.train(data, ["Ridge Regression"])[0]
    compared = fc.comparison(data, [ridge])
    forecast = fc.recursive_forecast(data, ridge, 5)
    both = fc.history_and_forecast(data.rows, forecast)
    assert both.filter("kind = 'forecast'").count() == 10
    band = both.filter("kind = 'forecast'").first()
    assert band["lo"] == pytest.approx(band["revenue"] * 0.85)
    assert band["hi"] == pytest.approx(band["revenue"] * 1.15)
    kpis = fc.forecast_kpis(forecast, compared).filter("series = 'a'").first()
    top = forecast.filter("series = 'a'").orderBy(F.desc("predicted_revenue"), "date").first()
    assert (kpis["best_date"], kpis["best_day"]) == (top["date"], top["predicted_revenue"])
    assert kpis["model_used"] == "Ridge Regression"


@pytest.fixture(scope="module")
def customers(spark):
    rows = [
        (i, 10 + i % 7, 1 + i % 3, 1000 + 10 * (i % 11)) if i % 3 else
        (i, 300 + i % 5, 9 + i % 2, 90_000 + 100 * (i % 13))
        for i in range(300)
    ]
    return spark.createDataFrame(rows, "customer_id long, recency int, frequency long, monetary_cents long")


def test_clusters(customers):
    points = sg.vectors(customers)
    curve, models = sg.elbow(points, (2, 3, 4), restarts=3)
    rows = curve.orderBy("k").collect()
    assert rows[0]["cost"] >= rows[1]["cost"] >= rows[2]["cost"]
    assert sg.best_k(curve) == 2
    segmented = sg.labelled(sg.clustered(models[2], points))
    summary = sg.segment_summary(segmented).collect()
    assert [r["segment"] for r in summary] == ["High Value Customers", "Regular Customers"]
    assert [r["customers"] for r in summary] == [100, 200]
    assert sum(r["revenue_share_pct"] for r in summary) == pytest.approx(100, abs=0.02)
    spread, model = sg.projection(segmented)
    assert spread.count() == 300 and sum(model.explainedVariance.toArray()) <= 1 + 1e-9
    first = [r[0] for r in sg.sampled(spread, 20, "customer_id").select("customer_id").collect()]
    again = [r[0] for r in sg.sampled(spread.repartition(5), 20, "customer_id").select("customer_id").collect()]
    assert first == again and len(first) == 20


def test_segment_names(spark):
    df = spark.range(1, 8).select(sg.segment_name(F.col("id").cast("int")).alias("n"))
    assert [r["n"] for r in df.collect()][-3:] == ["Lost Customers", "Segment 6", "Segment 7"]


def test_short_series_is_forecast_too(spark):
    """A series without a full history has forecast days, and all days are history."""
    from datetime import date, timedelta

    from salesprism.operators import forecast as fc

    start = date(2022, 1, 1)
    rows = [("long", start + timedelta(days=k), k % 7 + 1, 1000 * (k % 7 + 1), 2) for k in range(120)]
    rows += [("new", start + timedelta(days=115 + k), 1, 700, 1) for k in range(5)]
    days = spark.createDataFrame(rows, "series string, date date, orders bigint, cents bigint, qty bigint")
    data = fc.panel(ts.with_features(days), days)
    model = fc.train(data, fc.MODEL_NAMES[:1])[0]
    forecast = fc.recursive_forecast(data, model)
    assert {r["series"]: r["count"] for r in forecast.groupBy("series").count().collect()} == {"long": 30, "new": 30}
    past = fc.history_and_forecast(data.days, forecast).where("kind = 'actual'")
    assert past.count() == 125
