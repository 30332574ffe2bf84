"""Registered clustering and forecast queries. Fitted models have no SQL form; the
metrics operator is checked on a prediction that has one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from salesprism.operators import combined, forecast as fc, rfm as cust, segmentation as sg, series as ts
from salesprism.operators.quantiles import box_stats
from salesprism.plans.charts import _DAILY_COLUMNS, _RFM_COLUMNS, _feature_sql
from salesprism.operators.runs import Run, latest
from salesprism.plans.registry import NamedQuery
from salesprism.session import table_folder


_RUN_COLUMNS = tuple(dict.fromkeys((*_RFM_COLUMNS, *_DAILY_COLUMNS)))


def _scored(lines: DataFrame) -> DataFrame:
    return cust.scored(cust.rfm(lines))


def _segments(lines: DataFrame) -> DataFrame:
    return sg.segment_customers(_scored(lines))


def _elbow(lines: DataFrame) -> DataFrame:
    return sg.elbow(sg.vectors(_scored(lines)))[0]


def _points(lines: DataFrame) -> DataFrame:
    points, model = sg.projection(_segments(lines))
    first, second = (float(v) for v in model.explainedVariance.toArray())
    return points.withColumns({"pc1_variance": F.lit(first), "pc2_variance": F.lit(second)})


def _panel(lines: DataFrame, series: str | None = None) -> fc.Panel:
    days = ts.densified(ts.daily(lines, series))
    return fc.panel(ts.with_features(days), days)


def _comparison(lines: DataFrame) -> DataFrame:
    data = _panel(lines)
    return fc.comparison(data, fc.train(data))


def _best(data: fc.Panel, trained: list[fc.Trained]) -> tuple[fc.Trained, DataFrame]:
    compared = fc.comparison(data, trained)
    name = compared.first()["model"]
    return next(t for t in trained if t.name == name), compared


def _forecast(lines: DataFrame) -> DataFrame:
    """Past days and the 30-day forecast of the best of all models, with its band."""
    data = _panel(lines)
    best, _ = _best(data, fc.train(data))
    return fc.history_and_forecast(data.days, fc.recursive_forecast(data, best))


def _forecast_by_category(lines: DataFrame) -> DataFrame:
    data = _panel(lines, "category")
    best, _ = _best(data, fc.train(data))
    return fc.with_band(fc.recursive_forecast(data, best))


def _forecast_kpis(lines: DataFrame) -> DataFrame:
    """Forecast block per category with the best of all models."""
    data = _panel(lines, "category")
    best, compared = _best(data, fc.train(data))
    return fc.forecast_kpis(fc.recursive_forecast(data, best), compared)


def _forecast_kpis_total(lines: DataFrame) -> DataFrame:
    """Forecast block of all sales together."""
    data = _panel(lines)
    best, compared = _best(data, fc.train(data))
    return fc.forecast_kpis(fc.recursive_forecast(data, best), compared)


def _stored_run(lines: DataFrame) -> dict[str, DataFrame]:
    """Segments, forecast and model comparison, written as one run and read back."""
    spark = lines.sparkSession
    folder = f"{table_folder(spark)}/runs-{uuid.uuid4().hex}"
    run = Run(spark, folder)
    run.write("segments", _segments(lines).drop("features"))
    data = _panel(lines)
    best, compared = _best(data, fc.train(data))
    run.write("forecast", fc.history_and_forecast(data.days, fc.recursive_forecast(data, best)))
    run.write("models", compared)
    run.commit()
    return latest(spark, folder, combined.TABLES)


def _importance(lines: DataFrame) -> DataFrame:
    data = _panel(lines)
    return fc.feature_importance(data, fc.train(data, [fc.MODEL_NAMES[2]])[0])


def _week_ago(lines: DataFrame) -> DataFrame:
    """Error metrics of the test days when each is predicted by the day a week before.
    The percentage error is over days with sales; it has no meaning on the others."""
    rows = ts.split_by_time(ts.with_features(ts.densified(ts.daily(lines, "category"))))
    test = rows.filter("not is_train")
    selling = fc.metrics(test.filter(F.col(fc.TARGET) > 0), fc.TARGET, "revenue_lag_7")
    return fc.metrics(test, fc.TARGET, "revenue_lag_7").withColumn(
        "mape_pct", selling.select("mape_pct").scalar()
    )


MODELS = [
    NamedQuery("segment_elbow", "Cost and silhouette per k", _elbow, _RFM_COLUMNS),
    NamedQuery(
        "customer_segments", "Segment of every customer",
        lambda lines: cust.with_units(_segments(lines)).drop("features"), _RFM_COLUMNS,
    ),
    NamedQuery("segment_summary", "Segments and revenue share",
               lambda lines: sg.segment_summary(_segments(lines)), _RFM_COLUMNS),
    NamedQuery("cluster_profile", "Mean measures per cluster",
               lambda lines: sg.cluster_profile(_segments(lines)), _RFM_COLUMNS),
    NamedQuery("segment_points", "Customers on two principal components", _points, _RFM_COLUMNS),
    NamedQuery(
        "recency_box_by_segment", "Box-plot numbers of recency by segment",
        lambda lines: box_stats(_segments(lines), "recency", "segment"), _RFM_COLUMNS,
    ),
    NamedQuery("model_comparison", "Test metrics of the four models", _comparison, _DAILY_COLUMNS),
    NamedQuery("forecast_30_days", "History and 30-day forecast", _forecast, _DAILY_COLUMNS),
    NamedQuery(
        "forecast_by_category", "30-day forecast per category", _forecast_by_category,
        (*_DAILY_COLUMNS, "category"),
    ),
    NamedQuery(
        "forecast_kpis", "Forecast totals per category", _forecast_kpis, (*_DAILY_COLUMNS, "category"),
    ),
    NamedQuery("forecast_kpis_total", "Forecast totals of all sales", _forecast_kpis_total, _DAILY_COLUMNS),
    NamedQuery("combined_report", "Report over stored segments and forecast",
               lambda lines: combined.combined_report(_stored_run(lines)), _RUN_COLUMNS),
    NamedQuery(
        "combined_report_checks", "What must hold of the stored segments and forecast",
        lambda lines: combined.stored_checks(_stored_run(lines)), _RUN_COLUMNS,
        "with sales as ({sales}), d as (select * from sales where status in "
        "('Delivered', 'Shipped', 'Shipped - Delivered To Buyer')), "
        "span as (select min(order_date) as a, max(order_date) as b from d) "
        "select 'customers' as item, count(distinct customer_id) as value from d "
        "union all select 'different_customers', count(distinct customer_id) from d "
        "union all select 'revenue_cents', cast(sum(amount_cents) as bigint) from d "
        "union all select 'customers_without_segment', 0 "
        "union all select 'history_days', date_diff('day', a, b) + 1 from span "
        "union all select 'forecast_days', 30 "
        "union all select 'history_cents', cast(sum(amount_cents) as bigint) from d "
        "union all select 'gap_days', 1 union all select 'days_ahead', 30 union all select 'outside_band', 0 "
        "union all select 'models', 4 union all select 'best_models', 1",
    ),
    NamedQuery("feature_importance", "Top features of the forest", _importance, _DAILY_COLUMNS),
    NamedQuery(
        "week_ago_metrics", "Error of the week-ago prediction", _week_ago, (*_DAILY_COLUMNS, "category"),
        f"select round(avg(abs(y-p)), 2) as mae, round(sqrt(sum((y-p)*(y-p))/count(*)), 2) as rmse, "
        "round(1 - sum((y-p)*(y-p))/(var_pop(y)*count(*)), 4) as r2, "
        "round(avg(abs(y-p)/y) filter (where y > 0)*100, 2) as mape_pct from "
        f"(select daily_revenue as y, revenue_lag_7 as p from ({_feature_sql('category')}) where not is_train)",
    ),
]
