"""The catalogue of all business reports and the driver contract."""

import __spark_entry__ as contract

from salesprism.plans.catalogue import all_queries, export_reports

#: A text report and what rests on fitted models have no SQL form.
WITHOUT_ORACLE = {
    "quality_report_text", "segment_elbow", "customer_segments", "segment_summary", "cluster_profile",
    "segment_points", "recency_box_by_segment", "model_comparison", "forecast_30_days", "forecast_by_category",
    "forecast_kpis", "forecast_kpis_total", "feature_importance", "combined_report",
}


def test_export_reports(spark, tmp_path):
    catalogue = {r["key"]: r for r in export_reports(spark, "/root/testdata/sf0.001", f"{tmp_path}/out").collect()}
    assert all(r["error"] is None for r in catalogue.values())
    # shapes: 6 statuses, 12 summary metrics, 4 tiers, 5 states x 6 categories
    assert catalogue["q02_status_distribution"]["rows"] == 6
    assert catalogue["q25_executive_summary"]["rows"] == 12
    assert catalogue["q20_value_tiers"]["rows"] == 4
    assert catalogue["q21_top_state_category_matrix"]["rows"] == 30


def test_contract(spark):
    assert contract.entry(spark).count() == 6
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(all_queries()) <= set(contract.queries())
    assert {key for key, q in all_queries().items() if q.sql() is None} == WITHOUT_ORACLE
