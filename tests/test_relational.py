"""Joins over whole tables."""

from rateloom.queries import relational


def test_all_orders_meet_all_lines(spark, rows, tmp_path):
    spark.createDataFrame([(1, 5.0), (5, 7.0), (7, 9.0), (8, 1.0), (35, 2.0)], "o_orderkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 2.0), (1, 3.0), (5, 7.0), (7, 8.0), (10, 4.0)], "l_orderkey long, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = relational.QUERIES["header_vs_lines_all"](spark, str(tmp_path))
    assert rows(got) == sorted([(7, 9.0, 8.0, "differs"), (8, 1.0, None, "left_only"), (10, None, 4.0, "right_only"), (35, 2.0, None, "left_only")], key=repr)


def test_the_whole_file_log_is_joined(spark, rows, tmp_path):
    spark.sql("select 20 as seq, date'2024-01-01' as coverage_start, date'2024-01-07' as coverage_end union all select 21, date'2024-01-08', date'2024-01-14'").write.parquet(f"{tmp_path}/file_log.parquet")
    spark.createDataFrame([("1", 1, "registry_weekly_20240101-20240107.zip"), ("2", 1, "registry_weekly_20240108-20240114.zip"), ("3", 1, "none")], "npi string, version int, source_file string").write.parquet(f"{tmp_path}/provider_history.parquet")
    assert rows(relational.QUERIES["join_computed_key_all"](spark, str(tmp_path))) == [("1", 1, 20), ("2", 1, 21), ("3", 1, None)]
