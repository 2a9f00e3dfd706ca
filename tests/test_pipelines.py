"""Change capture over all snapshots."""

from collections import Counter

from rateloom.queries import pipelines


def test_every_pair_of_applied_snapshots_is_classified(spark, tmp_path):
    log = [("c", "applied", "2024-03-01"), ("a", "applied", "2024-01-01"), ("b", "applied", "2024-02-01"), ("b", "applied", "2024-02-01"), ("x", "rejected", "2024-02-15")]
    spark.createDataFrame(log, "source_file string, outcome string, day string").selectExpr("source_file", "outcome", "to_date(day) as coverage_end").write.parquet(f"{tmp_path}/file_log.parquet")
    rows = [("a", "1", "X", None), ("a", "2", "X", None), ("b", "1", "Y", None), ("b", "3", "X", None), ("x", "9", "X", None), ("c", "1", "Y", "02/20/2024"), ("c", "2", "X", None), ("c", "3", "X", None)]
    spark.createDataFrame(rows, "source_file string, npi string, practice_city string, deactivation_date string").selectExpr("*", "'01/01/2024' as last_update_date", "cast(null as string) as reactivation_date", "'O' as org_name").write.parquet(f"{tmp_path}/nppes_full.parquet")
    got = Counter(tuple(r) for r in pipelines.QUERIES["cdc_classify_all"](spark, str(tmp_path)).collect())
    assert got == Counter([("b", "1", "update"), ("b", "2", "absent_from_full"), ("b", "3", "insert"), ("c", "1", "deactivate"), ("c", "2", "insert"), ("c", "3", "unchanged")])
