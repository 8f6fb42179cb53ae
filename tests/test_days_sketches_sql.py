"""Many lake days in one read, quantile sketches kept by day, the knee of a sweep, SQL clients."""

import random

import pytest
from pyspark.sql import functions as F

from cadenza.operators import quantile_state as QS
from cadenza.operators.tuning import choose_k
from cadenza.sources import lake as LK


def test_many_days_in_one_pruned_read(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = spark.range(400).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("d"))
    LK.write_lake(rows.withColumns(LK.date_partitions(F.col("d"))), path)
    dates = spark.createDataFrame([(f"2024-01-{d:02d}", d % 3 == 0) for d in range(1, 32)] * 2, "date string, wanted boolean")
    days = dates.withColumn("date", F.to_date("date")).where("wanted AND date <= DATE '2024-01-31'")
    got = LK.read_lake_days(spark, path, days)
    by_day = [LK.read_lake_day(spark, path, f"2024-01-{d:02d}", drop_partitions=False) for d in range(3, 32, 3)]
    want = [tuple(r) for df in by_day for r in df.select("id", "d", "year", "month", "day").collect()]
    assert sorted(tuple(r) for r in got.select("id", "d", "year", "month", "day").collect()) == sorted(want)
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()


def test_sketches_merge_within_the_stated_error(spark, tmp_path):
    r = random.Random(5)
    path = str(tmp_path / "sketches")
    data = [(f"2024-01-{d:02d}", c, r.gauss(d, 3) if r.random() < 0.98 else (None if r.random() < 0.5 else float("nan")), float(r.randrange(3)))
            for d in range(1, 6) for c in (0, 1) for _ in range(3000)]
    df = spark.createDataFrame([*data, ("2024-01-06", 2, None, None)], "day string, cluster int, a double, b double")
    QS.store_sketches(df.withColumn("a", F.lit(0.0)), path, "cluster", ["a", "b"])
    QS.store_sketches(df, path, "cluster", ["a", "b"])  # sketched again: replaces
    for days in (None, ("2024-01-02", "2024-01-03")):
        for row in QS.merged_quartiles(spark, path, ["a", "b"], days).collect():
            own = sorted(x[2 if row["feature"] == "a" else 3] for x in data if x[1] == row["cluster"]
                         and (days is None or days[0] <= x[0] <= days[1]) and x[2 if row["feature"] == "a" else 3] is not None
                         and x[2 if row["feature"] == "a" else 3] == x[2 if row["feature"] == "a" else 3])
            assert row["n"] == len(own)
            if not own:
                assert row["values"] is None and row["cluster"] == 2
                continue
            assert (row["values"][0], row["values"][4]) == (own[0], own[-1])
            for q, v in zip(QS.QUARTILES, row["values"], strict=True):
                below, upto = sum(x < v for x in own) / len(own), sum(x <= v for x in own) / len(own)
                assert below <= q + QS.rank_error() and upto >= q - QS.rank_error()


@pytest.mark.parametrize("costs,silhouettes,want", [
    ([100, 40, 20, 17, 15, 13], [0.1] * 6, 4),      # the knee
    ([100, 80, 60, 40, 20, 0], [0.1, 0.2, 0.9, 0.2, 0.1, 0.1], 4),  # a straight line: best silhouette
    ([100, 50], [0.2, 0.3], 3), ([7], [0.5], 2)])
def test_choose_k(spark, costs, silhouettes, want):
    rows = [(k, float(s), float(c)) for k, (c, s) in enumerate(zip(costs, silhouettes, strict=True), 2)]
    got = choose_k(spark.createDataFrame(rows, "k int, silhouette double, cost double")).collect()
    assert [r["k"] for r in got if r["chosen"]] == [want] and len(got) == len(rows)


def test_sql_clients(spark):
    from cadenza.operators.reports import daily_genre_report
    from cadenza.plans import standins as S
    from cadenza.sources.sql_clients import publish
    lake = S.lake_rows(spark, "/root/testdata/sf0.001")
    publish(spark, LK.with_run_date(lake, "2024-01-15"))
    got = spark.sql("SELECT * FROM genre_report_by_day").collect()
    want = daily_genre_report(lake, "2024-01-15").collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted((tuple(r) for r in want), key=repr)
    assert spark.sql("SELECT major_genre('k-pop, dance pop') AS g, major_genre(NULL) AS n").collect()[0]["n"] is None
