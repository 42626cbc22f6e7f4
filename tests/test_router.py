import datetime

from pyspark.sql import functions as F

from traceloom.operators.router import rolling_rate


def test_rolling_rate_with_ties_edges_and_rows_without_a_time(spark):
    at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
    rows = [(0, at(0), True), (1, at(10), False), (2, at(10), True), (3, at(20), None), (4, at(21), False), (5, None, True), (6, None, False), (7, at(500), None)]
    got = rolling_rate(spark.createDataFrame(rows, "id int, received_at timestamp, fallback boolean"), F.col("fallback"), 10, 2).collect()
    assert {r.id: (r.n, r.rate, r.alert) for r in got} == {
        0: (1, 1.0, False), 1: (3, 2 / 3, True), 2: (3, 2 / 3, True), 3: (3, 0.5, True), 4: (2, 0.0, False), 5: (2, 0.5, True), 6: (2, 0.5, True), 7: (1, None, False),
    }
