"""Queries of price histories over closes of zero, against their SQL."""

from __future__ import annotations

import datetime

import duckdb
import pytest
from compare import assert_same

from millrace import plans

QUERIES, SQL = plans.load()


@pytest.fixture(scope="module")
def zeros(spark, tmp_path_factory):
    """A path and a connection: a zero first, last, seventh from the end, twice in a row, as all there is, and at one of few points."""
    series = [
        [0.0, *range(60, 72)], [*range(60, 72), 0.0], [*range(60, 70), 0.0, *range(80, 86)], [50.0, 0.0, 0.0, 70.0, 71.0, 65.0, 60.0, 64.0, 61.0], [0.0] * 9, [0.0, 5.0], [5.0, 0.0], [0.0, 0.0], [3.0], [0.0],
        [*range(90, 60, -1), 62.0, 61.5, 63.0], [55.0] + [x for _ in range(8) for x in (88.0, 61.0)],
        [100.0, 40.0, 0.0, *[x for _ in range(5) for x in (40.0, 100.0)], 100.0], [40.0, *[x for _ in range(6) for x in (40.0, 100.0)], 100.0],
    ]
    start, rows = datetime.datetime(2024, 1, 1), []
    for user, closes in enumerate(series):
        for k, v in enumerate(closes):
            rows.append((len(rows), start + datetime.timedelta(hours=31 * k, seconds=user), user, "view", float(v), '{"k": 1}'))
    path = tmp_path_factory.mktemp("zeros")
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string").write.parquet(f"{path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{path}/events.parquet/*.parquet'")
    return str(path), con


@pytest.mark.parametrize("name", ["win_weekret_pos", "eod_stock_metrics", "qry_stock_range", "topk_screen", "prj_composite_key"])
def test_closes_of_zero(name, spark, zeros):
    path, con = zeros
    assert_same(QUERIES[name](spark, path), con, SQL[name])
