import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

FAST = ["clean_pings", "route_hour_speed", "report_slowest", "report_bunching", "quality_route_hour",
        "snapshot_profile", "schedule_delay", "delay_quantiles", "upsert_ping_two_batches", "insight_prompt",
        "stream_speed", "stream_route_hour"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["route_id", "full_date", "hour_label", "n_moving", "avg_moving_speed_kmph", "n_bunched"]


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 50


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in ["customer", "supplier", "orders", "lineitem", "events"]:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = E.queries()[name](spark, SF_SMALL).toArrow()
    want = con.sql(E.oracle_sql()[name]).arrow()
    if not hasattr(want, "column_names"):
        want = want.read_all()
    assert sorted(got.column_names) == sorted(want.column_names)

    def norm(tbl):
        cols = sorted(tbl.column_names)
        data = [tbl.column(c).to_pylist() for c in cols]
        def cell(v):
            if v is None:
                return "NULL"
            return repr(round(v, 9)) if isinstance(v, float) else str(v)
        return sorted("|".join(cell(v) for v in row) for row in zip(*data))
    assert norm(got) == norm(want)
