import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import features as FT
from ledgerlens.operators.aggregates import daily_avg_interval
from ledgerlens.operators.features import DERIVED_COLS, build_features
from ledgerlens.plans import queries as Q
from helpers import T0, tx_rows
from conftest import SF0001, SF001

DAY = 86400
WEEK = 7 * DAY


def edge_rows():
    rows = []
    # a busy sender spanning many hourly segments and more than 7 days,
    # with ties inside one second and a row exactly 7 days after another
    for i in range(60):
        rows.append({"f": "hot", "t": f"r{i % 3}", "ts": T0 + i * 5000, "v": 1.0 + (i % 7), "err": i % 4 == 0})
    rows.append({"f": "hot", "t": "r0", "ts": T0 + 5000, "v": 3.0})  # tie with i=1
    rows.append({"f": "hot", "t": "r1", "ts": T0 + WEEK, "v": 2.0})  # exactly 7 days after the first
    rows.append({"f": "hot", "t": "r1", "ts": T0 + WEEK + 1, "v": 2.0})
    # constant values: rolling std exactly 0 -> NULL z
    for i in range(14):
        rows.append({"f": "flat", "t": "r9", "ts": T0 + i * 3600, "v": 5.0, "g": 5.0})
    # NULL sender / receiver
    rows.append({"f": None, "t": "r0", "ts": T0 + 100, "v": 1.0})
    rows.append({"f": None, "t": "r0", "ts": T0 + 200, "v": 2.0})
    rows.append({"f": "lonely", "t": None, "ts": T0 + 300, "v": 1.0})
    # a value spike after a quiet stretch
    for i in range(12):
        rows.append({"f": "spiky", "t": "r5", "ts": T0 + i * 600, "v": 10.0 + (i % 2) * 0.1, "g": 20.0 + (i % 2) * 0.1})
    rows.append({"f": "spiky", "t": "r5", "ts": T0 + 12 * 600, "v": 1e6, "g": 1e7})
    for i, r in enumerate(rows):
        r["h"] = f"h{i:04d}"
        r["b"] = i
    return rows


def collect(df):
    pdf = df.toPandas().sort_values("hash").reset_index(drop=True)
    return pdf


def assert_same(a, b, rtol=1e-9):
    assert list(a.columns) == list(b.columns)
    for c in a.columns:
        x, y = a[c], b[c]
        if x.dtype.kind == "f":
            ok = np.isclose(x.astype(float), y.astype(float), rtol=rtol, atol=1e-9, equal_nan=True)
        else:
            ok = (x == y) | (x.isna() & y.isna())
        assert ok.all(), f"column {c} differs in {int((~ok).sum())} rows"


@pytest.mark.parametrize("busy", [2, 7, 40, 100_000])
def test_plans_agree_on_edge_fixture(spark, busy):
    tx = tx_rows(spark, edge_rows())
    w = collect(build_features(tx, "window"))
    assert_same(w, collect(build_features(tx, "join")))
    assert_same(w, collect(build_features(tx, busy_rows=busy)))


def test_tasks_grow_with_the_rows(spark, monkeypatch):
    """The number of tasks that sort clusters follows the rows, whatever the
    setting, and adaptive execution does not join them."""
    tx = tx_rows(spark, edge_rows())
    want = collect(build_features(tx, "window"))
    monkeypatch.setattr(FT, "TASK_ROWS", 2)
    f = build_features(tx)
    n = tx.count()
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert f", {n})" in plan and f", {-(-n // 2)})" in plan and plan.count("REPARTITION_BY_NUM") == 2
    assert_same(want, collect(f))


def test_plans_agree_on_events(spark):
    tx = Q.tx(spark, SF001)
    w = collect(build_features(tx, "window"))
    assert_same(w, collect(build_features(tx)))


def test_rolling_frame_excludes_current_second_and_includes_7_days(spark):
    tx = tx_rows(spark, edge_rows())
    f = {r["hash"]: r for r in build_features(tx).collect()}
    first = f["h0000"]
    assert first["rolling_tx_count"] == 0 and first["rolling_value_mean"] is None
    # h0001 and the tie row share one second: neither sees the other
    assert f["h0001"]["rolling_tx_count"] == 1
    assert f["h0060"]["rolling_tx_count"] == 1
    # the row exactly 7 days after h0000 still has h0000 in its frame
    later = f["h0061"]
    n_in_frame = sum(1 for i in range(60) if T0 + WEEK - 604800 <= T0 + i * 5000 <= T0 + WEEK - 1) + 1
    assert later["rolling_tx_count"] == n_in_frame


def test_constant_values_give_zero_std_and_null_z(spark):
    tx = tx_rows(spark, edge_rows())
    rows = build_features(tx).filter(F.col("from") == "flat").orderBy("timeStamp").collect()
    last = rows[-1]
    assert last["rolling_value_std"] == 0.0 and last["value_zscore"] is None and last["value_spike"] == 0


def test_spike_detected(spark):
    tx = tx_rows(spark, edge_rows())
    r = build_features(tx).filter(F.col("from") == "spiky").orderBy(F.desc("timeStamp")).first()
    assert r["rolling_tx_count"] == 12 and r["value_spike"] == 1 and r["gasPrice_spike"] == 1


def test_null_keys_get_no_aggregates(spark):
    tx = tx_rows(spark, edge_rows())
    f = build_features(tx)
    n = f.filter(F.col("from").isNull()).collect()
    assert len(n) == 2 and all(r["total_tx_count_from"] is None and r["daily_tx_count_from"] is None for r in n)
    assert all(r["total_tx_count_to"] == 2 + 20 + 1 for r in n)  # r0 receives 20 hot rows, the tie row, 2 null rows
    # NULL senders still order among themselves for the interval
    assert sorted(r["interval_from"] for r in n if r["interval_from"] is not None) == [100.0]
    lonely = f.filter(F.col("from") == "lonely").first()
    assert lonely["total_tx_count_to"] is None and lonely["total_tx_count_from"] == 1


def test_intervals_and_daily_mean(spark):
    tx = tx_rows(spark, [{"f": "a", "t": "b", "ts": T0 + s} for s in (0, 10, 40, DAY + 5)])
    rows = build_features(tx).orderBy("timeStamp").collect()
    assert [r["interval_from"] for r in rows] == [None, 10.0, 30.0, float(DAY + 5 - 40)]
    assert rows[0]["daily_avg_interval_from"] == 20.0
    assert rows[3]["daily_avg_interval_from"] == float(DAY + 5 - 40)


def test_rates_and_counts(spark):
    tx = tx_rows(spark, [{"f": "a", "t": "b", "ts": T0 + s, "err": e} for s, e in ((0, 1), (10, 0), (DAY * 8, 1))])
    r = build_features(tx, "window").orderBy("timeStamp").first()
    assert r["total_tx_count_from"] == 3 and r["total_fail_count_from"] == 2
    assert math.isclose(r["total_fail_rate_from"], 3 / 4)
    assert r["daily_tx_count_from"] == 2 and r["weekly_tx_count_from"] == 2


def test_window_plan_has_two_exchanges(spark):
    f = build_features(Q.tx(spark, SF0001), "window")
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def _compare(a, b, rel):
    """Rows of two feature tables agree; floating columns to ``rel``."""
    key = lambda r: r["hash"]
    for x, y in zip(sorted(a.collect(), key=key), sorted(b.collect(), key=key), strict=True):
        for c in DERIVED_COLS:
            if isinstance(x[c], float) and y[c] is not None:
                assert math.isclose(x[c], y[c], rel_tol=rel, abs_tol=rel), (x["hash"], c, x[c], y[c])
            else:
                assert x[c] == y[c], (x["hash"], c, x[c], y[c])


def test_one_plan_agrees_on_null_times_and_addresses(spark):
    rows = [{"f": "a" if i % 3 else None, "t": "b", "ts": None if i % 4 == 0 else T0 + i * 977, "v": 1.0 + i, "err": i % 2} for i in range(80)]
    tx = tx_rows(spark, rows)
    _compare(build_features(tx), build_features(tx, "window"), 1e-9)
    untimed = [r for r in build_features(tx).collect() if r["datetime"] is None and r["from"] == "a"]
    assert untimed and all(r["rolling_tx_count"] == len(untimed) for r in untimed)


def test_one_plan_is_stable_on_near_constant_values(spark):
    # whole frames of one gas price, small changes, and one outlier
    rows = [{"f": "a", "t": "b", "ts": T0 + i * 1801, "v": 1e18 + (i % 5) * 1e12, "g": 2e10 if i < 100 else 2e10 + (i % 7) * 1e6} for i in range(200)]
    rows.append({"f": "a", "t": "b", "ts": T0 + 200 * 1801, "v": 1e18, "g": 9e10})
    tx = tx_rows(spark, rows)
    one, window = build_features(tx), build_features(tx, "window")
    cols = ["hash", "rolling_tx_count", "value_spike", "gasPrice_spike"]
    assert one.select(cols).exceptAll(window.select(cols)).count() == 0
    by = {r["hash"]: r for r in window.collect()}
    for r in one.collect():
        for c in ("rolling_value_std", "rolling_gasPrice_std", "rolling_value_mean", "rolling_gasPrice_mean"):
            x, y = r[c], by[r["hash"]][c]
            assert (x is None) == (y is None) and (x is None or math.isclose(x, y, abs_tol=1e-9))
        if by[r["hash"]]["rolling_gasPrice_std"] == 0:
            assert r["rolling_gasPrice_std"] == 0


def test_output_columns(spark):
    tx = tx_rows(spark, edge_rows()[:3])
    cols = build_features(tx).columns
    assert cols[-len(DERIVED_COLS):] == DERIVED_COLS


def test_four_exchanges_in_all(spark):
    tx = Q.tx(spark, SF0001)
    main = build_features(tx)
    days = FT.day_table(FT.activity_days(FT.with_value_logs(tx)))
    counts = [d._jdf.queryExecution().executedPlan().toString().count("Exchange ") for d in (main, days)]
    assert counts == [2, 2]


def test_days_of_a_longer_history(spark):
    tx = tx_rows(spark, edge_rows())
    base = FT.with_value_logs(tx)
    new = F.col("timeStamp") >= T0 + 2 * DAY
    days = FT.merge_days(FT.activity_days(base.filter(new)).unionByName(FT.activity_days(base.filter(~new))))
    whole = {r["hash"]: r for r in build_features(tx).collect()}
    # the last day from the rows of its 7-day frame only
    late = build_features(tx.filter(F.col("timeStamp") >= T0 - DAY), days=days).filter(new).collect()
    assert late and all(r == whole[r["hash"]] for r in late)


def test_daily_intervals_from_the_day_table(spark):
    rows = [{"f": "a" if i % 3 else None, "t": "b", "ts": None if i % 9 == 0 else T0 + i * 9777, "v": 1.0} for i in range(80)]
    tx = tx_rows(spark, rows + edge_rows()[:40])
    full = build_features(tx, "window")
    for side in ("from", "to"):
        key = lambda r: (str(r[0]), str(r[1]))
        a = sorted(map(tuple, daily_avg_interval(full, side).collect()), key=key)
        b = sorted(map(tuple, FT.daily_intervals(tx, side).collect()), key=key)
        assert [r[:2] for r in a] == [r[:2] for r in b]
        assert all(x[2] == y[2] or math.isclose(x[2], y[2], rel_tol=1e-12) for x, y in zip(a, b, strict=True))
