"""Rolling medians against a brute-force version, window by window."""

import random
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest

from loomtext.llm import rolling

from .helpers import rows_of

SCHEMA = "click_id bigint, ts timestamp_ntz, kind string, cents bigint, n string, block string, series string, own string, rest string"
BEGIN = datetime(2024, 1, 1)


def doubled(values):
    v = sorted(values)
    return v[(len(v) - 1) // 2] + v[len(v) // 2]


def brute(rows, minutes=60):
    out = []
    for i, ts, kind, c in rows:
        if ts is None:
            continue
        window = [x for _, t, k, x in rows if t is not None and k == kind and x is not None and ts - timedelta(minutes=minutes) <= t <= ts]
        m = d = far = None
        if len(window) > 1:
            m = doubled(window)
            d = doubled([abs(2 * x - m) for x in window])
            far = None if c is None else 2 * abs(2 * c - m) > 3 * d
        out.append((i, kind, len(window), m, d, far))
    return sorted(out, key=repr)


def clicks(seed, n, hours, top=40):
    """Ties in time and value, nulls in every column, negative values, rows exactly an hour apart, bursts."""
    rng, out = random.Random(seed), []
    for i in range(n):
        ts = BEGIN + timedelta(microseconds=rng.randrange(hours * 3_600_000_000))
        ts = rng.choice([ts, ts.replace(microsecond=0), ts.replace(minute=0, second=0, microsecond=0), BEGIN + timedelta(hours=5), out[-1][1] if out and out[-1][1] else ts])
        out.append((i if rng.random() < 0.98 else None, ts if rng.random() < 0.97 else None, rng.choice(["a", "a", "a", "b", "", None]), rng.choice([None, rng.randrange(-top, top), rng.randrange(top**3)])))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA)


@pytest.mark.parametrize("dealt", [{}, {"chunk_rows": 7}, {"most_hours": 1, "chunk_rows": 40}, {"block_rows": 50, "most_hours": 3, "chunk_rows": 1}])
def test_windows_and_ways_to_deal_them(spark, dealt):
    rows = clicks(1, 700, 30)
    got = rolling.rolling_medians(frame(spark, rows), "ts", "cents", "kind", ["click_id", "kind"], **dealt)
    assert rows_of(got) == brute(rows)


@pytest.mark.parametrize(("seed", "hours", "top", "minutes"), [(2, 2, 3, 60), (3, 400, 1000, 60), (4, 12, 100, 7), (5, 20, 50, 150)])
def test_shapes_of_series(spark, seed, hours, top, minutes):
    rows = clicks(seed, 400, hours, top)
    got = rolling.rolling_medians(frame(spark, rows), "ts", "cents", "kind", ["click_id", "kind"], minutes=minutes, chunk_rows=30)
    assert rows_of(got) == brute(rows, minutes)


def test_one_instant_and_equal_values(spark):
    rows = [(i, BEGIN, "a", 5) for i in range(300)] + [(900 + i, BEGIN + timedelta(hours=1), "a", i) for i in range(3)] + [(999, BEGIN + timedelta(hours=1, microseconds=1), "a", None)]
    got = rolling.rolling_medians(frame(spark, rows), "ts", "cents", "kind", ["click_id", "kind"], chunk_rows=10)
    assert rows_of(got) == brute(rows)


def test_empty(spark):
    assert rolling.rolling_medians(frame(spark, []), "ts", "cents", "kind", ["click_id"]).collect() == []
    assert rows_of(rolling.rolling_medians(frame(spark, [(1, None, "a", 1)]), "ts", "cents", "kind", ["click_id"])) == []


def test_a_zone_of_the_session_does_not_matter(spark):
    """01:30 to 03:30 on the night that this zone's clocks jump from 2 to 3."""
    rows = [(i, datetime(2024, 3, 31, 1, 30) + timedelta(minutes=10 * i), "a", i * i) for i in range(13)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert rows_of(rolling.rolling_medians(frame(spark, rows), "ts", "cents", "kind", ["click_id", "kind"])) == brute(rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_query_takes_each_click_once(spark, tmp_path):
    rows = [(1, BEGIN, "a", 1.005), (1, BEGIN, "a", 1.005), (2, BEGIN, "a", -0.125), (3, None, "a", 9.0), (4, BEGIN, "a", float("nan")), (5, BEGIN, "a", 1e300), (6, BEGIN, None, None)]
    spark.createDataFrame(rows, "click_id long, ts timestamp_ntz, kind string, value double").write.parquet(f"{tmp_path}/clicks.parquet")
    got = rows_of(rolling.op11_rolling_medians(spark, str(tmp_path)))
    want = brute([(1, BEGIN, "a", 100), (2, BEGIN, "a", -12), (4, BEGIN, "a", None), (5, BEGIN, "a", None), (6, BEGIN, None, None)])
    assert got == want


def test_wavelet():
    rng = np.random.default_rng(1)
    ranks = rng.integers(0, 37, 500).astype(np.int32)
    tree = rolling.Wavelet(ranks, 6)
    left = rng.integers(0, 499, 300).astype(np.int32)
    right = (left + 1 + rng.integers(0, 500, 300) % (500 - left)).astype(np.int32)
    k = (rng.integers(0, 500, 300) % (right - left)).astype(np.int32)
    x = rng.integers(0, 65, 300).astype(np.int32)
    assert tree.least(left, right, k).tolist() == [sorted(ranks[a:z])[i] for a, z, i in zip(left, right, k, strict=True)]
    assert tree.below(left, right, x).tolist() == [(ranks[a:z] < i).sum() for a, z, i in zip(left, right, x, strict=True)]


def test_a_stream_holds_one_window_only():
    """A block of 200 windows in small batches: what is held stays at a window and a chunk."""
    stream, most, n = rolling.Stream(100, 20_000, 50), 0, 0
    for at in range(0, 20_000, 40):
        time = np.arange(at, at + 40)
        rest = pa.StructArray.from_arrays([pa.array(time)], ["id"])
        stream.add(pa.RecordBatch.from_arrays([pa.array(["s"] * 40), pa.array(np.zeros(40, np.int64)), pa.array(time), pa.array(time), pa.array(np.ones(40, bool)), rest], ["series", "block", "time", "value", "own", "rest"]))
        n += sum(len(b) for b in stream.drain())
        most = max(most, sum(len(p[0]) for p in stream.parts))
    n += sum(len(b) for b in stream.drain(last=True))
    assert n == 20_000 and most < 400
