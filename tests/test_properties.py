"""Property tests: the Spark merges equal a plain-Python fold."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from streamfold.functions.schema import Field
from streamfold.operators import merge

FIELDS = [Field("k"), Field("a", "BIGINT"), Field("b", "STRING")]
T0 = dt.datetime(2024, 1, 1)

row = st.tuples(st.sampled_from(["x", "y", None]), st.one_of(st.none(), st.integers(0, 9)),
                st.one_of(st.none(), st.sampled_from(["p", "q", "r"])),
                st.integers(0, 600))           # minutes: gaps longer than the TTL happen
rows_st = st.lists(row, min_size=1, max_size=25)


def _df(spark, rows):
    data = [(k, a, b, T0 + dt.timedelta(minutes=m), i) for i, (k, a, b, m) in enumerate(rows)]
    return data, spark.createDataFrame(data, "k string, a long, b string, ts timestamp, id long")


def _fold(data, keep_nulls, ttl=None):
    out = {}
    last_ts = {}
    for k, a, b, ts, i in sorted(data, key=lambda r: (r[3], r[4])):
        if ttl is not None and k in last_ts and (ts - last_ts[k]).total_seconds() > ttl:
            out[k] = {"a": None, "b": None}
        last_ts[k] = ts
        cur = out.setdefault(k, {"a": None, "b": None})
        for c, v in (("a", a), ("b", b)):
            if keep_nulls or v is not None:
                cur[c] = v
    return {k: (v["a"], v["b"]) for k, v in out.items()}


SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(rows_st)
def test_latest_nonnull_property(spark, rows):
    data, df = _df(spark, rows)
    got = {r["k"]: (r["a"], r["b"]) for r in merge.merge_latest_nonnull(df, FIELDS, ["k"], ["ts", "id"]).collect()}
    assert got == _fold(data, keep_nulls=False)


@SETTINGS
@given(rows_st)
def test_last_row_property(spark, rows):
    data, df = _df(spark, rows)
    got = {r["k"]: (r["a"], r["b"]) for r in merge.upsert_last_row(df, FIELDS, ["k"], ["ts", "id"]).collect()}
    exp = {k: v for k, v in _fold(data, keep_nulls=True).items() if k is not None}
    assert got == exp


@SETTINGS
@given(rows_st)
def test_idle_ttl_property(spark, rows):
    data, df = _df(spark, rows)
    out = merge.merge_idle_ttl(df, FIELDS, ["k"], ["ts", "id"], ts_col="ts", ttl_seconds=3600)
    got = {r["k"]: (r["a"], r["b"]) for r in out.collect()}
    assert got == _fold(data, keep_nulls=False, ttl=3600)


asof_row = st.tuples(st.sampled_from(["x", "y", None]), st.booleans(), st.integers(0, 400),
                     st.one_of(st.none(), st.integers(0, 9)))
asof_rows = st.lists(asof_row, min_size=1, max_size=40)


@SETTINGS
@given(asof_rows, st.integers(1, 120), st.integers(1, 4))
def test_asof_property(spark, rows, chunk_seconds, span_chunks):
    """J1 with random chunk and span widths: each trade
    gets the quote of its key with the greatest (time, quote-first, id) at
    or before it, as a whole row (a NULL field is not filled)."""
    from streamfold.operators import enrich
    trades, quotes = [], []
    for i, (k, is_quote, sec, v) in enumerate(rows):
        ts = T0 + dt.timedelta(seconds=sec)
        (quotes if is_quote else trades).append((k, ts, i, v))
    tdf = spark.createDataFrame(trades or [(None, T0, -1, None)], "k string, ts timestamp, id long, v long")
    qdf = spark.createDataFrame(quotes or [(None, T0, -2, None)], "k string, ts timestamp, id long, v long")
    got = {r["id"]: r["q_v"] for r in enrich.asof_latest(
        tdf.select("k", "ts", "id"), qdf, ["k"], "ts", "id", ["v"], prefix="q_",
        chunk_ms=chunk_seconds * 1000, span_chunks=span_chunks).collect()}
    exp = {}
    for k, ts, i, _ in trades:
        if k is None:
            continue
        cands = [(qts, qi, qv) for qk, qts, qi, qv in quotes if qk == k and qts <= ts]
        if cands:
            exp[i] = max(cands, key=lambda c: (c[0], c[1]))[2]
    assert got == exp
