import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from streamfold.operators import enrich
from conftest import rows

T0 = dt.datetime(2024, 1, 1)
TS = "symbol string, price double, _ts timestamp, _seq long"
QS = "symbol string, current double, high double, low double, open double, prev_close double, _ts timestamp, _seq long"


def t(s):
    return T0 + dt.timedelta(seconds=s)


def test_trade_before_first_quote_and_null_field(spark):
    trades = spark.createDataFrame([("A", 10.0, t(0), 1), ("A", 11.0, t(20), 3), ("A", 12.0, t(40), 5)], TS)
    quotes = spark.createDataFrame([("A", 9.0, 9.5, 8.5, 9.0, 8.0, t(10), 2),
                                    ("A", 9.9, None, 8.8, 9.1, 10.0, t(30), 4)], QS)
    out = rows(enrich.enrich_trades(trades, quotes, chunk_ms=15_000), order=lambda d: d["_seq"])
    assert [r["_seq"] for r in out] == [3, 5]          # first trade had no quote yet
    assert out[0]["quote_high"] == 9.5 and out[0]["pct_change"] == 37.5
    assert out[1]["quote_high"] is None                # newest quote's NULL, not the older 9.5
    assert out[1]["quote_current"] == 9.9 and out[1]["pct_change"] == 20.0


def test_prev_close_zero_or_null(spark):
    trades = spark.createDataFrame([("A", 10.0, t(5), 2), ("B", 10.0, t(5), 4)], TS)
    quotes = spark.createDataFrame([("A", 1.0, 1.0, 1.0, 1.0, 0.0, t(1), 1),
                                    ("B", 1.0, 1.0, 1.0, 1.0, None, t(1), 3)], QS)
    out = rows(enrich.enrich_trades(trades, quotes))
    assert [r["pct_change"] for r in out] == [None, None]


def test_quote_at_equal_time_comes_first(spark):
    trades = spark.createDataFrame([("A", 10.0, t(5), 1)], TS)
    quotes = spark.createDataFrame([("A", 1.0, 1.0, 1.0, 1.0, 5.0, t(5), 9)], QS)
    assert rows(enrich.enrich_trades(trades, quotes))[0]["pct_change"] == 100.0


def test_null_symbol_never_matches(spark):
    trades = spark.createDataFrame([(None, 10.0, t(5), 1)], TS)
    quotes = spark.createDataFrame([(None, 1.0, 1.0, 1.0, 1.0, 5.0, t(1), 2)], QS)
    assert enrich.enrich_trades(trades, quotes).count() == 0


def test_matches_brute_force_across_chunks(spark):
    rnd = random.Random(7)
    tr, qu = [], []
    for i in range(600):
        sym = rnd.choice("ABC")
        ts = t(rnd.randrange(0, 5000))
        if rnd.random() < 0.3:
            qu.append((sym, float(i), None if rnd.random() < 0.2 else 1.0, 1.0, 1.0, float(rnd.choice([0, 1, 2])), ts, i))
        else:
            tr.append((sym, float(i), ts, i))
    trades, quotes = spark.createDataFrame(tr, TS), spark.createDataFrame(qu, QS)
    got = {r["_seq"]: (r["quote_current"], r["quote_high"]) for r in
           enrich.enrich_trades(trades, quotes, chunk_ms=97_000, span_chunks=5).collect()}
    # brute force: pandas merge_asof per symbol, quote first at equal time
    tp = pd.DataFrame(tr, columns=["symbol", "price", "_ts", "_seq"])
    qp = pd.DataFrame(qu, columns=["symbol", "current", "high", "low", "open", "prev_close", "_ts", "_seq"])
    exp = {}
    for _, trow in tp.iterrows():
        c = qp[(qp.symbol == trow.symbol) & (qp._ts <= trow._ts)]
        if len(c):
            last = c.sort_values(["_ts", "_seq"]).iloc[-1]
            exp[trow._seq] = (last.current, None if pd.isna(last.high) else last.high)
    assert got == exp


def test_burst_of_a_hot_key_is_split(spark):
    """A symbol with most rows, nearly all within a second: narrow chunks and
    short spans give the same rows as one chunk for everything, and brute
    force; no window holds more than a few rows."""
    rnd = random.Random(11)
    tr, qu = [], []
    for i in range(900):
        hot = rnd.random() < 0.7
        sym = "H" if hot else rnd.choice("AB")
        ts = T0 + dt.timedelta(milliseconds=rnd.randrange(0, 1000) if hot else rnd.randrange(0, 4_000_000))
        if rnd.random() < 0.3:
            qu.append((sym, float(i), None if rnd.random() < 0.2 else 1.0, 1.0, 1.0, 2.0, ts, i))
        else:
            tr.append((sym, float(i), ts, i))
    trades, quotes = spark.createDataFrame(tr, TS), spark.createDataFrame(qu, QS)
    got = rows(enrich.enrich_trades(trades, quotes, chunk_ms=10, span_chunks=16))
    assert got == rows(enrich.enrich_trades(trades, quotes, chunk_ms=10 ** 8)) and len(got) > 300
    qp = pd.DataFrame(qu, columns=["symbol", "current", "high", "low", "open", "prev_close", "_ts", "_seq"])
    for r in got[:200]:
        c = qp[(qp.symbol == r["symbol"]) & (qp._ts <= r["_ts"])].sort_values(["_ts", "_seq"])
        assert r["quote_current"] == c.iloc[-1].current
    groups = pd.concat([pd.DataFrame(tr)[[0, 2]], pd.DataFrame(qu)[[0, 6]].rename(columns={6: 2})])
    groups["c"] = (groups[2] - T0) // dt.timedelta(milliseconds=10)
    assert groups.groupby([0, "c"]).size().max() <= 20


def test_single_hot_symbol_from_tables(spark):
    """Every trade and quote of sf0.01 on one symbol: chunk and span widths
    change nothing."""
    from streamfold.sources import tables as tb
    sf = "/root/testdata/sf0.01"
    hot = lambda df: df.withColumn("symbol", F.lit("HOT"))
    trades, quotes = hot(tb.trades(spark, sf)), hot(tb.quotes(spark, sf))
    narrow = enrich.enrich_trades(trades, quotes)
    wide = enrich.enrich_trades(trades, quotes, chunk_ms=86_400_000, span_chunks=2)
    assert narrow.exceptAll(wide).count() == 0 and wide.exceptAll(narrow).count() == 0
