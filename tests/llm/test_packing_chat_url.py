"""Packing, URL filters and the pipeline."""
import hashlib
import struct
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from streamfold.llm import catalog, language_id, packing, simhash, url_filter
from streamfold.llm.common import tokenizer_path

SF = "/root/testdata/sf0.001"


def table(df):
    return [r.asDict() for r in df.collect()]


# ----------------------------------------------------------------- packing
def check_pieces(rows, texts, window):
    """Each id in exactly one piece, sequences gapless and without padding."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    expected = defaultdict(int)
    for doc_id, text in texts:
        ids = tuple([*tok.encode(text or "", add_special_tokens=False).ids, 2])
        expected[doc_id, ids] += 1
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    for (doc_id, ids), times in expected.items():
        mine = [r for r in by_doc[doc_id] if r["doc_tokens"] == len(ids)]
        starts = defaultdict(int)
        for r in mine:
            part = ids[r["start"]:r["start"] + r["length"]]
            assert len(part) == r["length"] > 0
            assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == r["ids_crc32"]
            starts[r["start"]] += 1
        if times == 1:
            at = 0
            for r in sorted(mine, key=lambda r: r["start"]):
                assert r["start"] == at
                at += r["length"]
            assert at == len(ids)
        else:
            assert sum(r["length"] for r in mine) == times * len(ids)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or at < window and at & (at - 1) == 0, at
    return sequences


@pytest.mark.parametrize("window", [64, 4096])
@pytest.mark.parametrize("name", ["odd", "docs", "empty"])
def test_pieces_cover_every_id_once(request, name, window):
    df = request.getfixturevalue(name)
    rows = table(packing.pieces(df, window=window))
    texts = [(r["doc_id"], r["text"]) for r in table(df.select("doc_id", "text"))]
    check_pieces(rows, texts, window)
    assert len(rows) >= len(texts)


def test_random_histograms():
    rng = np.random.default_rng(0)
    for window, size, top in ((16, 40, 50), (64, 30, 5), (256, 100, 3), (64, 1, 1000), (100, 2, 7)):
        hist = np.zeros(window, dtype=np.int64)
        for n in rng.integers(1, window, size):
            hist[n] += rng.integers(1, top + 1)
        plan = packing.Plan(hist, window)
        length = np.repeat(np.arange(window), hist)
        rank = np.concatenate([np.arange(k) for k in hist])
        row, start, n, seq, offset = packing.look_up(plan.tables(), length, rank)
        covered = np.bincount(row, weights=n, minlength=len(length))
        assert (covered == length).all()
        order = np.lexsort((start, row))
        r, s, z = row[order], start[order], n[order]
        assert (s[1:] == np.where(r[1:] == r[:-1], s[:-1] + z[:-1], 0)).all()
        order = np.lexsort((offset, seq))
        q, o, z = seq[order], offset[order], n[order]
        assert (o[1:] == np.where(q[1:] == q[:-1], o[:-1] + z[:-1], 0)).all()
        full = np.bincount(seq, weights=n)
        assert all(f == window or int(f) & (int(f) - 1) == 0 for f in full) and len(full) == plan.sequences


def test_combinations_fill_the_window():
    hist = np.zeros(64, dtype=np.int64)
    hist[[5, 7, 16, 20, 32, 44, 59]] = 9
    combos = packing.combinations(hist, 64)
    assert ((32, 2),) in combos and ((44, 1), (20, 1)) in combos and ((59, 1), (5, 1)) in combos
    assert all(sum(n * k for n, k in c) == 64 and len(c) <= 3 and all(hist[n] >= k for n, k in c) for c in combos)


def test_nnls_recovers_repeat_counts():
    combos = [((3, 1), (1, 1)), ((2, 2),), ((1, 4),)]
    target = np.array([0, 5 + 4 * 2, 2 * 7, 5], dtype=float)
    x = packing.nnls(combos, target, rounds=3000)
    assert np.allclose(x, [5, 7, 2], atol=0.05) and (x >= 0).all()


def test_most_rests_are_packed_by_combinations():
    rng = np.random.default_rng(2)
    hist = np.bincount(np.minimum(4095, rng.lognormal(6.2, 0.9, 200_000).astype(int) + 1), minlength=4096)
    plan = packing.Plan(hist)
    assert plan.by_combination >= 0.8 * hist.sum()


# -------------------------------------------------------------------- URLs
def day(n):
    return url_filter.START + n * 86_400


def test_most_specific_active_entry_decides(spark):
    e = spark.createDataFrame([
        ("example.org", "block", day(10)), ("good.example.org", "allow", day(20)), ("example.org", "remove", day(100)),
        ("good.example.org", "remove", day(200)), ("x.net", "block", day(5)), ("x.net", "allow", day(5)),
        ("X.NET", "remove", day(50)), (None, "block", day(1)), ("y.net", "odd", day(1)), ("z.net", "block", None),
        ("late.com", "block", day(300))], "domain string, action string, t long") \
        .select("domain", "action", F.timestamp_seconds("t").alias("listed_at"))
    asked = [("http://a.example.org/x", 9, "none", None), ("http://a.example.org/x", 10, "block", "example.org"),
             ("https://u:p@good.example.org:80/", 30, "allow", "good.example.org"),
             ("https://good.example.org/", 150, "allow", "good.example.org"), ("http://good.example.org", 250, "none", None),
             ("http://badexample.org/", 30, "none", None), ("http://X.net/?q", 20, "block", "x.net"),
             ("http://x.net/", 60, "none", None), ("http://y.net", 60, "none", None), ("http://z.net", 60, "none", None),
             ("not a url", 30, "none", None), (None, 30, "none", None), ("http://example.org", None, "none", None),
             ("http://late.com/", 299, "none", None), ("http://late.com/", 301, "block", "late.com"),
             ("http://" + "a." * 200 + "example.org/", 30, "none", None)]
    c = spark.createDataFrame([(i, u, None if d is None else day(d)) for i, (u, d, _, _) in enumerate(asked)],
                              "page_id long, url string, t long") \
        .select("page_id", "url", F.timestamp_seconds("t").alias("fetched_at"), F.lit(1).alias("host"), F.lit(2).alias("domain"))
    got = {r["page_id"]: (r["decision"], r["rule"]) for r in table(url_filter.judge(c, e))}
    assert got == {i: (x[2], x[3]) for i, x in enumerate(asked)}
    assert {r["decision"] for r in table(url_filter.judge(c, e.limit(0)))} == {"none"}
    assert url_filter.judge(c.limit(0), e).count() == 0
    assert url_filter.judge(c.union(c), e).count() == 2 * len(asked)


def at_micros(spark, rows, names):
    return spark.createDataFrame(rows, names).withColumn(names.split()[-2], F.timestamp_micros(names.split()[-2]))


def test_times_inside_one_second(spark):
    t = day(3) * 1_000_000
    e = at_micros(spark, [("a.com", "block", t + 100_000), ("a.com", "allow", t + 700_000), ("b.com", "block", t + 700_000)],
                  "domain string, action string, listed_at long")
    c = at_micros(spark, [(1, "http://a.com/", t + 99_999), (2, "http://a.com/", t + 100_000), (3, "http://a.com/", t + 699_999),
                          (4, "http://a.com/", t + 700_000), (5, "http://b.com/", t + 200_000), (6, "http://b.com/", t + 700_001)],
                  "page_id long, url string, fetched_at long")
    got = {r["page_id"]: r["decision"] for r in table(url_filter.judge(c, e))}
    assert got == {1: "none", 2: "block", 3: "block", 4: "allow", 5: "none", 6: "block"}


def test_open_intervals_cost_nothing_between_captures(spark):
    """Thousands of intervals that stay open, and captures in years 1 to 9999."""
    n = 2000
    e = at_micros(spark, [(f"h{i}.com", "block", day(i % 300) * 1_000_000) for i in range(n)],
                  "domain string, action string, listed_at long")
    c = at_micros(spark, [(1, "http://x.h7.com/", 253_370_764_800_000_000), (2, "http://h7.com/", day(6) * 1_000_000),
                          (3, "http://h8.com", -62_135_596_800_000_000), (4, "http://h8.com", day(900) * 1_000_000)],
                  "page_id long, url string, fetched_at long")
    df = url_filter.judge(c, e)
    assert {r["page_id"]: r["decision"] for r in table(df)} == {1: "block", 2: "none", 3: "none", 4: "block"}
    assert "sequence(" not in df._jdf.queryExecution().optimizedPlan().toString().split("explode")[0]


def test_buckets_against_a_plain_search(spark):
    rng = np.random.default_rng(8)
    step = url_filter.BUCKET_MICROS // 7
    acts = ["block", "allow", "remove"]
    es = [(f"d{rng.integers(4)}.com", acts[rng.integers(3)], int(rng.integers(200)) * step) for _ in range(120)]
    cs = [(i, f"http://w.d{rng.integers(5)}.com/", int(rng.integers(-20, 400)) * step) for i in range(300)]
    got = {r["page_id"]: (r["decision"], r["rule_since"]) for r in table(url_filter.judge(
        at_micros(spark, cs, "page_id long, url string, fetched_at long"),
        at_micros(spark, es, "domain string, action string, listed_at long")))}
    for i, url, t in cs:
        best = max(((s, url_filter.ACTIONS.index(a)) for d, a, s in es if d == url[9:-1] and s <= t), default=None)
        want = ("none", None) if best is None or best[1] == 1 else (url_filter.ACTIONS[best[1]], best[0] // 1_000_000)
        assert got[i] == want


def test_hosts(spark):
    urls = {"http://[2001:db8::1]:80/x": "[2001:db8::1]", "http://u@[::1]/": "[::1]", "http://A.com./": "a.com",
            "http://a.com": "a.com", "http://a.com:8080?x": "a.com", "http://./": None, "http:///x": None, "http://[::1": "[",
            "mailto:x@y.z": None}
    df = spark.createDataFrame([(u,) for u in urls], "url string").select("url", url_filter.host_of(F.col("url")).alias("h"))
    assert {r["url"]: r["h"] for r in table(df)} == urls
    e = at_micros(spark, [("A.com.", "block", 0), ("[::1]", "block", 0)], "domain string, action string, listed_at long")
    c = at_micros(spark, [(1, "http://x.a.com/", 9), (2, "http://[::1]:9/", 9), (3, "http://[2001:db8::1]/", 9)],
                  "page_id long, url string, fetched_at long")
    assert {r["page_id"]: r["decision"] for r in table(url_filter.judge(c, e))} == {1: "block", 2: "block", 3: "none"}


def test_url_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    df = catalog.op2_url_filter(spark, SF)
    res = con.execute(catalog.SQL["op2_url_filter"])
    names = [d[0] for d in res.description]
    expected = sorted(map(repr, res.fetchall()))
    assert sorted(repr(tuple(r[n] for n in names)) for r in df.collect()) == expected


def test_exact_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    df = catalog.op8_exact_dedup(spark, SF)
    res = con.execute(catalog.SQL["op8_exact_dedup"])
    names = [d[0] for d in res.description]
    expected = sorted(map(repr, res.fetchall()))
    assert sorted(repr(tuple(r[n] for n in names)) for r in df.collect()) == expected


# ---------------------------------------------------------------- pipeline
def slow_pipeline_keep(rows):
    """Ids left before the secrets are masked."""
    left = [r for r in rows if any(c.isalpha() for c in r["text"] or "")]
    last = {}
    for r in left:
        if r["text"] not in last or (r["doc_id"] is not None and r["doc_id"] > (last[r["text"]]["doc_id"] or -1)):
            last[r["text"]] = r
    left = list(last.values())
    fps = [simhash.fingerprint(r["text"]) for r in left]
    root = list(range(len(left)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(left)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b, key=lambda k: left[k]["doc_id"])] = min(a, b, key=lambda k: left[k]["doc_id"])
    return {left[find(i)]["doc_id"] for i in range(len(left))}


def test_pipeline_rows(spark, docs):
    rows = table(corpus_pipeline.run(spark, SF))
    kept = slow_pipeline_keep(table(docs))
    assert {r["doc_id"] for r in rows} == kept
    from streamfold.llm import secret_scan
    ranks = secret_scan.word_ranks(tokenizer_path("word_bpe_49k.json"))
    texts = [(r["doc_id"], secret_scan.mask(r["text"], secret_scan.scan(r["text"], ranks)))
             for r in table(docs) if r["doc_id"] in kept]
    check_pieces(rows, texts, 4096)


def test_stages_keep_the_columns_and_take_odd_rows(spark, odd, empty):
    for given in (odd, empty):
        d = given
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, d, SF)
            if name != "packing":
                assert out.columns == given.columns, name
                d = spark.createDataFrame(out.collect(), given.schema)
        out.collect()


def test_stages_are_the_dealt_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_dedup", "secret_scan", "packing"]
    assert language_id.UNDETERMINED == "und"


def test_simhash_stage_keeps_one_row_of_each_group_for_odd_ids(spark):
    base = " ".join(f"word{i} of{i % 7}" for i in range(400))
    other = " ".join(f"thing{i} in{i % 5}" for i in range(400))
    third = " ".join(f"place{i} at{i % 3}" for i in range(400))
    near = lambda t: t + " more"
    assert all((simhash.fingerprint(t) ^ simhash.fingerprint(near(t))).bit_count() <= 3 for t in (base, other, third))
    # id 5 stands for a near copy and for a unique text; null ids and one id for near copies of a group
    rows = [(1, base), (5, near(base)), (5, "a text of its own that no other is near to"),
            (None, other), (None, near(other)), (7, third), (7, near(third)), (8, "said twice by one"), (8, "said twice by one"),
            (None, "alone without an id"), (9, None), (9, "")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, h int, fp int, r int, kept_id int"
    d = spark.createDataFrame([(i, t, None, "s", 1, 7, 7, 7, 7) for i, t in rows], schema).repartition(3)
    out = corpus_pipeline.stage_simhash_dedup(spark, d, SF)
    assert out.columns == d.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    by_hash = lambda t: min((t, near(t)), key=lambda x: (
        (simhash.fingerprint(x) + 2**63) % 2**64, hashlib.sha256(x.encode()).digest()))
    assert got == sorted([(1, base), (5, rows[2][1]), (None, by_hash(other)), (7, by_hash(third)), rows[7], rows[9], (9, None)],
                         key=repr)


def test_one_length_with_null_ids_is_dealt_to_many_tasks(spark):
    """30,000 equal rows without an id: as many groups as the count asks for,
    alike in size, and a whole packing."""
    df = spark.createDataFrame([(None, "same text here")], "doc_id long, text string").crossJoin(spark.range(30_000)).drop("id")
    out = packing.pack(df, window=64)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "salt" in plan
    n = out.select("doc_tokens").first()[0]
    got = out.selectExpr("sum(length)", "count(distinct sequence_id, offset)", "count(*)").first()
    assert got[0] == 30_000 * n and got[1] == got[2]
    size = packing.GROUP_ROWS
    groups = spark.range(30_000).selectExpr(f"pmod(xxhash64(id), {-(-30_000 // size)}) as g").groupBy("g").count()
    top = groups.selectExpr("count(*)", "max(count)").first()
    assert top[0] == -(-30_000 // size) and top[1] < 2 * size
