"""SimHash, embedding near-duplicates and components against brute force."""
import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from streamfold.llm import catalog, embedding_dedup, simhash
from streamfold.llm.components import components

SF = "/root/testdata/sf0.001"


def table(df):
    return [r.asDict() for r in df.collect()]


def classes(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# -------------------------------------------------------------- components
@pytest.mark.parametrize("seed", [0, 1, 2])
def test_components_of_random_graphs(spark, seed):
    rng = np.random.default_rng(seed)
    edges = rng.integers(0, 60, (45, 2)).tolist() + [[100 + i, 101 + i] for i in range(30)] \
        + [[200, 200 + i] for i in range(1, 40)] + [[5, 5], [7, None]]
    got = {r["node"]: r["component"] for r in table(components(spark.createDataFrame(edges, "a long, b long")))}
    real = [(a, b) for a, b in edges if b is not None and a != b]
    expected = classes({x for e in real for x in e}, real)
    assert got == expected


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_join_with_a_hub_is_split(spark):
    """A hub with half of all edges: the join to the minima is dealt anew."""
    from streamfold.llm.components import _lowest, _to_lowest
    from streamfold.llm.common import scratch
    limits = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
              "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        edges = spark.range(40_000).selectExpr("if(id % 2 = 0, 0, id) as x", "id + 1000000 as y").repartition(8)
        edges = scratch(edges, "edges")
        joined = _to_lowest(edges, _lowest(edges))
        assert joined.count() == 40_000
        joined.write.format("noop").mode("overwrite").save()
        q = joined.selectExpr("x", "least(y, m) as y")
        q.collect()
        assert "skew=true" in q._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# ----------------------------------------------------------------- SimHash
def slow_fingerprint(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_simhash(rows):
    fps = [slow_fingerprint(r["text"]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    part = classes(range(len(rows)), links)
    least = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            least[part[i]] = min(least.get(part[i], r["doc_id"]), r["doc_id"])
    return sorted((repr(r["doc_id"]), format(fps[i], "016x"), least.get(part[i])) for i, r in enumerate(rows))


@pytest.mark.parametrize("name", ["odd", "docs", "empty"])
def test_simhash_is_brute_force(request, name):
    df = request.getfixturevalue(name)
    got = table(simhash.near_duplicates(df).select("doc_id", simhash.hex_digits().alias("f"), "component_id"))
    expected = slow_simhash(table(df.select("doc_id", "text")))
    assert sorted((repr(r["doc_id"]), r["f"], r["component_id"]) for r in got) == expected


def test_simhash_query(spark, docs):
    rows = table(catalog.op7_simhash(spark, SF))
    assert sorted((repr(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in rows) == slow_simhash(table(docs))


def near_words(rng, n):
    base = rng.integers(0, 2 ** 63, n // 4, dtype=np.uint64)
    out = [base, rng.integers(0, 2 ** 63, n // 4, dtype=np.uint64) | np.uint64(1 << 63)]
    for flips in (1, 2, 3, 4):
        m = base[:n // 8].copy()
        for _ in range(flips):
            m ^= np.uint64(1) << rng.integers(0, 64, len(m), dtype=np.uint64)
        out.append(m)
    return np.unique(np.concatenate([*out, np.array([0, 2 ** 64 - 1, 7, 15], dtype=np.uint64)]))


def star_classes(words, pairs):
    return classes([int(w) for w in words], [(int(a), int(b)) for a, b in pairs])


def all_links(words):
    return [(int(words[i]), int(words[j])) for i in range(len(words))
            for j in np.flatnonzero(np.bitwise_count(words ^ words[i]) <= 3) if j < i]


def test_tile_links_are_all_links():
    words = near_words(np.random.default_rng(3), 1200)
    expected = star_classes(words, all_links(words))
    assert star_classes(words, zip(*simhash.links_between(words, None))) == expected
    a, b = words[::2], words[1::2]
    pairs = [*zip(*simhash.links_between(a, None)), *zip(*simhash.links_between(b, None)),
             *zip(*simhash.links_between(a, b))]
    assert star_classes(words, pairs) == expected


@pytest.mark.parametrize("block", [8, 8192])
def test_links_over_blocks_and_cells(spark, block):
    words = near_words(np.random.default_rng(4), 600)
    df = spark.createDataFrame([(int(w),) for w in words.view(np.int64)], "fp long")
    got = [(r["a"] % 2 ** 64, r["b"] % 2 ** 64) for r in simhash.links(df, block=block).collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in got)
    assert star_classes(words, got) == star_classes(words, all_links(words))


# -------------------------------------------------------------- embeddings
def slow_embeddings(rows, limit=0.98):
    ok = []
    for r in rows:
        v = r["embedding"]
        good = r["label"] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ok.append(np.array(v, dtype=np.float64) / np.abs(v).max() if good else None)
    links = []
    for i, a in enumerate(ok):
        for j in range(i):
            b = ok[j]
            if a is not None and b is not None and rows[i]["label"] == rows[j]["label"] and len(a) == len(b) \
                    and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= limit:
                links.append((i, j))
    part = classes(range(len(rows)), links)
    count = np.bincount(np.array([x for e in links for x in e], dtype=int), minlength=len(rows))
    return count, {i: rows[part[i]]["vec_id"] for i in range(len(rows))}


VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                    T.StructField("label", T.IntegerType()), T.StructField("class", T.StringType()),
                    T.StructField("codes", T.StringType())])


def odd_vectors():
    rng = np.random.default_rng(5)
    base = rng.standard_normal((6, 16))
    near = [b + 0.02 * rng.standard_normal(16) for b in base for _ in range(30)]
    vs = [*base, *near, *(2 * base), *(base * 1e-30), *[base[0]] * 25]
    rows = [(i, [float(x) for x in np.float32(v)], i % 2) for i, v in enumerate(vs)]
    n = len(rows)
    v = rows[0][1]
    nan, inf = float("nan"), float("inf")
    rows += [(n, v, None), (n + 1, None, 0), (n + 2, [], 0), (n + 3, [0.0] * 16, 0), (n + 4, [nan] + v[1:], 0),
             (n + 5, [inf] + v[1:], 0), (n + 6, [None] + v[1:], 0), (n + 7, v[:8], 0), (n + 8, v[:8], 0),
             (n + 9, [-0.0] + v[1:], 0), (n + 10, [0.0] + v[1:], 0)]
    return [(*r, "x", "y") for r in rows]


@pytest.mark.parametrize("block", [4, 512])
def test_embeddings_of_odd_rows(spark, block):
    df = spark.createDataFrame(odd_vectors(), VEC).repartition(3)
    got = {r["vec_id"]: r for r in table(embedding_dedup.near_duplicates(df, block=block))}
    rows = sorted(table(df), key=lambda r: r["vec_id"])
    count, component = slow_embeddings(rows)
    for i, r in enumerate(rows):
        g = got.pop(r["vec_id"])
        assert (g["n_links"], g["component_id"]) == (count[i], component[i]), r["vec_id"]
        assert g["kept"] == (g["vec_id"] == g["component_id"])
    assert not got


def test_repeated_null_and_empty_vectors(spark):
    v = [1.0, 2.0]
    df = spark.createDataFrame([(1, v, 0, "", ""), (1, v, 0, "", ""), (None, v, 0, "", ""), (None, None, None, "", "")], VEC)
    got = sorted(repr((r["vec_id"], r["n_links"], r["component_id"])) for r in table(embedding_dedup.near_duplicates(df)))
    assert got == sorted(map(repr, [(1, 2, 1), (1, 2, 1), (None, 2, 1), (None, 0, None)]))
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VEC)).count() == 0


def test_chance_meetings_stay_few_and_pairs_at_the_limit_meet():
    """Random vectors of one label meet less than once each, at sixteen times
    the size about twice as often; pairs just over the limit share a code."""
    rng = np.random.default_rng(3)
    met = []
    for n in (4_000, 64_000):
        bits = embedding_dedup.bits_for(n)
        tables = embedding_dedup.tables_for(bits, 0.98)
        x = rng.standard_normal((n, 64))
        x /= np.abs(x).max(axis=1, keepdims=True)
        codes = embedding_dedup.codes_of(x, tables, bits, 1)
        pairs = sum(int((c * (c - 1) // 2).sum()) for t in codes.T for c in [np.unique(t, return_counts=True)[1]])
        met.append(pairs / n)
        a = x[:3000] / np.linalg.norm(x[:3000], axis=1, keepdims=True)
        side = rng.standard_normal(a.shape)
        side -= (side * a).sum(axis=1, keepdims=True) * a
        b = 0.9801 * a + np.sqrt(1 - 0.9801 ** 2) * side / np.linalg.norm(side, axis=1, keepdims=True)
        share = (embedding_dedup.codes_of(a, tables, bits, 1) == embedding_dedup.codes_of(b, tables, bits, 1)).any(axis=1)
        assert share.mean() > 0.998
    assert max(met) < 1 and met[1] < 2.5 * met[0]


def test_codes_do_not_depend_on_the_batch():
    x = np.float32(np.random.default_rng(2).uniform(-2, 2, (300, 77))).astype(np.float64)
    whole = embedding_dedup.codes_of(x, 20, 17, 5)
    assert (whole == np.vstack([embedding_dedup.codes_of(x[i:i + 1], 20, 17, 5) for i in range(300)])).all()
    assert (whole[::-1] == embedding_dedup.codes_of(x[::-1], 20, 17, 5)).all()


def test_embedding_query_recall(spark):
    rows = sorted(table(spark.read.parquet(f"{SF}/embeddings.parquet")), key=lambda r: r["vec_id"])
    got = {r["vec_id"]: r for r in table(catalog.op4_embedding_dedup(spark, SF))}
    count, component = slow_embeddings(rows)
    mine = np.array([got[r["vec_id"]]["n_links"] for r in rows])
    assert (mine <= count).all() and mine.sum() >= 0.99 * count.sum()
    assert sum(got[r["vec_id"]]["component_id"] == component[i] for i, r in enumerate(rows)) >= 0.99 * len(rows)
