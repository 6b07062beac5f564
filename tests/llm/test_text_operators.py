"""Token counts, byte BPE, secret spans, language ID and exact dedup against
plain per-row versions."""
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from streamfold.llm import byte_bpe, catalog, exact_dedup, language_id, secret_scan, token_count
from streamfold.llm.common import tokenizer_path

SF = "/root/testdata/sf0.001"


def table(df):
    return [r.asDict() for r in df.collect()]


def same(df, key, expected):
    got = sorted((repr(r[key]), repr(sorted(r.items()))) for r in table(df))
    assert got == sorted((repr(r[key]), repr(sorted(r.items()))) for r in expected)


def sha(b):
    return hashlib.sha256(b).hexdigest()


@pytest.fixture(scope="module", params=["odd", "docs", "empty"])
def given(request):
    return request.getfixturevalue(request.param)


# ------------------------------------------------------------ token counts
@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


def test_counts_are_the_librarys(given, library):
    expected = [{"doc_id": r["doc_id"], "n_bytes": len((r["text"] or "").encode()),
                 "n_tokens": len(library.encode(r["text"] or "", add_special_tokens=False).ids)}
                for r in table(given.select("doc_id", "text"))]
    same(token_count.count_tokens(given), "doc_id", expected)


def test_pattern_is_proved_for_every_code_point(library):
    """Each code point that the pattern takes: alone, between letters, after
    an apostrophe and beside digits and marks, it splits as the library."""
    tok = token_count.load(tokenizer_path("word_bpe_49k.json"))
    for c in map(chr, range(0x180)):
        for text in (c, f"a{c}b", f"1{c}2", f"'{c}s", f"a {c} b", f"!{c}!", c * 3):
            mine = tok.pretokens(text)
            if mine is None:
                assert c == "İ" or "\x1c" <= c <= "\x1f"
                continue
            norm = library.normalizer.normalize_str(text)
            theirs = [norm[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(norm)]
            assert mine == theirs, (text, mine, theirs)


def test_arrow_divides_every_proved_code_point_as_python():
    import pyarrow as pa

    tok = token_count.load(tokenizer_path("word_bpe_49k.json"))
    mem = token_count.Memory(tok, {})
    every = list(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    odd = mem._unproved(pa.array(every))
    assert odd.tolist() == [bool(token_count.UNPROVED.search(c)) for c in every]
    texts = [t for c, o in zip(every, odd) if not o for t in (c, f"A{c}B", f" {c} {c}", f"{c}\n")]
    mem.numbered(pa.array(texts))
    assert {p for p in mem.numbers if p} == {p for t in texts for p in t.lower().split()}


def test_counts_and_ids_of_mixed_texts(library):
    import pyarrow as pa

    tok = token_count.load(tokenizer_path("word_bpe_49k.json"))
    mem = token_count.Memory(tok, tok.whole_tokens())
    texts = ["", "  a b\t", "日本 x", "plain words, again", "<|endoftext|> z", "İa", "\x1cq r", "ŉ ſ", "   ", "plain"]
    for part in (texts, texts[2:3], texts[:1], []):
        ids, size = mem.encode(pa.array(part, pa.string()))
        expected = [library.encode(t, add_special_tokens=False).ids for t in part]
        assert ids.tolist() == [i for e in expected for i in e]
        assert size.tolist() == list(map(len, expected)) == mem.counts(pa.array(part, pa.string())).tolist()


def test_parts_with_other_characters_are_parts(library):
    """Curly quotes, dashes, euro signs, other scripts, combining marks and
    odd white space beside Latin words: ids as of the whole text, and only the
    parts that hold such a character go to the library."""
    import pyarrow as pa

    tok = token_count.load(tokenizer_path("word_bpe_49k.json"))
    mem = token_count.Memory(tok, tok.whole_tokens())
    rng = np.random.default_rng(4)
    pool = ["plain", "Words,", "don’t", "“quoted”", "a—b", "5€", "Größe", "ΣΑΣ", "Привет", "日本語", "한국어", "🙂", "e\u0301",
            "\u0301x", "İ", "x\u2003y", "\u2028", "\u3000", "\xa0z", "q\x85r", "\x1cs", "ﬁ", "\u200b", "ſ", "K", "\u0345", "α\u0345"]
    seps = [" ", "  ", "\n", "\t ", "\r\n", "\x0b", "\xa0", "\u2003", ""]
    texts = ["".join(w + s for w, s in zip(rng.choice(pool, n), rng.choice(seps, n))) for n in rng.integers(1, 40, 1500)]
    sent, many = [], tok.encode_many
    tok.encode_many = lambda parts: (sent.extend(parts), many(parts))[1]
    try:
        ids, size = mem.encode(pa.array(texts))
        counts = mem.counts(pa.array(texts))
    finally:
        del tok.encode_many
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [i for e in expected for i in e]
    assert size.tolist() == list(map(len, expected)) == counts.tolist()
    assert sent and all(token_count.UNPROVED.search(p) and not set(p) & set(" \n\t\r\x0b") for p in sent)


def test_a_full_memory_goes_back_to_its_first_parts(library, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_count, "CACHE_PARTS", 40)
    monkeypatch.setattr(token_count, "KEEP_PARTS", 7)
    tok = token_count.load(tokenizer_path("word_bpe_49k.json"))
    mem = token_count.Memory(tok, tok.whole_tokens())
    for i in range(12):
        texts = [f"word{j} qzx{j * i}, again" for j in range(i, i + 15)]
        ids, _ = mem.encode(pa.array(texts))
        assert ids.tolist() == [k for t in texts for k in library.encode(t, add_special_tokens=False).ids]
        assert len(mem.numbers) == len(mem.first) - 1 <= 40 + 31


def test_text_outside_the_proved_range_goes_to_the_library():
    tok = token_count.load(tokenizer_path("word_bpe_49k.json"))
    for text in ("ƀ", "日本", "é", "İ", "Σ", "<|endoftext|>"):
        assert tok.pretokens(text) is None


def test_whole_tokens_are_single_tokens(library):
    whole = token_count.load(tokenizer_path("word_bpe_49k.json")).whole_tokens()
    assert len(whole) > 20_000
    assert all(library.encode(w, add_special_tokens=False).ids == [i] for w, i in list(whole.items())[::37])


# ---------------------------------------------------------------- byte BPE
@pytest.fixture(scope="module")
def tiktok():
    import base64

    import tiktoken
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_round_trip_is_tiktokens(given, tiktok):
    expected = []
    for r in table(given.select("doc_id", "text")):
        ids = tiktok.encode_ordinary(r["text"] or "")
        expected.append({"doc_id": r["doc_id"], "n_tokens": len(ids), "ids_sha256": sha(" ".join(map(str, ids)).encode()),
                         "decoded_sha256": sha((r["text"] or "").encode())})
    same(byte_bpe.round_trip_digests(given), "doc_id", expected)


def test_long_and_short_words_merge_alike(tiktok):
    """Random words around the limit, by both recursions against the library."""
    bpe = byte_bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdeinorstéß"), size=n)) for n in [2, 3, 9, 30, 60, 120, 150, 1000, 5000]] \
        + ["a" * 255, "a" * 256, "ab" * 200, "aab" * 80, "日本語の長い文章" * 60, "x" * 3001]
    long = [w.encode() for w in words if w.encode() not in bpe.ranks]
    expected = [tiktok.encode_ordinary(w.decode()) for w in long]
    assert bpe.orderly
    for orderly in (True, False):
        bpe.orderly = orderly
        few = [i for i, w in enumerate(long) if orderly or len(w) < 500]
        assert [x.tolist() for x in bpe.merge_words([long[i] for i in few], long=True)] == [expected[i] for i in few]
    bpe.orderly = True
    short = [i for i, w in enumerate(long) if len(w) <= byte_bpe.SHORT_BYTES]
    assert [x.tolist() for x in bpe.merge_words([long[i] for i in short])] == [expected[i] for i in short]
    assert [x.tolist() for x in bpe.encode(words)] == [tiktok.encode_ordinary(w) for w in words]


def test_encode_then_decode_frames(odd):
    both = byte_bpe.decode(byte_bpe.encode(odd))
    texts = sorted((repr(r["doc_id"]), (r["text"] or "").encode()) for r in table(odd))
    assert sorted((repr(r["doc_id"]), bytes(r["bytes"])) for r in table(both)) == texts


def test_latin_pattern_splits_alike():
    bpe = byte_bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert bpe.latin_split is not bpe.any_split
    for c in map(chr, range(byte_bpe.LATIN)):
        for text in (c, f"a{c}b", f"1{c}2", f"'{c}s", f"a {c} b", f"!{c}!", f" {c}", f"{c}  {c}\n ", c * 3):
            assert bpe.latin_split(text) == bpe.any_split(text), repr(text)


def test_forgetting_changes_nothing(monkeypatch, tiktok):
    monkeypatch.setattr(byte_bpe, "CACHE_WORDS", 3)
    bpe = byte_bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for text in ("größer als été and more of it", "more of größer", ""):
        assert [x.tolist() for x in bpe.encode([text, text])] == [tiktok.encode_ordinary(text)] * 2


def test_decode_in_slices(monkeypatch, tiktok):
    monkeypatch.setattr(byte_bpe, "CHUNK_TOKENS", 7)
    bpe = byte_bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = ["", "größer als étage", "", "x" * 50, "🙂🙂"]
    ids = [tiktok.encode_ordinary(t) for t in texts]
    flat = np.array([i for x in ids for i in x], dtype=np.int32)
    assert bpe.decode(flat, np.array([len(x) for x in ids])) == [t.encode() for t in texts]


def test_unknown_and_null_ids_raise(spark):
    for ids in ("array(50300)", "array(1, null)"):
        with pytest.raises(Exception, match="token id"):
            byte_bpe.decode(spark.sql(f"select 1 as doc_id, {ids} as ids")).collect()
    assert byte_bpe.decode(spark.sql("select 1 as doc_id, cast(null as array<int>) ids")).first()["bytes"] == b""


# ------------------------------------------------------------ secret spans
def base_spans(text):
    out = []
    for kind, pattern, need in (
            ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
            ("access", r"AKIA[A-Z0-9]+", 16), ("hex", r"[0-9a-f]+", 32)):
        for m in re.finditer(pattern, text, re.ASCII):
            if len(m[2] if kind == "assign" else m[0]) >= need:
                out.append((m.start(), ("assign", "access", "hex").index(kind), kind, m.end()))
    return sorted(out)


def test_base_spans(given):
    got = {}
    for r in table(secret_scan.digests(given)):
        got.setdefault(r["doc_id"], []).append(r)
    for r in table(given.select("doc_id", "text")):
        spans = base_spans(r["text"] or "")
        digest = sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans).encode())
        mine = [x for x in got[r["doc_id"]] if x["base_sha256"] == digest]
        assert mine and mine[0]["n_assign"] == sum(s[2] == "assign" for s in spans)
        assert mine[0]["n_hex"] == sum(s[2] == "hex" for s in spans)
        assert all(f"{k}:{a}:{b}" in mine[0]["spans"].split(",") for a, _, k, b in spans)
    assert sum(map(len, got.values())) == given.count()


def test_guess_cost_orders_passwords():
    ranks = secret_scan.word_ranks(tokenizer_path("word_bpe_49k.json"))
    cost = lambda v: secret_scan.guess_cost(v, ranks)[0]
    for weak in ("password", "P4ssword", "hunter2", "2024-01-01", "qwertyuiop", "aaaaaaaaaaaa", "abcabcabcabc", "12345678",
                 "lkjhgfdsa", "welcome2023"):
        assert cost(weak) < secret_scan.MIN_GUESSES_LOG10, (weak, cost(weak))
    for strong in ("x9$Lq!72vRz", "kQ82_vNw-3Xz9", "9f8e7d6c5b4a3f2e1d"):
        assert cost(strong) >= secret_scan.MIN_GUESSES_LOG10, (strong, cost(strong))


def test_guess_cost_is_the_least_over_all_segmentations():
    """Exhaustive search over all splits of short values into spans."""
    ranks = {"cat": 3, "dog": 10, "catalog": 50}

    def exhaustive(v):
        singles = {}
        for i in range(len(v)):
            for j in range(i + 1, len(v) + 1):
                cost, parts = secret_scan.guess_cost(v[i:j], ranks)
                if len(parts) == 1 and parts[0][0] != "brute":
                    singles[i, j] = cost
                elif j == i + 1:
                    singles[i, j] = secret_scan.BRUTE_LOG10
        best = math.inf

        def walk(i, cost, n, brute):
            nonlocal best
            if i == len(v):
                best = min(best, cost)
                return
            for j in range(i + 1, len(v) + 1):
                if (i, j) in singles:
                    is_brute = j == i + 1
                    more = not (is_brute and brute)
                    walk(j, cost + singles[i, j] + (math.log10(n + 1) if more else 0), n + more, is_brute)

        walk(0, 0.0, 0, False)
        return best

    for v in ("catdog", "xcat9", "aaacat", "dogqwe", "catalogs", "zz11"):
        assert secret_scan.guess_cost(v, ranks)[0] <= exhaustive(v) + 0.8
        parts = secret_scan.guess_cost(v, ranks)[1]
        assert parts[0][1] == 0 and parts[-1][2] == len(v)
        assert all(a[2] == b[1] for a, b in zip(parts, parts[1:]))


def test_redact_masks_values_and_keeps_clean_rows(odd):
    before = {(r["doc_id"], r["source"]): r for r in table(odd)}
    after = table(secret_scan.redact(odd))
    assert len(after) == odd.count() and secret_scan.redact(odd).columns == odd.columns
    for r in after:
        if r["doc_id"] is None or r["doc_id"] == 20:       # two different rows each
            continue
        old = before[r["doc_id"], r["source"]]
        if r["text"] == old["text"]:
            assert r["n_chars"] == old["n_chars"]
        else:
            assert r["n_chars"] == len(r["text"]) and not base_spans(r["text"])
    masked = [r["text"] for r in after if r["text"] and "[SECRET]" in r["text"]]
    assert masked and "AKIA" not in masked[0] and "x9$Lq!72vRz" not in masked[0]


def test_mask_joins_overlapping_values():
    assert secret_scan.mask("0123456789", [(0, 0, 4, 2), (3, 2, 6, 3), (8, 2, 10, 8)]) == "01[SECRET]67[SECRET]"


# ------------------------------------------------------------- language ID
def test_ngrams_by_hand():
    keys, counts = language_id.ngrams("Ab, ab1b")
    unpack = lambda k: "".join(chr(int(k) >> s & 0x1FFFFF) for s in (42, 21, 0)).strip("\x00")
    assert dict(zip(map(unpack, keys), counts.tolist())) == {
        "a": 2, "b": 3, " a": 2, "ab": 2, "b ": 3, " b": 1, " ab": 2, "ab ": 2, " b ": 1}


def test_ngrams_of_pieces_are_those_of_the_whole(monkeypatch):
    text = "größer als été! 12 naïve  words, and more " * 20
    whole = language_id.ngrams(text)
    for piece in (1, 7, 50, 64):
        monkeypatch.setattr(language_id, "PIECE", piece)
        for got, expected in zip(language_id.ngrams(text), whole):
            assert (got == expected).all(), piece


def test_out_of_place_distance_by_hand():
    model = language_id.Model.of({"x": [10, 20, 30], "y": [30, 40]}, 3)
    assert model.languages == ["x", "y"] and model.keys.tolist() == [10, 20, 30, 40]
    assert model.ranks[:4].tolist() == [[0, 3], [1, 3], [2, 0], [3, 1]]


def plain_grams(text):
    """n-grams of the words of a text, as the packed code points that order them."""
    from collections import Counter
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    out = Counter()
    for w in words:
        out.update(w)
    line = " " + " ".join(words) + " " if words else ""
    out.update(line[i:i + 2] for i in range(len(line) - 1))
    out.update(line[i:i + 3] for i in range(len(line) - 2) if line[i + 1] != " ")
    return out


def plain_profile(grams):
    def packed(g):
        n = 0
        for c in g:
            n = n << 21 | ord(c)
        return n
    return sorted(grams, key=lambda g: (-grams[g], packed(g)))[:language_id.PROFILE]


def plain_languages(train, texts):
    """Language and score of every text, n-gram by n-gram."""
    from collections import Counter
    total = {}
    for text, lang in train:
        total.setdefault(lang, Counter()).update(plain_grams(text))
    ranks = {lang: {g: i for i, g in enumerate(plain_profile(c))} for lang, c in total.items()}
    size, out = language_id.PROFILE, []
    for text in texts:
        mine = plain_profile(plain_grams(text or ""))
        if not mine:
            out.append(("und", 0.0))
            continue
        far = {lang: sum(min(abs(r[g] - i), size) if g in r else size for i, g in enumerate(mine)) for lang, r in ranks.items()}
        best = min(far, key=lambda lang: (far[lang], lang))
        out.append((best, 1 - far[best] / (size * len(mine))))
    return out


def test_every_prediction_equals_a_plain_computation(spark, docs, odd):
    rows = table(docs.select("doc_id", "text", "lang"))
    train = [(r["text"], r["lang"]) for r in rows if r["lang"] is not None and r["text"] is not None
             and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1]
    model = language_id.fit(docs)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in table(language_id.identify(docs, model))}
    expected = plain_languages(train, [r["text"] for r in rows])
    for r, (lang, score) in zip(rows, expected):
        assert got[r["doc_id"]][0] == lang and math.isclose(got[r["doc_id"]][1], score, abs_tol=1e-12), r["doc_id"]
    texts = [r["text"] for r in table(odd.select("text"))]
    mine = [model.predict(t) for t in texts]
    for a, b in zip(mine, plain_languages(train, texts)):
        assert a[0] == b[0] and math.isclose(a[1], b[1], abs_tol=1e-12)


def test_language_accuracy_and_contract(spark, docs):
    rows = table(catalog.op1_language_id(spark, SF))
    truth = {r["doc_id"]: r for r in table(docs)}
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 3 == 1}
    right = [r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in held if truth[r["doc_id"]]["lang"]]
    assert sum(right) >= 0.97 * len(right)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_prediction_uses_the_text_alone(spark, docs):
    model = language_id.fit(docs)
    moved = docs.select((F.col("doc_id") + 10_000).alias("doc_id"), "text", F.lit("zz").alias("lang"),
                        F.lit("q").alias("source"), "n_chars")
    a = {r["doc_id"]: r["lang_pred"] for r in table(language_id.identify(docs, model))}
    b = {r["doc_id"] - 10_000: r["lang_pred"] for r in table(language_id.identify(moved, model))}
    assert a == b


def test_language_of_odd_rows(odd, empty, docs):
    model = language_id.fit(docs)
    got = table(language_id.identify(odd, model))
    assert len(got) == odd.count()
    texts = {r["doc_id"]: r["text"] for r in table(odd)}
    for r in got:
        if r["doc_id"] is not None:
            letters = any(c.isalpha() for c in texts[r["doc_id"]] or "")
            assert (r["lang_pred"] == "und") == (not letters), r
    nothing = language_id.fit(empty)
    assert {r["lang_pred"] for r in table(language_id.identify(odd, nothing))} == {"und"}
    assert language_id.identify(empty, model).count() == 0
    assert language_id.with_language(odd, model).columns == odd.columns


def test_training_sample_is_bounded(docs):
    small = language_id.fit(docs, per_lang=5)
    assert small.languages == language_id.fit(docs).languages


# -------------------------------------------------------------- exact dedup
@pytest.mark.parametrize("collide", [False, True])
def test_exact_groups(given, collide):
    """Also with a hash that sends all texts of one length together."""
    rows = table(given.select("doc_id", "text"))
    groups = {}
    for r in rows:
        groups.setdefault(r["text"] or "", []).append(r["doc_id"])
    expected = []
    for r in rows:
        g = groups[r["text"] or ""]
        keep = max([x for x in g if x is not None], default=None)
        expected.append({"doc_id": r["doc_id"], "keep_id": keep, "group_size": len(g),
                         "kept": r["doc_id"] == keep, "text_sha256": sha((r["text"] or "").encode())})
    options = {"hash_fn": lambda t: F.length(t)} if collide else {}
    same(exact_dedup.mark(given, **options), "doc_id", expected)
    left = table(exact_dedup.survivors(given, **options))
    assert sorted((r["text"] or "", r["doc_id"]) for r in left) == sorted(
        (t, max([x for x in g if x is not None], default=None)) for t, g in groups.items())
    assert exact_dedup.survivors(given).columns == given.columns


def test_exact_dedup_plan_is_native(docs):
    plan = exact_dedup.mark(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_a_very_long_secret_is_found_and_masked_whole():
    ranks = secret_scan.word_ranks(tokenizer_path("word_bpe_49k.json"))
    value = "x9$Lq!72vRz&kW" * 3 + "".join(chr(33 + i * i * 7 % 90) for i in range(5000)).translate(
        str.maketrans("\"'`,;<>(){}[]", "abcdefghijklm"))
    text = f"the password is {value} and more"
    spans = secret_scan.scan(text, ranks)
    assert ("guess", value) in [(secret_scan.KINDS[k], text[a:b]) for a, k, b, _ in spans]
    assert secret_scan.mask(text, spans) == "the password is [SECRET] and more"


QUOTED = [('password = "@@"', "x9;Lq!72vRz(T"), ('{"password": "@@", "user": "bob"}', "Vb7#kQ2!x,9$Lw@4zR"),
          ("pwd='@@' # old", "k(Q8)2_v{N}w[3]\"X`z9<>"), ("the secret is `@@`.", "kQ82 vN'w-3;Xz9."),
          ('token: "@@" x', 'q7\\"L,w9#Zt4'), ('token="@@"', "q7L,w9;#Zt4R\\"),
          ("password =      @@ ok", "x9$Lq!72vRz"), ("password\t\t\t\t\t:\n\n\n\n  @@", "x9$Lq!72vRz")]


@pytest.mark.parametrize("form,value", QUOTED)
def test_quoted_and_aligned_values_are_found_whole(form, value):
    ranks = secret_scan.word_ranks(tokenizer_path("word_bpe_49k.json"))
    text = form.replace("@@", value)
    found = secret_scan.scan(text, ranks)
    assert ("guess", value) in [(secret_scan.KINDS[k], text[a:b]) for a, k, b, _ in found]
    assert secret_scan.mask(text, found) == form.replace("@@", "[SECRET]")


def test_quotes_without_an_end_and_weak_quoted_values():
    ranks = secret_scan.word_ranks(tokenizer_path("word_bpe_49k.json"))
    masked = lambda t: secret_scan.mask(t, secret_scan.scan(t, ranks))
    assert masked('password: "x9$Lq!72vRz\nnext "line"') == 'password: "[SECRET]\nnext "line"'
    for text in ('password: "" and "more"', 'password: "abc"', "pwd = 'hunter2'", "password:", 'token = "'):
        assert masked(text) == text


def test_quoted_values_in_the_query_and_in_redact(spark):
    d = spark.createDataFrame([(i, f.replace("@@", v)) for i, (f, v) in enumerate(QUOTED)], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in secret_scan.redact(d).collect()} == {
        i: f.replace("@@", "[SECRET]") for i, (f, _) in enumerate(QUOTED)}
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.digests(d).collect()}
    for i, (f, v) in enumerate(QUOTED):
        assert f"guess:{f.index('@@')}:{f.index('@@') + len(v)}" in spans[i].split(",")


def test_short_random_values_are_found_and_weak_ones_are_not(spark):
    ranks = secret_scan.word_ranks(tokenizer_path("word_bpe_49k.json"))
    strong = ("x9$Lq!7v", "P@7x!k2Q", "kQ8vNw3Xz", "w7#Rt9&Lp", "x9$L!q", "zq8xk3vj", "8365746295")
    weak = ("password", "P4ssword", "hunter2", "2024-01-01", "qwertyuiop", "aaaaaaaaaaaa", "abcabcabcabc", "12345678",
            "lkjhgfdsa", "welcome2023", "correcthorse", "x9$L", "8301946")
    for v in strong + weak:
        for form in ("pin: {} and", "pwd={}", 'passwd = "{}"'):
            text = form.format(v)
            guessed = [text[a:b] for a, k, b, _ in secret_scan.scan(text, ranks) if secret_scan.KINDS[k] == "guess"]
            assert guessed == ([v] if v in strong else []), text
    d = spark.createDataFrame([(i, f"pin: {v} and") for i, v in enumerate(strong)], "doc_id long, text string")
    assert {r["text"] for r in secret_scan.redact(d).collect()} == {"pin: [SECRET] and"}


def test_alphabet_of_a_value():
    for value, size in (("abc", 26), ("ABC", 26), ("12", 10), ("a1", 36), ("aB1", 62), ("aB1$", 94), ("$ ", 32), ("", 1)):
        assert secret_scan.alphabet_log10(value) == pytest.approx(np.log10(size))


def test_guess_cost_equals_the_exhaustive_search():
    """The least over all splits, each single part by its own definition."""
    ranks = {"cat": 3, "dog": 10, "catalog": 50, "log": 900, "gdo": 40_000, "ogc": 25_000, "ats": 7000, "aaa": 20}

    def exhaustive(v, brute):
        def parts(i, j):
            t, low = v[i:j], v[i:j].lower()
            leet = low.translate(secret_scan.LEET)
            for word, ways in ((low, 1), (leet, 4)):
                if len(t) >= 3 and word in ranks and (ways == 1 or low not in ranks):
                    upper = sum(c.isupper() for c in t)
                    case = 1 if not upper else 2 if t in (low.capitalize(), low.upper()) else 2 ** min(upper, 8)
                    yield math.log10(ranks[word] * case * ways + 1)
            if secret_scan.DATE.fullmatch(t):
                yield secret_scan.DATE_LOG10 if len(t) > 4 else math.log10(200)
            if len(t) >= 3 and any(low in r or low in r[::-1] for r in secret_scan.KEYBOARD):
                yield math.log10(94 * len(t))
            for size in range(1, len(t) // 2 + 1):
                copies = len(t) // size
                if t == t[:size] * copies and (size > 1 or copies > 2):
                    yield size * brute + math.log10(copies)

        best = {(0, 0, False): 0.0}
        for i in range(len(v)):
            for (at, n, last), cost in list(best.items()):
                if at != i:
                    continue
                steps = [(i + 1, n + (not last), True, brute + (0 if last else math.log10(n + 1)))]
                steps += [(j, n + 1, False, c + math.log10(n + 1)) for j in range(i + 1, len(v) + 1) for c in parts(i, j)]
                for j, m, is_brute, c in steps:
                    best[j, m, is_brute] = min(best.get((j, m, is_brute), math.inf), cost + c)
        return min(c for (at, _, _), c in best.items() if at == len(v))

    rng = np.random.default_rng(5)
    pieces = ["cat", "dog", "catalog", "log", "gdo", "ats", "aaa", "c4t", "D0g", "x", "9$", "aa", "2019", "20240101", "1/2",
              "qwe", "4321", "abab", "zzz", "12-12-19"]
    values = ["catcatcatalog", "xcat9dogq2catlog", "aaaaab", "20240101", "2019cat2020", "aaacat", "zz11", "xyxyxyxz", "a" * 40,
              "0101201919", *("".join(rng.choice(pieces, rng.integers(1, 9))) for _ in range(400))]
    for v in values:
        for brute in (secret_scan.BRUTE_LOG10, secret_scan.alphabet_log10(v)):
            least = exhaustive(v, brute)
            cost, parts = secret_scan.guess_cost(v, ranks, brute)
            assert abs(cost - least) < 1e-9, (v, cost, least, parts)
            assert [a[2] for a in parts] == [*[b[1] for b in parts[1:]], len(v)] and parts[0][1] == 0
            for limit in (5.0, 10.0):
                assert (secret_scan.guess_cost(v, ranks, brute, limit)[0] >= limit) == (cost >= limit)


def test_long_values_are_decided_soon():
    import time
    ranks = secret_scan.word_ranks(tokenizer_path("word_bpe_49k.json"))
    start = time.monotonic()
    for v in ("=" * 20_000, "x9$" + "=" * 20_000, "ab" * 10_000, "x9abc" * 4000, "aab" * 7000 + "q", "9f8e7d" * 3000):
        secret_scan.scan(f"password: {v} and", ranks)
    assert time.monotonic() - start < 60
