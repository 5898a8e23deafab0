"""URL filters, embedding whitening and collocations against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import EDGES, SF, documents
from ordermill.llm import collocations, lm, queries, url_filter, whitening
from ordermill.llm.common import importable

# --- URL filters

URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?y#z", "http://net", "http://net/", "x://a.net?b/c", "http://anet/", "http://.net/",
        "http://a.net./", "http://example.com/de/", "http://Example.COM/DE/", "http://www.example.com/de", "http://www.example.com/de/1",
        "http://a.org/fr/x", "http://cheap-pills.org/", "http://cheap-pills.org/fr/", "http://u@a.net:80/", "a://b://c.net/", "http://exämple.net/en/",
        "http://ÄBC.org/fr/", "http://x/\npills\n/", "http://spam\nx/y", "http://" + "a." * 30_000 + "net/" + "p" * 30_000,
        "http://" + "b" * 60_000 + "/de/", "http://adult.net/", "http://x.y.z.example.net/en/"]


def brute_verdict(url, rules, words):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [(h, p, v) for (h, p), v in rules.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, key=lambda r: (len((r[0] + r[1]).encode()), len(r[0].encode())), default=None)
    word = None if best else next((w for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", host) if w in words), None)
    return host, path, best and best[0] + best[1], best[2] if best else "block" if word else "allow", word


def judged(spark, urls, rules, words, **build):
    bits = {k: v for k, v in build.items() if k == "digest_bits"}
    index = url_filter.build(spark.createDataFrame(rules, "host string, path string, verdict string"),
                             spark.createDataFrame([(w,) for w in words], "word string"), **build)
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumns(
        {c: F.lit("clash") for c in ("host", "path", "rule", "verdict", "word", "key", "says")})
    return {r.page_id: (r.host, r.path, r.rule, r.verdict, r.word) for r in url_filter.judge(rows, index, **bits).collect()}


def test_url_filter_contract_on_odd_urls(spark):
    importable(spark)
    rules = {(h, p): v for h, p, v in queries.URL_RULES}
    got = judged(spark, URLS, list(queries.URL_RULES), queries.URL_WORDS)
    assert got == {i: brute_verdict(u, rules, set(queries.URL_WORDS)) for i, u in enumerate(URLS)}
    assert got[6][2:4] == ("net/", "block") and got[5][2] is None and got[4][2:4] == ("example.net/en/", "allow")


@pytest.mark.parametrize("entries,bits", [(1 << 18, 64), (7, 64), (1000, 2), (40, 5)])
def test_url_filter_equals_brute_force(spark, entries, bits):
    """Also with several ranges of digests, and with digests that collide."""
    importable(spark)
    r = random.Random(entries + bits)
    labels = ["a", "b", "cc", "net", "org", "spam", "pills-x"]
    host = lambda n: ".".join(r.choice(labels) for _ in range(r.randrange(n)))
    path = lambda: r.choice(["", "/"]) + "/".join(r.choice(["en", "fr", "e", "x"]) for _ in range(r.randrange(3)))
    listed = [(host(4), path(), r.choice(["allow", "block"])) for _ in range(120)]
    rules = {}
    for h, p, v in listed:  # block wins where both are listed
        rules[h, p] = max(v, rules.get((h, p), ""))
    urls = [f"http://{host(6)}{path()}{r.choice(['', '?q=/en', '#/x'])}" for _ in range(400)] * 2
    got = judged(spark, urls, listed, ["spam", "pills"], range_entries=entries, digest_bits=bits)
    assert got == {i: brute_verdict(u, rules, {"spam", "pills"}) for i, u in enumerate(urls)}


def test_url_filter_lists(spark):
    importable(spark)
    rules = [(None, None, "block"), ("A.net", None, "allow"), ("a.net", "", "allow")]
    assert judged(spark, ["x", "http://b.a.net/q", "http://c.net"], rules, []) == {
        0: ("", "", "", "block", None), 1: ("b.a.net", "/q", "a.net", "allow", None), 2: ("c.net", "", None, "allow", None)}
    assert judged(spark, ["http://a.net/"], [], []) == {0: ("a.net", "/", None, "allow", None)}
    assert judged(spark, [], rules, ["w"]) == {}
    for bad, words in (([("a", "/", "maybe")], []), ([("a", "/", None)], []), ([], [None])):
        with pytest.raises(Exception, match="verdict is allow or block|a word is null"):
            judged(spark, ["http://a.net/"], bad, words)


# --- embedding whitening


def brute_whitening(vectors, k=16):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    c = fit - sums / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(k, int((e > 1e-10 * e[0]).sum())) if n > 1 else 0
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, deviation, (x - sums / n) @ q[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def whitened(spark, rows, kind="float", **kw):
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").withColumns({c: F.lit(1) for c in ("x", "n", "at", "cell", "label")})
    return whitening.whiten(df, **kw)


def compare(got, ids, vectors, k=16, tol=1e-7):
    n, deviation, want, explained = brute_whitening(vectors, k)
    rows = defaultdict(list)
    for r in got:
        rows[r.component].append(r)
    assert sorted(rows) == list(range(1, want.shape[1] + 1))
    for c, part in rows.items():
        by = sorted((r.vec_id, r.deviation, abs(r.whitened)) for r in part)
        assert [x[:2] for x in by] == sorted(zip(ids, deviation))
        assert np.allclose(sorted(abs(r.whitened) for r in part), np.sort(np.abs(want[:, c - 1])), atol=tol)
        sign = [(r.vec_id, r.whitened) for r in part]
        ref = dict(zip(ids, want[:, c - 1]))
        flip = np.sign(sum(w * ref[i] for i, w in sign))
        assert all(abs(w * flip - ref[i]) < tol for i, w in sign if ids.count(i) == 1)
        assert {r.n for r in part} == {n} and max(r.identity_error for r in part) <= 1e-4
        assert abs(part[0].explained / explained[c - 1] - 1) < 1e-8


@pytest.mark.parametrize("d,n", [(5, 40), (64, 300), (96, 400)])
def test_whitening_equals_eigenvectors(spark, d, n):
    importable(spark)
    rng = np.random.default_rng(d)
    base = rng.standard_normal((n, d)).astype(np.float32) * np.linspace(3, 0.3, d).astype(np.float32)
    vectors = [[float(c) for c in v] for v in np.concatenate([base, base[:20], base[:1].repeat(30, axis=0)])]
    ids = list(range(len(vectors)))
    compare(whitened(spark, list(zip(ids, vectors))).collect(), ids, vectors)


def test_whitening_of_a_flat_spectrum_takes_the_filter(spark):
    importable(spark)
    rng = np.random.default_rng(3)
    vectors = [[float(c) for c in v] for v in rng.standard_normal((600, 80))]
    points = whitening.grid(spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>"))
    model = whitening.fit(points)
    assert model.passes > 20 and model.residual < 1e-11 and model.identity_error < 1e-10
    assert np.allclose(model.vectors.T @ model.vectors, np.eye(16), atol=1e-12)
    _, _, _, explained = brute_whitening(vectors)
    assert np.allclose(model.explained, explained, rtol=1e-10)


def test_whitening_rows_that_do_not_count(spark):
    importable(spark)
    rng = np.random.default_rng(5)
    good = [[float(c) for c in v] for v in rng.standard_normal((30, 4))]
    ids = list(range(28)) + [None, 7]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [float("nan"), 1.0, 1.0, 1.0]), (104, [1.0, float("inf"), 0.0, 0.0]),
           (105, [1.0, 2.0]), (106, [1e300, 0.0, 0.0, 0.0]), (107, [1.0, 2.0, 3.0, 4.0, 5.0])]
    got = whitened(spark, list(zip(ids, good)) + odd, "double").collect()
    assert {r.vec_id for r in got} == set(ids) and len(got) == 30 * 4
    _, deviation, _, _ = brute_whitening(good)
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(deviation)
    assert whitened(spark, odd[:1]).collect() == [] and whitened(spark, []).collect() == []
    assert whitened(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]).collect() == []  # one distinct vector has no variance
    flat = whitened(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(9)]).collect()  # one direction only
    assert {r.component for r in flat} == {1} and abs(flat[0].explained - 1) < 1e-12


def test_whitening_is_exact_for_large_numbers(spark):
    importable(spark)
    vectors = [[float(1 << 40), -3.0], [float((1 << 40) + 1), 5.5], [2.0, 1.0]]
    got = whitened(spark, list(enumerate(vectors)), "double").collect()
    _, deviation, _, _ = brute_whitening(vectors)
    assert {r.vec_id: r.deviation for r in got} == {i: (v if v < 1 << 63 else None) for i, v in enumerate(deviation)}
    near = [[1e9 + i, 2.0 * (i % 3)] for i in range(20)]
    got = whitened(spark, list(enumerate(near)), "double").collect()
    assert {r.vec_id: r.deviation for r in got} == dict(enumerate(brute_whitening(near)[1]))


def test_whitening_on_a_table(spark):
    got = queries.op12_whitening(spark, SF).collect()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    compare(got, [r.vec_id for r in rows], [r.embedding for r in rows])


# --- collocations


def brute_phrases(rows, min_count, longest, keep=2000, covered=50):
    """rows: (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang in f:
        cand = {p: a for p, a in f[lang].items() if len(p) > 1 and a >= min_count}
        gone = set()
        for p, a in cand.items():
            for m in range(2, len(p)):
                gone |= {s for i in range(len(p) - m + 1) if 100 * a >= covered * cand[s := p[i:i + m]]}
        rows_ = []
        for p, a in cand.items():
            if p not in gone:
                cuts = [(1_000_000 * a * a // (f[lang][p[:k]] * f[lang][p[k:]]), k, f[lang][p[:k]], f[lang][p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                rows_.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (score, a, p, left, right) in enumerate(sorted(rows_)[:keep], start=1):
            out.append((lang, i, p.decode(), -a, left, right, n[lang], -score))
    return Counter(out)


def mined(spark, rows, **kw):
    df = documents(spark, [(i, t, lang) for i, (lang, t) in enumerate(rows)]).withColumns({c: F.lit(1) for c in ("shard", "f", "names", "rank", "phrase")})
    return Counter(tuple(r) for r in collocations.phrases(df, **kw).collect())


def mixed_texts(seed, n=300):
    r = random.Random(seed)
    vocabulary = ["New", "york", "is", "a", "the", "é", "İ", "\x00", "x-1", "ß", "york.", "city,", "one", "two"]
    rows = []
    for _ in range(n):
        words = r.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=r.randrange(0, 40))
        rows.append((r.choice(["en", "en", "de", None, "und", "a\nb"]), "".join(w + r.choice([" ", " ", " ", "\t", "  ", " ", "\n", "\u2028", "; "]) for w in words)))
    return rows + [("en", None), (None, None), ("de", ""), ("de", " ,; "), ("fr", "once")] + [("en", "the same text again and again")] * 25


@pytest.mark.parametrize("shards,longest,part,block,least", [(3, 3, 1 << 20, 1 << 20, 10), (1, 3, 200, 50, 5), (2, 2, 500, 1 << 20, 3), (5, 4, 300, 100, 3)])
def test_collocations_equal_brute_force(spark, shards, longest, part, block, least):
    importable(spark)
    rows = mixed_texts(shards)
    got = mined(spark, rows, min_count=least, longest=longest, shards=shards, part_bytes=part, block_bytes=block, buckets=3)
    want = brute_phrases(rows, least, longest)
    assert got == want and sum(want.values()) > 20


def test_collocations_of_little(spark):
    importable(spark)
    assert not mined(spark, []) and not mined(spark, [(None, None), ("en", "a b c")])
    assert mined(spark, [("en", "a b")] * 10) == Counter({("en", 1, "a b", 10, 10, 10, 20, 1_000_000): 1})
    rows = [("en", "w " * 60_000)]  # overlaps count; one long piece, more tokens than a block
    assert mined(spark, rows, block_bytes=1000) == brute_phrases(rows, 10, 3)
    assert mined(spark, mixed_texts(8), keep=4, buckets=2) == brute_phrases(mixed_texts(8), 10, 3, keep=4)


def test_collocations_keep_words_apart_whose_digests_collide(tmp_path, monkeypatch):
    monkeypatch.setattr(collocations, "_digests", lambda lang, words: np.array([len(w) for w in words], np.uint64))
    words = [b"aa", b"bb", b"cc", b"d"]
    rows = [(lang, collocations._join(words), collocations._dense(np.array([3, 9, 12, 10]))) for lang in ("de", "en")]
    assert collocations._merge_words(str(tmp_path), 1, 0, -1, 10, 0, rows) == 4
    assert collocations._merge_words(str(tmp_path), 1, 1, 0, 10, 0, [("en", collocations._join([b"bb"]), collocations._dense(np.array([1])))]) == 1
    names = collocations.Names(str(tmp_path), 1, {1: 1})
    known = {lang: names.words(lang, words, collocations._digests(lang, words)) for lang in ("de", "en", "fr")}
    assert known["de"][0].tolist()[:2] == [-1, -1] and known["en"][0].tolist()[0] == -1 and set(known["fr"][0].tolist()) == {-1}
    given = [n for name, _ in known.values() for n in name.tolist() if n >= 0]
    assert sorted(given) == list(range(5)) and known["en"][1].tolist()[1:] == [1, 0, 0]
    assert {(lang, tuple(w), tuple(n.tolist())) for lang, w, n in collocations._languages(str(tmp_path), "1-0-1")} == {
        ("de", tuple(words), (3, 9, 12, 10)), ("en", tuple(words), (3, 10, 12, 10))}
    with pytest.raises(OverflowError):
        collocations._named(0, 1 << 20, 1 << 9, 1 << 9, collocations.WORD_BITS)


def test_collocations_read_no_file_of_the_scan_itself(spark):
    """A part's task that runs again gives the same files."""
    importable(spark)
    folder = lm.shared_folder(spark, "again")
    keys = np.array([5, 7, 9], np.uint64)
    rows = [(None, lm.squeeze(keys), collocations._dense(np.array([4, 12, 10])))]
    for _ in range(2):
        assert collocations._merge_phrases(folder, 3, 4, -1, 10, 2, 1, rows) == 2
    more = [(None, lm.squeeze(keys[:1]), collocations._dense(np.array([6])))]
    for _ in range(2):
        assert collocations._merge_phrases(folder, 3, 5, 4, 10, 2, 1, more) == 1
    assert lm.load(folder, "2-1-5-key").tolist() == [5, 7, 9] and lm.load(folder, "2-1-5-n").tolist() == [10, 12, 10]
    assert lm.load(folder, "2-1-5-name").tolist() == [7, 1, 4] and lm.load(folder, "2-1-5-when").tolist() == [5, 4, 4]


def test_collocations_of_edge_rows(spark):
    importable(spark)
    rows = [(r[2] if len(r) > 2 else "en", r[1]) for r in EDGES] * 4
    assert mined(spark, rows) == brute_phrases(rows, 10, 3)


def test_pieces_and_words():
    every = bytes(range(128)) * 2
    words = [w[i] for w, seq in collocations.tokens(every, 40) for i in seq.tolist() if i >= 0]
    assert b"".join(words) == bytes(b + 32 if 65 <= b <= 90 else b for b in every if b not in b".,;:!?\n\v\f\r \t")
    (words, seq), = collocations.tokens(b" .A b;; a\tB\n\n")
    assert words == [b"a", b"b"] and seq.tolist() == [0, 1, -1, 0, 1]
    assert list(collocations.tokens(b"")) == list(collocations.tokens(b" ..\n")) == []
