"""Language ID, toxicity, license scan, decontamination, LM, packing, HTML, pipeline."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from helpers import EDGES, SF, documents, words
from ordermill.llm import common, decontaminate, html_extract, language_id, license_scan, lm, packing, queries, simhash, toxicity
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(t):
    return "".join(c.lower() if c.isascii() else c for c in t or "")


def edge_docs(spark):
    return documents(spark, EDGES)


# --- language ID

def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op3_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out").toPandas()
    assert len(got) > 150 and (got.lang == got.lang_pred).mean() > 0.95
    assert got.score.between(0, 1).all() and not got.rejected.mean() > 0.02


def test_language_id_edges_and_rejection(spark):
    docs = edge_docs(spark)
    model = language_id.fit(docs.where("lang IS NOT NULL"))
    got = {(r.doc_id, r.lang_pred, r.rejected) for r in language_id.predict(docs, model).collect()}
    assert {(1, "und", True), (2, "und", True), (3, "und", True), (5, "und", True)} <= got
    assert language_id.predict(docs, model).count() == len(EDGES)
    known = language_id.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    far = documents(spark, [(1, "добрый вечер всем " * 30), (2, words(60, 4))])
    assert [r.rejected for r in language_id.predict(far, known).orderBy("doc_id").collect()] == [True, False]
    kept = language_id.accepted(far, known)
    assert kept.columns == far.columns and [r.doc_id for r in kept.collect()] == [2]


FOREIGN = [
    "Bugün hava çok güzel olduğu için arkadaşlarımla birlikte parka gitmeye karar verdik ve akşama kadar orada oturup konuştuk",
    "Tänään sää oli niin kaunis että päätimme lähteä ystävien kanssa puistoon ja istuimme siellä iltaan asti puhuen kaikesta",
    "Dzisiaj pogoda była tak piękna że postanowiliśmy pójść z przyjaciółmi do parku i rozmawialiśmy tam do wieczora",
    "Ma olyan szép idő volt hogy elhatároztuk hogy a barátainkkal elmegyünk a parkba és estig beszélgettünk ott",
    "Leo hali ya hewa ilikuwa nzuri sana hivyo tuliamua kwenda bustanini pamoja na marafiki zetu na tukazungumza hadi jioni",
    "qxv jzkw vqpf zzkj wqx kjvq pfx zqw jxkv qqz wvjk xpq zfk vjq"]
CLEAN = [
    "The weather was so nice today that we decided to go to the park with friends and talk until evening",
    "Heute war das Wetter so schön dass wir beschlossen haben mit Freunden in den Park zu gehen und bis zum Abend zu reden",
    "Il faisait si beau aujourd'hui que nous avons décidé d'aller au parc avec des amis et de parler jusqu'au soir",
    "Hoy hacía tan buen tiempo que decidimos ir al parque con amigos y hablar hasta la noche", "the report of the day", "nicht mit der Frau"]


def test_language_id_rejects_languages_that_are_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(language_id.learn_rows(docs))
    _, _, rejected = model.predict([t for f in FOREIGN for t in (f, (f + " ") * 10)])
    assert rejected.all()
    langs, _, rejected = model.predict(CLEAN)
    assert langs[:4] == ["en", "de", "fr", "es"] and not rejected.any()
    assert not any(model.predict([(t + " ") * 10 for t in CLEAN])[2])
    assert language_id.predict(docs, model).where("rejected").count() <= 2


def test_language_id_letters_are_of_category_l():
    assert not any(map(language_id.has_letter, ("½", "²", "Ⅷ 12", "1_2", "", "\u0301 ①")))
    assert all(map(language_id.has_letter, ("x", "5 é", "ª", "语", "ʰ")))


def test_language_id_sample_is_bounded_whatever_the_languages(spark):
    assert language_id.shares([("a", 1000), ("b", 3), ("c", 900)], 100) == [("b", 3), ("c", 48), ("a", 49)]
    assert language_id.shares([], 5) == []
    rows = [(i, words(8, i), f"l{i % 300}") for i in range(600)] + [(1000 + i, words(8, i), "en") for i in range(300)]
    model = language_id.fit(documents(spark, rows), sample_rows=20)
    assert len(set(model.langs)) == 20 and "en" in model.langs and len(model.langs) <= 20
    few = language_id.fit(documents(spark, rows[:3] + rows[600:]), sample_rows=50)
    assert set(few.langs) == {"l0", "l1", "l2", "en"}


def test_smallest_hashes_equal_a_plain_ranking(spark):
    rows = [(None if i == 5 else i % 3000, "ab"[i % 7 == 0]) for i in range(5000)] + [(1, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, kind string")
    quotas = spark.createDataFrame([("a", 40), ("b", 700), ("none", 3)], "kind string, quota bigint")
    got = {tuple(r) for r in common.smallest_hashes(df, "kind", quotas, steps=4).collect()}
    ranked = df.distinct().select("doc_id", "kind", F.xxhash64("doc_id").alias("h")).collect()
    want = set()
    for kind, n in (("a", 40), ("b", 700)):
        want |= {(r.doc_id, kind) for r in sorted((r for r in ranked if r.kind == kind), key=lambda r: r.h)[:n]}
    assert got == want


def test_language_id_counts_long_texts_in_steps(monkeypatch):
    text = words(3000, 5)
    whole = language_id.counts(text)
    monkeypatch.setattr(language_id, "_STEP", 1000)
    assert (language_id.counts(text) == whole).all()


def test_language_id_without_training_rows(spark):
    model = language_id.fit(edge_docs(spark).limit(0))
    got = language_id.predict(edge_docs(spark), model).collect()
    assert {r.lang_pred for r in got} == {"und"} and {r.doc_id for r in got if r.rejected} >= {1, 2, 3, 5}
    assert not next(r for r in got if r.doc_id == 6).rejected


# --- toxicity

def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op9_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert len(got) > 400 and (got.toxic == got.predicted).mean() > 0.95


def test_toxicity_grammar():
    model = toxicity.Model({"idiot": (toxicity.INSULT, 2.0), "kill": (toxicity.THREAT, 2.0), "you": (toxicity.TARGET, 0.0),
                            "not": (toxicity.NEGATION, 0.0), "said": (toxicity.REPORT, 0.0)}, {"lowei": 3.0})
    score = lambda t: sum(model.clauses(t, {}))
    assert score("an idiot") == 2.0 and score("you are an idiot") == 3.0
    assert score("you are not an idiot") == pytest.approx(0.9)
    assert score("he said you idiot") == 1.5 and score("he said. you idiot") == 3.0
    assert score("kill time") == 0.8 and score("you i kill") == 3.0
    assert score("Loweixyz") == 3.0 and score("nothing here") == 0 and model.clauses("", {}) == []
    assert model.clauses("idiot. idiot", {}) == [2.0, 2.0]


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(6, 1, 0), (7, 1, 1), (None, 1, 1), (11, 1, None), (7, 1, 1)], "doc_id bigint, quality int, toxic int")
    for marks in (labels, labels.limit(0)):
        got = toxicity.score(edge_docs(spark), toxicity.fit(edge_docs(spark), marks)).collect()
        assert len(got) == len(EDGES) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


# --- license scan

def test_license_base_equals_brute_force(spark):
    rows = [(r[0], r[1]) for r in EDGES if r[0] is not None] + [
        (20, "Released under the MIT License."), (21, "the mit license, MIT license; Apache\nLicense General Public License general public license"),
        (22, "mit xlicense mit licenses"), (23, "This program is free software: you can redistribute it and maybe modify it under the terms of it"),
        (24, "Licensed under the Apache License, Version 2.0"), (25, words(20, 3) + " licensed under cc by nc 4.0 " + words(20, 4))]
    got = license_scan.scan(documents(spark, rows)).collect()
    want = Counter()
    for d, t in rows:
        w = WORD.findall(ascii_lower(t))
        places = [(i, label) for phrase, label in license_scan.BASE for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
        at = [i for i, _ in places]
        want[(d, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))] += 1
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    by = {r.doc_id: r for r in got}
    assert by[20].labels == "mit" and by[20].score == 1.0 and by[23].labels == "gpl" and by[23].n_base == 0
    assert by[24].labels == "apache" and by[25].labels == "cc-by-nc" and by[25].spans[0].start == 20
    assert by[6].labels == "" and by[2].score == 0.0
    assert license_scan.scan(documents(spark, rows).limit(0)).collect() == []


def test_license_merges_neighbouring_diagonals(spark):
    text = "Permission is hereby granted, free of any charge, to any person obtaining a copy of this software"
    r = license_scan.scan(documents(spark, [(1, text)])).first()
    assert r.labels == "mit" and r.n_base == 0 and 0.8 < r.score < 1


def test_license_texts_altered_and_cut(spark):
    def text(label, changed=0, cut=1.0, seed=0):
        r = random.Random(seed)
        w = " ".join(t for t, x in license_scan.TEMPLATES if x == label).split()
        w = w[:int(len(w) * cut)]
        for _ in range(changed):
            i = r.randrange(len(w))
            w[i:i + 1] = r.choice([[], ["changed"], [w[i], "more"]])
        return words(60, seed + 1) + "\n" + " ".join(w).upper() + "\n" + words(60, seed + 2)

    kinds = sorted({x for _, x in license_scan.TEMPLATES})
    rows = [(label, text(label, seed=i)) for i, label in enumerate(kinds)]
    rows += [(label, text(label, changed=6, seed=50 + i)) for i, label in enumerate(("mit", "bsd", "apache", "gpl"))]
    rows += [(label, text(label, cut=0.5, seed=90 + i)) for i, label in enumerate(("mit", "bsd", "gpl"))]
    rows += [("cc-by-nc", "This work is licensed under CC BY-NC 4.0."), ("cc-by-nc-sa", "licensed under CC BY-NC-SA 4.0"), ("cc-by", "Licensed under CC BY 4.0!"),
             ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.")]
    bare = ["see the terms of the mozilla public license", "BSD, ISC and MPL are licenses", "the software is provided", "free software and its use",
            "without warranty of any kind", "a creative commons license", "cc by", words(3000, 7), "in no event shall the authors be liable",
            "this program is free software", "you may use this file in compliance with the law", "the above copyright notice"]
    got = license_scan.scan(documents(spark, list(enumerate([t for _, t in rows] + bare)))).collect()
    by = {r.doc_id: r for r in got}
    for i, (label, _) in enumerate(rows):
        assert label in by[i].labels.split(","), (label, by[i].labels)
        assert set(by[i].labels.split(",")) <= {label, *by[i].base_labels.split(",")} | ({"gpl"} if label == "lgpl" else set()), (label, by[i].labels)
        assert by[i].score >= 0.75 and all(60 <= s.start for s in by[i].spans if len(rows[i][1]) > 300)
    assert all(by[len(rows) + i].labels == "" and by[len(rows) + i].score < 1 for i in range(len(bare)))


# --- decontamination

def brute_contamination(rows, items, width=10):
    windows = {}
    for i, t in items:
        w = WORD.findall(ascii_lower(t)) if t is not None else []
        m = min(width, len(w))
        for s in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[s:s + m]), set()).add(None if i is None else str(i))
    out = Counter()
    for d, t in rows:
        w = WORD.findall(ascii_lower(t))
        hit, names = set(), set()
        for m in {len(x) for x in windows}:
            for s in range(len(w) - m + 1):
                if (found := windows.get(tuple(w[s:s + m]))):
                    hit |= set(range(s, s + m))
                    names |= found
        ids = ",".join(sorted(n for n in names if n is not None))
        out[(d, len(w), len(hit), len(names), hashlib.sha256(ids.encode()).hexdigest(), bool(hit))] += 1
    return out


@pytest.mark.parametrize("slice_bytes", [1 << 20, 200])
def test_decontamination_equals_brute_force(spark, slice_bytes):
    items = [("q1", words(25, 900)), ("q2", words(14, 901)), ("q3", "only three words"), ("q4", ""), ("q5", None), (None, words(12, 902)),
             ("q6", words(25, 900)), ("q1", words(11, 903)), ("q7", "x")]
    rows = [(r[0], r[1]) for r in EDGES] + [
        (30, words(30, 50) + " " + words(25, 900).upper() + " " + words(9, 51)), (31, words(14, 901)[:60] + " and " + words(14, 901)),
        (32, "ONLY three, words! only-three words"), (33, words(11, 903) + "; " + words(12, 902))]
    got = decontaminate.contamination(documents(spark, rows), spark.createDataFrame(items, "item_id string, text string"), slice_bytes=slice_bytes)
    want = brute_contamination(rows, items)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()) == want
    kept = decontaminate.clean(documents(spark, rows), spark.createDataFrame(items, "item_id string, text string"), slice_bytes=slice_bytes)
    assert kept.count() == sum(n for k, n in want.items() if not k[5])
    empty = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.contamination(documents(spark, rows), empty).where("contaminated").count() == 0


def test_decontamination_tables_are_small_and_skip(spark):
    from ordermill.llm.common import alnum_words

    items = [(f"q{i}", words(4000, 40 + i).encode()) for i in range(20)]
    _, tables = decontaminate.searchers(items, 10)
    size = sum(len(t) for _, t in items)
    assert len(tables) == 1 and tables[0].nbytes() < 12 * size
    looked = [i for i in range(9, 9000, 9)]
    text = alnum_words(b"nothing of this is in there " * 1500)
    found = tables[0].find(text, decontaminate.word_hashes(text))
    assert found == [] and len(looked) == 999
    hit = text[:50] + alnum_words(items[3][1])[100:130] + text[:7]
    spans, ids = decontaminate.scan(hit, (["a"] * 20, tables), {})
    assert ids == {"a"} and min(s for s, _ in spans) == 50 and max(e for _, e in spans) == 80


def test_decontamination_collisions_only_cost_time(monkeypatch):
    monkeypatch.setattr(decontaminate, "word_hashes", lambda ws, known=None: np.array([len(w) % 2 for w in ws], np.uint64))
    items = [("a", words(40, 1).encode()), ("b", words(12, 2).encode()), ("c", b"one two"), ("d", b"one")]
    ids, tables = decontaminate.searchers(items, 10)
    for text in (words(30, 3) + " " + words(12, 2) + " one two " + words(5, 1), words(40, 1), "one", ""):
        w = text.encode().lower().split()
        spans, found = decontaminate.scan(w, (ids, tables), {})
        want = set()
        for name, item in items:
            i = item.split()
            m = min(10, len(i))
            windows = {tuple(i[k:k + m]) for k in range(len(i) - m + 1)}
            if any(tuple(w[k:k + m]) in windows for k in range(len(w) - m + 1)):
                want.add(name)
        assert found == want


# --- language model

def test_lm_refuses_more_words_than_its_keys_hold():
    lm._fits(1 << 32)
    with pytest.raises(OverflowError):
        lm._fits((1 << 32) + 1)


def brute_lm(train, rows):
    """Interpolated modified Kneser-Ney of order 2, written from the formula."""
    toks = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", ascii_lower(t)) if w] + ["</s>"]
    uni, pair = Counter(), Counter()
    for t in train:
        w = toks(t)
        uni.update(w)
        pair.update(zip(["<s>", *w], w))
    n, v = sum(uni.values()), len(uni)
    cont = Counter(w for _, w in pair)
    total, kinds = Counter(), {}
    for (h, w), c in pair.items():
        total[h] += c
        kinds.setdefault(h, Counter())[min(c, 3)] += 1
    d2 = lm.discounts([sum(c == k for c in pair.values()) for k in (1, 2, 3, 4)])
    d1 = lm.discounts([sum(c == k for c in cont.values()) for k in (1, 2, 3, 4)])
    sub = lambda c, d: max(c - (d[min(c, 3) - 1] if c else 0), 0)
    left1 = sum(d1[min(c, 3) - 1] for c in cont.values()) / len(pair) if pair else 1.0

    def p1(w):
        return sub(cont[w], d1) / max(1, len(pair)) + left1 / (v + 1)

    def p2(h, w):
        if not total[h]:
            return p1(w)
        return sub(pair[h, w], d2) / total[h] + sum(d2[k - 1] * m for k, m in kinds[h].items()) / total[h] * p1(w)

    out = []
    for d, t in rows:
        w = toks(t)
        known = [x if x in uni else "<unk>" for x in w]
        out.append((d, len(w), sum(x in uni for x in w), n, sum(math.log10((uni[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w),
                    sum(math.log10(p2(a, b)) for a, b in zip(["<s>", *known], known))))
    return out, (p2, uni)


@pytest.mark.parametrize("shards,block", [(1, 10 ** 6), (5, 50)])
def test_lm_equals_brute_force(spark, shards, block):
    rows = [(r[0], r[1]) for r in EDGES if r[0] not in (9, 10)] + [(d, words(40 + d % 30, d)) for d in range(100, 160)]
    train = [(d, t) for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 10]
    docs = documents(spark, rows)
    model = lm.train(lm.learn_rows(docs), shards=shards, block=block)
    got = sorted((r[0] is None, r[0] or 0, r[1], r[2], r[3], round(r[4], 6), round(r[5], 6)) for r in lm.score(docs, model, block).select(
        "doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect())
    want, (p2, uni) = brute_lm([t for _, t in train], rows)
    assert got == sorted((r[0] is None, r[0] or 0, r[1], r[2], r[3], round(r[4], 6), round(r[5], 6)) for r in want)
    for h in ("<s>", "the", "</s>", "nothing"):  # a distribution over the words and the unknown one
        assert sum(p2(h, w) for w in uni) + p2(h, "<unk>") == pytest.approx(1)


def test_lm_without_training_rows(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    got = lm.score(docs, lm.train(docs.limit(0), shards=3)).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in got] == [(3, 0, 0), (1, 0, 0)]
    assert all(r.score == 0 for r in got)  # one unknown word is all there is
    assert lm.score(docs.limit(0), lm.train(docs, shards=2)).collect() == []


def test_lm_beats_the_base_score_on_held_out_texts(spark):
    got = queries.op6_lm_scoring(spark, SF).where("held_out AND n_tokens > 50").toPandas()
    assert (got.score > got.base_score).mean() > 0.9


# --- packing

@pytest.mark.parametrize("capacity,group", [(4096, 1 << 20), (64, 500), (16, 1)])
def test_packing_is_a_round_trip(spark, capacity, group):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    rows = [(r[0], r[1]) for r in EDGES if r[0] not in (10,)]
    got = packing.pack(documents(spark, rows), path, capacity=capacity, group_tokens=group, with_ids=True).collect()
    plain = Tokenizer.from_file(path)
    want = Counter((d, tuple(plain.encode(t or "", add_special_tokens=False).ids) + (2,)) for d, t in rows)
    by_seq, pieces = {}, {}
    for r in got:
        assert r.length == len(r.ids) > 0 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, tuple(r.ids)))
    for parts in by_seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity and (at == capacity or at & (at - 1) == 0)
    for (d, n), parts in pieces.items():
        docs = [ids for (x, ids), m in want.items() for _ in range(m) if x == d and len(ids) == n]
        assert sum(len(p) for _, p in parts) == n * len(docs)
        for start, ids in parts:
            assert any(doc[start:start + len(ids)] == ids for doc in docs)
    assert packing.pack(documents(spark, rows).limit(0), path).collect() == []


def test_packing_ids_do_not_depend_on_the_cache():
    texts = [words(300, seed) + " Été, straße. x\u00a0y" for seed in range(6)]
    small, large = packing.Encoder(queries.tokenizer_path(), 7), packing.Encoder(queries.tokenizer_path())
    assert all((small.ids(t) == large.ids(t)).all() for t in texts * 2)
    assert len(small) <= 7 and len(small.old) <= 7 and len(small.words) <= 7 and len(small.old_words) <= 7


def test_packing_looks_up_a_batchs_distinct_chunks_once():
    import pyarrow as pa

    encode = packing.Encoder(queries.tokenizer_path())
    plain = encode.tokenizer
    looked = []
    missing = encode._simple
    encode._simple = lambda *chunk: looked.append(chunk) or missing(*chunk)
    texts = ["Quorvax QUORVAX quorvax, Quorvax,", None, "", "  quorvax\tQuorvax\x1cquorvax!? "] * 50
    assert [x.tolist() for x in encode.ids_of(pa.array(texts))] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sorted(looked) == [("quorvax", ""), ("quorvax", ",")]  # \x1c is no white space to the tokenizer


def test_packing_does_not_depend_on_the_rows_looked_up_at_a_time(spark):
    docs = documents(spark, EDGES)
    got = [sorted(map(str, packing.pack(docs, queries.tokenizer_path(), cache=9, rows=n).collect())) for n in (1, 3, 2000)]
    assert got[0] == got[1] == got[2] and len(got[0]) >= len(EDGES)


def test_packing_ids_of_odd_texts_are_the_tokenizers():
    import pyarrow as pa

    r = random.Random(8)
    odd = list("aAhHtTwWyYjJkKiIZ.,'!?-_<|>1 \t\n\x0b\x1c\x85\xa0\u0327\u0331\u0300\u030a\u0307\u0308\u0130\u0131\u015f\u00df\u1e9e\u03a3"
               "\u03c2\u212b\u212a\u00c9\u00f1\u00b2\u2167\u4f60\U0001f600\x00\u200d") + ["'S", "'re", "Word", "...", "<|endoftext|>", "<|EndOfText|>"]
    texts = ["".join(r.choice(odd) for _ in range(r.randrange(25))) for _ in range(5000)]
    encode = packing.Encoder(queries.tokenizer_path())
    assert encode.simple and encode.lowers
    assert [x.tolist() for x in encode.ids_of(pa.array(texts))] == [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_balances_cost():
    lengths = [900, 50, 30, 2000, 700, 650, 4000, 20, 10, 5, 3000, 1500, 60, 9000] * 20
    pieces = packing.assign(lengths, 4096)
    fill = Counter()
    for _, _, n, s, _ in pieces:
        fill[s] += n
    assert sum(fill.values()) == sum(lengths) and sum(n not in (4096,) for n in fill.values()) <= 12
    assert len(pieces) < len(lengths) * 1.5


# --- HTML

PAGE = """<html><head><title>t</title><style>x</style></head><body><header>Site</header><nav><a href=/>Home</a></nav>
<div class="cookie-notice">We use cookies</div><article><h1>A &amp; B</h1><p>One  <b>two</b><br>three<p>Four<script>var a="</p>"</script> five
<div class="share">share me</div><form><p>mail</p></form><ul><li>x<li>y</ul></article><div id="comments"><p>nice</p></div>
<aside>more</aside><footer>&copy; now</footer></body></html>"""


def test_html_extract(spark):
    shared = "<div>Welcome to the best site of all the web today</div>"
    rows = [(1, "https://a.example/x", PAGE), (2, None, None), (3, "https://a.example/y", ""), (4, "u", "<article>open <p>end"),
            (5, "u", "a < b &lt;c&gt;<!-- no --> d")]
    rows += [(10 + i, "https://b.example/" + str(i), f"<body>{shared}<p>{words(30, 600 + i)}</p>{shared}</body>") for i in range(5)]
    rows += [(10, "https://b.example/0", rows[5][2])]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({c: F.lit(1) for c in ("row", "text", "free", "host")})
    got = {}
    for r in html_extract.extract(df).collect():
        got.setdefault(r.page_id, []).append((r.url, r.text, r.n_chars))
    assert got[1] == [("https://a.example/x", "A & B\nOne two three\nFour five\nx\ny", 33)]
    assert got[2] == [(None, "", 0)] and got[3] == [("https://a.example/y", "", 0)]
    assert got[4][0][1] == "open\nend" and got[5][0][1] == "a < b <c> d"
    for i in range(5):
        assert {t for _, t, _ in got[10 + i]} == {words(30, 600 + i)}
    assert len(got[10]) == 2 and html_extract.extract(df.limit(0)).collect() == []


def test_html_extract_by_names(spark):
    kept = ["related-work", "social-history", "notice-of-appeal", "share-price-table", "comment-on-smith", "respond-time"]
    gone = ["related-posts", "comment-list", "share-buttons", "post-comments", "adSlot", "cookie-notice", "newsletter signup-form", "sidebar"]
    inner = "".join(f"<section class='{c}'>x {c}</section>" for c in kept) + "".join(f"<div id='{c}'>y {c}</div>" for c in gone)
    rows = [("<article>one</article><article class='comment'><p>reader</article>", "one"),
            (f"<article class='post'>{inner}<article class='comment-reply'>no</article><article>quoted</article></article>",
             "\n".join(f"x {c}" for c in kept) + "\nquoted"),
            ("<main class='content sidebar-right'><p>a</p><div itemprop='comment'>no</div><div role=comment>no</div></main>", "a"),
            ("<main id=comments>no</main><article class='no-comments'>b</article>", "b")]
    df = spark.createDataFrame([(i, "u", h) for i, (h, _) in enumerate(rows)], "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got == {i: t for i, (_, t) in enumerate(rows)}


def test_html_extract_drops_blocks_that_a_whole_host_shares(spark):
    def page(i, extra=""):
        return f"<article><p>Follow us every day</p><p>{words(12, 700 + i)}</p>{extra}<p>Copyright of all</p></article>"

    quote = f"<p>{words(10, 999)}</p>"
    rows = [(i, f"https://h.example/{i}", page(i, quote if i % 2 else "")) for i in range(20)]
    rows += [(100 + i, f"https://h.example/copy{i}", page(0)) for i in range(60)]  # copies count once
    rows += [(200 + i, f"https://small.example/{i}", page(i)) for i in range(5)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all(got[i] == words(12, 700 + i) + ("\n" + words(10, 999) if i % 2 else "") for i in range(20))
    assert all(got[100 + i] == words(12, 700) for i in range(60))
    assert all(got[200 + i].startswith("Follow us every day\n") for i in range(5))


def test_html_extract_keeps_what_some_unmarked_pages_share(spark):
    def part(i):
        said = words(20, 3) if i % 8 == 0 else words(8, 2) if i % 2 else "none"
        return f"{words(15, 800 + i)} x{i} {said} y{i} {words(15, 900 + i)}"

    rows = [(i, f"https://big.example/{i}", f"<body><div>Menu</div><div>{words(14, 1)}</div><p>{words(12, 4)} w{i} {words(12, 5)}</p>"
             f"<p>{part(i)}</p><div>Back to top</div></body>") for i in range(40)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {i: f"w{i}\n{part(i)}" for i in range(40)}


def test_html_extract_finds_strings_inside_different_blocks(spark):
    r = random.Random(77)
    passage, rare = words(17, 31), words(14, 32)
    hosts = {"big.example": 130, "edge.example": 10, "small.example": 9, "few.example": 3}
    pages = {}
    for marked in (True, False):
        for host, n in hosts.items():
            for i in range(n):
                parts = [words(r.randrange(1, 12), 1000 + i), f"a{i} {passage} b{i}" if i % 5 or 5 < i < 20 or n == 3 else f"c{i}",
                         f"d{i} {rare}" if i % 10 < 7 else "e", f"{words(4, 33)} f{i}", " ".join(passage.split()[:9])]
                pages[len(pages)] = (host, marked, parts if i % 50 != 49 else ["short"])
    pages |= {len(pages) + k: pages[k % 3] for k in range(300)}  # copies count once
    page = lambda parts, marked: ("<article>" if marked else "<body>") + "".join(f"<p>{t}</p>" for t in parts)
    df = spark.createDataFrame([(i, f"https://{h}/{i}", page(t, m)) for i, (h, m, t) in pages.items()], "page_id bigint, url string, html string")

    want, cut = {}, set()
    for group in {(h, m) for h, m, _ in pages.values()}:
        distinct = {tuple(t) for h, m, t in pages.values() if (h, m) == group}
        runs = Counter(x for t in distinct for x in {tuple(w) for w in zip(*(" ".join(t).split()[k:] for k in range(10)))})
        blocks = Counter(b for t in distinct for b in set(t))
        enough = len(distinct) >= 10
        for i, (h, m, t) in pages.items():
            if (h, m) == group:
                tokens = [(w, k) for k, b in enumerate(t) for w in b.split()]
                common = {b for b, n in blocks.items() if enough and n >= len(distinct) * 0.8}
                gone = {p + k for p in range(len(tokens) - 9) for k in range(10)
                        if (enough or not m) and runs[tuple(w for w, _ in tokens[p:p + 10])] >= max(3, len(distinct) * 0.8)}
                lines = [" ".join(w for p, (w, b) in enumerate(tokens) if b == k and p not in gone) for k in range(len(t)) if t[k] not in common]
                want[i] = "\n".join(x for x in lines if x)
                cut |= {group} if gone else set()
    assert {("big.example", True), ("edge.example", True), ("few.example", False)} <= cut and ("small.example", True) not in cut
    for more in ({}, {"array_words": 300, "copies": 20}):
        assert {x.page_id: x.text for x in html_extract.extract(df, **more).collect()} == want


def test_html_suffix_array_equals_sorted_suffixes():
    r = random.Random(5)
    pages = [" ".join(r.choice("abc") for _ in range(n)) for n in (0, 1, 4, 5, 40, 60, 9)]
    for run in (1, 2, 3, 5, 10):
        tokens = [(p, i, w) for p, t in enumerate(pages) for i, w in enumerate(t.split(" "))]
        named = {k: " ".join(w for _, _, w in tokens[k:k + run]) for k in range(len(tokens))
                 if len({p for p, _, _ in tokens[k:k + run]}) == 1 and k + run <= len(tokens)}
        places, of, agrees, _ = html_extract.suffix_array(pages_array(pages), run)
        assert sorted(places) == sorted(named) and [tokens[k][0] for k in places] == of.tolist()
        assert [bool(x) for x in agrees] == [i > 0 and named[a] == named[places[i - 1]] for i, a in enumerate(places)]
        assert sum(~agrees) == len(set(named.values()))  # equal ones are neighbours
        for least in (1, 2, 3):
            on = Counter(s for p in range(len(pages)) for s in {named[k] for k in named if tokens[k][0] == p})
            assert sorted(html_extract.repeated_strings(pages_array(pages), run, least)) == sorted(s for s, n in on.items() if n >= least)


def pages_array(pages):
    import pyarrow as pa

    return pa.array(pages, pa.string())


def test_html_extract_on_a_table(spark):
    got = queries.op7_html_extract(spark, SF).toPandas().set_index("page_id")
    pages = spark.read.parquet(f"{SF}/pages.parquet").toPandas()
    assert len(got) == len(pages)
    import html

    for r in pages.itertuples():
        inner = r.html.split("<article>")[1].split("</article>")[0]
        want = [" ".join(html.unescape(re.sub("<[^>]+>", " ", x)).split()) for x in re.split(r"</?h1>|</?p>", inner)]
        assert got.text[r.page_id] == "\n".join(x for x in want if x)


# --- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline

    item = words(15, 900)
    rows = [(d, words(2000 if d == 4 else 200, d), "en") for d in range(50)] + [
        (100, words(200, 3), "en"), (101, words(2000, 4) + " end", "en"), (102, words(40, 5) + " " + item, "en"), (103, "123 456", "en"),
        (104, None, None), (105, "", "en"), (None, words(200, 60), None)]
    docs = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    spark_dir = common_dir(spark, item)
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, spark_dir), "test-stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen.append({r.doc_id for r in docs.collect()})
    ids = {r[0] for r in rows}
    bits = {d: simhash.fingerprint((t or "").encode(), 4) for d, t, _ in rows}
    assert (bits[4] ^ bits[101]).bit_count() <= 4
    assert ids - seen[0] == {103, 104, 105} and seen[0] - seen[1] == {3}
    assert seen[1] - seen[2] == {101} and seen[2] - seen[3] == {102}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, spark_dir)
    assert {r.doc_id for r in packed.collect()} == seen[3]


def test_pipeline_near_copies_go_by_row(spark):
    import corpus_pipeline

    near = lambda seed, end: words(400, seed) + " " + end
    rows = [(1, near(950, "a")), (5, near(950, "b")), (5, words(200, 951)), (None, near(952, "a")), (None, near(952, "b")),
            (None, near(953, "a")), (7, near(953, "b")), (8, near(954, "a")), (8, near(954, "b")), (9, words(200, 955))]
    docs = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    texts = [t for _, t in rows]
    bits = [simhash.fingerprint(t.encode(), 4) for t in texts]
    linked = [(0, 1), (3, 4), (5, 6), (7, 8)]
    assert all((bits[a] ^ bits[b]).bit_count() <= 4 for a, b in linked)
    kept = sorted(texts.index(r.text) for r in corpus_pipeline.drop_near(spark, docs, "").collect())
    first = min((3, 4), key=lambda i: hashlib.sha256(texts[i].encode()).digest())
    tie = min((7, 8), key=lambda i: hashlib.sha256(texts[i].encode()).digest())
    assert kept == sorted([0, 2, first, 6, tie, 9])


def test_pipeline_stages_keep_clashing_columns(spark):
    import corpus_pipeline

    rows = [(1, words(400, 960) + " a"), (2, words(400, 960) + " b"), (3, words(200, 961)), (4, words(200, 961)), (5, words(200, 962)),
            (5, words(200, 962)), (None, words(200, 963)), (None, words(200, 963)), (6, None), (7, "")]
    names = ("__sha", "keep_doc", "keep_sha", "near_id", "near_sha", "gone_id", "gone_sha", "again_id", "c0", "c1", "sha", "kept", "rows", "root")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").select(
        *(F.lit(f"own {n}").alias(n) for n in names), "text", F.lit("en").alias("lang"), "doc_id")
    for limit in (corpus_pipeline.BROADCAST_ROWS, 0):  # both ways of the join
        was, corpus_pipeline.BROADCAST_ROWS = corpus_pipeline.BROADCAST_ROWS, limit
        try:
            exact = corpus_pipeline.drop_copies(spark, docs, "")
            near = corpus_pipeline.drop_near(spark, corpus_pipeline.stored(exact, "test-exact"), "")
            for kept, want in ((exact, [None, 1, 2, 4, 5, 7]), (near, [None, 1, 4, 5, 7])):
                got = kept.collect()
                assert kept.columns == docs.columns and sorted((r.doc_id for r in got), key=lambda d: d or 0) == want
                assert all(r[n] == f"own {n}" for r in got for n in names)
                assert kept.select(*names).dtypes == docs.select(*names).dtypes
        finally:
            corpus_pipeline.BROADCAST_ROWS = was


def common_dir(spark, item):
    from ordermill.session import scratch_path

    path = scratch_path(spark, "tables")
    spark.createDataFrame([("q1", item)], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline_over_nothing(spark):
    import corpus_pipeline

    docs = edge_docs(spark).select("doc_id", "text", "lang", "source", "n_chars").limit(0)
    folder = common_dir(spark, "an item")
    for _, stage in corpus_pipeline.STAGES:
        last = stage(spark, docs, folder)
        assert last.count() == 0
