"""The registered queries op1..op13 with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import (collocations, decontaminate, exact_dedup, html_extract, language_id, license_scan, lm, packing, simhash,
                           suffix_dedup, toxicity, url_filter, whitening)
from ordermill.llm.common import importable


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-dedup of documents: 4-word shingles, 4 bits."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), width=4, radius=4).select(
        "doc_id", "fingerprint", "component_id", "component_size")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 100-byte strings of documents, all but their first place removed."""
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def _held_out(parts: int, part: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == part, F.lit(False)).alias("held_out")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(language_id.learn_rows(docs))
    return language_id.predict(docs, model).select("doc_id", _held_out(4, 2), "lang_pred", "score", "rejected")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every document."""
    return license_scan.scan(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 10 words in every document."""
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kneser-Ney score of every document, learned from those not held out."""
    docs = _table(spark, sf_dir, "documents")
    return lm.score(docs, lm.train(lm.learn_rows(docs))).select(
        "doc_id", _held_out(10, 0), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4,096 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, toxicity.learn_labels(_table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).select("doc_id", _held_out(5, 0), "score", "predicted", "n_clauses")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates among documents; the largest doc_id stays."""
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


# The rules of the URL filter.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
# Words that block a host to which no rule applies.
URL_WORDS = ("adult", "ads", "adserver", "bet", "bets", "betting", "casino", "clickbait", "escort", "gamble", "gambling", "hentai", "jackpot",
             "lottery", "malware", "nude", "payday", "phishing", "pills", "poker", "porn", "sex", "slots", "spam", "track", "tracker",
             "tracking", "viagra", "warez", "xxx")


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page, by rule or by the host's words."""
    pages = _table(spark, sf_dir, "pages")
    index = url_filter.build(spark.createDataFrame(URL_RULES, "host string, path string, verdict string"),
                             spark.createDataFrame([(w,) for w in URL_WORDS], "word string"))
    return url_filter.judge(pages, index)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of every embedding."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of two and three words of every language."""
    return collocations.phrases(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    found = {n: f for n, f in globals().items() if n.startswith("op") and n[2].isdigit()}
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the operators that SQL can express."""
    import corpus_pipeline

    found = {n.removeprefix("SQL_"): s for n, s in globals().items() if n.startswith("SQL_")}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})


SQL_op10_exact_dedup = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""

SQL_op5_decontaminate = r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
wins AS (
  SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1),
                                        lambda i: array_to_string(w[i : i + least(len(w), 10) - 1], ' '))) AS win,
         least(len(w), 10) AS m
  FROM item WHERE len(w) > 0),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
sizes AS (SELECT DISTINCT m FROM wins),
place AS (
  SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS i,
         unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS win
  FROM doc JOIN sizes ON len(w) >= m),
hit AS (SELECT p.doc_id, p.i, p.m, w.item_id FROM place p JOIN wins w ON p.win = w.win AND p.m = w.m),
hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit
              FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM hit) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
              FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN hit_words h ON d.doc_id = h.doc_id LEFT JOIN hit_items t ON d.doc_id = t.doc_id
"""

SQL_op11_url_filter = r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(rule_host, rule_path, says) AS (VALUES """ + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES) + r"""),
fits AS (SELECT page_id, rule_host || rule_path AS rule, says FROM p JOIN rules
         ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
         QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY strlen(rule_host) + strlen(rule_path) DESC, strlen(rule_host) DESC) = 1),
named AS (SELECT page_id, list_filter(regexp_extract_all(host, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
                                      lambda w: w IN (""" + ", ".join(f"'{w}'" for w in URL_WORDS) + r"""))[1] AS word FROM p)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.says, CASE WHEN n.word IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN f.rule IS NULL THEN n.word END AS word
FROM p JOIN named n ON p.page_id = n.page_id LEFT JOIN fits f ON p.page_id = f.page_id
"""

SQL_op13_collocations = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
gram AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS phrase
         FROM words, (VALUES (1), (2), (3)) AS t(m) WHERE len(w) >= m),
f AS (SELECT lang, m, phrase, count(*) AS f FROM gram GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 10),
cut AS (SELECT lang, m, phrase, a, w, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
        FROM cand, (VALUES (1), (2)) AS t(k) WHERE k < m),
scored AS (SELECT c.lang, c.m, c.phrase, c.a, c.w, x.f AS l, y.f AS r,
                  CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score, c.k
           FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail
           QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY
             (CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.f AS HUGEINT) * y.f), c.k) = 1),
held AS (SELECT lang, sub, max(a) AS over FROM (
           SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS sub FROM cand WHERE m = 3) GROUP BY ALL),
ranked AS (SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank, s.phrase, s.a, s.l, s.r, s.score
           FROM scored s LEFT JOIN held h ON h.lang = s.lang AND h.sub = s.phrase
           WHERE s.m = 3 OR h.over IS NULL OR 100 * h.over < 50 * s.a)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM ranked r JOIN total t ON t.lang = r.lang WHERE r.rank <= 2000
"""
