"""The registered queries of these operators and the SQL of those that SQL can express."""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import functions as F

from trawl.llm import pii, toxicity
from trawl.llm.ann import projected_neighbours
from trawl.llm.common import bound_batches, id_remainder, labelled_sample, table
from trawl.llm.decontaminate import find_leaks
from trawl.llm.langid import LanguageModel, identify
from trawl.llm.ngram_join import near_duplicates
from trawl.llm.packing import pack
from trawl.llm.quality import SAMPLE_ROWS, fit_quality, score_quality
from trawl.llm.rollup import TokenRollup, count_tokens
from trawl.llm.sharding import assign_shards
from trawl.llm.spelling import count_words, group_variants
from trawl.llm.url_rules import glob_rule, host_rule, judge_urls
from trawl.llm.whitening import whiten
from trawl.plans.registry import shipped
from trawl.session import scratch_path

URL_RULES = [
    host_rule("block", "net/"), host_rule("allow", "example.net/en/"),
    host_rule("block", "example.com/de/"), host_rule("allow", "org/fr/"),
    *(glob_rule("block", g) for g in (
        "*.casino-*", "*.adult-*", "*.ads-track.*", "*.spam-farm.*", "*.cheap-pills.*", "*-bets.*",
        "casino-*", "adult-*", "ads-track.*", "spam-farm.*", "cheap-pills.*", "*/login/*", "*/cart/*",
        "*/tag/*", "*.swf", "*.exe")),
]


#: Places in which the copies of one text are looked for.
COPY_SALTS = 16


def op1_projected_neighbours(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return projected_neighbours(vectors, vectors.where("vec_id % 100 = 0"))


def op2_url_rules(spark, sf):
    judged = judge_urls(table(spark, sf, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "pattern")


def op3_language_id(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    rest = id_remainder("doc_id", 5)
    model = LanguageModel.fit(docs.where(rest != 0))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_ngram_jaccard_join(spark, sf):
    return near_duplicates(table(spark, sf, "documents"))


def op5_benchmark_leaks(spark, sf):
    return find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op6_additive_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    sample = labelled_sample(table(spark, sf, "labels"), "quality", 3, 1, SAMPLE_ROWS)
    scored = score_quality(docs, fit_quality(docs, sample))
    return scored.select("doc_id", F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                         "score", "predicted")


def op7_byte_shards(spark, sf):
    placed = assign_shards(table(spark, sf, "documents"), 40)
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"),
                         "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed public tokenizers keep a file; another path may be given to the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_best_fit_packing(spark, sf):
    return pack(table(spark, sf, "documents"), tokenizer_file())


def op9_token_rollup(spark, sf):
    """Loads every document, loads it again to no effect, and takes exact copies out again."""
    docs = table(spark, sf, "documents")
    counted = count_tokens(docs.select("doc_id", "source", "lang", "text"), tokenizer_file()).select(
        F.lit("insert").alias("op"), "doc_id", "source", "lang", F.lit("byte_bpe_50k").alias("version"),
        "tokens", F.octet_length("text").alias("bytes"))
    rollup = TokenRollup(spark, scratch_path(spark, f"rollup-{uuid.uuid4().hex}"))
    rollup.apply("load", counted)
    rollup.apply("load", counted)
    texts = docs.where("text IS NOT NULL").select("doc_id", F.md5(F.encode("text", "UTF-8")).alias("digest"))
    first = texts.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    # A digest that many documents have is met in several places.
    salts = F.explode(F.sequence(F.lit(0), F.lit(COPY_SALTS - 1)))
    salted = texts.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(COPY_SALTS)).cast("int"))
    copies = salted.join(first.withColumn("salt", salts), ["digest", "salt"]).where("doc_id > first")
    rollup.apply("copies", copies.select(
        F.lit("delete").alias("op"), "doc_id", F.lit("byte_bpe_50k").alias("version"),
        *(F.lit(None).cast("string").alias(c) for c in ("source", "lang")),
        *(F.lit(0).alias(c) for c in ("tokens", "bytes"))))
    return rollup.totals()


def op10_clause_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    sample = labelled_sample(table(spark, sf, "labels"), "toxic", 4, 2, toxicity.SAMPLE_ROWS)
    scored = toxicity.score_toxicity(docs, toxicity.ToxicityModel.fit(docs, sample))
    return scored.select("doc_id", F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                         "score", "predicted", "clauses", "strongest")


def op11_personal_data(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs, pii.fit_field(docs))
    base = F.filter("found", lambda s: s["by_rule"])
    return found.select(
        "doc_id",
        *(pii.span_count(base, kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(pii.span_list(base), 256).alias("base_sha256"), pii.span_list(F.col("found")).alias("spans"))


def op12_spelling_variants(spark, sf):
    return group_variants(count_words(table(spark, sf, "documents")))


def op13_embedding_whitening(spark, sf):
    return whiten(table(spark, sf, "embeddings"))


def _bounded(run):
    @wraps(run)
    def query(spark, sf):
        bound_batches(spark)
        return run(spark, sf)

    return shipped(query)


QUERIES = {f.__name__: _bounded(f) for f in (
    op1_projected_neighbours, op2_url_rules, op3_language_id, op4_ngram_jaccard_join, op5_benchmark_leaks, op6_additive_quality, op7_byte_shards, op8_best_fit_packing,
    op9_token_rollup, op10_clause_toxicity, op11_personal_data,
    op12_spelling_variants, op13_embedding_whitening)}

# It cuts slices of one size whatever the session's batches are, and so needs no setting.
QUERIES["op4_ngram_jaccard_join"] = shipped(op4_ngram_jaccard_join)

_PATTERN_SQL = " ".join(
    f"WHEN regexp_matches(target, '{r.regex.replace(chr(92) + 'z', '$')}') THEN '{r.name}'"
    for r in sorted((r for r in URL_RULES if not r.named), key=lambda r: (r.action, r.name)))
_NAMED_SQL = " ".join(
    f"WHEN regexp_matches(target, '{r.regex}') THEN '{r.action} {r.name}'"
    for r in sorted((r for r in URL_RULES if r.named), key=lambda r: -len(r.name)))

ORACLES = {
    "op2_url_rules": f"""
WITH p AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
t AS (SELECT *, host || path AS target FROM p),
d AS (SELECT *, CASE {_NAMED_SQL} END AS named, CASE {_PATTERN_SQL} END AS general FROM t)
SELECT page_id, host, path, split_part(named, ' ', 2) AS rule,
       CASE WHEN named IS NULL THEN general END AS pattern,
       CASE WHEN named IS NOT NULL THEN split_part(named, ' ', 1)
            WHEN general IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict FROM d""",
    # The checksum byte by byte; words one edit apart share what is left when a code point goes, or one
    # is what is left of the other.
    "op12_spelling_variants": r"""
WITH RECURSIVE t AS (
    SELECT list(c ORDER BY i) AS crc FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
        CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(i))),
runs AS (SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
bytes AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM runs),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(length(h) // 2),
        lambda i: ('0x' || substr(h, (2 * i + 1)::INT, 2))::BIGINT)),
    lambda c, b: xor(c // 256, t.crc[xor(c % 256, b) + 1]))) AS h FROM bytes, t),
words AS (SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT)
        || substr(run, (h % length(run) + 2)::INT) ELSE run END AS word FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, (i - 1)::INT) || substr(word, (i + 1)::INT) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS most FROM pairs GROUP BY word),
first AS (SELECT p.word, min(other) AS other FROM pairs p JOIN best b ON p.word = b.word AND other_n = most GROUP BY p.word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * w.n THEN other END AS form,
        CASE WHEN most >= 5 * w.n THEN most END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word LEFT JOIN first f ON f.word = w.word),
chain AS (SELECT word, word AS root FROM forms
    UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.root AND e.form IS NULL""",
}
