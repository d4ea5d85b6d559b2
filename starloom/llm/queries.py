"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (bpe, decontaminate, embedding_dedup, hard_negatives, html_text, licenses, pieces,
                          pu_quality, secret_scan, simhash_dedup, spelling, toxicity, url_filter)
from starloom.llm.common import crc_mod, table

#: The rules of the URL query (host, path, action).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


#: Remainder of crc32(doc_id) modulo 4 whose labels the quality query never sees.
QUALITY_HELD_OUT = 2
QUALITY_AT = 0.7


def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = pu_quality.sample(docs, table(spark, sf_dir, "labels"), crc_mod(F.col("id"), 4) != QUALITY_HELD_OUT)
    return pu_quality.score(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 4) == QUALITY_HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= QUALITY_AT).cast("int").alias("predicted"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.flag(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def secret_columns(spans: Column) -> list[Column]:
    """The digest columns of the secret query from the operator's spans."""
    base = F.filter(spans, lambda s: s["kind_no"] < len(secret_scan.BASE_RULES))

    def joined(of: Column) -> Column:
        return F.array_join(F.transform(of, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    counts = [F.size(F.filter(spans, lambda s: s["kind"] == r.kind)).cast("long").alias(f"n_{r.kind}")
              for r in secret_scan.BASE_RULES]
    return [*counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans")]


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *secret_columns(F.col("spans")))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (html_text.extract_text(table(spark, sf_dir, "pages"))
            .withColumn("n_chars", F.length("text").cast("long")))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.group(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash_dedup.hex_digits(F.col("fp")).alias("fingerprint"),
                        "component_id")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.group(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


#: Remainder of crc32(doc_id) modulo 5 whose labels the toxicity query never sees.
TOXIC_HELD_OUT = 0
TOXIC_AT = 0.5


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Trained on labelled documents outside the held-out fold."""
    return toxicity.sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                           crc_mod(F.col("id"), 5) != TOXIC_HELD_OUT)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 5) == TOXIC_HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    best = F.array_max(F.transform("found", lambda x: x["coverage"]))
    return found.select("doc_id", F.size("found").cast("long").alias("n_licenses"),
                        F.array_join(F.transform("found", lambda x: x["template"]), ",").alias("licenses"),
                        F.coalesce(best, F.lit(0.0)).alias("coverage"),
                        F.array_join(F.transform("found", lambda x: F.concat_ws(
                            ":", x["start"].cast("string"), x["stop"].cast("string"))), ",").alias("places"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def vocabulary(path: str | None = None) -> bpe.Vocabulary:
    """The byte-level vocabulary of the BPE query, or the file at ``path``."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.load(path)


def token_columns() -> list[Column]:
    """The digest columns of the BPE query from the operator's ids and decoded text."""
    return [F.size("ids").cast("long").alias("n_tokens"),
            F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
            F.sha2("text", 256).alias("decoded_sha256")]


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary())
    return coded.select("doc_id", *token_columns())


def piece_model(path: str | None = None) -> pieces.Model:
    """The model of the SentencePiece query, or the file at ``path``."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.load(path)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, decoded text and spans; the spans' ends say where every piece begins and ends."""
    m = piece_model()

    def digest(numbers: str) -> Column:
        return F.sha2(F.array_join(F.col(numbers).cast("array<string>"), " "), 256).alias(f"{numbers}_sha256")

    coded = pieces.encode(table(spark, sf_dir, "documents"), m, spans=("ends",)).select(
        "doc_id", "ids", digest("ends"))
    return pieces.decode(coded, m, keep=("doc_id", "ends_sha256")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), digest("ids"),
        F.sha2("text", 256).alias("decoded_sha256"), "ends_sha256")


#: Fixed values of the spelling query: runs of letters (shorter ones cannot reach the least
#: length), every how many occurrences a letter is dropped, least length and least occurrences.
SPELLING_RUNS = r"[A-Za-z\u00C0-\u00FF]{6,}"
SPELLING_EVERY, SPELLING_CHARS, SPELLING_TIMES = 199, 6, 5


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.runs(table(spark, sf_dir, "documents"), SPELLING_RUNS)
    name = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("word"))
    h, chars = F.crc32(name.cast("binary")), F.char_length("word")
    at = F.pmod(h, chars).cast("int")
    shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, chars))
    found = found.select(F.when(F.pmod(h, F.lit(SPELLING_EVERY)) == 0, shorter).otherwise(F.col("word")).alias("word"))
    counted = (found.where(F.char_length("word") >= SPELLING_CHARS).groupBy("word").agg(F.count("*").alias("n"))
               .where(F.col("n") >= SPELLING_TIMES))
    return spelling.variants(counted)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    usable = ("embedding IS NOT NULL AND NOT exists(embedding, x -> x IS NULL OR isnan(x) "
              "OR abs(x) = double('inf'))")
    vecs = rows.where(usable).select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("embedding"))
    return hard_negatives.mine(vecs, F.col("id") % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pu_quality": op1_pu_quality,
        "op2_decontaminate": op2_decontaminate,
        "op3_secret_scan": op3_secret_scan,
        "op4_html_text": op4_html_text,
        "op5_simhash_dedup": op5_simhash_dedup,
        "op6_embedding_dedup": op6_embedding_dedup,
        "op7_toxicity": op7_toxicity,
        "op8_licenses": op8_licenses,
        "op9_url_filter": op9_url_filter,
        "op10_bpe": op10_bpe,
        "op11_sentencepiece": op11_sentencepiece,
        "op12_spelling": op12_spelling,
        "op13_hard_negatives": op13_hard_negatives,
    }


_OP9 = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*', 0) AS h,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
urls AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path
  FROM parts),
marked AS (
  SELECT *, path LIKE '/%' AND (host = 'com' OR host LIKE '%.com') AS com,
         path LIKE '/en/%' AND (host = 'example.com' OR host LIKE '%.example.com') AS ex,
         path LIKE '/en/%' AND (host = 'www.example.com' OR host LIKE '%.www.example.com') AS www,
         path LIKE '/es/%' AND (host = 'net' OR host LIKE '%.net') AS es,
         path LIKE '/fr/%' AND (host = 'net' OR host LIKE '%.net') AS fr
  FROM urls),
ruled AS (
  SELECT page_id, host, path, CASE WHEN www THEN 'www.example.com/en/' WHEN ex THEN 'example.com/en/'
         WHEN es THEN 'net/es/' WHEN fr THEN 'net/fr/' WHEN com THEN 'com/' END AS rule
  FROM marked)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


def _op3_spans(kind: str, number: int, pattern: str, group: int, least: int) -> str:
    rx = pattern.replace("'", "''")
    return f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, '{rx}')) + 1), lambda i: {{
        's': (coalesce(list_sum(list_transform(string_split_regex(t, '{rx}')[1:i], lambda x: length(x))), 0)
              + coalesce(list_sum(list_transform(regexp_extract_all(t, '{rx}')[1:i - 1], lambda x: length(x))), 0)
             )::BIGINT, 'k': {number}, 'kind': '{kind}', 'n': length(regexp_extract_all(t, '{rx}')[i]),
        'ok': length(regexp_extract_all(t, '{rx}', {group})[i]) >= {least}}}), lambda z: z.ok)"""


def _op3() -> str:
    parts = [_op3_spans(r.kind, i, r.pattern, r.group, r.min_chars)
             for i, r in enumerate(secret_scan.RULES)]
    hits = ", ".join(f"CASE WHEN regexp_matches(t, '{r.pattern.replace(chr(39), chr(39) * 2)}') "
                     f"THEN {p} ELSE [] END AS h{i}"
                     for i, (r, p) in enumerate(zip(secret_scan.RULES, parts, strict=True)))
    cols = [f"h{i}" for i in range(len(parts))]
    text = "list_transform(list_sort({}), lambda z: z.kind || ':' || z.s || ':' || (z.s + z.n))"
    n_base = len(secret_scan.BASE_RULES)
    base, every = (text.format(" || ".join(c)) for c in (cols[:n_base], cols))
    counts = ", ".join(f"len(h{i})::BIGINT AS n_{r.kind}" for i, r in enumerate(secret_scan.BASE_RULES))
    return f"""
WITH src AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS (SELECT doc_id, {hits} FROM src)
SELECT doc_id, {counts}, sha256(coalesce(array_to_string({base}, ','), '')) AS base_sha256,
       coalesce(array_to_string({every}, ','), '') AS spans
FROM found
"""


_OP13 = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         list_inner_product(a.v, r.v)::BIGINT AS score
  FROM usable a JOIN usable r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""

#: crc32 bit by bit over the UTF-8 bytes, near words through what is left when one letter is
#: taken out: equal at the same place for a replaced letter, equal to the shorter word for a
#: deleted one.
_OP12 = """
WITH runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
seen AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
bytes AS (
  SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS hx FROM seen),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
           list_transform(range(0, 4 * len(hx)), lambda i:
             (('0x' || substr(hx, 1 + 2 * (i // 8), 2))::BIGINT >> (i % 8)::INT) & 1),
           lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295::BIGINT)) AS h
  FROM bytes),
written AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
              ELSE run END AS word, n FROM hashed),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM written WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
holes AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS hole
  FROM (SELECT word, n, unnest(range(0, length(word)::BIGINT)) AS i FROM words)),
one_way AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.i = b.i
  WHERE a.word <> b.word AND length(a.word) = length(b.word)
  UNION SELECT h.word, h.n, w.word, w.n FROM holes h JOIN words w ON h.hole = w.word),
near AS (
  SELECT word, n, other, other_n FROM one_way
  UNION SELECT other, other_n, word, n FROM one_way),
best AS (
  SELECT word, count(*) AS n_near,
         arg_min(other, {'a': -other_n, 'b': encode(other)}) AS other, max(other_n) AS other_n
  FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (
  WITH RECURSIVE c AS (
    SELECT word, word AS at FROM forms
    UNION ALL SELECT c.word, f.form FROM c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL)
  SELECT c.word, c.at AS root FROM c JOIN forms f ON f.word = c.at WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n::BIGINT AS form_n FROM forms f JOIN chain USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op12_spelling": _OP12,
        "op13_hard_negatives": _OP13,
        "op3_secret_scan": _op3(),
        "op9_url_filter": _OP9,
    }
