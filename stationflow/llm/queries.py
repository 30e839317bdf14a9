"""Registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, langid, licenses, lm, minhash, neighbours, packing, pii, quality, sentencepieces, simhash, spelling, substring


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op2_maxent_scores(spark: SparkSession, sf_dir: str, model: bool = True) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id"), 1))
    return lm.score(docs, ~F.col("held_out"), keep=("held_out",), model=model, within=True)


def op3_output_code_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id"), 0))
    return langid.predict(docs, langid.fit(docs, ~F.col("held_out")), keep=("doc_id", "held_out"))


def op4_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), size=2048, end=1)


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.measure(table(spark, sf_dir, "documents"), window=35)


def op7_sentencepiece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & F.col("rule").isNull()).alias("kept"), "rule")


def op9_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pii.find(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "n_spans", "n_secret")


def op10_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"), least=7, drop=31, times=10)


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"), longest=3, least=10, absorbed=50, top=2000)


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, similarity=0.8)


def base_op2_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op2: all but the model's score, which is not trained for."""
    return op2_maxent_scores(spark, sf_dir, model=False).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 5).alias("base_score"))


def base_op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op8: all but the rules' verdict."""
    return op8_quality_rules(spark, sf_dir).drop("kept", "rule")


def base_op9_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op9: how many matches of the patterns hold."""
    return op9_semi_markov_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


def base_op10_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op10: words and phrases."""
    return op10_license_diagonals(spark, sf_dir).drop("labels", "score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith(("op", "base_op")) and callable(f)}


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPLIT = r"list_filter(string_split_regex(coalesce({}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
#: CRC-32 of a number's decimal digits, bit by bit.
CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda a, b: list_reduce(list_prepend(xor(a, b), CAST(range(8) AS BIGINT[])), lambda v, _: xor(v >> 1, (v & 1) * 3988292384::BIGINT))), 4294967295::BIGINT)"

SQL = {
    "op6_substring_dedup": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {SPLIT.format("text")} AS w FROM documents),
s AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS win FROM (SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d)),
f AS (SELECT r, i FROM s WHERE win IN (SELECT win FROM s GROUP BY win HAVING count(*) > 1)),
p AS (SELECT r, j, w[j] AS word FROM (SELECT r, w, unnest(generate_series(1, len(w))) AS j FROM d)),
c AS (SELECT p.r, j, word, max(f.i) OVER (PARTITION BY p.r ORDER BY j ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone FROM p LEFT JOIN f ON f.r = p.r AND f.i = p.j),
k AS (SELECT r, count_if(gone) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (NOT gone) AS kept FROM c GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (r)""",
    "op11_spelling_variants": f"""WITH RECURSIVE k AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda v, _: xor(v >> 1, (v & 1) * 3988292384::BIGINT))) AS k),
t AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS w FROM documents),
c AS (SELECT doc_id, w, count(*) AS n FROM t WHERE length(w) >= 7 GROUP BY ALL),
h AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w, ''), lambda z: CASE WHEN unicode(z) < 128 THEN [unicode(z)::BIGINT] ELSE [195::BIGINT, unicode(z)::BIGINT - 64] END))), lambda a, b: xor(a >> 8, k[1 + (xor(a, b) & 255)])), 4294967295) AS h FROM c, k),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
g AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS s FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM v)),
p AS (SELECT a.word, b.word AS other, b.n FROM g a JOIN g b ON a.s = b.s AND a.i = b.i AND a.word <> b.word UNION SELECT a.word, b.word, b.n FROM g a JOIN v b ON a.s = b.word UNION SELECT b.word, a.word, a.n FROM g a JOIN v b ON a.s = b.word),
q AS (SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS m FROM p GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * v.n THEN other END AS form, CASE WHEN m >= 10 * v.n THEN m END AS form_n FROM v LEFT JOIN q USING (word)),
r AS (SELECT word, word AS at FROM f UNION ALL SELECT r.word, f.form FROM r JOIN f ON f.word = r.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.at AS root, f.n, f.n_near, f.form_n FROM f JOIN r ON r.word = f.word JOIN f e ON e.word = r.at AND e.form IS NULL""",
    "op12_phrase_collocations": f"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS x FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(x, '[ \x09]+'), lambda z: z <> '') AS w FROM d),
g AS (SELECT lang, k, w[i:i + k - 1] AS p FROM (SELECT lang, k, w, unnest(generate_series(1, len(w) - k + 1)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k))),
f AS (SELECT lang, k, p, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
b AS (SELECT lang, p, max(f) AS longer FROM (SELECT lang, unnest([p[1:2], p[2:3]]) AS p, f FROM c WHERE k = 3) GROUP BY 1, 2),
s AS (SELECT c.lang, array_to_string(c.p, ' ') AS phrase, c.f AS a, x.f AS l, y.f AS r, 1000000::HUGEINT * c.f * c.f // (x.f::HUGEINT * y.f) AS score, h
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS h FROM c) c JOIN f x ON x.lang = c.lang AND x.p = c.p[1:h] JOIN f y ON y.lang = c.lang AND y.p = c.p[h + 1:c.k] LEFT JOIN b ON b.lang = c.lang AND b.p = c.p WHERE b.longer IS NULL OR 100 * b.longer < 50 * c.f),
t AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, h) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM t JOIN n USING (lang) QUALIFY rank <= 2000""",
    "op13_minhash_near_dedup": f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {SPLIT.format(f"translate(text, '{UPPER}', '{LOWER}')")} AS w FROM documents),
g AS (SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT r, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.r < b.r GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
z AS (SELECT r AS a, r AS b FROM d UNION SELECT z.a, l.b FROM z JOIN l ON l.a = z.b),
c AS (SELECT z.a AS r, min(doc_id) AS component_id FROM z JOIN d ON d.r = z.b GROUP BY 1)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM d JOIN c USING (r) LEFT JOIN n USING (r)""",
    "base_op2_maxent_scores": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {CRC} % 5 = 1 AS held_out, list_append({SPLIT.format(f"translate(text, '{UPPER}', '{LOWER}')")}, '') AS w FROM documents),
t AS (SELECT r, held_out, unnest(w) AS word FROM d),
c AS (SELECT word, count(*) AS c FROM t WHERE NOT held_out GROUP BY word),
n AS (SELECT sum(c) AS n, count(*) AS v FROM c),
s AS (SELECT r, count(*) AS n_tokens, count(c.c) AS n_known, sum(log10((coalesce(c.c, 0) + 0.5::DOUBLE) / (n.n + 0.5::DOUBLE * (n.v + 1)))) AS base FROM t LEFT JOIN c USING (word), n GROUP BY r)
SELECT doc_id, held_out, n_tokens, n_known, CAST((SELECT n FROM n) AS BIGINT) AS train_tokens, round(base, 5) AS base_score FROM d JOIN s USING (r)""",
    "base_op8_quality_rules": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x, {SPLIT.format("text")} AS w FROM documents),
g AS (SELECT r, i, w[i:i + 2] AS g FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d)),
q AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
j AS (SELECT r, count(DISTINCT pos) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS pos FROM q) GROUP BY r),
l AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(x, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r)
SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda z: length(z))), 0) AS BIGINT) AS word_chars, length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines, coalesce(j.n, 0) AS n_repeat_words, len(w) < 50 OR 100 * coalesce(j.n, 0) > 50 * len(w) AS base_failed FROM d LEFT JOIN l USING (r) LEFT JOIN j USING (r)""",
    "base_op9_semi_markov_pii": r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
m AS (SELECT doc_id, regexp_extract_all(x, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS e, list_transform(regexp_extract_all(x, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'), lambda v: string_split(v, '.')) AS i,
list_transform(regexp_extract_all(x, '[0-9]([ -]?[0-9])+'), lambda v: list_reverse(string_split(regexp_replace(v, '[ -]', '', 'g'), ''))) AS c, list_transform(regexp_extract_all(x, '\+[0-9][ ().0-9-]+[0-9]'), lambda v: length(regexp_replace(v, '[^0-9]', '', 'g'))) AS p FROM d)
SELECT doc_id, len(e) AS n_email, len(list_filter(i, lambda v: list_max(list_transform(v, lambda o: CAST(o AS HUGEINT))) <= 255)) AS n_ip,
len(list_filter(c, lambda v: len(v) BETWEEN 14 AND 19 AND list_sum(list_transform(v, lambda o, n: CASE WHEN n % 2 = 1 THEN CAST(o AS INTEGER) ELSE 2 * CAST(o AS INTEGER) - 9 * CAST(CAST(o AS INTEGER) > 4 AS INTEGER) END)) % 10 = 0)) AS n_card,
len(list_filter(p, lambda v: v BETWEEN 10 AND 15)) AS n_phone FROM m""",
    "base_op10_license_diagonals": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
a AS (SELECT r, w, unnest(list_filter(range(1, len(w) + 1), lambda i: w[i] = 'license')) AS i FROM d),
p AS (SELECT r, CASE WHEN w[i - 1] = 'mit' THEN i - 2 WHEN w[i - 1] = 'apache' THEN i - 2 WHEN w[i - 1] = 'public' AND w[i - 2] = 'general' THEN i - 3 END AS pos, CASE w[i - 1] WHEN 'mit' THEN 'mit' WHEN 'apache' THEN 'apache' ELSE 'gpl' END AS label FROM a WHERE i > 1),
s AS (SELECT r, count(*) AS n, min(pos) AS lo, max(pos) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM p WHERE pos IS NOT NULL GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word, coalesce(labels, '') AS base_labels FROM d LEFT JOIN s USING (r)""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
