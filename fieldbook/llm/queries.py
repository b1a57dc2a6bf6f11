"""Queries of the llm operators over the given tables, and their DuckDB SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldbook.llm import (decontamination, exact_dedup, lexical_search, mixing, near_dedup, ngram_model, pii, quality_classifier,
                           quality_rules, secret_scan, spelling, templates, warc)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    return systematic_columns(mixing.systematic_mix(_table(spark, sf_dir, "documents")))


def systematic_columns(mixed: DataFrame) -> DataFrame:
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language model scores of every document."""
    return ngram_model.score_documents(_table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_classifier.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return templates.extract_main_text(_table(spark, sf_dir, "pages"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics and rule verdict of every document."""
    return quality_rules.apply_quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page after a round trip through WARC archives."""
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    return decontamination.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document."""
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word of the documents."""
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

OP1_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_sides AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM both_sides JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = d.doc_id
"""

OP5_SQL = r"""
WITH RECURSIVE z AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM z GROUP BY source),
step AS (
  SELECT 0 AS i, CAST(3 * sum(source_size) AS HUGEINT) AS x, CAST(2 * sum(w) AS HUGEINT) AS y FROM s
  UNION ALL
  SELECT i + 1, CAST(nx AS HUGEINT), CAST(ny AS HUGEINT) FROM (
    SELECT p.i, p.x, p.y, sum(3 * s.source_size) - sum(CASE WHEN s.w * p.x > 2 * s.source_size * p.y THEN 4 * s.source_size ELSE 0 END) AS nx,
           2 * sum(CASE WHEN s.w * p.x > 2 * s.source_size * p.y THEN 0 ELSE s.w END) AS ny
    FROM step p, s GROUP BY p.i, p.x, p.y)
  WHERE (nx <> x OR ny <> y) AND ny > 0 AND i < 100),
lv AS (SELECT x, y FROM step ORDER BY i DESC LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN w * x > 2 * source_size * y THEN 2.0::DOUBLE * source_size ELSE CAST(w * x AS DOUBLE) / CAST(y AS DOUBLE) END AS target,
         CAST('0x' || substr(md5('mix-1' || coalesce('|s' || source, '|n')), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM s, lv),
r AS (
  SELECT z.doc_id, z.source, z.size, row_number() OVER (PARTITION BY z.source ORDER BY z.size DESC, z.doc_id NULLS LAST) AS rank FROM z),
c AS (
  SELECT r.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS e, t.u
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, CAST(least(floor(rank * e + u) - floor((rank - 1) * e + u), 2) AS BIGINT) AS copies FROM c)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM k
"""

OP9_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
g AS (SELECT html, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY html)
SELECT p.page_id, p.payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN g.keeper <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.keeper <> p.page_id THEN g.keeper END AS refers_to, true AS verified
FROM p LEFT JOIN g ON g.html = p.html AND p.payload_bytes >= 1000
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_SQL = rf"""
WITH p AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM p GROUP BY ALL),
d AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) AS term FROM benchmark),
df AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM q) GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM df, c),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN d USING (doc_id), c GROUP BY ALL),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 10
"""

OP12_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
FROM t WINDOW g AS (PARTITION BY body)
"""

# The checksum runs over a list: each byte is added, then eight steps (-1) divide by the polynomial.
OP13_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS key, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
sums AS (
  SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(key, ''), lambda c:
    CAST(CASE WHEN ord(c) < 128 THEN [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]
         ELSE [195, -1, -1, -1, -1, -1, -1, -1, -1, ord(c) - 64, -1, -1, -1, -1, -1, -1, -1, -1] END AS BIGINT[])))),
    lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END), 4294967295) AS h
  FROM counted),
v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
                ELSE run END AS word, n FROM sums)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (
  SELECT a.word AS word, a.n AS n, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, c.n, v.word, v.n FROM cuts c JOIN v ON v.word = c.rest
  UNION SELECT v.word, v.n, c.word, c.n FROM cuts c JOIN v ON v.word = c.rest),
best AS (
  SELECT word, count(*) OVER (PARTITION BY word) AS n_near, near, near_n,
         row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k FROM pairs),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * v.n THEN near END AS form,
         CASE WHEN near_n >= 10 * v.n THEN near_n END AS form_n
  FROM v LEFT JOIN best ON best.word = v.word AND k = 1),
walk AS (
  SELECT word, word AS at FROM f UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n
FROM f JOIN walk ON walk.word = f.word JOIN f last ON last.word = walk.at AND last.form IS NULL
"""


def queries() -> dict[str, Query]:
    return {
        "op1_near_dedup": op1_near_dedup,
        "op2_ngram_scores": op2_ngram_scores,
        "op3_quality_classifier": op3_quality_classifier,
        "op4_main_text": op4_main_text,
        "op5_systematic_mix": op5_systematic_mix,
        "op6_secrets": op6_secrets,
        "op7_personal_data": op7_personal_data,
        "op8_quality_rules": op8_quality_rules,
        "op9_warc": op9_warc,
        "op10_decontamination": op10_decontamination,
        "op11_lexical_search": op11_lexical_search,
        "op12_exact_dedup": op12_exact_dedup,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_near_dedup": OP1_SQL, "op5_systematic_mix": OP5_SQL, "op9_warc": OP9_SQL, "op11_lexical_search": OP11_SQL,
            "op12_exact_dedup": OP12_SQL, "op13_spelling_variants": OP13_SQL}
