"""The registered queries of this subpackage, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardloom.llm import alignment, decontam, fingerprint, langid, linededup, mixing, neardup, packing, phrases, pii, quality, secret_scan, toxicity
from cardloom.llm.common import table

# names of public tokenizers; each worker looks up their paths
TOKENIZER = "word_bpe_49k.json"
BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.classes(fingerprint.fingerprints(table(spark, sf_dir, "documents")))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(table(spark, sf_dir, "documents"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    out = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"), BYTES, PIECES)


def op12_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    out = mixing.pack_mixture(table(spark, sf_dir, "documents"), BYTES)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[s + 1 : s + least(13, len(w))] AS g FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 13, 0) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(g) AS n FROM win),
dw AS (SELECT doc_id, n, s, w[s + 1 : s + n] AS g FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, s, n FROM dw JOIN win USING (g)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP7_SQL = r"""
WITH l AS (SELECT doc_id, i, ls[i] AS line, translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
f AS (SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT l.*, last IS NOT NULL AND doc_id < last AS gone FROM l LEFT JOIN f USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP10_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 5], ' ') AS g FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 5, 0) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, m) AS (SELECT doc_id, doc_id FROM documents UNION SELECT u.b, r.m FROM r JOIN u ON r.doc_id = u.a WHERE r.m < u.b),
c AS (SELECT doc_id, min(m) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""

OP13_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS g, count(*) AS f FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k)) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, g, k, f, string_split(g, ' ') AS w FROM g WHERE f >= 30),
c AS (SELECT lang, g, f, array_to_string(w[:c], ' ') AS x, array_to_string(w[c + 1:], ' ') AS y, c FROM (SELECT *, unnest(range(1, k)) AS c FROM f WHERE k > 1)),
s AS (SELECT c.lang, c.g, c.f AS a, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * c.f // (x.f::HUGEINT + y.f) AS BIGINT) AS score, c FROM c JOIN f x ON x.lang = c.lang AND x.g = c.x JOIN f y ON y.lang = c.lang AND y.g = c.y),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
i AS (SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS g, max(f) AS held FROM (SELECT lang, w, f, k, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM f WHERE k > 2)) GROUP BY ALL),
o AS (SELECT b.lang, b.g AS phrase, a, l, r, n, score FROM b JOIN n ON n.lang = b.lang LEFT JOIN i ON i.lang = b.lang AND i.g = b.g WHERE held IS NULL OR 100::HUGEINT * held < 80::HUGEINT * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o QUALIFY rank <= 2000
"""

QUERIES = {f.__name__: f for f in (op1_quality, op2_fingerprints, op3_language, op4_personal_data, op5_pack_sequences, op6_benchmark_decontamination, op7_line_dedup, op8_secrets, op9_toxicity, op10_near_duplicates, op11_token_alignment, op12_mixture_packing, op13_collocations)}
ORACLES = {"op6_benchmark_decontamination": OP6_SQL, "op7_line_dedup": OP7_SQL, "op10_near_duplicates": OP10_SQL, "op13_collocations": OP13_SQL}
