"""The queries of this subpackage: each applies one operator to its whole table.

Links of embeddings and removed windows are written in SQL too, by brute force over the whole tables. Fingerprints by 64-bit
hashes, learned models and tokenizers can't be: tests hold those against brute-force versions.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import embed, fingerprint, mixing, packing, pii, quality, secrets, sharding, simhash, substring
from .common import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.document_fingerprints(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_figures(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeats_removed(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_mixing": op2_mixing,
    "op3_simhash": op3_simhash,
    "op4_embeddings": op4_embeddings,
    "op5_quality": op5_quality,
    "op6_packing": op6_packing,
    "op7_pii": op7_pii,
    "op8_substring": op8_substring,
    "op9_sharding": op9_sharding,
    "op10_secrets": op10_secrets,
}
#: All pairs of a label, and what is reached over them.
LINKED_SQL = """WITH RECURSIVE v AS (SELECT vec_id, label, e, sqrt(list_sum([x * x FOR x IN e])) AS size FROM (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings)
  WHERE label IS NOT NULL AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.93),
r AS (SELECT vec_id AS node, vec_id AS root FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node AND r.root < l.b)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, c.root AS component_id, vec_id = c.root AS kept
FROM embeddings e JOIN (SELECT node, min(root) AS root FROM r GROUP BY node) c ON c.node = e.vec_id"""

#: All windows by their words, the first of each, and the words that later ones cover.
REPEATS_SQL = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
k AS (SELECT r, doc_id, i, md5(array_to_string(words[i : i + 19], ' ')) AS h FROM (SELECT *, unnest(range(1, len(words) - 18)) AS i FROM d WHERE len(words) >= 20)),
f AS (SELECT h, min({'d': doc_id, 'i': i}) AS first FROM k GROUP BY h HAVING count(*) > 1),
g AS (SELECT DISTINCT r, unnest(range(i, i + 20)) AS p FROM k JOIN f USING (h) WHERE {'d': doc_id, 'i': i} > first),
p AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM d),
s AS (SELECT p.r, count(*) FILTER (g.p IS NOT NULL) AS gone, string_agg(word, ' ' ORDER BY p.p) FILTER (g.p IS NULL) AS kept FROM p LEFT JOIN g ON g.r = p.r AND g.p = p.p GROUP BY p.r)
SELECT doc_id, len(words) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN s ON s.r = d.r"""

ORACLES: dict[str, str] = {"op4_embeddings": LINKED_SQL, "op8_substring": REPEATS_SQL}
