"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exactdedup, htmlmain, langid, linededup, ngramjoin, packing, secretscan, shardtree, wavelet, winnow
from .common import materialize, table


def tokenizer_path() -> str:
    """The byte-level BPE vocabulary of the queries; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = wavelet.write_shards(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)
    return wavelet.read_shards(manifest)


def op2_assignment_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.digest(secretscan.secrets(table(spark, sf_dir, "documents")))


def packed(docs: DataFrame) -> DataFrame:
    """The pieces of every document's token ids (byte_bpe_50k, an end mark) in packed sequences, and the crc32 of the sequence each is in."""
    tokens = materialize(wavelet.token_ids(docs, tokenizer_path()), "token_ids")
    laid = packing.sequences(tokens).select("bin_id", "capacity", F.crc32("input_ids").alias("bin_crc32"), F.explode("pieces").alias("p"))
    return laid.select("p.*", "bin_id", "capacity", "bin_crc32")


def op3_variable_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op4_token_combination_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.near_duplicates(table(spark, sf_dir, "documents"), width=5, percent=80)


OP4_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{20}\x{09}-\x{0D}]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0) t),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, '|' ORDER BY g)) AS class FROM s GROUP BY doc_id),
copies AS (SELECT class, count(*) AS n_equal FROM n GROUP BY class),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach AS (SELECT doc_id, doc_id AS r FROM n UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r),
comp AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id),
other AS (SELECT DISTINCT x.class FROM links JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE x.class <> y.class)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
  CAST(coalesce(n_equal, 1) AS BIGINT) AS n_equal, other.class IS NOT NULL AS linked
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id) LEFT JOIN copies USING (class) LEFT JOIN other USING (class)
"""


def op5_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(table(spark, sf_dir, "documents"), window=3)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


OP5_SQL = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
n AS (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM d WHERE len(l) >= 3),
w AS (SELECT doc_id, i, l[i] AS a, l[i + 1] AS b, l[i + 2] AS c FROM n WHERE length(trim(l[i], ' ')) + length(trim(l[i + 1], ' ')) + length(trim(l[i + 2], ' ')) > 0),
g AS (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS r FROM w),
gone AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE r > 1),
lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS p FROM d),
left_over AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS t FROM lines ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
k AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS text_sha256
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""


def op6_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bi AS (SELECT item, w, CAST(least(13, len(w)) AS BIGINT) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bi) t),
ns AS (SELECT DISTINCT n FROM bi),
dw AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n) t),
h AS (SELECT rid, i, dw.n AS n, item FROM dw JOIN bw ON dw.n = bw.n AND dw.s = bw.s),
c AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM h) t GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM h) t GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN it USING (rid)
"""


def op7_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shardtree.shard_rows(table(spark, sf_dir, "documents"), shards=8)


def op8_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(langid.fold() != 2))
    found = langid.identify(docs, model)
    return found.select("doc_id", F.coalesce(langid.fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op9_refined_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_dedup(table(spark, sf_dir, "documents"), digest_all=True)


OP9_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""


def op10_boosted_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlmain.extract(table(spark, sf_dir, "pages"))


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_wavelet_tokens, op2_assignment_secrets, op3_variable_best_fit, op4_token_combination_join, op5_line_windows, op6_winnowing_decontamination,
        op7_hash_tree_sharding, op8_centroid_language, op9_refined_exact_dedup, op10_boosted_main_text,
    )}


def oracle_sql() -> dict:
    return {"op4_token_combination_join": OP4_SQL, "op5_line_windows": OP5_SQL, "op6_winnowing_decontamination": OP6_SQL, "op9_refined_exact_dedup": OP9_SQL}
