"""The operators' registered queries, each over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm import (
    conversation_trie,
    decontaminate,
    hard_negatives,
    imatch,
    licenses,
    packing,
    paragraphs,
    quality_mil,
    simhash,
    suffix_dedup,
    tag_paths,
    token_files,
    token_trees,
)
from emberlog.llm.work import work_folder

QUERIES = {}


def _query(name: str):
    def keep(build):
        QUERIES[name] = build
        return build

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op1_token_files")
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    token_files.write_token_files(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.token_checksums(token_files.read_tokens(spark, path))


@_query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digest(table(spark, sf_dir, "documents"))


@_query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_mil.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality_mil.score_quality(docs, model)
    return scored.select("*", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query("op4_tag_paths")
def op4_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.extract(table(spark, sf_dir, "pages"))


@_query("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query("op6_decontaminate")
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


@_query("op8_paragraphs")
def op8_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_paragraphs(table(spark, sf_dir, "documents"))


@_query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text before and after three edits: a replaced word or two near the
    front, a cut in the middle, a mark set in near the end."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    state = token_trees.build_trees(table(spark, sf_dir, "documents"), tokenizer)
    n = F.length("text")
    edit = lambda start, gone, new: F.struct(
        F.floor(start).cast("long").alias("start"), F.floor(gone).cast("long").alias("n_deleted"), new.alias("inserted")
    )
    edits = F.array(
        edit(n / 5, F.lit(12), F.substring("text", 1, 30)),
        edit(n / 2, n / 50, F.lit("")),
        edit(n * 4 / 5, F.lit(0), F.lit("[removed]")),
    )
    before = state.withColumn("edits", edits)
    after = token_trees.apply_edits(before, tokenizer)
    return after.select(
        "doc_id",
        F.col("tokens_before").alias("n_tokens"),
        F.col("n_tokens").alias("edited_tokens"),
        F.length("text").cast("long").alias("edited_chars"),
        F.size("leaf_chars").cast("long").alias("edited_leaves"),
        "recounted_chars",
        "n_edits",
    )

@_query("op10_imatch")
def op10_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_with_edits(table(spark, sf_dir, "documents"))


@_query("op11_hard_negatives")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh id are moved on by one first, as the query's contract has it."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label")))


@_query("op12_licenses")
def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(licenses.scan_licenses(table(spark, sf_dir, "documents")))


@_query("op13_conversation_trie")
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that begin with turns of the first one of their hundred, as many as
    the id's checksum says."""
    turns = conversation_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    base = F.col("conv_id") - F.col("conv_id") % 100
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return conversation_trie.prefix_nodes(conversation_trie.rebuilt(turns, base, shared, most_shared=5))


#: DuckDB SQL of the queries that SQL can express. The others rest on tokenizers, hashes or
#: fitted models that it lacks, and are held against brute force in tests/llm.
ORACLES: dict[str, str] = {
    "op2_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d)),
m AS (SELECT s, min(doc_id) AS lo FROM p GROUP BY s),
c AS (SELECT p.doc_id, p.i FROM p JOIN m USING (s) WHERE lo < p.doc_id),
g AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER w + 50 THEN 0 ELSE 1 END AS fresh FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
s AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM r GROUP BY doc_id, run),
k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_ FROM s),
t AS (SELECT k.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
             string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) AS kept
      FROM k JOIN d ON d.doc_id = k.doc_id GROUP BY k.doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN t ON t.doc_id = d.doc_id
""",
    "op11_hard_negatives": """
WITH r AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, r.id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM r AS a JOIN r ON a.id <> r.id WHERE a.id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id
  WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
""",
    "op13_conversation_trie": """
WITH t AS (
  SELECT conv_id, {'r': coalesce(role, ''), 'x': coalesce(text, '')} AS turn,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS b,
         -- CRC-32 of the decimal id: a character is mixed in, then eight shifts
         xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
             lambda s: [CAST(ascii(s) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) % 6 AS h
  FROM n),
u AS (SELECT c.*, least(h, coalesce(n.n, 0)) AS used FROM c LEFT JOIN n ON n.conv_id = c.b),
r AS (
  SELECT conv_id, used + k - h AS depth, turn FROM u JOIN t USING (conv_id) WHERE k > h
  UNION ALL SELECT u.conv_id, k, turn FROM u JOIN t ON t.conv_id = u.b WHERE k <= h),
s AS (SELECT u.conv_id, coalesce(list(turn ORDER BY depth) FILTER (turn IS NOT NULL), []) AS s FROM u LEFT JOIN r USING (conv_id) GROUP BY u.conv_id),
m AS (SELECT conv_id, d, s[1:d] AS key, s[1:d - 1] AS up, len(s) AS n FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM s)),
v AS (
  SELECT key, any_value(CASE WHEN d > 0 THEN up END) AS up, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM m GROUP BY key),
k AS (SELECT up AS key, count(*) AS n_children FROM v WHERE depth > 0 GROUP BY up),
w AS (SELECT v.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * length(key[depth].x) ELSE 0 END AS own FROM v LEFT JOIN k USING (key)),
a AS (SELECT key[1:i] AS key, sum(own) AS saved, count(*) FILTER (n_children = 0) AS n_leaves
      FROM (SELECT *, unnest(range(0, depth + 1)) AS i FROM w) GROUP BY 1)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, a.n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, w.ends_sha256
FROM w JOIN a USING (key) LEFT JOIN v AS p ON w.depth > 0 AND p.key = w.up
""",
}
