"""One query per operator, over the whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import (
    chat, decontaminate, exact_dedup, merkle, mixing, near_dedup, pii, quality, secrets, token_counts,
    token_output, trie_bpe, whitening,
)
from marlstone.sources.sinks import work_path
from marlstone.llm.registry import ORACLES, QUERIES, query, table
from marlstone.llm.storage import stored

__all__ = ["ORACLES", "QUERIES"]

TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"
CONTEXT_TOKENS = 1024


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_near_dedup")
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2)
    return found.withColumnRenamed("id", "doc_id")


@query("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op3_token_output")
def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "tokens")
    token_output.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_output.read_tokens(spark, path).withColumnRenamed("id", "doc_id")


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())
    return counts.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens",
        (F.col("n_tokens") > CONTEXT_TOKENS).alias("over_limit"))


@query("op5_exact_dedup", """
WITH norm AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM norm WINDOW g AS (PARTITION BY text_sha256)
""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.duplicates(table(spark, sf_dir, "documents"))
    return found.withColumnsRenamed({"id": "doc_id", "digest": "text_sha256"})


@query("op7_decontamination")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.find_hits(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.report(hits).select(
        F.col("id").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query("op6_source_mixing", """
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, sum(n) OVER () * sqrt(n) / sum(sqrt(n)) OVER () / n AS rate FROM counts),
draws AS (SELECT source, rate, greatest(ceil(rate / 16), 1)::INT AS draws FROM rates),
cdf AS (
  SELECT source, k, sum(exp(-rate / draws + k * ln(rate / draws) - lgamma(k + 1)))
         OVER (PARTITION BY source ORDER BY k) AS c
  FROM draws, range(0, 101) t(k)),
numbers AS (
  SELECT doc_id, d.source, j,
         ('0x' || substr(md5('20240607|' || doc_id || '|' || j), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM documents d JOIN draws USING (source), range(1, draws + 1) t(j)),
copies AS (
  SELECT doc_id, n.source, count(*) AS n
  FROM numbers n JOIN cdf ON cdf.source = n.source AND c <= u GROUP BY doc_id, n.source)
SELECT doc_id, source, copy::INT AS mix_copy, md5('20240607|' || doc_id || '|' || copy || '|order') AS mix_key
FROM copies, range(1, n + 1) t(copy)
""")
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, mixing.source_rates(docs), seed=20240607)
    return mixed.select("doc_id", "source", "mix_copy", "mix_key")


@query("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        own = F.filter("base", lambda s: s["kind"] == kind)
        return F.size(own).cast("bigint").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"), *[count(kind) for kind in pii.KINDS],
        F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"))


@query("op9_chat_format")
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], turns.schema)
    return chat.read_back(stored(chat.format_chats(turns.unionByName(extra)), "chats"))


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, quality.graded(table(spark, sf_dir, "labels")))
    return quality.scores(docs, model).select(
        F.col("id").alias("doc_id"), "expected_grade", "top_probability",
        (F.col("top_probability") >= 0.5).alias("selected"))


@query("op11_merkle_manifest", """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang,
    concat_ws('', CASE WHEN doc_id IS NULL THEN '-' ELSE concat(strlen(CAST(doc_id AS VARCHAR)), ':', doc_id) END,
      CASE WHEN source IS NULL THEN '-' ELSE concat(strlen(source), ':', source) END,
      CASE WHEN lang IS NULL THEN '-' ELSE concat(strlen(lang), ':', lang) END) AS head,
    n_chars, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END AS tail,
    list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(
        string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::UBIGINT)),
      lambda crc, c: list_reduce(
        list_prepend(xor(crc, c), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda r, bit: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::UBIGINT) ELSE r >> 1 END)) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n,
    sha256(concat(head, CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(CAST(n_chars AS VARCHAR)), ':', n_chars) END, tail)) AS leaf,
    CASE WHEN xor(crc, 4294967295::UBIGINT) % 7 = 0 THEN
      sha256(concat(head, CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(CAST(n_chars + 1 AS VARCHAR)), ':', n_chars + 1) END, tail))
    END AS changed
  FROM fields),
nodes AS (
  SELECT lang, 0 AS level, place, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT lang, level + 1, place // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM nodes WHERE n > 1 GROUP BY lang, level, place // 2, n),
subroots AS (
  SELECT lang, digest AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, place, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM tops WHERE n > 1 GROUP BY level, place // 2, n),
steps AS (
  SELECT l.doc_id, l.lang, x.level AS step, (l.place >> x.level) & 1 AS odd, coalesce(s.digest, '') AS sibling
  FROM leaves l JOIN (SELECT DISTINCT lang, level FROM nodes WHERE n > 1) x ON x.lang IS NOT DISTINCT FROM l.lang
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM l.lang AND s.level = x.level AND s.place = xor(l.place >> x.level, 1)
  UNION ALL
  SELECT l.doc_id, l.lang, r.height + x.level, (r.place >> x.level) & 1, coalesce(s.digest, '')
  FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang
  JOIN (SELECT DISTINCT level FROM tops WHERE n > 1) x ON true
  LEFT JOIN tops s ON s.level = x.level AND s.place = xor(r.place >> x.level, 1)),
paths AS (
  SELECT doc_id, lang, list(struct_pack(odd := odd, sibling := sibling) ORDER BY step) AS path,
         sha256(string_agg(sibling, '' ORDER BY step)) AS proof_sha256
  FROM steps GROUP BY doc_id, lang),
folded AS (
  SELECT l.doc_id, l.lang, 0 AS step, coalesce(l.changed, l.leaf) AS digest FROM leaves l
  UNION ALL
  SELECT f.doc_id, f.lang, f.step + 1,
    sha256(CASE WHEN p.path[f.step + 1].odd = 1 THEN concat(p.path[f.step + 1].sibling, f.digest)
                ELSE concat(f.digest, p.path[f.step + 1].sibling) END)
  FROM folded f JOIN paths p ON p.doc_id = f.doc_id AND p.lang IS NOT DISTINCT FROM f.lang WHERE f.step < len(p.path)),
ends AS (SELECT doc_id, lang, arg_max(digest, step) AS folded_root FROM folded GROUP BY doc_id, lang)
SELECT l.doc_id, l.leaf, r.subroot, t.digest AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
       e.folded_root, e.folded_root = t.digest AS verified
FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang JOIN tops t ON t.n = 1
JOIN ends e ON e.doc_id = l.doc_id AND e.lang IS NOT DISTINCT FROM l.lang
LEFT JOIN paths p ON p.doc_id = l.doc_id AND p.lang IS NOT DISTINCT FROM l.lang
""")
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    changed = F.col("n_chars") + F.lit(1)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, merkle.leaf(
        *[changed if name == "n_chars" else F.col(name) for name in merkle.FIELDS]))
    found = merkle.manifest(docs, claim=tampered)
    folded = merkle.fold(F.coalesce("claim", "leaf"), F.col("path"))
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(F.array_join(merkle.siblings(F.col("path")), ""), 256).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


@query("op12_trie_bpe")
def op12_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return trie_bpe.digests(docs, tokenizer_path(WORD_TOKENIZER)).withColumnRenamed("id", "doc_id")


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
