"""The registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardlens.llm import (
    byte_bpe, chat, decontaminate, licences, manifest, negatives, neighbours, quality, sharding, simhash, suffix_dedup,
    token_files, warc,
)
from cardlens.session import shared_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    path = shared_path(spark, "token-files")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path, tokenizer, end_id=1)
    return token_files.read_token_files(spark, path).select(
        "doc_id", "start", F.expr("CAST(octet_length(ids) div 4 AS BIGINT)").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.encode_and_decode(documents, ranks, public_tokenizers.PATTERN).select(
        "doc_id", F.expr("CAST(octet_length(ids) div 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled into 40 shards of equal counts, read back."""
    path = shared_path(spark, "shards")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16
    sharding.shuffle_to(_table(spark, sf_dir, "documents").withColumn("size", size), path, "size", seed=42)
    rows = sharding.read_shards(spark, path, 40).select("row.doc_id", "row.size", "row.text", "shard", "slot")
    return rows.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the components of those that differ in at most 4 bits."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that documents hold, exact or paraphrased."""
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), every=50, k=5)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted and read back."""
    path = shared_path(spark, "chat")
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string"
    )
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    chat.format_conversations(given).write.parquet(path)
    return chat.read_conversations(spark.read.parquet(path))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality by a network trained on labels that are not held out."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    net = quality.train(documents, _table(spark, sf_dir, "labels"))
    return quality.add_score(documents, net).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence notices that documents hold."""
    return licences.scan(_table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive of all pages, read back."""
    path = shared_path(spark, "archive")
    warc.write_archive(_table(spark, sf_dir, "pages"), path, least=1000)
    return warc.read_archive(spark, path).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type",
        "refers_to",
    )


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof in a Merkle manifest, and what it says of documents whose text was changed."""
    documents = _table(spark, sf_dir, "documents")
    capitals = string.ascii_uppercase
    changed = F.translate("text", capitals, capitals.lower())

    def leaf(text: Column) -> Column:
        return manifest.row_hash([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text])

    forged = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, leaf(changed))
    rows = documents.select("doc_id", "lang", leaf(F.col("text")).alias("leaf"), forged.alias("forged"))
    path = F.col("path")
    proven = manifest.prove(rows).select(
        "row.doc_id", "row.leaf", "subroot", "root", F.sha2(manifest.siblings(path), 256).alias("proof_sha256"),
        manifest.folded(F.coalesce("row.forged", "row.leaf"), path).alias("folded_root"),
    )
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, the labels of every seventh moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the strings of 400 bytes that occur twice."""
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), least=400)
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES = {
    q.__name__: q for q in (
        op1_token_files, op2_byte_bpe, op3_shards, op4_simhash, op5_decontaminate, op6_neighbours, op7_chat,
        op8_quality, op9_licences, op10_warc, op11_manifest, op12_negatives, op13_suffix_dedup,
    )
}


def _manifest_sql(levels: int = 9, group_levels: int = 4) -> str:
    """The manifest of up to ``8 ** levels`` documents a language, level by level."""

    def leaf(text: str) -> str:
        fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
        return "SHA256(" + " || ".join(f"COALESCE(OCTET_LENGTH(ENCODE({f})) || ':' || {f}, '-')" for f in fields) + ")"

    # CRC-32 of the decimal id: for each byte eight steps of the reflected polynomial (a fixed value).
    bytes_of = "LIST_TRANSFORM(STRING_SPLIT(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ASCII(c) AS BIGINT))"
    bit = "LIST_REDUCE(RANGE(8), lambda x, i: XOR(x >> 1, 3988292384 * (x & 1)), XOR(c, b))"
    crc = f"XOR(LIST_REDUCE({bytes_of}, lambda c, b: {bit}, CAST(4294967295 AS BIGINT)), 4294967295)"
    lower = "TRANSLATE(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def tree(name: str, steps: int) -> str:
        """Of the nodes ``<name>0 (g, i, n, h)``: what stands left and right of each, and the next level."""
        run = "PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN"
        return ", ".join(f"""
            {name}{k}s AS MATERIALIZED (SELECT *,
                COALESCE(STRING_AGG(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                COALESCE(STRING_AGG(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k}),
            {name}{k + 1} AS MATERIALIZED (SELECT g, i // 8 AS i, (n + 7) // 8 AS n,
                CASE WHEN n > 1 THEN SHA256(STRING_AGG(h, '' ORDER BY i)) ELSE MIN(h) END AS h FROM {name}{k} GROUP BY g, i // 8, n)"""
            for k in range(steps))

    def fold(name: str, steps: int, start: str, on: str) -> str:
        """``f`` and the siblings ``p`` of each document, carried up ``steps`` levels."""
        return ", ".join(f"""
            {name}f{k + 1} AS MATERIALIZED (SELECT d.* REPLACE (
                CASE WHEN s.n > 1 THEN SHA256(s.l || d.f || s.r) ELSE d.f END AS f,
                CASE WHEN s.n > 1 THEN d.p || s.l || s.r ELSE d.p END AS p)
            FROM {start if k == 0 else f'{name}f{k}'} d JOIN {name}{k}s s ON {on.format(8 ** k)})"""
            for k in range(steps))

    return f"""
        WITH marked AS (SELECT doc_id, lang, {leaf('text')} AS leaf,
                CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS f FROM documents),
            d AS MATERIALIZED (SELECT *, COALESCE('.' || lang, '') AS g, '' AS p,
                ROW_NUMBER() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, COUNT(*) OVER (PARTITION BY lang) AS n
                FROM marked),
            a0 AS MATERIALIZED (SELECT g, i, n, leaf AS h FROM d), {tree('a', levels)},
            t AS MATERIALIZED (SELECT g AS own, h AS subroot, ROW_NUMBER() OVER (ORDER BY ENCODE(g)) - 1 AS place FROM a{levels}),
            b0 AS MATERIALIZED (SELECT 0 AS g, place AS i, COUNT(*) OVER () AS n, subroot AS h FROM t), {tree('b', group_levels)},
            {fold('a', levels, 'd', 'd.g = s.g AND d.i // {} = s.i')},
            e AS MATERIALIZED (SELECT * FROM af{levels} JOIN t ON g = own),
            {fold('b', group_levels, 'e', 'd.place // {} = s.i')}
        SELECT doc_id, leaf, subroot, root.h AS root, SHA256(p) AS proof_sha256, f AS folded_root, f = root.h AS verified
        FROM bf{group_levels}, b{group_levels} root"""


ORACLES = {
    # The template's control strings take 8, 8 and 7 characters a turn, and each "<" or "[" one more.
    "op7_chat": """
        WITH c AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
                   UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
             t AS (SELECT *, CASE WHEN role = 'assistant' THEN text END AS learned, role || text AS own FROM c)
        SELECT conv_id, COUNT(*) AS n_turns,
               SHA256(STRING_AGG(role || CHR(10) || text || CHR(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               CAST(COALESCE(SUM(LENGTH(learned)), 0) AS BIGINT) AS loss_chars,
               SHA256(COALESCE(STRING_AGG(learned, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
               CAST(SUM(23 + 2 * LENGTH(own) - LENGTH(REPLACE(REPLACE(own, '<', ''), '[', ''))) AS BIGINT) AS formatted_chars
        FROM t GROUP BY conv_id""",
    "op11_manifest": _manifest_sql(),
    "op12_negatives": """
        WITH v AS (SELECT ROW_NUMBER() OVER () AS row, vec_id, LEN(embedding) AS dims,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   LIST_TRANSFORM(embedding, lambda x: FLOOR(256 * CAST(x AS DOUBLE))) AS c
                   FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                   AND LEN(LIST_FILTER(embedding, lambda x: x IS NULL OR NOT ISFINITE(x))) = 0),
             s AS MATERIALIZED (SELECT a.row AS a, a.vec_id AS anchor_id, b.row AS b, b.vec_id, a.label = b.label AS alike,
                   CAST(LIST_INNER_PRODUCT(a.c, b.c) AS BIGINT) AS score
                   FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.row <> b.row AND a.dims = b.dims),
             p AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY a ORDER BY score DESC, vec_id, b) AS turn FROM s WHERE alike),
             n AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
                   CAST(ROW_NUMBER() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.vec_id, s.b) AS INTEGER) AS rank
                   FROM p JOIN s ON p.turn <= 5 AND p.a = s.a AND NOT s.alike
                   AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
    "op10_warc": """
        WITH p AS (SELECT page_id, ENCODE(COALESCE(html, '')) AS payload FROM pages),
             d AS (SELECT page_id, CAST(OCTET_LENGTH(payload) AS BIGINT) AS payload_bytes, SHA1(payload) AS payload_digest FROM p),
             o AS (SELECT payload_digest, payload_bytes, MAX(page_id) AS owner FROM d GROUP BY ALL)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes < 1000 OR page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN payload_bytes < 1000 OR page_id = owner THEN NULL ELSE owner END AS refers_to
        FROM d JOIN o USING (payload_digest, payload_bytes)""",
}
