"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, chat_repair, exact_dedup, hard_negatives, langid, mixing, ngram_join, order_minhash, packing, pii, sharding, token_binary, token_counts
from tidemark.llm.common import scratch_root


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document before and after three splices."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    trees = token_counts.build(docs, added=True).withColumn("edits", token_counts.sample_edits(F.char_length(text), text))
    out = token_counts.apply_edits(trees, added=True)
    return out.withColumn("edited_sha256", F.sha2("edited_text", 256)).drop("edited_text")


def op2_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_root(spark)
    manifest = token_binary.write_tokens(documents(spark, sf_dir), folder, added=True)
    back = token_binary.read_tokens(spark, folder, manifest)
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir), n=4, percent=85)


def op5_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = sharding.byte_shards(documents(spark, sf_dir), 24)
    return cut.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the readings of the mix, in training order, add up to for each document."""
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "position", "readings", "last_position", "first_place", "last_place")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.fit(langid.learnable(docs))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), added=True)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = order_minhash.fingerprints(documents(spark, sf_dir))
    return found.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(documents(spark, sf_dir))
    name = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda spans: F.concat_ws(",", F.transform(spans, name))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op11_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged, copies = chat_repair.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return chat_repair.repaired_hashes(damaged, copies)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.encode(documents(spark, sf_dir), back=True)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_token_counts, op2_token_binary, op3_exact_dedup, op4_ngram_join, op5_byte_shards, op6_mixing, op7_language_id, op8_packing, op9_order_minhash, op10_pii, op11_chat_repair, op12_byte_bpe, op13_hard_negatives)
}

#: Texts without white space, in DuckDB.
NORMALISED = "regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')"

ORACLE: dict[str, str] = {
    "op3_exact_dedup": f"""
        with t as (select doc_id, length(coalesce(text, '')) as n_cp, {NORMALISED} as norm from documents)
        select doc_id,
               first(doc_id) over g as keep_id,
               count(*) over (partition by norm) as group_size,
               row_number() over g = 1 as kept,
               sha256(norm) as text_sha256
        from t window g as (partition by norm order by n_cp desc, doc_id)
    """,
    "op4_ngram_join": """
        with recursive words as (
            select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
            from documents),
        sets as (
            select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
                   else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) end as s
            from words),
        sizes as (select doc_id, len(s) as n from sets),
        grams as (select doc_id, unnest(s) as g from sets),
        shared as (
            select x.doc_id as a, y.doc_id as b, count(*) as m from grams x join grams y on x.g = y.g and x.doc_id <> y.doc_id group by all),
        links as (
            select a, b from shared join sizes p on p.doc_id = a join sizes q on q.doc_id = b where 100 * m >= 85 * (p.n + q.n - m)),
        reach(doc_id, c) as (
            select doc_id, doc_id from sizes
            union
            select l.b, r.c from reach r join links l on l.a = r.doc_id)
        select s.doc_id, s.n::bigint as n_shingles, min(r.c) as component_id
        from sizes s join reach r on r.doc_id = s.doc_id group by all
    """,
}
