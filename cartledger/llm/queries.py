"""The operators as queries over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartledger.llm import (
    chat, crosspolytope, html, mixing, negatives, nndescent, packing, periodic, quality, sharding, simhash, toxicity, warc,
)
from cartledger.llm.common import WORD, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


#: Nearest vectors of a query; every vector whose id this divides is a query.
NEAREST, QUERY_EVERY = 20, 20


def op2_nndescent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    queries = rows.where(rows["vec_id"] % QUERY_EVERY == 0)
    return nndescent.search(nndescent.build(rows), queries, NEAREST)


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


#: Bytes of text in a shard.
SHARD_LIMIT = 1 << 20


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARD_LIMIT)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_crosspolytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.near_vectors(table(spark, sf_dir, "embeddings"))


#: A conversation that says control strings itself.
CONTROL_CHAT = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(CONTROL_CHAT, "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.segments(rows.union(more)))
    said = F.array_join("loss", "")
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(said).cast("long").alias("loss_chars"),
        F.sha2(said, 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
    )


ANCHOR_EVERY, SHIFTED_EVERY, LABELS = 50, 7, 10


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % SHIFTED_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % ANCHOR_EVERY == 0, label=label)


def repeating(docs: DataFrame) -> DataFrame:
    """(doc_id, text), the text of one key in ten repeating one of its stretches to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    # Columns of their own, as a function over an array would split the text for every word.
    words = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, split).alias("words"))
    n = F.size("words")
    start = words.select("*", F.when(n > 0, F.col("g") % n).alias("a"))
    period = start.select("*", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).alias("p"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    again = F.transform("words", lambda w, i: F.element_at("words", (place(i) + 1).cast("int")))
    return period.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(again, " ")).alias("text"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.detect(repeating(table(spark, sf_dir, "documents")))
    best = periodic.longest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_nndescent": op2_nndescent,
    "op3_html": op3_html,
    "op4_sharding": op4_sharding,
    "op5_toxicity": op5_toxicity,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_warc": op8_warc,
    "op9_mixing": op9_mixing,
    "op10_crosspolytope": op10_crosspolytope,
    "op11_chat": op11_chat,
    "op12_negatives": op12_negatives,
    "op13_periodic": op13_periodic,
}

ORACLE_SQL = {
    "op4_sharding": sharding.SQL.format(limit=SHARD_LIMIT),
    "op9_mixing": mixing.SQL,
    "op11_chat": chat.SQL,
    "op12_negatives": negatives.SQL,
}
