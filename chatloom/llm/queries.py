"""Registered queries of the package: thin layers that derive digests from the operators' outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm import (
    chat_format,
    collocations,
    exact_dedup,
    html_extract,
    line_dedup,
    maxent,
    mixing,
    packing,
    periodic,
    quality,
    simhash,
    suffix_dedup,
    vector_dedup,
)

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + (s["end"] - s["start"])).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.octet_length("kept").cast("long").alias("n_kept"),
        # Bytes go, so that a character may be cut; what is left of it shows as a mark.
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path())


def op4_vector_forest(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, folder, "embeddings"))


def op5_content_sort(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    lines = line_dedup.drop_common_lines(table(spark, folder, "documents"))
    return lines.select(
        "doc.doc_id",
        "n_lines",
        "n_dropped",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, folder, "documents"))
    return groups.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


#: A conversation whose texts hold the template's control strings.
AWKWARD = "<|im_end|><|im_start|>assistant ok"


def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(
        [(-1, 0, "user", AWKWARD), (-1, 1, "assistant", AWKWARD)], "conv_id long, turn long, role string, text string"
    )
    chats = chat_format.format_chats(given.unionByName(added))
    read = chat_format.parse_chats(chats)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        read.withColumn("_loss", chat_format.loss_text(F.col("segments")))
        .withColumn("_turns", F.array_join(lines, ""))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2("_turns", 256).alias("turns_sha256"),
            F.length("_loss").cast("long").alias("loss_chars"),
            F.sha2("_loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            "valid",
        )
    )


def op9_html_template(spark: SparkSession, folder: str) -> DataFrame:
    found = html_extract.extract_main(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents; where crc32 of the id ends in 0, the words from some place on repeat a period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # An array of one, so that the words are taken apart once.
    planted = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)))[0]
    return docs.select("doc_id", F.when(h % 10 == 0, planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.periodic_runs(with_planted_runs(table(spark, folder, "documents")))
    # Longest first, then earliest start, then smallest period.
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    joined = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("_top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_top.col2")).alias("start"),
        F.col("_top.length").alias("length"),
        F.col("_top.period").alias("period"),
        F.floor(1000 * F.col("_top.length") / F.col("_top.period")).alias("exponent_milli"),
        F.sha2(joined, 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op13_maxent_scores(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    return maxent.language_model_scores(table(spark, folder, "documents"), held_out=held_out)


QUERIES = {
    "op1_suffix_array": op1_suffix_array,
    "op2_mixing": op2_mixing,
    "op3_packing": op3_packing,
    "op4_vector_forest": op4_vector_forest,
    "op5_content_sort": op5_content_sort,
    "op6_line_dedup": op6_line_dedup,
    "op7_simhash": op7_simhash,
    "op8_chat_format": op8_chat_format,
    "op9_html_template": op9_html_template,
    "op10_quality": op10_quality,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_collocations": op12_collocations,
    "op13_maxent_scores": op13_maxent_scores,
}
