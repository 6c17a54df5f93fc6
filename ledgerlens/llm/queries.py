"""Registered queries of the operators, with production parameters over their
whole tables. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import chat_format, collocations, decontaminate, exact_dedup, identifiers, language_id, license_scan, near_dedup, passages, periodic_runs, piece_codec, quality, substring_exact
from ledgerlens.llm.common import load

#: Name of the SentencePiece model among the public tokenizers.
PIECE_MODEL = "piece_bpe_32k.model"
#: A document of at least this score is of good quality.
QUALITY_SCORE = 0.7


def held_out(id_col: Column, parts: int, part: int) -> Column:
    """crc32 of the id as text modulo ``parts`` is ``part``; false for null."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == part, F.lit(False))


def piece_model() -> dict:
    import public_tokenizers

    return piece_codec.read_vocabulary(public_tokenizers.path(PIECE_MODEL))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def quality_model(docs: DataFrame, labels: DataFrame):
    return quality.train(docs, labels.select("doc_id", "quality"), ~held_out(F.col("_id"), 4, 2))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = quality_model(docs, load(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= QUALITY_SCORE).cast("int").alias("predicted")
    )


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = piece_codec.encode_and_decode(load(spark, sf_dir, "documents"), piece_model())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_exact.remove_repeats(load(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(F.col("kept"), 256).alias("kept_sha256"),
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(load(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = language_id.train(docs, ~held_out(F.col("_id"), 3, 1))
    return language_id.predict(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(load(spark, sf_dir, "documents"))


#: The contract's extra conversation.
EXTRA_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame(EXTRA_TURNS, "conv_id long, turn long, role string, text string")
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    messages = chat_format.fold_events(chat_format.events_from_turns(turns))
    return chat_format.read_back(chat_format.render(messages))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return exact_dedup.exact_groups(docs, carry={"text_sha256": F.sha2(exact_dedup.normalise(docs["text"]), 256)})


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.near_passages(load(spark, sf_dir, "documents"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's input: where crc32 of the id ends in 0, the words from
    ``a`` on repeat with period ``p``."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    d = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    d = d.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words"))
    a = (F.col("g") % F.col("n")).cast("int")
    p = F.lit(1) + F.floor((F.col("n") - a) / (F.lit(3) + F.col("g") % 8)).cast("int")
    times = F.ceil((F.col("n") - a) / p).cast("int")
    again = F.concat(F.slice("words", F.lit(1), a), F.flatten(F.array_repeat(F.slice("words", a + 1, p), times)))
    planted = F.array_join(F.slice(again, F.lit(1), F.col("n")), " ")
    return d.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), planted).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = periodic_runs.periodic_runs(with_planted_runs(load(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return runs.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        (F.lit(1000) * best["length"]).try_cast("long").alias("_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    ).withColumn("exponent_milli", F.expr("_milli div period")).drop("_milli")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(load(spark, sf_dir, "documents"))


def op13_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_<kind> and base_sha256 are of the plain spans; spans holds all."""
    found = identifiers.find_identifiers(load(spark, sf_dir, "documents"))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    d = found.withColumn("base", F.filter("spans", lambda s: ~s["disguised"]))
    counts = [number(k) for k in identifiers.KINDS]
    return d.select(
        "doc_id",
        *counts,
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_disguised"),
    )


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_quality, op3_pieces, op4_substrings, op5_near_dedup, op6_language, op7_licenses, op8_chat, op9_exact_dedup, op10_passages, op11_runs, op12_collocations, op13_identifiers)}
