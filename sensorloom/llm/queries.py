"""The queries that apply the operators to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions.once import once

from . import brown, langid, toxicity
from .common import fold, stored, table
from .decontaminate import contaminated
from .hnsw import nearest
from .lexical import build_index, search
from .linededup import without_common_lines
from .minhash import near_duplicates
from .oracles import ORACLES as ORACLES
from .packing import pack
from .periodic import periodic_runs
from .pii import replace_entities
from .suffix import without_repeats
from .unigram import token_counts


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold_of = fold("doc_id", 3)
    model = langid.fit(docs.where(fold_of.isin(0, 2)), "doc_id", "text", "lang")
    rows = docs.select("doc_id", (fold_of == 1).alias("held_out"), "text")
    return langid.predict(rows, model).drop("text")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold_of = fold("doc_id", 7)
    training = docs.where(fold_of.isin(0, 1, 3, 4, 5, 6)).select("doc_id", "text")
    counts = stored(brown.count_words(training), "word_counts")
    model = brown.fit(training, counts)
    rows = docs.select("doc_id", "text", (fold_of == 2).alias("held_out"))
    return brown.score(rows, model, counts)


def op8_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where(F.col("vec_id") % 20 == 0), k=20)


def op9_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold_of = fold("doc_id", 5)
    learn = fold_of.isin(1, 2, 3, 4)
    labels = table(spark, sf_dir, "labels").where(learn)
    model = toxicity.fit(docs, labels, "doc_id", "text", "toxic")
    rows = docs.select("doc_id", "text", (fold_of == 0).alias("held_out"))
    return toxicity.score(rows, model, keep=("held_out",))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op12_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_common_lines(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs(with_repeated_tails(table(spark, sf_dir, "documents")))
    # The longest run; of equal ones the first, then the one with the least period.
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"]))
    )
    length, start, period = longest["length"], -longest["col2"], -longest["col3"]
    line = F.transform(
        "runs",
        lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")),
    )
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.concat_ws("", line).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; in one document of ten, chosen by its id, the words from one place on
    repeat with a period, both taken from the id as the query's contract says."""
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), (h % 10 == 0).alias("odd"))
    found = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    words = once(chosen, words=F.when(F.col("odd"), found))
    n = F.size("words")
    placed = words.withColumn("a", F.col("g") % n).withColumn(
        "p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))
    )
    repeated = F.expr(
        "transform(sequence(0L, size(words) - 1L), "
        "i -> words[cast(if(i < a, i, a + (i - a) % p) as int)])"
    )
    tail = F.when(F.col("odd") & (n > 0), F.concat_ws(" ", repeated)).otherwise(F.col("text"))
    return placed.select("doc_id", tail.alias("text"))


QUERIES = {
    "op1_pack": op1_pack,
    "op2_langid": op2_langid,
    "op3_decontaminate": op3_decontaminate,
    "op4_pii": op4_pii,
    "op5_unigram": op5_unigram,
    "op6_minhash": op6_minhash,
    "op7_brown": op7_brown,
    "op8_hnsw": op8_hnsw,
    "op9_suffix": op9_suffix,
    "op10_toxicity": op10_toxicity,
    "op11_lexical": op11_lexical,
    "op12_linededup": op12_linededup,
    "op13_periodic": op13_periodic,
}
