"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, benchmark
decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept and
returns a DataFrame, which ``run`` writes as Parquet under the shared checkpoint folder
and reads again as the next stage's ``docs``. All but the last return the columns of
``documents``; the last adds token ids and digests to ``doc_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm.bpe import encode_decode
from ferry.llm.decontam import decontaminated
from ferry.llm.linededup import line_dedup
from ferry.llm.neardup import near_duplicates
from ferry.llm.quality import passing
from ferry.session import fresh_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, as they are."""
    return passing(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated multi-line chunks; ``n_chars`` follows the text. A
    document of which nothing but white space is left goes; untouched ones stay as they are."""
    names = docs.columns
    rows = line_dedup(docs).where((F.col("n_removed_lines") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in names:
        changed = F.when(F.col("n_removed_lines") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        rows = rows.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")))
    return rows.select(*names)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each near-duplicate component. Rows with a null id, which no
    component can hold, stay; of rows that repeat an id all stay or go."""
    gone = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's byte-level BPE ids, and digests of them and of the bytes they decode to."""
    import public_tokenizers

    return encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).drop("decoded")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", without_repeated_lines),
    ("MinHash near-dedup", one_of_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", tokenized),
]

#: Near duplicates and BPE are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = fresh_dir(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
