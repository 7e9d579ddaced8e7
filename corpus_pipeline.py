"""From documents to token ids in five stages, each by one operator of ``millrace.llm``.

Every stage takes all rows that its predecessor kept and returns the columns of documents, but for
the last, which returns the ids. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.fmindex import contamination, is_contaminated
from millrace.llm.langid import fit, identify
from millrace.llm.linededup import drop_repeated_lines
from millrace.llm.prefix_bpe import encode_documents
from millrace.llm.queries import held_out
from millrace.llm.setjoin import similar_groups
from millrace.llm.shared import Stored, smaller_batches

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: The languages that go on (None: all that the labelled documents have), and the least posterior of a document's own.
LANGUAGES: tuple[str, ...] | None = None
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str, languages: tuple[str, ...] | None = LANGUAGES, least_score: float = LEAST_SCORE) -> DataFrame:
    """Documents whose text is in one of ``languages`` with a posterior of ``least_score`` or more.

    Both are judged by the text alone: a wrong label neither saves nor costs a document. Null texts and those without a
    letter have no language and go.
    """
    smaller_batches(spark)
    model = fit(docs, public_tokenizers.path("piece_bpe_32k.model"), ~held_out())
    found = identify(docs, model, keep=COLUMNS).where((F.col("lang_pred") != "und") & (F.col("score") >= least_score))
    return (found if languages is None else found.where(F.col("lang_pred").isin(*languages))).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three-line windows; documents of which nothing is left go."""
    out = drop_repeated_lines(docs, width=3, keep=["lang", "source"])
    out = out.where("not (n_removed > 0 and n_removed = n_lines)")
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more): the one of least id.

    A document is known by its id and its text, so rows that share an id but not a text are judged apart; of rows that
    share both, one stays. Rows without an id stay where their whole group has none. Documents without words are in
    no group and stay.
    """
    smaller_batches(spark)
    name = F.struct(F.col("doc_id").isNull().alias("absent"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    named = docs.select(*COLUMNS).withColumn("_name", name)
    groups = similar_groups(named, k=5, percent=80, key="_name")
    first = groups.where("n_shingles = 0 or _name = component_id").select("_name").distinct()
    return named.join(first, "_name", "left_semi").dropDuplicates(["_name"]).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are in 13-word phrases of benchmark items."""
    smaller_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, items, width=13, keep=COLUMNS).where(~is_contaminated()).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): byte-level BPE ids, and the text decoded from them."""
    smaller_batches(spark)
    e = encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)
    return e.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: The first and the last stage have no SQL form; the tests compare run() with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = Stored(docs, name).df
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
