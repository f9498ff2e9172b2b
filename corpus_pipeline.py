"""The corpus pipeline: five stages, each on all that the one before it kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet
to the shared folder and reads again for the next. All stages but the last return the columns of documents.

Cases, for every stage: an empty table gives an empty one with the same columns. A null text counts as empty, is never toxic, has
no near copies and is packed as its end alone. A row without an id stands after all others where the least id decides. Of
repeated rows, the same id included, one stays after drop_copies; ties go by place in the scan. Other columns ride along
unread. Texts of any length are read whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchwright.llm import common, exact_dedup, ngram_join, packing, suffix_dedup, toxicity

#: Not expressible in SQL: learned scores, byte-level suffix matches and a tokenizer. tests/llm compares with brute force.
ORACLE_SQL = None

TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents with a score of TOXIC and more; the model is fitted on the labelled rows of the table itself."""
    model = toxicity.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where(F.col(common.free("score", docs.columns)) < TOXIC).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space runs, the row of least id stays; all empty and null texts are equal."""
    return exact_dedup.without_copies(docs).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each linked group stays; documents without words are linked with nothing."""
    return ngram_join.without_near_copies(docs).select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that an earlier text holds in 100-byte strings; a character cut in two is dropped whole.

    n_chars follows the new text; every document stays, if only with what is its own.
    """
    carry = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    out = suffix_dedup.suffix_dedup(docs, made=("kept",), carry=carry, decoded=True)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents in sequences, each source by its share of the tokens; see packing.pack for the columns."""
    return packing.pack(docs, *packing.public_vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir; hand-over files lie under the folder that spark.checkpoint.dir names."""
    common.ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
