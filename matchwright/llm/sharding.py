"""Two-pass external shuffle into shards.

Pass one scatters the records uniformly over buckets, each sized to fit a task's memory, by a seeded hash of the whole
record. Pass two puts each bucket in a canonical order, permutes it by Fisher-Yates from a seed that depends on the bucket
alone, and deals its rows out. A record's global position is its bucket's first position plus its place there, so a
shard, every `shards`-th position, has at most one row more than another, and slots in a shard have no gaps. Everything is
a function of the seed and the rows, so a task that runs again writes the same.

Cases: null texts have size 1; null ids and repeated rows are scattered like any others (identical rows meet in one
bucket only if all their columns are equal; a tie then does not show); empty tables give empty shards; extra columns ride
along, maps and other nested ones too; a text longer than a bucket makes that bucket as large as itself.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchwright.llm.common import MB, free, pieces, text_bytes

ADDED = ("bucket", "place", "shard", "slot")
#: The driver holds the number of rows of each bucket, so many at most.
MAX_BUCKETS = 1 << 20


def _fisher_yates(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).permutation(n)


def _canonical(t: pa.Table, first: list[str]) -> np.ndarray:
    """An order of the rows that depends on their values alone; nested values are ordered as they are written."""
    keys = [c for c in first if c in t.column_names] + [c for c in t.column_names if c not in first]
    plain = {}
    for k, c in enumerate(keys):
        col = t.column(c)
        plain[str(k)] = pa.array([str(v) for v in col.to_pylist()]) if pa.types.is_nested(col.type) else col
    return pc.sort_indices(pa.table(plain), sort_keys=[(k, "ascending") for k in plain]).to_numpy()


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.MapType) or isinstance(kind, T.StructType) and any(_has_map(f.dataType) for f in kind)


def two_pass_shuffle(
    docs: DataFrame, shards: int, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = 8 * MB
) -> DataFrame:
    """All columns of `docs` plus bucket int, place long (in its bucket), shard int and slot long.

    Where `docs` has a column of such a name, the one added gets an underscore.
    """
    bucket_, place_, shard_, slot_ = (free(x, docs.columns) for x in ADDED)
    _, size = text_bytes(docs, text_col)
    buckets = min(MAX_BUCKETS, pieces(size, bucket_bytes, 16))
    values = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if _has_map(f.dataType) else F.col(f"`{f.name}`") for f in docs.schema]  # maps have no hash
    keyed = docs.withColumn(bucket_, F.pmod(F.xxhash64(F.lit(seed), *values), F.lit(buckets)).cast("int"))
    # one number for each bucket, MAX_BUCKETS at most
    counts = np.zeros(buckets + 1, dtype=np.int64)
    for row in keyed.groupBy(bucket_).count().collect():
        counts[row[0] + 1] = row[1]
    first = np.cumsum(counts)
    names = docs.columns
    schema = T.StructType([*keyed.schema.fields, T.StructField(place_, T.LongType()), T.StructField(shard_, T.IntegerType()), T.StructField(slot_, T.LongType())])

    def shuffle(t: pa.Table) -> pa.Table:
        bucket = t.column(bucket_)[0].as_py()
        t = t.take(pa.array(_canonical(t.select(names), [id_col])))
        t = t.take(pa.array(_fisher_yates(t.num_rows, zlib.crc32(f"{seed}:{bucket}".encode()))))
        place = np.arange(t.num_rows, dtype=np.int64)
        at = place + first[bucket]
        return t.append_column(place_, pa.array(place)).append_column(shard_, pa.array((at % shards).astype(np.int32))).append_column(slot_, pa.array(at // shards))

    return keyed.groupBy(bucket_).applyInArrow(shuffle, schema)


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder for each shard; within a file rows stand in slot order."""
    shuffled.repartition("shard", "bucket").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)


def op2_two_pass_shuffle(spark: SparkSession, sf_dir: str, shards: int = 16) -> DataFrame:
    """The law is `rows`: the digests come from the texts as the shards hold them."""
    out = two_pass_shuffle(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"), shards)
    text = F.coalesce(F.col("text"), F.lit(""))
    return out.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
