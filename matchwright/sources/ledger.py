"""A ledger of model replies: a folder of batches, to which replies are only ever added.

A batch is written whole by Spark's committer and counts from the moment its success marker is there, so a task that runs twice
adds nothing twice, and a run that breaks off leaves what it had finished. Replies belong to prompts, by the digest of the
prompt's text: equal prompts are asked once, a changed one is asked anew. Of several replies to a prompt the latest counts
that is not null; a null reply is a failed request and is asked again by the next run.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchwright.operators.staging import written
from matchwright.sources import clients

SCHEMA = "prompt_hash string, reply string, asked_at double, batch string"


def prompt_hash(prompt: Column) -> Column:
    return F.sha2(prompt, 256)


def latest(replies: DataFrame, keys: list[str], reply: str = "reply", at: str | None = None) -> DataFrame:
    """One row for each key: the reply that is not null, the latest by `at` where there is one, then the greatest as text; else null."""
    order = [F.col(reply).isNotNull(), *([F.col(at)] if at else []), F.col(reply)]
    return replies.groupBy(*keys).agg(F.max_by(reply, F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias(reply))


def batches(spark: SparkSession, path: str) -> list[str]:
    """The finished batches, oldest first."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    folders = [s.getPath() for s in files.listStatus(root) if s.isDirectory()]
    done = [p for p in folders if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(p.toString() for p in done)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every reply ever written: prompt_hash, reply, asked_at, batch."""
    found = batches(spark, path)
    return spark.read.schema(SCHEMA).parquet(*found) if found else spark.createDataFrame([], SCHEMA)


def replies(spark: SparkSession, path: str) -> DataFrame:
    """prompt_hash, reply: one row for each prompt that was asked."""
    return latest(read(spark, path), ["prompt_hash"], at="asked_at")


def append(df: DataFrame, path: str) -> str:
    """Writes (prompt_hash, reply) as one batch and returns its folder."""
    now = time.time()
    folder = f"{path}/{int(now * 1000):015d}-{uuid.uuid4().hex[:12]}"
    df.select("prompt_hash", "reply", F.lit(now).alias("asked_at"), F.lit(folder.rsplit("/", 1)[1]).alias("batch")).write.parquet(folder)
    return folder


def ask(
    prompts: DataFrame, path: str, client: Callable[[], Callable[[str], str]], prompt: str = "prompt", waves: int = 1, **limits: object
) -> DataFrame:
    """The rows of `prompts` with `reply`, after asking for every prompt that the ledger at `path` has no reply to.

    What is missing is asked in `waves` batches of about equal size, each of which is kept once it is finished: a run that
    breaks off repeats one wave at most. `limits` go to clients.ask (tasks, threads, per_second, retries, ...).
    """
    spark = prompts.sparkSession
    named = prompts.withColumn("prompt_hash", prompt_hash(F.col(prompt)))
    distinct = named.where(F.col(prompt).isNotNull()).groupBy("prompt_hash").agg(F.first(prompt).alias("prompt"))
    todo = written(clients.missing(distinct, replies(spark, path), ["prompt_hash"]))
    for wave in range(waves):
        part = todo if waves == 1 else todo.where(F.pmod(F.xxhash64("prompt_hash"), F.lit(waves)) == wave)
        if part.take(1):
            append(clients.ask(part, "prompt", "reply", client, **limits), path)
    return named.join(replies(spark, path), "prompt_hash", "left").drop("prompt_hash")
