"""Tables that a plan writes for itself, in the folder that driver and executors share."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; only a local master gets a temporary one where none is named."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", "")
        if not named and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="shared-"))
    return context.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """The rows, written once: their lineage runs once, their partitions and order stay as they are, a lost executor costs nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def _place(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def write_note(spark: SparkSession, path: str, note: dict) -> None:
    """A small JSON file beside a table, where the table itself lies: written under another name, then renamed."""
    at, files = _place(spark, path)
    draft, _ = _place(spark, f"{path}.{uuid.uuid4().hex}")
    out = files.create(draft, True)
    out.write(bytearray(json.dumps(note, sort_keys=True).encode()))
    out.close()
    files.delete(at, False)
    if not files.rename(draft, at):
        raise OSError(f"{draft.toString()} could not become {path}")


def read_note(spark: SparkSession, path: str) -> dict | None:
    """What write_note wrote, or None."""
    at, files = _place(spark, path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def fingerprint(df: DataFrame, *columns: str) -> dict[str, str]:
    """Count, sum and exclusive or of row hashes: equal for equal rows in any order, and in all likelihood for no others."""
    h = F.xxhash64(*(columns or df.columns))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s"), F.bit_xor(h).alias("x")).first()
    return {"rows": str(row.n), "sum": str(row.s or 0), "xor": str(row.x or 0)}
