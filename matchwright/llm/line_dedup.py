"""Line de-duplication by overlapping three-line windows, in built-in functions only.

Every three consecutive lines of a text make a window, identified by two independent 64-bit hashes of its lines. Windows
that occur twice or more anywhere are found by one aggregation with partial sums; of each, all occurrences but the
first (least id, then place in the scan, then position) are removed, and the positions that a text's removed windows cover are
merged in one pass over their sorted starts. Repeated windows are joined back over `salts` keys, so a window that a
third of all documents hold is dealt over that many tasks.

Cases: a null text stays null and has no lines; texts of fewer than three lines have no window; windows of blank lines
alone do not count; repeated rows lose the windows of all but the first; null ids stand last. Empty tables give empty results;
columns other than id and text are not read. `docs` must be a table scan or otherwise stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "_row"


def _windows(named: DataFrame, size: int) -> DataFrame:
    lines = named.select(ROW, "id", F.transform(F.split("text", "\n"), lambda x: F.struct(F.xxhash64(F.lit(1), x).alias("a"), F.xxhash64(F.lit(2), x).alias("b"), x.rlike(r"[^\x20\x09-\x0D]").alias("w"))).alias("lines"))
    lines = lines.where(F.size("lines") >= size)
    at = lambda i, k, part: F.get(F.col("lines"), i + k)[part]
    made = F.transform(
        F.sequence(F.lit(0), F.size("lines") - size),
        lambda i: F.struct(
            i.alias("pos"),
            F.xxhash64(F.lit(11), *[at(i, k, "a") for k in range(size)]).alias("h1"),
            F.xxhash64(F.lit(12), *[at(i, k, "b") for k in range(size)]).alias("h2"),
            F.greatest(*[at(i, k, "w") for k in range(size)]).alias("word"),
        ),
    )
    each = lines.select(ROW, "id", F.explode(made).alias("x"))
    return each.where("x.word").select(ROW, "id", F.col("x.pos").alias("pos"), F.col("x.h1").alias("h1"), F.col("x.h2").alias("h2"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, salts: int = 16) -> DataFrame:
    """id, n_lines long, n_removed long, kept_text string."""
    named = docs.select(F.monotonically_increasing_id().alias(ROW), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    windows = _windows(named, size)
    place = F.struct(F.col("id").isNull().alias("none"), "id", ROW, "pos")
    again = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = again.select("h1", "h2", F.col(f"first.{ROW}").alias("first_row"), F.col("first.pos").alias("first_pos"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    later = windows.withColumn("salt", F.pmod(F.xxhash64(ROW), F.lit(salts)).cast("int")).join(again, ["h1", "h2", "salt"])
    later = later.where((F.col(ROW) != F.col("first_row")) | (F.col("pos") != F.col("first_pos")))
    gone = later.groupBy(F.col(ROW).alias("_gone")).agg(F.array_sort(F.collect_set("pos")).alias("starts"))
    both = named.join(gone, F.col(ROW) == F.col("_gone"), "left").withColumn("lines", F.split("text", "\n"))
    ends = F.concat(F.array(F.lit(-size)), F.col("starts"), F.array(F.size("lines")))
    kept = F.flatten(
        F.transform(
            F.slice("ends", 1, F.size("ends") - 1),
            lambda a, i: F.slice(F.col("lines"), a + size + 1, F.greatest(F.lit(0), F.get(F.col("ends"), i + 1) - a - size)),
        )
    )
    both = both.withColumn("ends", F.when(F.col("starts").isNotNull(), ends))
    both = both.withColumn("kept", F.when(F.col("ends").isNotNull(), kept).otherwise(F.col("lines")))
    return both.select(
        F.col("id").alias(id_col),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
        F.array_join("kept", "\n").alias("kept_text"),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null text counts as empty here, as in OP4_SQL."""
    out = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS pos FROM d),
w AS (SELECT doc_id, pos, line AS a, lead(line, 1) OVER o AS b, lead(line, 2) OVER o AS c FROM l WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
v AS (SELECT * FROM w WHERE c IS NOT NULL AND regexp_matches(a || b || c, '[^\x20\x09-\x0D]')),
r AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS k FROM v) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM r, (SELECT unnest([0, 1, 2]) AS k)),
kept AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.pos) AS t, count(*) AS n FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos
  WHERE g.doc_id IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
