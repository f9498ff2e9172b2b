"""Quality rules as a bitmask ledger, in built-in functions only.

Every rule is evaluated once. The ledger keeps, for each document, the measurements and one integer whose bit k says that
rule k failed. A policy is a versioned mask: a document passes when `failures & mask = 0`, so new policies, their
differences and each rule's ablation (how many documents only this rule rejects) are bit operations on the small
ledger and never touch the text again.

Cases: a null text has no words; a null id is carried as it is; empty tables give empty ledgers; other columns are not
read; repeated rows get a row each; a text of any length is measured in one row's expressions, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
#: Version 1 has the two base rules alone; version 2 adds rules that only plain junk fails.
POLICIES = {1: 0b000011, 2: 0b111111}


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: str


#: Every rule is an integer comparison on measurements, so that any engine gets the same bit.
RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "n_symbols > n_words"),
    Rule(3, "repeated_lines", "n_lines >= 4 and 2 * n_dup_lines > n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 40 * n_words"),
)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words).

    Windows that all differ, as in nearly every text, end at the comparison of two counts. Otherwise windows are sorted
    with their positions, those equal to a neighbour give their position, and each adds the words up to the next.
    """
    t = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    t = t.select(
        id_col,
        "t",
        F.filter(F.split("t", SPACE + "+"), lambda w: w != "").alias("words"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    t = t.select(
        id_col,
        F.size("words").cast("long").alias("n_words"),
        (F.length("t") - F.regexp_count("t", F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    window = F.when(
        F.size("h") >= 5,
        F.transform(
            F.slice("h", 1, F.greatest(F.size("h") - 4, F.lit(0))),
            lambda x, i: F.xxhash64(x, *[F.get(F.col("h"), i + k) for k in range(1, 5)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    t = t.withColumn("w", window).drop("h")
    t = t.withColumn("w", F.when(F.size(F.array_distinct("w")) < F.size("w"), F.col("w")))
    t = t.withColumn("spot", F.when(F.col("w").isNotNull(), F.array_sort(F.transform("w", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("w")
    twice = F.array_sort(
        F.filter(
            F.transform(
                "spot",
                lambda x, i: F.when(
                    (F.get(F.col("spot"), i - 1)["h"] == x["h"]) | (F.get(F.col("spot"), i + 1)["h"] == x["h"]), x["i"]
                ),
            ),
            lambda x: x.isNotNull(),
        )
    )
    t = t.withColumn("twice", twice).drop("spot")
    covered = F.aggregate(
        F.transform("twice", lambda x, i: F.least(F.lit(5), F.coalesce(F.get(F.col("twice"), i + 1) - x, F.lit(5)))),
        F.lit(0),
        lambda a, x: a + x,
    )
    return t.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("twice")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements and `failures`, bit k of which is set when rule k fails."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in RULES]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    return measure(docs, id_col, text_col).withColumn("failures", mask)


def passes(version: int, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(F.lit(POLICIES[version])) == 0


def ablations(rows: DataFrame, version: int) -> DataFrame:
    """For each rule of a policy: documents that fail it, and those that only it rejects."""
    mask = POLICIES[version]
    rules = rows.sparkSession.createDataFrame([(r.bit, r.name, 1 << r.bit) for r in RULES if mask >> r.bit & 1], "bit int, rule string, flag int")
    failed = rows.select(F.col("failures").bitwiseAND(F.lit(mask)).alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    hit = F.col("f").bitwiseAND(F.col("flag")) != 0
    return rules.join(failed, hit, "left").groupBy("bit", "rule").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_failed"), F.coalesce(F.sum(F.when(F.col("f") == F.col("flag"), F.col("n"))), F.lit(0)).alias("n_only")
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str, version: int = 2) -> DataFrame:
    rows = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("failures").bitwiseAND(F.lit(POLICIES[1])) != 0).alias("base_failed"),
        passes(version).alias("kept"),
        "n_lines",
        "failures",
    )


OP10_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT doc_id, i, words[i:i+4] AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n FROM
  (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines
  FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
f AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
  + (CASE WHEN n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
  + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 40 * n_words THEN 32 ELSE 0 END) AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & 3 <> 0 AS base_failed, failures = 0 AS kept,
  n_lines, failures::INTEGER AS failures FROM f
"""
