"""The two phases as stages that are kept: a stage runs only where its inputs or its settings are new.

Each stage's table lies under the fingerprints of its inputs and the settings it reads. A note is written after the table; a
stage whose note is there is read, not run, so a run that breaks off goes on where it stopped, and a changed threshold runs
again from the stage that reads it.
"""

from __future__ import annotations

import dataclasses
import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from matchwright.operators import cleaning, matching
from matchwright.operators.nearest import topk
from matchwright.operators.staging import fingerprint, read_note, write_note
from matchwright.plans.policy import CatalogConfig, Policy

#: Part of every fingerprint: raised when a stage's meaning changes.
VERSION = 1


@dataclass(frozen=True)
class Kept:
    """A table and the digest of all that it depends on."""

    df: DataFrame
    digest: str


@dataclass
class Runner:
    spark: SparkSession
    folder: str
    #: What this runner did: (stage, "run" or "read", rows).
    log: list[tuple[str, str, int]] = field(default_factory=list)

    def source(self, df: DataFrame) -> Kept:
        """An input table: its digest is that of its rows, in any order."""
        return Kept(df, _digest(sorted(df.columns), fingerprint(df, *sorted(df.columns))))

    def stage(self, name: str, inputs: list[Kept], settings: object, build: Callable[..., DataFrame]) -> Kept:
        """The table of `build` on the inputs' tables, from the folder if it is there."""
        digest = _digest(VERSION, name, [k.digest for k in inputs], settings)
        path, note = f"{self.folder}/{name}/{digest}", f"{self.folder}/{name}/{digest}.json"
        known = read_note(self.spark, note)
        if known is None:
            seen = Observation()
            build(*[k.df for k in inputs]).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
            known = {"stage": name, "settings": settings, "rows": seen.get.get("rows", 0)}
            write_note(self.spark, note, known)
            self.log.append((name, "run", known["rows"]))
        else:
            self.log.append((name, "read", known["rows"]))
        return Kept(self.spark.read.parquet(path), digest)


def _digest(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()[:32]


def some(policy: Policy, *names: str) -> dict:
    """The settings of a policy that a stage reads."""
    every = dataclasses.asdict(policy)
    return {n: every[n] for n in names}


def clean(runner: Runner, raw: Kept, config: CatalogConfig, replies: Kept, policy: Policy = Policy()) -> Kept:
    """Phase one of one side in stages: rules, records, fusion."""
    l0 = runner.stage(f"rules-{config.side}", [raw], dataclasses.asdict(config), lambda df: cleaning.l0_clean(df, config))
    how = {"id": config.product_id, **some(policy, "skip_simple_rows")}
    l1 = runner.stage(f"records-{config.side}", [l0, replies], how, lambda df, r: cleaning.l1_clean(df, r, config.product_id, policy.skip_simple_rows))
    return runner.stage(f"fusion-{config.side}", [l1], {}, cleaning.l2_clean)


def match(
    runner: Runner, a: Kept, b: Kept, policy: Policy = Policy(), review: Callable[[DataFrame], DataFrame] | None = None, similarity: Callable = lambda c: c, review_name: str = ""
) -> Kept:
    """Phase two in stages: candidates, scores, matches, review, final list. `review_name` tells one review from another."""

    def near(x: DataFrame, y: DataFrame) -> DataFrame:
        return topk(x, y, policy.k).withColumn("similarity", similarity(F.col("similarity")))

    found = runner.stage("candidates", [a, b], {**some(policy, "k"), "similarity": getattr(similarity, "__name__", "")}, near)
    scored = runner.stage("scores", [found, a, b], some(policy, "weights", "number"), lambda c, x, y: matching.score(matching.attach(c, x, y), policy))
    rules = some(policy, "min_score", "min_embedding", "min_category", "relax", "number")
    kept = runner.stage("matches", [scored], rules, lambda s: matching.matches(s, policy))
    if review is None:
        return runner.stage("final", [kept], {}, lambda k: k.withColumns({"bb_id_A": F.col("a_id"), "bb_id_B": F.col("b_id")}))
    how = {**some(policy, "band", "band_limit", "number"), "review": review_name}
    told = runner.stage("reviews", [kept], how, lambda k: review(matching.review_band(k, policy)))
    return runner.stage("final", [kept, told], {}, matching.final_matches)
