"""The two phases as plans; see runner for the same in stages that are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.operators import cleaning, matching
from matchwright.operators.staging import written
from matchwright.plans.policy import CatalogConfig, Policy
from matchwright.sources import ledger

Client = Callable[[], Callable[[str], str]]


def clean(raw: DataFrame, config: CatalogConfig, replies: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Phase one of one side: rules, stored replies (id, reply) for the hard rows, fusion."""
    return cleaning.l2_clean(cleaning.l1_clean(cleaning.l0_clean(raw, config), replies, config.product_id, policy.skip_simple_rows))


def ask_replies(raw: DataFrame, config: CatalogConfig, client: Client, path: str, waves: int = 1, policy: Policy = Policy(), **limits: object) -> DataFrame:
    """(id, reply) for the hard rows of a side: those that the ledger at `path` has no reply to are asked, all are read from it."""
    l0 = cleaning.l0_clean(raw, config)
    hard = l0.where(F.coalesce(cleaning.needs_model(l0, policy.skip_simple_rows), F.lit(True)))
    asked = hard.select(config.product_id, cleaning.clean_prompt(l0, config.side, config.product_id).alias("prompt"))
    return ledger.ask(asked, path, client, waves=waves, **limits).drop("prompt")


def ask_reviews(band: DataFrame, client: Client, path: str, waves: int = 1, **limits: object) -> DataFrame:
    """(a_id, b_id, reply) for the band's pairs, from the ledger at `path` after asking for what it lacks; see matching.review_decode."""
    asked = band.select("a_id", "b_id", matching.review_prompt(band).alias("prompt"))
    return ledger.ask(asked, path, client, waves=waves, **limits).drop("prompt")


def candidates(a: DataFrame, b: DataFrame, policy: Policy = Policy(), similarity: Callable = lambda c: c) -> DataFrame:
    """Scored candidates: both sides have bb_id, embedding and the fused attributes."""
    near = matching.topk(a, b, policy.k).withColumn("similarity", similarity(F.col("similarity")))
    return matching.score(matching.attach(near, a, b), policy)


def match(a: DataFrame, b: DataFrame, policy: Policy = Policy(), review: Callable[[DataFrame], DataFrame] | None = None, similarity: Callable = lambda c: c) -> DataFrame:
    """Phase two: final matches. `review` takes the band's pairs and returns them with gpt_label; without it all matches are final."""
    kept = matching.matches(candidates(a, b, policy, similarity), policy)
    if review is None:
        return kept.withColumns({"bb_id_A": F.col("a_id"), "bb_id_B": F.col("b_id")})
    kept = written(kept)  # read twice: one row for each left product at most
    return matching.final_matches(kept, review(matching.review_band(kept, policy)))
