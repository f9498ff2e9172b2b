"""Every threshold, weight and limit of the matching plans."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class CatalogConfig:
    """Names of the columns of a raw catalog; None or an absent column gives nulls."""

    side: str
    product_id: str = "bb_id"
    title: str = "name"
    upc: str | None = "upc_raw"
    brand: str | None = "brand_raw"
    category: str | None = "department"


# Weights, thresholds, band and limits of the matching policy.
@dataclass(frozen=True)
class Policy:
    k: int = 50
    weights: dict[str, float] = field(default_factory=lambda: {"embedding": 0.55, "brand": 0.15, "category": 0.15, "size": 0.05, "size_strict": 0.10})
    min_score: float = 0.70
    min_embedding: float = 0.65
    min_category: float = 0.5
    relax: float = 0.05
    band: tuple[float, float] = (0.70, 0.71)
    band_limit: int = 2000
    blend: tuple[float, float] = (0.6, 0.4)
    sample_rows: int = 50
    sample_seed: int = 42
    legacy_similarity: float = 0.45
    legacy_score: float = 0.55
    legacy_category: float = 0.05
    legacy_title: float = 0.10
    number: str = "float"
    skip_simple_rows: bool = True
    reject_on_error: bool = True


#: For random vectors and generated products, which reach few of the thresholds above.
FIXTURE = Policy(min_score=0.50, min_embedding=0.55, band=(0.45, 0.52), number="double")
