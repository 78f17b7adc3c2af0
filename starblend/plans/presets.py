"""The two parameter sets of the pipeline."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from starblend.operators.blend import Weights
from starblend.operators.features import CATEGORY_TERMS, CITY_TERMS, STATE_TERMS


@dataclass(frozen=True)
class Preset:
    name: str
    # similarity and neighbourhood
    shrink: float
    threshold: float
    neighbours: int
    resid_cap: float
    gate: float
    # latent factors
    rank: int
    latent_rounds: int
    latent_reg: float
    # trees
    trees: int
    depth: int
    rate: float
    row_share: float
    column_share: float
    min_rows: int
    # blend
    inputs: tuple[str, ...]
    blend_lam: float
    bounds: Mapping[str, tuple[float, float]]
    default_weights: Weights
    # shared
    bias_lam: float = 9.0
    bias_rounds: int = 4
    alpha: float = 1.1
    implicit_alpha: float = 0.6
    category_terms: int = CATEGORY_TERMS
    city_terms: int = CITY_TERMS
    state_terms: int = STATE_TERMS
    seed: int = field(default=42)
    # optional bounds; set, they drop data
    items_per_user: int | None = None  # items of a user that similarities count
    blend_rows: int | None = None  # labelled rows, from the first on, that the blend is fitted on


# Fixed values.  ``latent_reg`` is the exception: the least-squares solver scales its penalty by the
# number of ratings, so it has a scale of its own.
STABLE = Preset(
    name="stable",
    shrink=5.0,
    threshold=0.05,
    neighbours=120,
    resid_cap=2.4,
    gate=0.6,
    rank=80,
    latent_rounds=10,
    latent_reg=0.2,
    trees=300,
    depth=7,
    rate=0.06,
    row_share=0.9,
    column_share=0.8,
    min_rows=1,
    inputs=("cf", "latent", "boosted"),
    blend_lam=0.01,
    bounds={"cf": (-0.10, 0.40), "latent": (-0.10, 0.40), "boosted": (0.40, 1.20)},
    default_weights=Weights({"cf": 0.13, "latent": 0.05, "boosted": 0.87}, -0.25),
)
AGGRESSIVE = Preset(
    name="aggressive",
    shrink=20.0,
    threshold=0.10,
    neighbours=80,
    resid_cap=1.8,
    gate=0.8,
    rank=100,
    latent_rounds=15,
    latent_reg=0.2,
    trees=420,
    depth=6,
    rate=0.045,
    row_share=0.85,
    column_share=0.75,
    min_rows=1,
    inputs=("bias", "cf", "latent", "boosted"),
    blend_lam=0.05,
    bounds={
        "bias": (-0.10, 0.30),
        "cf": (-0.20, 0.40),
        "latent": (-0.20, 0.40),
        "boosted": (0.70, 1.30),
    },
    default_weights=Weights({"bias": 0.05, "cf": 0.10, "latent": 0.08, "boosted": 0.80}, -0.10),
)
PRESETS = {p.name: p for p in (STABLE, AGGRESSIVE)}
