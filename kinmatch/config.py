"""Settings of the entity-resolution plan."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Blocking:
    top_k: int = 40
    #: Candidates of a query in training; None: as many as in matching.
    train_top_k: int | None = None
    rrf_k: int = 60
    char_features: int = 40_000
    word_features: int = 35_000
    word_min_df: int = 2
    #: Terms in more than this share of a country's records only score pairs that rarer terms have found.
    common_share: float = 0.05

    @property
    def pool_k(self) -> int:
        return max(self.top_k + 20, 60)


@dataclass(frozen=True)
class Gate:
    tau_singleton: float = 0.75
    tau_match: float = 0.90
    delta: float = 0.11


@dataclass(frozen=True)
class Training:
    folds: int = 3
    rounds: int = 2
    hard_percentile: float = 0.90
    hard_factor: float = 2.5
    most_weight: float = 10.0
    trees: int = 800
    patience: int = 40
    leaves: int = 63
    depth: int = 7
    step: float = 0.05
    least_rows: int = 20
    seed: int = 42


@dataclass(frozen=True)
class Settings:
    blocking: Blocking = field(default_factory=Blocking)
    gate: Gate = field(default_factory=Gate)
    training: Training = field(default_factory=Training)
