"""Tunables of a run, as one immutable value."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal
from fractions import Fraction

# Default cut-offs, weights and limits.
DEFAULT_WEIGHTS = {
    "syntactic": Decimal("0.35"),
    "documentation": Decimal("0.25"),
    "security": Decimal("0.20"),
    "llm": Decimal("0.20"),
}


@dataclass(frozen=True)
class Settings:
    # ingestion
    source: str = "the-stack"
    language: str = "python"
    sample_size: int | None = None  # None takes every row
    # near-duplicate removal
    dedup_near: bool = False
    minhash_threshold: float = 0.8
    minhash_num_perm: int = 128
    # hard cut-offs, all inclusive
    min_lines: int = 5
    max_lines: int = 1000
    min_alphanum: float = 0.25
    max_avg_line_length: float = 200.0
    # scoring
    weights: dict[str, Decimal] = field(default_factory=lambda: dict(DEFAULT_WEIGHTS))
    quality_threshold: Decimal = Decimal("0.70")
    judge_sample_size: int | None = None  # rows to ask about; None asks about all
    judge_seed: int = 42
    judge_prefix_chars: int | None = None  # characters a prompt quotes; None quotes the whole text
    version: str = "v0.1.0"

    def __post_init__(self) -> None:
        if set(self.weights) != set(DEFAULT_WEIGHTS):
            raise ValueError(f"weights need exactly the keys {sorted(DEFAULT_WEIGHTS)}")
        if sum(self.weights.values()) != 1:
            raise ValueError("weights must sum to 1")
        if any(w < 0 for w in self.weights.values()) or self.weights["llm"] == 1:
            raise ValueError("weights must not be negative, and the rule-based ones not all zero")
        if not 0 < self.minhash_threshold < 1:
            raise ValueError("minhash_threshold must lie between 0 and 1")
        if self.min_lines > self.max_lines:
            raise ValueError("min_lines must not exceed max_lines")
        if self.sample_size is not None and self.sample_size < 0:
            raise ValueError("sample_size must not be negative")

    def weights_without_judge(self) -> dict[str, Decimal]:
        """The judge's weight shared out in proportion to the other weights."""
        rest = 1 - Fraction(self.weights["llm"])
        return {
            name: _decimal(Fraction(weight) / rest)
            for name, weight in self.weights.items()
            if name != "llm"
        }


def _decimal(x: Fraction) -> Decimal:
    return (Decimal(x.numerator) / Decimal(x.denominator)).quantize(Decimal("0.00000001")).normalize()
