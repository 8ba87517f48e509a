"""Default parameters shared by the operators and jobs."""

from __future__ import annotations

from dataclasses import dataclass

# Defaults a user relies on when no argument is given.
LEGAL_LABELS = ("寿险意图", "拒识")
SYSTEM_PROMPT = "你是一个意图分类模型，只能输出：寿险意图 或 拒识"
NEW_SHEET = "new"
REFERENCE_LABEL = "寿险意图"
QUERY_LABEL = "拒识_new"
SEED = 42
TOPK = 1
THRESHOLD = 0.9
ENCODER_BATCH = 64
FORMAT = "internal"


@dataclass(frozen=True)
class SplitRatios:
    """Shares of train, val and test; every share is positive and they sum to 1 within 1e-6."""

    train: float = 0.8
    val: float = 0.1
    test: float = 0.1

    def __post_init__(self) -> None:
        shares = (self.train, self.val, self.test)
        if min(shares) <= 0:
            raise ValueError(f"split ratios must be positive, got {shares}")
        if abs(sum(shares) - 1.0) > 1e-6:
            raise ValueError(f"split ratios must sum to 1.0, got {sum(shares):.4f}")

    @property
    def val_of_rest(self) -> float:
        """Share of val among the rows left after test is cut off."""
        return self.val / (self.train + self.val)
