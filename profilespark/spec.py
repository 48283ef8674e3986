"""What the columns of a labelled table mean, threaded through every operator."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

# The names, labels and settings every stage agrees on.
TARGET = "Result"
WEIGHT = "sample_weight"
POSITIVE = -1
NEGATIVE = 1
SEED = 42
FAMILIES = ("Decision Tree", "Random Forest")
K_VALUES = (5, 10, 15, 20, 25, "all")
HIGH_CONFIDENCE = 0.80


@dataclass(frozen=True)
class TableSpec:
    """Roles of the columns of one labelled table.

    ``multiplicity`` names a column saying how many identical rows a row stands
    for, so the exploratory operators can run on a table collapsed to profiles.
    """

    features: tuple[str, ...]
    target: str = TARGET
    weight: str | None = None
    key: str | None = None
    multiplicity: str | None = None
    positive: int = POSITIVE
    negative: int = NEGATIVE
    # The most different values of a feature, where it has been measured (see ``with_bins``).
    bins: int | None = None

    @classmethod
    def infer(cls, df: DataFrame, target: str = TARGET, weight: str = WEIGHT, key: str | None = None) -> "TableSpec":
        """Features are whatever is left after the known columns."""
        known = {target, weight, key}
        return cls(
            features=tuple(c for c in df.columns if c not in known),
            target=target,
            weight=weight if weight in df.columns else None,
            key=key,
        )

    @property
    def labels(self) -> tuple[int, int]:
        return (self.positive, self.negative)

    @property
    def mass(self) -> Column:
        """Weight of a row, 1.0 where the table carries none."""
        weight = F.col(self.weight).cast("double") if self.weight else F.lit(1.0)
        # A weight belongs to one row; a collapsed table already sums it.
        return weight if self.weight or not self.multiplicity else F.col(self.multiplicity).cast("double")

    @property
    def rows(self) -> Column:
        """How many input rows a row stands for."""
        return F.col(self.multiplicity) if self.multiplicity else F.lit(1).cast("bigint")

    def label_rows(self, label: int) -> Column:
        return F.sum(F.when(F.col(self.target) == label, self.rows).otherwise(F.lit(0).cast("bigint")))

    def label_mass(self, label: int) -> Column:
        return F.sum(F.when(F.col(self.target) == label, self.mass).otherwise(F.lit(0.0)))

    def with_(self, **changes) -> "TableSpec":
        return replace(self, **changes)
