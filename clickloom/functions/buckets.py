"""Fixed-width (lo, hi] buckets of visit length and step length."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Buckets:
    """``prefix_lo_hi`` buckets up to ``top``, one overflow bucket beyond.

    ``ratio_top`` is where the columns of the persisted ratio table end.
    """

    prefix: str
    width: int
    top: int
    ratio_top: int
    overflow: str

    def label(self, value: Column, compat_zero_bucket: bool = False) -> Column:
        """Bucket label of a length.

        Length 0 belongs to the first bucket; with ``compat_zero_bucket`` it gets the
        label ``prefix_top_0`` instead, which no ratio column counts.
        """
        upper = F.greatest(F.ceil(value / self.width), F.lit(1).cast("bigint")) * self.width
        label = F.when(value > self.top, F.lit(self.overflow)).otherwise(
            F.concat(F.lit(f"{self.prefix}_"), upper - self.width, F.lit("_"), upper)
        )
        if compat_zero_bucket:
            label = F.when(value <= 0, F.lit(f"{self.prefix}_{self.top}_0")).otherwise(label)
        return label

    def tests(self, value: Column, compat_zero_bucket: bool = False) -> dict[str, Column]:
        """For every label the condition that a length has it."""
        bounds = [(hi - self.width, hi) for hi in range(self.width, self.top + 1, self.width)]
        found = {
            f"{self.prefix}_{lo}_{hi}": self.contains(value, lo, hi, compat_zero_bucket) for lo, hi in bounds
        }
        found[self.overflow] = value > self.top
        if compat_zero_bucket:
            found[f"{self.prefix}_{self.top}_0"] = value <= 0
        return found

    def ratio_bounds(self) -> list[tuple[int, int]]:
        return [(hi - self.width, hi) for hi in range(self.width, self.ratio_top + 1, self.width)]

    def ratio_columns(self) -> list[str]:
        return [f"{self.prefix}_{lo}_{hi}" for lo, hi in self.ratio_bounds()]

    def contains(self, value: Column, lo: int, hi: int, compat_zero_bucket: bool = False) -> Column:
        """Whether a length falls in the bucket (lo, hi]; the first bucket includes 0."""
        inside = value <= hi
        if lo > 0 or compat_zero_bucket:
            inside = inside & (value > lo)
        return inside


# Bucket widths, ends and labels.
VISIT = Buckets("visit", 300, 7200, 3600, "visit_length > 7200")
STEP = Buckets("step", 5, 200, 100, "step_length > 200")
