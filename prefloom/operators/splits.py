"""Cutting a list into train, preference and evaluation parts by position."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefloom.operators.positions import first_rows, keys_at_positions


@dataclass(frozen=True)
class Cuts:
    """Half-open position ranges."""

    train: tuple[int, int]
    preference: tuple[int, int]
    evaluation: tuple[int, int]

    @property
    def overlap(self) -> int:
        """Train rows that are also in another part."""
        return max(0, self.train[1] - self.preference[0])


def cut_positions(total: int, train: int, preference: int, evaluation: int) -> Cuts:
    """Train from the head, evaluation from the tail, preference just before it."""
    if total < preference + evaluation:
        raise ValueError(
            f"{total} rows cannot hold {preference} preference and {evaluation} evaluation rows"
        )
    tail = total - evaluation
    cuts = Cuts((0, min(train, total)), (tail - preference, tail), (tail, total))
    if cuts.overlap:
        warnings.warn(f"{cuts.overlap} train rows are also in another part", stacklevel=2)
    return cuts


def slice_rows(
    df: DataFrame, key: str, ranges: dict[str, tuple[int, int]], total: int
) -> dict[str, DataFrame]:
    """Rows of each half-open position range in ``key`` order, as filters on ``key``.

    Only the key column is read to find the bounds, once for all ranges; the
    rows themselves are neither shuffled nor sorted, and the filters reach the
    Parquet scan.
    """
    inner = {p for r in ranges.values() for p in r if 0 < p < total}
    bounds = keys_at_positions(df, key, inner)
    parts = {}
    for name, (lo, hi) in ranges.items():
        part = df if lo < min(hi, total) else df.filter(F.lit(False))
        if lo in bounds:
            part = part.filter(F.col(key) >= bounds[lo])
        if hi in bounds:
            part = part.filter(F.col(key) < bounds[hi])
        parts[name] = part
    return parts


def split_rows(
    df: DataFrame, key: str, train: int, preference: int, evaluation: int
) -> dict[str, DataFrame]:
    """The parts ``train``, ``preference`` and ``evaluation``."""
    total = df.count()
    cuts = cut_positions(total, train, preference, evaluation)
    ranges = {"train": cuts.train, "preference": cuts.preference, "evaluation": cuts.evaluation}
    return slice_rows(df, key, ranges, total)


def first_n(df: DataFrame, n: int | None, key: str = "pos") -> DataFrame:
    """The first ``n`` rows by the unique integer ``key``; all of them when there are
    no more. Nothing runs before the result is used, and blocks of keys that start
    after the n-th row are dropped before any row is sorted."""
    if n is None:
        return df
    return first_rows(df, n, key, [], "_n").drop("_n")
