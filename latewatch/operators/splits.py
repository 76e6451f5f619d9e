"""Temporal and stratified splits, samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latewatch.functions import hash_hex
from latewatch.operators.ranges import hash_cutoffs
from latewatch.runtime import lookup_join, pin

# Months of each split, and the shares of the random split.
TEMPORAL_BOUNDS = {"train": (1, 9), "val": (10, 10), "test": (11, 11), "prod": (12, 12)}
RANDOM_SHARES = {"train": 0.4, "val": 0.1, "test": 0.1, "prod": 0.4}


def temporal_split(
    df: DataFrame, month: str = "MONTH", bounds: Mapping[str, tuple[int, int]] = TEMPORAL_BOUNDS, name: str = "split"
) -> DataFrame:
    """One ``split`` column instead of one frame per split; rows outside all bounds get NULL."""
    out = None
    for split, (lo, hi) in bounds.items():
        inside = F.col(month).between(lo, hi)
        out = F.when(inside, split) if out is None else out.when(inside, split)
    return df.withColumn(name, out)


def stratified_split(
    df: DataFrame,
    label: str,
    key: str | Sequence[str],
    fractions: Mapping[str, float] = RANDOM_SHARES,
    seed: int = 42,
    exact: bool = True,
    name: str = "split",
) -> DataFrame:
    """Seeded random split with equal label shares in every part.

    Rows are put in the order of a seeded hash of ``key``. With ``exact`` each stratum is cut at the exact row counts
    (±1 by rounding; rows that share a key stay together), and the rows themselves are never sorted or shuffled: only
    the cut-offs are searched for and looked up. Without ``exact`` the hash is compared to fixed limits, no extra pass.
    """
    names = list(fractions)
    bounds, acc = [], 0.0
    for n in names[:-1]:
        acc += fractions[n]
        bounds.append(acc)
    if abs(acc + fractions[names[-1]] - 1.0) > 1e-9:
        raise ValueError("fractions must add up to 1")
    hashed = df.withColumn("_digest", hash_hex(key, seed))
    if exact:
        # a missing label is a stratum of its own
        hashed = hashed.withColumn("_stratum", F.coalesce(F.col(label).cast("string"), F.lit("\0")))
        cuts = pin(hash_cutoffs(hashed, "_digest", bounds, ["_stratum"]))
        hashed = lookup_join(hashed, cuts, ["_stratum"], cuts.count() * 64 * (len(bounds) + 1))
        limits = [F.col(f"cut_{i}") for i in range(len(bounds))]
    else:
        limits = [F.lit(_digest_limit(b)) for b in bounds]
    out = None
    for n, limit in zip(names, limits):
        # exact cut-offs belong to the lower part, fixed limits to the upper one; no cut-off means an empty part
        inside = F.col("_digest") <= limit if exact else F.col("_digest") < limit
        out = F.when(inside, n) if out is None else out.when(inside, n)
    out = F.lit(names[-1]) if out is None else out.otherwise(names[-1])
    return hashed.withColumn(name, out).select(*df.columns, name)


def first_n(df: DataFrame, n: int, order_by: str | Sequence[str]) -> DataFrame:
    """The first ``n`` rows in key order (a bounded top-n, not a sort)."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*keys).limit(n)


def capture_sample(df: DataFrame, pct: float, key: str | Sequence[str], seed: int = 0) -> DataFrame:
    """Keep ``pct`` percent of the keys by hash limit: a plain filter, so it works on streams as well."""
    if pct >= 100:
        return df
    if pct <= 0:
        return df.where(F.lit(False))
    return df.where(hash_hex(key, seed) < _digest_limit(pct / 100))


def _digest_limit(share: float) -> str:
    """The digest below which ``share`` of all digests lie, to all 128 bits."""
    return f"{min(int(Fraction(share) * 16**32), 16**32 - 1):032x}"
