"""Training and test split (GEN3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values of the key hash: a share is met to one part in four thousand million.
HASHES = 1 << 32


def key_hash(keys: Sequence[str], salt: str = "") -> Column:
    """Number from 0 to ``HASHES`` - 1, the same in every run, engine and cluster size."""
    text = F.concat_ws("|", *keys, *([F.lit(salt)] if salt else []))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_split(
    df: DataFrame, keys: Sequence[str], share: float = 0.7, salt: str = ""
) -> tuple[DataFrame, DataFrame]:
    """Two parts by key: a filter each, no sort, no shuffle, safe to recompute.

    All rows of a key land in the same part.
    """
    place = key_hash(keys, salt)
    limit = round(share * HASHES)
    return df.filter(place < limit), df.filter(place >= limit)


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 42
) -> list[DataFrame]:
    """Seeded random parts. Sorts every partition first; prefer ``hash_split`` at scale."""
    return df.randomSplit(list(weights), seed)
