"""Token-id array expressions (R1-R3, R5 element work, R6-R9).

Native higher-order / array functions only, so they stay in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import IGNORE_INDEX, PAD_ID

INT_ARRAY = "array<int>"


def _repeat(value: int, n: Column) -> Column:
    return F.array_repeat(F.lit(value), F.greatest(n, F.lit(0)).cast("int")).cast(INT_ARRAY)


# R1
def truncate_head(ids: Column, n: int | Column) -> Column:
    """``ids[:n]``."""
    return F.slice(ids, 1, n if isinstance(n, Column) else F.lit(n))


# R2
def truncate_tail(ids: Column, n: int) -> Column:
    """``ids[-n:]`` when longer than ``n`` (keep the end); shorter arrays,
    empty ones included, are returned as they are."""
    return F.when(F.size(ids) > n, F.slice(ids, -n, n)).otherwise(ids)


# R3
def pad_right(ids: Column, length: int | Column, pad_id: int = PAD_ID) -> Column:
    """Truncate to ``length`` then right-pad with ``pad_id``."""
    n = length if isinstance(length, Column) else F.lit(length)
    t = truncate_head(ids, n)
    return F.concat(t, _repeat(pad_id, n - F.size(t)))


def mask_right(ids: Column, length: int | Column) -> Column:
    n = length if isinstance(length, Column) else F.lit(length)
    real = F.least(F.size(ids), n)
    return F.concat(_repeat(1, real), _repeat(0, n - real))


# R5 (element part; the batch maximum comes from a window)
def pad_left(ids: Column, length: Column, pad_id: int = PAD_ID) -> Column:
    return F.concat(_repeat(pad_id, length - F.size(ids)), ids)


def mask_left(ids: Column, length: Column) -> Column:
    return F.concat(_repeat(0, length - F.size(ids)), _repeat(1, F.size(ids)))


# R6
def labels_masked(ids: Column, mask: Column, ignore: int = IGNORE_INDEX) -> Column:
    """Copy of the ids with ``ignore`` where the mask is 0."""
    return F.zip_with(ids, mask, lambda i, m: F.when(m == 0, F.lit(ignore)).otherwise(i))


# R7
def labels_plain(ids: Column) -> Column:
    """Plain copy: padding positions keep the pad id."""
    return ids


# R8
def labels_by_pad_id(ids: Column, pad_id: int = PAD_ID, ignore: int = IGNORE_INDEX) -> Column:
    """``ignore`` wherever the id equals the pad id (stock causal-LM
    collator behaviour)."""
    return F.transform(ids, lambda i: F.when(i == pad_id, F.lit(ignore)).otherwise(i))


# R9
def length(ids: Column) -> Column:
    return F.size(ids)
