"""String similarity for pair features.

D1 ``indel_ratio(a, b) = 2 * LCS(a, b) / (len a + len b)`` (normalised insertion/deletion similarity; a substitution
costs 2, unlike Levenshtein). Either side null -> 0.0.

D2 ``token_set_ratio``: white-space token sets; intersection ``I`` and the two sorted differences are built with
native array functions; only the LCS of the two differences goes through Python.

The single Python boundary is ``lcs_length``: an Arrow-batched pandas UDF running the bit-parallel LCS recurrence
(Allison-Dix / Hyyro) vectorised over the batch with numpy ``uint64`` words for strings up to 64 characters, and with
Python integers as bit vectors beyond that.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .text import _WS_CLASS_BODY

_WORD = 64


def _lcs_bigint(a: str, b: str) -> int:
    if not a or not b:
        return 0
    if len(a) < len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, ch in enumerate(b):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(b)) - 1
    v = full
    for ch in a:
        m = masks.get(ch, 0)
        u = v & m
        v = ((v + u) | (v - u)) & full
    return len(b) - bin(v).count("1")


def _lcs_block(a_codes: np.ndarray, a_len: np.ndarray, b_codes: np.ndarray, b_len: np.ndarray) -> np.ndarray:
    """Vectorised LCS for a batch where every ``a`` has at most 64 characters.

    ``a_codes``: (n, La) code points (-1 padding), ``b_codes``: (n, Lb) (-2 padding). For each position j of ``b``,
    ``M_j`` is the bit mask of positions of ``a`` holding ``b[j]``; then ``V <- (V + (V & M)) | (V & ~M)``. Padding
    never matches, so ``M = 0`` and ``V`` is unchanged past the end of ``b``.
    """
    n, la = a_codes.shape
    weights = (np.uint64(1) << np.arange(la, dtype=np.uint64))
    full = np.where(a_len >= _WORD, np.uint64(0xFFFFFFFFFFFFFFFF),
                    (np.uint64(1) << a_len.astype(np.uint64)) - np.uint64(1))
    v = full.copy()
    for j in range(b_codes.shape[1]):
        eq = a_codes == b_codes[:, j:j + 1]
        m = (eq * weights).sum(axis=1, dtype=np.uint64)
        u = v & m
        with np.errstate(over="ignore"):
            v = ((v + u) | (v & ~m)) & full
    ones = np.zeros(n, dtype=np.int64)
    x = v.copy()
    while np.any(x):
        ones += (x & np.uint64(1)).astype(np.int64)
        x >>= np.uint64(1)
    return a_len.astype(np.int64) - ones


def _codes(strings: list[str], width: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.full((len(strings), max(width, 1)), pad, dtype=np.int32)
    lens = np.zeros(len(strings), dtype=np.int64)
    for i, s in enumerate(strings):
        if s:
            cps = np.frombuffer(s.encode("utf-32-le"), dtype=np.uint32).astype(np.int32)
            out[i, :len(cps)] = cps
            lens[i] = len(cps)
    return out, lens


def lcs_lengths(a: pd.Series, b: pd.Series) -> pd.Series:
    """LCS length per row; null on either side -> 0."""
    av = a.where(a.notna(), "").astype(str).tolist()
    bv = b.where(b.notna(), "").astype(str).tolist()
    # the shorter string of each pair becomes the bit vector
    short = [x if len(x) <= len(y) else y for x, y in zip(av, bv)]
    long_ = [y if len(x) <= len(y) else x for x, y in zip(av, bv)]
    res = np.zeros(len(av), dtype=np.int64)
    fast = np.array([len(s) <= _WORD for s in short], dtype=bool)
    idx = np.nonzero(fast)[0]
    if len(idx):
        ss = [short[i] for i in idx]
        ll = [long_[i] for i in idx]
        wa = max((len(s) for s in ss), default=1)
        wb = max((len(s) for s in ll), default=1)
        ac, al = _codes(ss, wa, -1)
        bc, bl = _codes(ll, wb, -2)
        res[idx] = _lcs_block(ac, al, bc, bl)
    for i in np.nonzero(~fast)[0]:
        res[i] = _lcs_bigint(short[i], long_[i])
    return pd.Series(res, dtype="int64")


@F.pandas_udf(T.LongType())
def lcs_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return lcs_lengths(a, b)


# A filter on a similarity would otherwise be pushed below its projection and the function run once for each.
lcs_udf = lcs_udf.asNondeterministic()


def indel_ratio_from_lcs(lcs: Column, la: Column, lb: Column) -> Column:
    total = la + lb
    return F.when(total == 0, F.lit(1.0)).otherwise(F.lit(2.0) * lcs / total)


def indel_ratio(a, b) -> Column:
    """``2 LCS / (len a + len b)``; null on either side -> 0.0; two empty strings -> 1.0."""
    ship_package()
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    la, lb = F.length(a), F.length(b)
    # equal strings need no LCS; different lengths bound it (cheap native short cuts before the UDF)
    r = F.when(a == b, F.lit(1.0)).otherwise(indel_ratio_from_lcs(lcs_udf(a, b), la, lb))
    return F.when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(r)


def tokens(c) -> Column:
    """Distinct white-space separated tokens (empty tokens dropped)."""
    c = F.col(c) if isinstance(c, str) else c
    parts = F.split(c, "[" + _WS_CLASS_BODY + "]+")
    return F.array_distinct(F.filter(parts, lambda t: t != F.lit("")))


def token_set_ratio(a, b) -> Column:
    """Token-set similarity on white-space tokens, scaled to [0, 1]; null on either side -> 0.0.

    With ``I`` = sorted intersection and ``A``, ``B`` the sorted differences joined by spaces:
    empty token set -> 0; ``I`` non-empty and ``A`` or ``B`` empty -> 1; otherwise the largest of
    ``1 - indel(A, B) / (|I+A| + |I+B|)`` (``I+X`` = ``I`` and ``X`` joined by a space), and when ``I`` is
    non-empty ``1 - (1 + |A|) / (|I| + |I+A|)`` and ``1 - (1 + |B|) / (|I| + |I+B|)``.
    """
    ship_package()
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    ta, tb = tokens(a), tokens(b)
    inter = F.array_join(F.array_sort(F.array_intersect(ta, tb)), " ")
    da = F.array_join(F.array_sort(F.array_except(ta, tb)), " ")
    db = F.array_join(F.array_sort(F.array_except(tb, ta)), " ")
    li, lda, ldb = F.length(inter), F.length(da), F.length(db)
    sep = F.when(li > 0, F.lit(1)).otherwise(F.lit(0))
    ab_len = li + sep + lda
    ba_len = li + sep + ldb
    lcs = F.when(da == db, lda).otherwise(lcs_udf(da, db))
    dist = lda + ldb - F.lit(2) * lcs
    total = ab_len + ba_len
    base = F.when(total == 0, F.lit(1.0)).otherwise(F.lit(1.0) - dist / total)
    r_ab = F.lit(1.0) - (sep + lda) / (li + ab_len)
    r_ba = F.lit(1.0) - (sep + ldb) / (li + ba_len)
    with_inter = F.greatest(base, r_ab, r_ba)
    result = (F.when((F.size(ta) == 0) | (F.size(tb) == 0), F.lit(0.0))
              .when((li > 0) & ((lda == 0) | (ldb == 0)), F.lit(1.0))
              .when(li == 0, base)
              .otherwise(with_inter))
    return F.when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(result)
