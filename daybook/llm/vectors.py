"""What the two vector operators share: valid vectors and their Arrow form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vec_col: str) -> Column:
    """Not null or empty, without null or non-finite components, not zero."""
    bad = F.exists(vec_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vec_col, lambda x: x != 0), F.lit(False))


def keyed_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, vec`` (doubles) and a 128-bit key of the content; key null for unusable vectors."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    ok = usable("vec")
    return rows.withColumns({"k1": F.when(ok, F.xxhash64("vec")), "k2": F.when(ok, F.xxhash64(F.lit(1), F.col("vec")))})


def matrix(column: pa.ListArray) -> np.ndarray:
    """Equal-length lists of doubles as the rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two that brings its largest component near one."""
    if not x.size:
        return x
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, in double precision.

    Rows are scaled by a power of two first, which is exact, so that squares of very
    large or small components neither overflow nor vanish.
    """
    a, b = scaled(a), scaled(b)
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))
