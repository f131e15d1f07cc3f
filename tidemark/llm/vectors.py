"""What operators on embeddings share: rows whose vectors can be used, as whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str = "embedding") -> Column:
    """True where the vector and all of its entries are there and finite; an empty vector is not usable."""
    entry = F.col(vector)
    finite = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.coalesce((F.size(entry) > 0) & finite, F.lit(False))


def whole(vector: str, factor: int, added: int, most: int) -> Column:
    """floor(factor * c) + added of each entry; entries beyond ``most`` on either side count as ``most``."""
    return F.transform(F.col(vector), lambda c: F.floor(F.greatest(F.least(c.cast("double") * factor, F.lit(float(most))), F.lit(float(-most)))) + added)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Arrays of one length as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def commonest_width(kept: DataFrame, vector: str) -> int | None:
    """The length that most vectors have, the smallest of several; none without vectors."""
    row = kept.groupBy(F.size(vector).alias("width")).count().orderBy(F.desc("count"), "width").first()
    return row and row["width"]
