"""State changes of logical keys as a stream that remembers each key's latest content.

A key's state is its latest content hash and how many changes it has had. A row whose hash differs from the latest is the
next change, so A, B, A are three; a repeat is none. Rows of a key count in the order of ``at`` within a
micro-batch and of the micro-batches otherwise: a row that comes later is later news, as in the store, whose commits
are sequenced. State lives in Spark's state store, partitioned by key, and is checkpointed with the offsets, so a stream
that stops goes on where it was and emits no change twice into a sink that Spark commits with it (files).

No watermark: a key may change years later. State grows with the keys, by a few dozen bytes each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_OUT = "logical_key string, content_hash string, at bigint, ordinal bigint"
_STATE = "latest string, ordinal bigint"


def _of_key(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(frames)).sort_values("at", kind="stable")
    known = state.exists
    latest, ordinal = state.get if known else (None, 0)
    hashes = rows["content_hash"].astype(object).where(rows["content_hash"].notna(), None)
    before = hashes.shift(1)
    before.iloc[0] = latest
    # A null is a content like any other, so None beside None is a repeat; only a new key's first row has nothing before.
    changed = ((hashes != before) & ~(hashes.isna() & before.isna())).to_numpy(bool)
    changed[0] |= not known
    out = rows[changed][["content_hash", "at"]]
    out.insert(0, "logical_key", key[0])
    out["ordinal"] = range(ordinal + 1, ordinal + 1 + len(out))
    state.update((hashes.iloc[-1], ordinal + len(out)))
    yield out


def transitions(rows: DataFrame) -> DataFrame:
    """(logical_key, content_hash, at, ordinal) of each change in a stream of (logical_key, content_hash, at)."""
    given = rows.selectExpr("cast(logical_key as string) logical_key", "cast(content_hash as string) content_hash", "cast(at as bigint) at")
    return given.groupBy("logical_key").applyInPandasWithState(_of_key, _OUT, _STATE, "append", GroupStateTimeout.NoTimeout)


def write(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Changes of what the source holds by now, as Parquet; a call with the same checkpoint goes on."""
    return transitions(rows).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
