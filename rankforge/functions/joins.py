"""Joining a small aggregate back to the rows it was made of.

Spark estimates an aggregate by the size of its input, so on big data it would
shuffle the data side onto a handful of keys. Here the aggregate is written
once, its rows and bytes are counted, and only then is it broadcast; beyond the
bounds the join is an ordinary one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions.columns import null_safe_join
from rankforge.session import materialize

BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20


def broadcast_if_small(df: DataFrame, name: str = "small", written: bool = False) -> DataFrame:
    """``df`` written once (unless it is ``written`` already), with a broadcast hint if both its rows and its bytes are within the bounds."""
    small = df if written else materialize(df, name)
    if small.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return small
    width = F.lit(0)
    for f in small.schema.fields:
        plain = isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))
        width = width + (F.lit(16) if plain else 16 + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0)))
    size = small.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(small) if size <= BROADCAST_BYTES else small


def join_back(data: DataFrame, aggregate: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``data`` joined with ``aggregate`` on ``keys`` (NULL matches NULL); ``data`` isn't shuffled if the aggregate is small."""
    return null_safe_join(data, broadcast_if_small(aggregate), keys, how)
