"""Join helpers: broadcast only behind a checked size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Dimensions above this many bytes are joined by shuffle (AQE may still pick a broadcast from measured sizes).
MAX_BROADCAST_BYTES = 256 * 1024 * 1024
_ROW_OVERHEAD = 32


def _width(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(field.dataType, (T.MapType, T.ArrayType, T.StructType)):
        return F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0)) * 2
    return F.lit(8)


def size_in_bytes(df: DataFrame) -> int:
    """Bytes of the rows, from one aggregate with a partial step; kept on the frame, so each is measured once."""
    if not hasattr(df, "_ledgerline_bytes"):
        width = sum((_width(f) for f in df.schema.fields), F.lit(_ROW_OVERHEAD))
        df._ledgerline_bytes = int(df.agg(F.sum(width.cast("long")).alias("n")).first().n or 0)
    return df._ledgerline_bytes


def fits(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    return size_in_bytes(df) <= max_bytes


def bounded_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES, basis: DataFrame | None = None) -> DataFrame:
    """Hint a broadcast for ``df`` only if it holds at most ``max_bytes``.

    ``basis`` is a frame whose size bounds ``df`` (``df`` is a projection,
    filter or distinct of it); the check then runs once per base dimension.
    For small dimensions only: key sets that grow with the data are written and
    left to the planner, which knows the size of the files.
    """
    return F.broadcast(df) if fits(df if basis is None else basis, max_bytes) else df
