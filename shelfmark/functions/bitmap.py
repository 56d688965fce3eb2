"""A filter of fixed size on the keys of another table, to drop most rows before they are shuffled.

The filter holds one bit per key hash in bitmaps of 4 KB, at most 4096 of them: 16 MB however many keys there are, so it
is broadcast. Rows that share a bit with a key pass too (few up to some ten million keys, nearly all far beyond that), so an
exact join must follow; results never depend on the filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITMAP, _BITMAPS = 32768, 4096


def likely_in(rows: DataFrame, hashed: Column, keys: DataFrame, key_hash: Column) -> DataFrame:
    """``rows`` whose ``hashed`` (long, not null) may equal ``key_hash`` of a row of ``keys``; nothing of ``rows`` is shuffled."""
    spot = lambda value: F.pmod(value, F.lit(_BITMAP * _BITMAPS))
    spots = keys.select(spot(key_hash).alias("spot")).selectExpr(f"spot div {_BITMAP} AS __part", f"spot % {_BITMAP} AS place")
    bitmaps = spots.groupBy("__part").agg(F.bitmap_construct_agg("place").alias("__bits"))
    marked = rows.withColumn("__spot", spot(hashed)).withColumn("__part", F.expr(f"__spot div {_BITMAP}"))
    held = f"substring(__bits, CAST(__spot % {_BITMAP} div 8 AS INT) + 1, 1)"
    byte = f"CAST(conv(hex({held}), 16, 10) AS INT)"
    hit = F.expr(f"{held} <> X'00' AND (shiftright({byte}, CAST(__spot % 8 AS INT)) & 1) = 1")  # most bytes are zero, which is told cheaply
    return marked.join(F.broadcast(bitmaps), "__part").filter(hit).select(*rows.columns)
