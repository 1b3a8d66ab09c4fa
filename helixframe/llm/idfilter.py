"""A filter of ids in bitmaps of bounded size, to spare rows with wide
columns a shuffle to a join they would not pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each id, about, and at most in all (16 MB): beyond, more strangers pass, never fewer members.
BITS_PER_ID = 16
MOST_BITS = 1 << 27
#: Bits in a bitmap of Spark's bitmap functions.
_MAP = 1 << 15


def flagged(df: DataFrame, id_column: Column, ids: DataFrame, name: str) -> DataFrame:
    """``df`` with the boolean column ``name``: true for every row whose id is
    in ``ids`` (its only column) and for few others; false for a null id.  The
    bitmaps are at most MOST_BITS / 8 bytes at any input, so they are broadcast."""
    wanted = BITS_PER_ID * max(1, ids.count())
    bits = min(MOST_BITS, max(_MAP, 1 << (wanted - 1).bit_length()))

    def place(c: Column) -> Column:
        return F.pmod(F.xxhash64(c.cast("long")), F.lit(bits))

    number, at = f"__{name}_map", f"__{name}_bits"
    spots = ids.select(place(F.col(ids.columns[0])).alias("p"))
    maps = spots.groupBy(F.floor(F.col("p") / _MAP).alias(number)).agg(
        F.bitmap_construct_agg(F.col("p") % _MAP).alias(at))
    mine = place(id_column)
    joined = df.withColumn(f"__{name}_p", mine).join(
        F.broadcast(maps), F.floor(F.col(f"__{name}_p") / _MAP) == F.col(number), "left")
    spot = F.col(f"__{name}_p") % _MAP
    byte = F.conv(F.hex(F.col(at).substr(F.floor(spot / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(byte, (spot % 8).cast("int")) == 1
    return joined.withColumn(name, F.coalesce(bit, F.lit(False)) & id_column.isNotNull()).drop(number, at, f"__{name}_p")
