"""Geohash as column arithmetic: bits of both axes interleaved, five per character."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The geohash alphabet.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"

# A character takes three bits from one axis and two from the other, in turns. These are
# the places of those bits inside the character's number, e.g. 0b101 -> 0b10001.
WIDE = [0b00000, 0b00001, 0b00100, 0b00101, 0b10000, 0b10001, 0b10100, 0b10101]
NARROW = [0b0000, 0b0010, 0b1000, 0b1010]


def _cell(value: Column, low: float, span: float, bits: int) -> Column:
    """Index of the cell along one axis; the upper edge belongs to the last cell."""
    cells = 1 << bits
    index = F.floor((value - F.lit(low)) / F.lit(span) * F.lit(float(cells))).cast("int")
    return F.least(index, F.lit(cells - 1))


def possible_position(lat: Column, lng: Column) -> Column:
    return lat.between(-90.0, 90.0) & lng.between(-180.0, 180.0)


def _placed(cell: Column, shift: int, places: list[int]) -> Column:
    part = F.shiftright(cell, shift).bitwiseAND(F.lit(len(places) - 1))
    return F.get(F.array(*[F.lit(p) for p in places]), part)


def with_geohash(frame: DataFrame, lat: str, lng: str, name: str = "geohash", length: int = 5) -> DataFrame:
    """Add the geohash of a position; an empty string if the position is missing or impossible.

    The two cell numbers are columns of their own, so they are worked out once per row.
    """
    total = 5 * length
    lng_bits, lat_bits = (total + 1) // 2, total // 2
    valid = possible_position(F.col(lat), F.col(lng))
    cells = frame.withColumns(
        {
            "__x": F.when(valid, _cell(F.col(lng), -180.0, 360.0, lng_bits)),
            "__y": F.when(valid, _cell(F.col(lat), -90.0, 180.0, lat_bits)),
        }
    )
    letters = []
    for i in range(length):
        # Bits used up to and including this character; longitude comes first.
        used = 5 * (i + 1)
        x_shift, y_shift = lng_bits - (used + 1) // 2, lat_bits - used // 2
        x, y = F.col("__x"), F.col("__y")
        if i % 2 == 0:
            number = _placed(x, x_shift, WIDE) + _placed(y, y_shift, NARROW)
        else:
            number = _placed(y, y_shift, WIDE) + _placed(x, x_shift, NARROW)
        letters.append(F.substring(F.lit(ALPHABET), number + 1, F.lit(1)))
    return cells.withColumn(name, F.coalesce(F.concat(*letters), F.lit(""))).drop("__x", "__y")
