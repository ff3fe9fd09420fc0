"""Geohash arithmetic on integer cell coordinates.

A geohash of ``bits`` bits is a pair of integers: ``x`` (longitude, one bit more when
``bits`` is odd) and ``y`` (latitude). Grouping, shifting and decoding use the pair;
the interleaved number and its text are made only where they are shown. The binary
digits of a number, read as base-4 digits, are that number with a zero bit before every
bit; a table of that for every four bits spreads a coordinate in a few array lookups.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The geohash alphabet, the digits of base 32 in Spark, and the angles'
# fixed-point scale.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
SCALE_BITS = 31
MAX_BITS = 61
TAGGED = 1 << 62

SPREAD_FOURS = ", ".join(f"{int(format(four, 'b'), 4)}L" for four in range(16))
# Bits 0, 2 and 4 of each number of six bits.
GATHERED_SIXES = ", ".join(f"{int(format(six, '06b')[1::2], 2)}L" for six in range(64))
LETTERS = ", ".join(f"'{letter}'" for letter in ALPHABET)


def x_bits(bits: int) -> int:
    return (bits + 1) // 2


def y_bits(bits: int) -> int:
    return bits // 2


def check_bits(bits: int, text: bool = False) -> int:
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"geohash bits must be 0..{MAX_BITS}, got {bits}")
    if text and bits % 5:
        raise ValueError(f"a geohash text needs a multiple of 5 bits, got {bits}")
    return bits


def cell_x(lon: Column, bits: int) -> Column:
    """Column of the geohash cell; longitudes in [-180, 180)."""
    return _fixed_point(lon, 180.0, x_bits(bits))


def cell_y(lat: Column, bits: int) -> Column:
    """Row of the geohash cell; latitudes in [-90, 90)."""
    return _fixed_point(lat, 90.0, y_bits(bits))


def _fixed_point(angle: Column, half: float, keep: int) -> Column:
    scaled = F.floor((angle + half) * float(1 << SCALE_BITS) / (2 * half))
    return F.shiftright(scaled.bitwiseAND(F.lit((1 << SCALE_BITS) - 1)), SCALE_BITS - keep)


def interleave(x: Column, y: Column, bits: int) -> Column:
    """The geohash as a number: longitude and latitude bits in turn, longitude first."""
    spread_x, spread_y = _spread(x, x_bits(bits)), _spread(y, y_bits(bits))
    if bits % 2:
        return F.shiftleft(spread_y, 1).bitwiseOR(spread_x)
    return F.shiftleft(spread_x, 1).bitwiseOR(spread_y)


def _spread(value: Column, keep: int) -> Column:
    table = F.expr(f"array({SPREAD_FOURS})")
    spread = F.lit(0).cast("bigint")
    for at in range(0, keep, 4):
        four = F.shiftright(value, at).bitwiseAND(F.lit(15)).cast("int")
        spread = spread.bitwiseOR(F.shiftleft(F.get(table, four), 2 * at))
    return spread


def deinterleave(number: Column, bits: int) -> tuple[Column, Column]:
    """(x, y) of an interleaved number."""
    high, low = _gather(F.shiftright(number, 1)), _gather(number)
    return (low, high) if bits % 2 else (high, low)


def deinterleave_tagged(tagged: Column) -> tuple[Column, Column, Column]:
    """(x, y, precision) of a tagged number; NULL without a tag."""
    precision = tagged_precision(tagged)
    number = tagged.bitwiseAND(ones(precision))
    high, low = _gather(F.shiftright(number, 1)), _gather(number)
    odd = precision % 2 == 1
    x = F.when(odd, low).otherwise(high)
    y = F.when(odd, high).otherwise(low)
    return x, y, precision


def interleave_tagged(x: Column, y: Column, precision: Column) -> Column:
    """Tagged number of a cell of ``precision`` bits."""
    odd = precision % 2 == 1
    low, high = F.when(odd, x).otherwise(y), F.when(odd, y).otherwise(x)
    number = F.shiftleft(_spread(high, 31), 1).bitwiseOR(_spread(low, 31))
    return number.bitwiseOR(ones(precision) + 1).bitwiseOR(F.lit(TAGGED).cast("bigint"))


def ones(count: Column) -> Column:
    """A number of ``count`` one bits."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), count.cast("int")) - 1


def _gather(number: Column) -> Column:
    """Every second bit, the lowest first, put together: six bits at a time, by table."""
    table = F.expr(f"array({GATHERED_SIXES})")
    gathered = F.lit(0).cast("bigint")
    for at in range(0, 62, 6):
        six = F.shiftright(number, at).bitwiseAND(F.lit(63)).cast("int")
        gathered = gathered.bitwiseOR(F.shiftleft(F.get(table, six), at // 2))
    return gathered


def text(number: Column, bits: int) -> Column:
    """Base-32 text of an interleaved number."""
    letters = F.expr(f"array({LETTERS})")
    places = range(bits - 5, -1, -5)
    fives = (F.shiftright(number, at).bitwiseAND(F.lit(31)).cast("int") for at in places)
    return F.concat(F.lit(""), *(F.get(letters, five) for five in fives))


def from_text(geohash: Column) -> Column:
    """Interleaved number of a base-32 text."""
    digits = F.translate(geohash, ALPHABET, BASE32_DIGITS)
    return F.when(geohash == "", F.lit(0)).otherwise(F.conv(digits, 32, 10)).cast("bigint")


def tag(number: Column, bits: int) -> Column:
    """The number with its precision: bit 62 set, and bit ``bits`` set."""
    return number.bitwiseOR(F.lit(TAGGED | (1 << bits)).cast("bigint"))


def tagged_precision(tagged: Column) -> Column:
    """Precision of a tagged number, NULL without a tag."""
    marker = tagged.bitwiseAND(F.lit(TAGGED - 1).cast("bigint"))
    return F.when(tagged.bitwiseAND(F.lit(TAGGED).cast("bigint")) != 0, bit_length(marker) - 1)


def untag(tagged: Column, bits: int) -> Column:
    return tagged.bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))


def shift(x: Column, y: Column, dx: int, dy: int, bits: int) -> tuple[Column, Column]:
    """The cell ``dx`` to the east and ``dy`` to the north; wraps at the borders."""
    wide, high = 1 << x_bits(bits), 1 << y_bits(bits)
    return (
        (x + (dx % wide)).bitwiseAND(F.lit(wide - 1).cast("bigint")),
        (y + (dy % high)).bitwiseAND(F.lit(high - 1).cast("bigint")),
    )


def lon_error(bits: int) -> float:
    return 180.0 / (1 << x_bits(bits))


def lat_error(bits: int) -> float:
    return 90.0 / (1 << y_bits(bits))


def lon_centre(x: Column, bits: int) -> Column:
    return x / float(1 << x_bits(bits)) * 360.0 - 180.0 + lon_error(bits)


def lat_centre(y: Column, bits: int) -> Column:
    return y / float(1 << y_bits(bits)) * 180.0 - 90.0 + lat_error(bits)


def tagged_centre(place: Column, keep: Column, turn: float) -> tuple[Column, Column]:
    """(centre, error) of a cell coordinate of ``keep`` bits; ``turn``: 360 for longitudes,
    180 for latitudes."""
    cells = (ones(keep) + 1).cast("double")
    error = F.lit(turn / 2) / cells
    return place / cells * turn - turn / 2 + error, error


def bit_length(value: Column) -> Column:
    """Number of bits up to the highest set one; 0 for 0."""
    return F.when(value == 0, F.lit(0)).otherwise(F.length(F.bin(value)))
