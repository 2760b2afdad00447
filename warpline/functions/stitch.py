"""Stitch commands of three bytes: displacement, type and units, all native."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values: (byte, bit, weight) of the balanced-ternary displacements.
X_BITS = ((2, 2, 81), (2, 3, -81), (1, 2, 27), (1, 3, -27), (0, 2, 9), (0, 3, -9), (1, 0, 3), (1, 1, -3), (0, 0, 1), (0, 1, -1))
Y_BITS = ((2, 5, 81), (2, 4, -81), (1, 5, 27), (1, 4, -27), (0, 5, 9), (0, 4, -9), (1, 7, 3), (1, 6, -3), (0, 7, 1), (0, 6, -1))
#: Type masks of the third byte, first match wins.
TYPES = ((0xF3, "end"), (0xC3, "color_change"), (0x43, "sequin_mode"), (0x83, "jump"))


def _weigh(bytes_: tuple[Column, Column, Column], bits) -> Column:
    out = F.lit(0)
    for byte, bit, weight in bits:
        out = out + F.shiftrightunsigned(bytes_[byte], bit).bitwiseAND(1) * weight
    return out.cast("int")


def displacement(b0: Column, b1: Column, b2: Column) -> tuple[Column, Column]:
    """(dx, dy) of a command whose bytes are whole numbers from 0 to 255."""
    return _weigh((b0, b1, b2), X_BITS), _weigh((b0, b1, b2), Y_BITS)


def command_type(b2: Column) -> Column:
    out = None
    for mask, name in TYPES:
        test = b2.bitwiseAND(mask) == mask
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("stitch")


def to_mm(units: Column) -> Column:
    return F.round(units * F.lit(0.1), 1)


def signed32(value: Column) -> Column:
    return F.when(value >= 2**31, value - 2**32).otherwise(value)


def signed24(b0: Column, b1: Column, b2: Column) -> Column:
    """Little-endian three-byte number with its sign."""
    value = b0 + b1 * 256 + b2 * 65536
    return F.when(value >= 2**23, value - 2**24).otherwise(value)


def align4(value: Column) -> Column:
    return F.shiftleft(F.shiftright(value + 3, 2), 2)


def byte_at(data: Column, at: Column) -> Column:
    """The unsigned byte at a 1-based place of a binary column."""
    return F.conv(F.hex(F.substring(data, at, F.lit(1))), 16, 10).cast("int")
