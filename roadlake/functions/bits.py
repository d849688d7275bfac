"""CAN payload bits on one BIGINT per frame: fields of either byte order, sign extension, single bytes and bits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BYTE_PAIRS = 0x00FF00FF00FF00FF
_WORD_PAIRS = 0x0000FFFF0000FFFF


def _int(value: Column | int) -> Column:
    return F.lit(value).cast("int") if isinstance(value, int) else value.cast("int")


def _shr(value: Column, n: Column | int) -> Column:
    return F.call_function("shiftrightunsigned", value, _int(n))


def _shl(value: Column, n: Column | int) -> Column:
    return F.call_function("shiftleft", value, _int(n))


def word_of_hex(data_hex: Column) -> Column:
    """Up to eight payload bytes as a big-endian BIGINT, zero-padded on the right."""
    return F.conv(F.rpad(data_hex, 16, "0"), 16, -10).cast("long")


def swap_bytes(word: Column) -> Column:
    one = _shl(word.bitwiseAND(F.lit(_BYTE_PAIRS)), 8).bitwiseOR(_shr(word, 8).bitwiseAND(F.lit(_BYTE_PAIRS)))
    two = _shl(one.bitwiseAND(F.lit(_WORD_PAIRS)), 16).bitwiseOR(_shr(one, 16).bitwiseAND(F.lit(_WORD_PAIRS)))
    return _shl(two, 32).bitwiseOR(_shr(two, 32))


def byte_at(word: Column, index: Column | int) -> Column:
    return _shr(word, F.lit(56) - _int(index) * 8).bitwiseAND(F.lit(255).cast("long"))


def bit_at(word: Column, bit: Column) -> Column:
    """Bit in DBC numbering: byte * 8 + bit, bit 0 the least significant of its byte."""
    return _shr(byte_at(word, F.floor(bit / 8)), bit % 8).bitwiseAND(F.lit(1).cast("long"))


def first_bit(start: Column) -> Column:
    """Distance of a big-endian field's first (most significant) bit from the payload's first bit."""
    return F.floor(start / 8) * 8 + 7 - start % 8


def bits_needed(start: Column, length: Column, little_endian: Column) -> Column:
    """Payload bits a field reaches into."""
    return F.when(little_endian, start + length).otherwise(first_bit(start) + length)


def field(word: Column, start: Column, length: Column, little_endian: Column, signed: Column) -> Column:
    """Raw value of a field as DOUBLE: Intel runs up from its LSB, Motorola down from its MSB; sign-extended."""
    shift = F.when(little_endian, start).otherwise(F.lit(64) - first_bit(start) - length)
    bits = _shr(F.when(little_endian, swap_bytes(word)).otherwise(word), shift)
    whole = length >= 64
    one = F.lit(1).cast("long")
    raw = F.when(whole, bits).otherwise(bits.bitwiseAND(_shl(one, length) - one))
    top_set = _shr(raw, length - 1).bitwiseAND(one) == 1
    narrow = F.when(signed & top_set, raw - _shl(one, length)).otherwise(raw).cast("double")
    wide = F.when(~signed & (raw < 0), raw.cast("double") + F.lit(2.0**64)).otherwise(raw.cast("double"))
    return F.when(whole, wide).otherwise(narrow)
