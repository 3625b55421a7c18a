"""Murmur3 x86 32-bit with seed 0, from Spark's own ``hash`` (the same function, seed 42).

Spark chains ``hash(a, b)`` by using the hash of ``a`` as seed for ``b``, so a
leading literal whose hash is 0 resets the seed. For ints, longs, dates and
timestamps that is the whole answer. For byte strings Spark's hash agrees with
textbook Murmur3 only when the length is a multiple of 4, because it mixes the
1-3 tail bytes differently. So: hash the aligned prefix natively, undo the
finalizer (it is a bijection on 32 bits), mix the tail the textbook way, and
finalize with the full length. No per-byte loop and no UDF, whatever the length.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of Murmur3 and their inverses modulo 2^32.
_C1 = 0xCC9E2D51
_C2 = 0x1B873593
_F1 = 0x85EBCA6B
_F2 = 0xC2B2AE35
_F1_INV = pow(_F1, -1, 1 << 32)
_F2_INV = pow(_F2, -1, 1 << 32)
# An INT literal whose seed-42 hash is 0.
_SEED_RESET = -1693959553

_MASK = 0xFFFFFFFF


def murmur3_fixed(value: Column) -> Column:
    """Hash of an INT, BIGINT, DATE or TIMESTAMP column as a signed 32-bit integer."""
    return F.hash(F.lit(_SEED_RESET), value)


def _low32(value: Column) -> Column:
    return value.bitwiseAND(F.lit(_MASK))


def _times(value: Column, factor: int) -> Column:
    # A 32-bit value times a signed 32-bit factor always fits a BIGINT.
    signed = factor - (1 << 32) if factor >= 1 << 31 else factor
    return _low32(value * F.lit(signed).cast("bigint"))


def _xor_shift(value: Column, *shifts: int) -> Column:
    out = value
    for shift in shifts:
        out = out.bitwiseXOR(F.shiftrightunsigned(value, shift))
    return out


def stepwise(value: Column, *steps) -> Column:
    """Apply steps that each use their input several times. A one-element array
    carries the value, so it is computed once and the expression stays small."""
    carrier = F.array(value)
    for step in steps:
        carrier = F.transform(carrier, step)
    return carrier[0]


def _finalize(value: Column) -> Column:
    return stepwise(
        value,
        lambda h: _times(_xor_shift(h, 16), _F1),
        lambda h: _times(_xor_shift(h, 13), _F2),
        lambda h: _xor_shift(h, 16),
    )


def _unfinalize(value: Column) -> Column:
    return stepwise(
        value,
        lambda h: _times(_xor_shift(h, 16), _F2_INV),
        lambda h: _times(_xor_shift(h, 13, 26), _F1_INV),
        lambda h: _xor_shift(h, 16),
    )


def murmur3_bytes(value: Column) -> Column:
    """Hash of a BINARY column as an unsigned 32-bit value in a BIGINT."""
    length = F.octet_length(value).cast("bigint")
    tail_len = length.bitwiseAND(F.lit(3))
    aligned_len = length - tail_len
    prefix = F.substring(value, F.lit(1), aligned_len.cast("int"))
    aligned = _low32(F.hash(F.lit(_SEED_RESET), prefix).cast("bigint"))
    # The tail as hex, last byte first, is the little-endian integer of the tail bytes.
    tail_hex = F.hex(F.substring(value, (aligned_len + 1).cast("int"), F.lit(3)))
    tail = F.conv(
        F.concat(F.substring(tail_hex, 5, 2), F.substring(tail_hex, 3, 2),
                 F.substring(tail_hex, 1, 2)), 16, 10,
    ).cast("bigint")
    k = _times(tail, _C1)
    k = _low32(F.shiftleft(k, 15).bitwiseOR(F.shiftrightunsigned(k, 17)))
    k = _times(k, _C2)
    state = _unfinalize(aligned).bitwiseXOR(aligned_len).bitwiseXOR(k).bitwiseXOR(length)
    return F.when(tail_len == 0, aligned).otherwise(_finalize(state))


def murmur3_text(value: Column) -> Column:
    """Hash of the UTF-8 bytes of a STRING column, unsigned in a BIGINT."""
    return murmur3_bytes(value.cast("binary"))
