"""Base16/Base32 of bit strings, Base64 text, ``family:qualifier`` names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the Base32 alphabet of RFC 4648.
BASE32_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

# Fixed value: the digits that ``conv`` writes in base 32.
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used there."""
    return F.transform(F.array(value), body)[0]


def _pad(text: Column, multiple: int, fill: str) -> Column:
    """Add ``fill`` on the right up to a multiple of ``multiple``."""
    length = F.length(text)
    return F.rpad(text, length + F.pmod(-length, F.lit(multiple)), F.lit(fill))


def _convert(bits: Column, width: int, base: int, bits_per_digit: int) -> Column:
    """Digits of a bit string in a base of 2**bits_per_digit, leading zeros kept.

    ``conv`` takes 64 bits at most; a longer text is converted in pieces.
    """

    def piece(text: Column) -> Column:
        digits = (F.length(text) / bits_per_digit).cast("int")
        return F.lpad(F.conv(text, 2, base), digits, F.lit("0"))

    starts = F.sequence(F.lit(0), F.length(bits) - 1, F.lit(width))
    pieces = F.transform(starts, lambda i: piece(F.substr(bits, i + 1, F.lit(width))))
    return F.when(F.length(bits) <= width, piece(bits)).otherwise(F.array_join(pieces, ""))


def _convert_fixed(bits: Column, length: int, width: int, base: int, bits_per_digit: int) -> Column:
    """The same for bit strings that all have ``length`` bits."""
    pieces = []
    for first in range(0, length, width):
        taken = min(width, length - first)
        text = bits if taken == length else F.substr(bits, F.lit(first + 1), F.lit(taken))
        pieces.append(F.lpad(F.conv(text, 2, base), taken // bits_per_digit, "0"))
    return pieces[0] if len(pieces) == 1 else F.concat(*pieces)


def _up_to(length: int, multiple: int) -> int:
    return -(-length // multiple) * multiple


def base16_bits(bits: Column, length: int | None = None) -> Column:
    """Base16 of a bit string padded with zeros to whole bytes.

    With ``length``, the number of bits of every string, the work stays in
    generated code.
    """
    if length is not None:
        whole = _up_to(length, 8)
        return _convert_fixed(F.rpad(bits, whole, "0"), whole, 64, 16, 4)
    padded = _with(bits, lambda b: _pad(b, 8, "0"))
    return _with(padded, lambda b: _convert(b, 64, 16, 4))


def base32_bits(bits: Column, length: int | None = None) -> Column:
    """Base32 of a bit string padded with zeros to whole bytes, ``=`` at the end."""
    if length is not None:
        whole = _up_to(_up_to(length, 8), 5)
        digits = _convert_fixed(F.rpad(bits, whole, "0"), whole, 60, 32, 5)
        letters = F.translate(digits, CONV_DIGITS, BASE32_ALPHABET)
        return F.rpad(letters, _up_to(whole // 5, 8), "=")
    whole_bytes = _with(bits, lambda b: _pad(b, 8, "0"))
    padded = _with(whole_bytes, lambda b: _pad(b, 5, "0"))
    digits = _with(padded, lambda b: _convert(b, 60, 32, 5))
    letters = F.translate(digits, CONV_DIGITS, BASE32_ALPHABET)
    return _with(letters, lambda text: _pad(text, 8, "="))


def base64_text(encoded: Column) -> Column:
    return F.unbase64(encoded).cast("string")


def column_family(name: Column) -> Column:
    """Part of ``family:qualifier`` before the first colon."""
    return F.substring_index(name, ":", 1)


def column_qualifier(name: Column) -> Column:
    """Part of ``family:qualifier`` after the first colon."""
    return F.substr(name, F.instr(name, ":") + 1)
