"""Bit vectors: packed bytes (``BINARY``), eight dimensions a byte, lowest bit first.

The dimension is eight times the number of bytes. Functions for numbers do not take them: their arguments are arrays, so that
the analysis of a plan refuses a bit vector where numbers are meant.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _byte(v: Column, at: Column) -> Column:
    return F.conv(F.hex(F.substring(v, at + 1, F.lit(1))), 16, 10).cast("int")


def _packed(flags: Column) -> Column:
    """Bytes from an array of booleans whose size is a multiple of eight."""
    def byte(k: Column) -> Column:
        ones = F.transform(F.slice(flags, k * 8 + 1, F.lit(8)), lambda x, i: F.when(x, F.call_function("shiftleft", F.lit(1), i)).otherwise(F.lit(0)))
        return F.lpad(F.hex(F.aggregate(ones, F.lit(0), lambda a, b: a + b).cast("long")), 2, "0")

    count = F.floor(F.size(flags) / 8).cast("int")
    wrong = F.raise_error(F.concat(F.lit("a bit vector needs a positive multiple of 8 dimensions, got "), F.size(flags)))
    bytes_ = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), byte), ""))
    return F.when(flags.isNull(), F.lit(None)).when((F.size(flags) % 8 != 0) | (F.size(flags) == 0), wrong).otherwise(bytes_)


def vec_bit(v: Column, parse: bool = False) -> Column:
    """A bit vector from packed bytes, or (``parse``) from JSON text of 0 and 1. Empty ones are an error."""
    if parse:
        items = F.from_json(v, "array<int>")
        odd = F.exists(items, lambda x: x.isNull() | ~x.isin(0, 1))
        return F.when(odd, F.raise_error(F.lit("bits are 0 or 1"))).otherwise(_packed(F.transform(items, lambda x: x == 1)))
    empty = F.raise_error(F.lit("a bit vector must not be empty"))
    return F.when(F.octet_length(v) == 0, empty).otherwise(v.cast("binary"))


def quantize(v: Column) -> Column:
    """Bit set where x > 0; the dimension must be a multiple of 8 (H11 as packed bytes)."""
    return _packed(F.transform(v, lambda x: x > 0))


def length(v: Column) -> Column:
    return F.octet_length(v) * 8


def kind(v: Column) -> Column:
    return F.when(F.typeof(v) == "binary", "bit")


def each(v: Column) -> Column:
    """The bits as an array of 0 and 1."""
    return F.transform(F.sequence(F.lit(0), length(v) - 1), lambda i: F.call_function("shiftright", _byte(v, F.floor(i / 8).cast("int")), i % 8).bitwiseAND(1))


def to_json(v: Column) -> Column:
    return F.to_json(each(v))


def part(v: Column, start: int, end: int) -> Column:
    """Dimensions start … end-1; both must be multiples of 8."""
    if start < 0 or end <= start or start % 8 or end % 8:
        raise ValueError("a slice of bits needs 0 <= start < end, both multiples of 8")
    too_long = F.raise_error(F.lit(f"slice end {end} is beyond the vector"))
    return F.when(length(v) < end, too_long).otherwise(F.substring(v, start // 8 + 1, (end - start) // 8))


def words(v: Column) -> Column:
    """The bits as 64-bit numbers for the search kernels; a short last word is filled with zeros."""
    count = F.ceil(F.octet_length(v) / 8).cast("int")

    def word(i: Column) -> Column:
        chunk = F.rpad(F.hex(F.substring(v, i * 8 + 1, F.lit(8))), 16, "0")
        low_first = F.array_join(F.transform(F.sequence(F.lit(7), F.lit(0), F.lit(-1)), lambda k: F.substring(chunk, k * 2 + 1, F.lit(2))), "")
        return F.conv(low_first, 16, -10).cast("long")

    return F.transform(F.sequence(F.lit(0), count - 1), word)


def distance_hamming(a: Column, b: Column) -> Column:
    """Differing bits; NULL for NULL, an error for different dimensions."""
    message = F.concat(F.lit("vector dimensions differ: "), length(a), F.lit(" and "), length(b))
    differing = F.zip_with(words(a), words(b), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    value = F.aggregate(differing, F.lit(0), lambda acc, x: acc + x)
    return F.when(a.isNull() | b.isNull(), F.lit(None)).when(length(a) != length(b), F.raise_error(message)).otherwise(value)
