"""Scalar vector functions (H1–H12) as native expressions on arrays.

Float vectors are ``ARRAY<FLOAT>``, int8 vectors ``ARRAY<TINYINT>``, bit vectors packed bytes (``functions.bits``) or, for the
search kernels, ``ARRAY<BIGINT>`` with 64 dimensions per word, lowest bit first. Arithmetic runs in
double. Searches over whole tables use the Arrow kernels of ``operators.knn``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WORD = 64


def _numbers(v: Column, value: Column, kinds: tuple[str, ...] = ("array<float>", "array<double>", "array<tinyint>", "array<int>")) -> Column:
    """``value``, or an error if ``v`` is a vector of another kind; the type is known when the query is planned."""
    return F.when(F.typeof(v).isin(*kinds), value).otherwise(F.raise_error(F.concat(F.lit("not for vectors of type "), F.typeof(v))))


def _checked(a: Column, b: Column, value: Column, bits: bool = False) -> Column:
    """NULL for NULL input, an error for vectors of different length, and for bits where numbers are meant or the reverse."""
    kinds = ("array<bigint>",) if bits else ("array<float>", "array<double>", "array<tinyint>", "array<int>")
    value = _numbers(a, _numbers(b, value, kinds), kinds)
    message = F.concat(F.lit("vector dimensions differ: "), F.size(a), F.lit(" and "), F.size(b))
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None))
        .when(F.size(a) != F.size(b), F.raise_error(message))
        .otherwise(value)
    )


def _sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, x: acc + x)


def _pairwise(a: Column, b: Column, f) -> Column:
    return F.zip_with(a, b, lambda x, y: f(x.cast("double"), y.cast("double")))


def dot(a: Column, b: Column) -> Column:
    return _sum(_pairwise(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def distance_l2(a: Column, b: Column) -> Column:
    return _checked(a, b, F.sqrt(_sum(_pairwise(a, b, lambda x, y: (x - y) * (x - y)))))


def distance_l1(a: Column, b: Column) -> Column:
    return _checked(a, b, _sum(_pairwise(a, b, lambda x, y: F.abs(x - y))))


def distance_cosine(a: Column, b: Column) -> Column:
    return _checked(a, b, 1 - dot(a, b) / (norm(a) * norm(b)))


def distance_hamming(a: Column, b: Column) -> Column:
    """Differing bits of two packed vectors."""
    differing = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return _checked(a, b, F.aggregate(differing, F.lit(0), lambda acc, x: acc + x), bits=True)


def vec_length(v: Column) -> Column:
    """Dimensions; a word of a packed bit vector has 64."""
    return F.size(v) * F.when(F.typeof(v) == "array<bigint>", F.lit(WORD)).otherwise(F.lit(1))


def vec_type(v: Column) -> Column:
    kind = F.typeof(v)
    return (
        F.when(kind == "array<float>", "float32").when(kind == "array<double>", "float64")
        .when(kind == "array<tinyint>", "int8").when(kind == "array<bigint>", "bit")
    )


def vec_to_json(v: Column) -> Column:
    return F.to_json(v)


def vec_add(a: Column, b: Column) -> Column:
    return _checked(a, b, F.zip_with(a, b, lambda x, y: x + y))


def vec_sub(a: Column, b: Column) -> Column:
    return _checked(a, b, F.zip_with(a, b, lambda x, y: x - y))


def vec_slice(v: Column, start: int, end: int) -> Column:
    """Elements start … end-1; an empty or impossible range is an error."""
    if start < 0 or end <= start:
        raise ValueError("slice needs 0 <= start < end")
    too_long = F.raise_error(F.lit(f"slice end {end} is beyond the vector"))
    numbers = F.slice(v, start + 1, end - start)
    if start % WORD == 0 and end % WORD == 0:
        words = F.slice(v, start // WORD + 1, (end - start) // WORD)
    else:
        words = F.when(F.typeof(v) == "array<bigint>", F.raise_error(F.lit("words of bits are cut at multiples of 64; use bits.part"))).otherwise(v)
    return F.when(vec_length(v) < end, too_long).when(F.typeof(v) == "array<bigint>", words).otherwise(numbers)


def vec_normalize(v: Column) -> Column:
    """Unit length; for float vectors only."""
    return _numbers(v, F.transform(v, lambda x: x.cast("double") / norm(v)), ("array<float>", "array<double>"))


def vec_f32(text_or_array: Column, parse: bool = False) -> Column:
    return F.from_json(text_or_array, "array<float>") if parse else text_or_array.cast("array<float>")


def vec_int8(text_or_array: Column, parse: bool = False) -> Column:
    return (F.from_json(text_or_array, "array<int>") if parse else text_or_array).cast("array<tinyint>")


def quantize_int8(v: Column) -> Column:
    """Scale [-1, 1] to [-128, 127], truncating toward zero."""
    def q(x: Column) -> Column:
        scaled = (x.cast("double") + 1.0) / (2.0 / 255.0) - 128.0
        return F.greatest(F.lit(-128.0), F.least(F.lit(127.0), scaled)).cast("tinyint")

    return F.transform(v, q)


def _pack(v: Column, test) -> Column:
    """Words of 64 bits; a short last word is filled with zeros."""
    def word(start: Column) -> Column:
        part = F.slice(v, start * WORD + 1, F.lit(WORD))
        bits = F.transform(part, lambda x, i: F.when(test(x), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
        return F.aggregate(bits, F.lit(0).cast("long"), lambda acc, b: acc.bitwiseOR(b))

    words = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / WORD).cast("int"))
    return F.transform(words, word)


def quantize_binary(v: Column) -> Column:
    """Bit set where x > 0; the dimension must be a multiple of 8."""
    wrong = F.raise_error(F.lit("binary quantisation needs a multiple of 8 dimensions"))
    return F.when(F.size(v) % 8 != 0, wrong).otherwise(_pack(v, lambda x: x > 0))


def quantize_binary_inclusive(v: Column) -> Column:
    """The variant of the two-phase search: bit set where x >= 0."""
    return _pack(v, lambda x: x >= 0)


def vec_each(v: Column) -> Column:
    """One row per element: ``pos``, ``col``."""
    return F.posexplode(v)
