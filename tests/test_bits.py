"""Bit vectors as packed bytes: every function by hand, and errors where numbers are meant."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from graphweft.functions import bits, vectors as V
from graphweft.sources import vectors as S

c = F.col


def one(df, column):
    return df.select(column.alias("x")).first().x


@pytest.fixture(scope="module")
def df(spark):
    floats = [0.5, -1.0, 0.0, 2.0] * 4 + [1.0] * 8  # bits 1 0 0 1 ... then ones
    return spark.createDataFrame([(bytes([0x99, 0x99, 0xFF]), bytes([0x98, 0x99, 0x0F]), floats, [1, 2])], "a binary, b binary, v array<float>, w array<bigint>")


def test_bits(df):
    assert one(df, bits.quantize(c("v"))) == bytes([0x99, 0x99, 0xFF])
    assert one(df, bits.length(c("a"))) == 24 and one(df, bits.kind(c("a"))) == "bit"
    assert one(df, bits.each(c("b"))) == [0, 0, 0, 1, 1, 0, 0, 1, 1, 0, 0, 1, 1, 0, 0, 1, 1, 1, 1, 1, 0, 0, 0, 0]
    assert one(df, bits.distance_hamming(c("a"), c("b"))) == 5
    assert one(df, bits.part(c("b"), 8, 24)) == bytes([0x99, 0x0F])
    assert one(df, bits.words(c("a"))) == [0xFF9999] and one(df, bits.words(F.lit(bytes(range(1, 10))))) == [0x0807060504030201, 9]
    assert one(df, bits.words(F.lit(b"\xff" * 8))) == [-1]
    assert one(df, bits.vec_bit(bits.to_json(c("a")), parse=True)) == bytes([0x99, 0x99, 0xFF])
    assert one(df, bits.distance_hamming(c("a"), F.lit(None).cast("binary"))) is None


def test_ingest_of_bits(df):
    assert one(df, S.from_blob(c("a"), 24, "bit")) == bytes([0x99, 0x99, 0xFF]) == one(df, S.to_blob(c("a"), "bit"))
    assert one(df, S.from_json_text(F.lit("[1,0,0,0,0,0,0,1]"), 8, "bit")) == bytes([0x81])
    for bad in (S.from_blob(c("a"), 16, "bit"), S.from_json_text(F.lit("[1,0]"), 8, "bit"), S.from_json_text(F.lit("[1,0,2,0,0,0,0,0]"), 8, "bit"), bits.vec_bit(F.lit(b"")), bits.part(c("a"), 8, 32)):
        with pytest.raises(Exception, match="bit|expected|beyond"):
            one(df, bad)
    with pytest.raises(ValueError):
        bits.part(c("a"), 4, 12)


def test_numbers_and_bits_are_told_apart(df):
    for f in (V.distance_l2, V.distance_l1, V.distance_cosine, V.vec_add, V.vec_sub):
        with pytest.raises(AnalysisException):
            one(df, f(c("a"), c("b")))
        with pytest.raises(Exception, match="not for vectors of type array<bigint>"):
            one(df, f(c("w"), c("w")))
    with pytest.raises(AnalysisException):
        one(df, V.distance_hamming(c("v"), c("v")))
    with pytest.raises(Exception, match="not for vectors of type array<tinyint>"):
        one(df, V.vec_normalize(c("v").cast("array<tinyint>")))
    assert one(df, V.vec_length(c("w"))) == 128 and one(df, V.vec_slice(c("w"), 64, 128)) == [2]
    with pytest.raises(Exception, match="64"):
        one(df, V.vec_slice(c("w"), 8, 16))
