"""Language identification by compression: the language whose text helps most to compress a text is its language.

``learn`` takes, per language, slices of ``SLICE`` characters from a bounded sample of the labelled
texts and joins them to a raw-content dictionary of ``DICTIONARY`` bytes at most. ``identify``
compresses every whole text with each dictionary, in blocks of ``BLOCK`` bytes so that the
dictionary counts all along and not for the beginning only, and adds the sizes up. The smallest
wins; equal sizes go to the language with more labelled rows, then to the smaller name.
``score`` is the share by which the winner's size is below the second's (0 to 1; with one
language the second is a compressor without dictionary). Where it is below ``margin`` the text is
rejected: ``accepted`` is false and the guess stands beside it.

Texts are compared in lower case. Null texts and texts without a letter are ``und`` with score 0,
as is everything where nothing could be learned. Rows without text or language, or with a text without
a letter, teach nothing. Copies of a text count once in the sample. More than ``LANGUAGES`` languages are an error,
so the dictionaries never exceed 16 MB together. Repeated rows, null ids and further
columns are kept as they are; columns named like the new ones are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from .common import parts_of

DICTIONARY = 64 << 10
SLICE = 500
SLICES = 300  # sampled per language
LANGUAGES = 256
BLOCK = 4096
LEVEL = 8
MARGIN = 0.01
UNDETERMINED = "und"
NEW = ("lang_pred", "score", "accepted")
_PART = 8 << 20


@dataclass
class Languages:
    """Dictionary and number of labelled rows per language, most rows first."""

    names: list[str]
    dictionaries: list[bytes]


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Languages:
    """Dictionaries from the labelled rows of ``docs``."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(F.col("lang").isNotNull() & has_letter(F.col("text")))
    hashed = rows.withColumn("h", F.xxhash64("text"))
    seen = hashed.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("h").alias("texts")).limit(LANGUAGES + 1).collect()
    if len(seen) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not seen:
        return Languages([], [])
    share = F.create_map(*[x for r in seen for x in (F.lit(r["lang"]), F.lit(min(1.0, 4.0 * SLICES / max(1, r["texts"]))))])
    some = hashed.where(F.pmod("h", F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
    begin = F.pmod("h", F.greatest(F.length("text") - SLICE + 1, F.lit(1))).cast("int") + 1
    slices = some.select("lang", "h", F.substring("text", begin, F.lit(SLICE)).alias("slice")).dropDuplicates(["lang", "h"])
    first = F.row_number().over(W.partitionBy("lang").orderBy("h", "slice"))
    picked = slices.withColumn("k", first).where(F.col("k") <= SLICES).orderBy("lang", "k").collect()  # SLICES a language at most
    order = sorted(seen, key=lambda r: (-r["n"], r["lang"]))
    text: dict[str, bytes] = {r["lang"]: b"" for r in order}
    for r in picked:
        text[r["lang"]] += r["slice"].lower().encode() + b"\n"
    return Languages(list(text), [t[:DICTIONARY] for t in text.values()])


class Compressors:
    """One compressor per language, made once per worker."""

    def __init__(self, languages: Languages):
        import zstandard

        self.names = languages.names
        parameters = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.each = []
        for raw in languages.dictionaries:
            dictionary = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(compression_params=parameters)
            self.each.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters))
        self.plain = zstandard.ZstdCompressor(compression_params=parameters)

    def sizes(self, text: str) -> list[int]:
        data = text.lower().encode()
        blocks = [data[at : at + BLOCK] for at in range(0, len(data), BLOCK)]
        return [sum([len(c.compress(b)) for b in blocks]) for c in self.each] + ([sum([len(self.plain.compress(b)) for b in blocks])] if len(self.each) == 1 else [])

    def best(self, text: str | None) -> tuple[str, float]:
        if not self.names or not text or not any(c.isalpha() for c in text):
            return UNDETERMINED, 0.0
        sizes = self.sizes(text)
        ranked = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        best, second = ranked[0] if ranked[0] < len(self.names) else 0, ranked[1]
        return self.names[best], max(0.0, 1 - sizes[best] / sizes[second])


_made: dict[str, Compressors] = {}


def identify(docs: DataFrame, languages: Languages, text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """``docs`` with ``lang_pred, score, accepted``."""
    sent, key = docs.sparkSession.sparkContext.broadcast(languages), uuid.uuid4().hex  # LANGUAGES dictionaries at most
    names = [c for c in docs.columns if c not in NEW]
    at = names.index(text_col)
    schema = T.StructType([docs.schema[c] for c in names]).add("lang_pred", "string").add("score", "double").add("accepted", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _made:
            _made.clear()
            _made[key] = Compressors(sent.value)
        compressors = _made[key]
        for part in parts_of(batches, _PART):
            found = [compressors.best(t.as_py()) for t in part.column(at)]
            accepted = [f[0] != UNDETERMINED and f[1] >= margin for f in found]
            new = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array(accepted, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], [*names, *NEW])

    return docs.select(*names).mapInArrow(run, schema)
