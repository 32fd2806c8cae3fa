"""Every stage of the pipeline on odd rows: null and repeated ids, null and empty texts, clashing columns, an empty table."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

GOOD = "The council met on the first day of the month. It heard from all of the members, and it voted for the plan with a few changes to the budget. "
CLASHING = ("size", "target", "taken", "words", "score", "keep", "posterior", "digest", "c_0", "source_size")


@pytest.fixture(scope="module")
def odd(spark):
    a, u, v = GOOD * 2, "Another text of the same kind is in the list of the day, and it is for the reader to see. " * 3, GOOD.replace("council", "board") + "This is the end of it, as far as we know. " * 2
    rows = [(1, a, "s"), (None, a, "s"), (None, u, None), (9, a, "s"), (9, v, "t"), (9, v, "t"), (3, None, "t"), (4, "", None), (5, " \n ", "t"), (6, "!!! $$$ ### " * 30, "s")]
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], "doc_id long, text string, source string, n_chars long")
    return df.withColumns({c: F.lit(f"my {c}") for c in CLASHING})


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage(spark, odd, name, stage):
    got = stage(spark, odd, "").collect()
    if name != "encode":
        assert stage(spark, odd, "").columns == odd.columns
        assert all(r[c] == f"my {c}" for r in got for c in CLASHING)
        rows = {(r.doc_id, r.text, r.source) for r in odd.collect()}
        if name in ("quality", "near_dedup"):
            assert {(r.doc_id, r.text, r.source) for r in got} <= rows
        if name == "near_dedup":
            texts = [r.text for r in got]
            assert len(texts) == len(set(texts)) and {t for _, t, _ in rows if t} <= set(texts)  # one of each, none lost
        if name == "mix":
            assert all(r.text and r.n_chars == len(r.text) for r in got)
    else:
        assert len(got) == odd.count()
    assert stage(spark, odd.where("false"), "").count() == 0
