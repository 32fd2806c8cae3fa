"""The corpus pipeline, each stage against a plain version on what the stage before kept."""

import glob
import hashlib
import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from graphweft.llm import mixing, quality
from test_llm_operators import plain_repeats
from test_llm_queries import shingles

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not glob.glob(f"{SF}/*.parquet"), reason="no test data here")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    base, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{base}/{name}")
        before, docs = docs, spark.read.parquet(f"{base}/{name}")
        out.append((before, docs))
    return out


def test_columns(steps):
    for before, after in steps[:-1]:
        assert after.dtypes == before.dtypes
        assert all(r.n_chars == len(r.text) for r in after.collect())


def test_quality(steps):
    before, after = steps[0]
    assert after.count() == quality.classify(before).where("keep").count() < before.count()


def test_near_copies(steps):
    before, after = ({r.doc_id: r.text for r in df.collect()} for df in steps[1])
    assert len(set(after.values())) == len(after) < len(before) and set(after) < set(before)
    sets = {d: shingles(t) for d, t in before.items()}
    parent = {d: d for d in before}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in before:
        for b in before:
            shared = sum((sets[a] & sets[b]).values()) if a < b else 0
            if a < b and (before[a] == before[b] or shared and shared / (sum(sets[a].values()) + sum(sets[b].values()) - shared) >= 0.8):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    assert set(after) == {d for d in before if root(d) == d}


def test_repeats(steps):
    before, after = ({r.doc_id: r.text for r in df.collect()} for df in steps[2])
    for d, size, removed, spans in plain_repeats(sorted(before.items()), 100):
        left = len(after.get(d, "").encode())
        assert size - removed - 6 * spans <= left <= size - removed  # a cut may break a character on either side


def test_mix(steps):
    before, after = steps[3]
    texts = {r.doc_id: r.text for r in before.collect()}
    words = lambda t: len(re.findall(mixing.WORD, t))
    taken = {r.doc_id: r.taken for r in mixing.mix(before).collect() if r.taken}
    got = {}
    for r in after.collect():
        assert texts[r.doc_id].startswith(r.text)
        got[r.doc_id] = got.get(r.doc_id, 0) + words(r.text)
    assert got == taken


def test_encode(steps):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    before, after = steps[4]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = sorted((r.doc_id, len(ids := model.encode(r.text)), sha(",".join(map(str, ids))), sha(model.decode(ids))) for r in before.collect())
    assert sorted(map(tuple, after.collect())) == want


def test_registered(spark, steps):
    assert entry.queries()["pipeline"](spark, SF).count() == steps[-1][1].count()
    assert [n for n in entry.queries() if n.startswith("op")] and corpus_pipeline.ORACLE_SQL is None
