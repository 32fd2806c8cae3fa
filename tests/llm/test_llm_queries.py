"""Every query of the subpackage against its SQL, or against a plain version where there is none."""

import glob
import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from graphweft.llm.queries import ORACLE, QUERIES
from graphweft.plans.check import connect, rows_of_duck, rows_of_spark, type_differences

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not glob.glob(f"{SF}/*.parquet"), reason="no test data here")


@pytest.fixture(scope="module")
def docs(spark):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    con = connect(SF)
    df = QUERIES[name](spark, SF)
    names, got = rows_of_spark(df)
    want_names, want = rows_of_duck(con, ORACLE[name])
    assert names == want_names and got == want and got
    assert not type_differences(df, con, ORACLE[name])


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text, n=5):
    w = words(text)
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else Counter([tuple(w)] if w else [])


def test_op2(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op2_fingerprints"](spark, SF).collect()}
    down = docs[::-1]

    def likeness(a, b):
        a, b = set(shingles(a)), set(shingles(b))
        return len(a & b) / len(a | b) if a | b else 1.0

    assert len(got) == len(docs)
    same = {}
    for i, (d, t) in enumerate(down):
        following = down[(i + 1) % len(down)][1]
        edited = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        r = got[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - likeness(t, edited)) < 0.15 and abs(r.near_next - likeness(t, following)) < 0.15
        assert same.setdefault(t, r.fingerprint) == r.fingerprint


def test_op5(spark, docs):
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            shared = sum((sets[i] & sets[j]).values())
            union = sum(sets[i].values()) + sum(sets[j].values()) - shared
            if docs[i][1] == docs[j][1] or union and shared / union >= 0.8:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    want = {d: docs[root(i)][0] for i, (d, _) in enumerate(docs)}
    assert {r.doc_id: r.class_id for r in QUERIES["op5_near_classes"](spark, SF).collect()} == want


def test_op6_agrees_with_labels(spark, docs):
    got = {r.doc_id: r.keep for r in QUERIES["op6_quality"](spark, SF).collect()}
    assert len(got) == len(docs)
    labels = {r.doc_id: r.quality == 1 for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert np.mean([got[d] == q for d, q in labels.items()]) > 0.97
    assert all(got[d] for d, q in labels.items() if q)


def removed(docs, length):
    first = {}
    for d, t in docs:
        b = t.encode()
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], (d, i))
    for d, t in docs:
        b = t.encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < (d, i):
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        yield d, (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())


def test_op8(spark, docs):
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op8_repeated_bytes"](spark, SF).collect()}
    assert got == dict(removed(docs, 100))


def test_op9_finds_the_licence_lines(spark, docs):
    got = {(r.doc_id, r.paragraph): r.family for r in QUERIES["op9_licences"](spark, SF).collect() if r.confirmed}
    family = {"Apache": "Apache", "MIT": "MIT", "GNU": "GPL", "CC BY-NC": "CC-BY-NC"}
    want = {(d, i): next(f for k, f in family.items() if k in line) for d, t in docs for i, line in enumerate(t.split("\n")) if "icensed under" in line or "MIT License" in line}
    assert got == want


def test_op10(spark, docs):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op10_piece_round_trip"](spark, SF).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {d: (len(ids := model.encode(t)), sha(",".join(map(str, ids))), sha(model.decode(ids))) for d, t in docs}
