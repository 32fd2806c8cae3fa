"""Language, filter audit and spelling variants on small made cases, and on the test tables where SQL cannot follow."""

import glob
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from graphweft.llm import audit, language, spelling
from graphweft.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 997} stands{i % 31}" for i in range(20_000))


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, LONG, "en"), (2, LONG, "de"), (2, LONG, "de"), (3, None, "en"), (4, "", None), (5, " \n ", ""), (None, "ONE TWO three", "en"), (None, "ONE TWO three", "en"),
        (None, None, "fr"), (6, "ONE TWO three", "en"), (7, "x" * 50_000, None), (8, "|", "en"), (9, "one two three", "en"), (10, "12 34 !", "en"), (-3, "one two three", "en"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in ("id", "n", "mask", "part", "good", "word", "root", "h", "score", "lang_pred", "accepted", "digest", "step"):
        df = df.withColumn(name, F.lit("mine"))
    return df


# 11


def test_language_of_odd_rows(spark, odd):
    languages = language.learn(odd)
    assert languages.names == ["en", "de"]  # null, and languages without a letter, teach nothing
    got = language.identify(odd, languages).select("doc_id", "text", "lang_pred", "score", "accepted", "word").collect()
    assert len(got) == odd.count() and all(r.word == "mine" and 0 <= r.score <= 1 for r in got)
    assert all((r.lang_pred, r.score, r.accepted) == ("und", 0.0, False) for r in got if r.text is None or not re.search(r"[^\W\d_]", r.text))
    assert {r.lang_pred for r in got if r.text and re.search(r"[^\W\d_]", r.text)} <= {"en", "de"}
    nothing = language.identify(odd, language.learn(odd.where("false")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"} and language.identify(odd.where("false"), languages).count() == 0


def test_language_rejects_narrow_margins(spark):
    rows = [("aus dem Haus ging der Hund in den Wald und schlief", "de"), ("the dog left the house and slept in the woods", "en")]
    docs = spark.createDataFrame([(t * k, x) for t, x in rows for k in range(1, 40)], "text string, lang string")
    languages = language.learn(docs)
    asked = spark.createDataFrame([("the dog slept and the dog left the house " * 300,), ("der Hund schlief in dem Wald und der Hund ging " * 300,), ("qzx",)], "text string")
    got = language.identify(asked, languages, margin=0.05).collect()
    assert [(r.lang_pred, r.accepted) for r in got[:2]] == [("en", True), ("de", True)] and not got[2].accepted
    one = language.learn(docs.where("lang = 'de'"))
    assert {r.lang_pred for r in language.identify(asked, one).collect()} == {"de"}


def test_language_counts_copies_once(spark):
    docs = spark.createDataFrame([("same old text here",  "xx")] * 3000 + [(f"text number {i} of many", "xx") for i in range(50)], "text string, lang string")
    assert language.learn(docs).dictionaries[0].count(b"\n") == 51


@pytest.mark.skipif(not glob.glob(f"{SF}/*.parquet"), reason="no test data here")
def test_language_on_held_out_documents(spark):
    sf = SF.replace("0.001", "0.01")
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op11_language"](spark, sf).collect()
    assert len(got) == len(langs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)
    sure = [r for r in held if r.accepted]
    assert sum(r.lang_pred == langs[r.doc_id] for r in sure) >= 0.97 * len(sure) and len(sure) > 0.85 * len(held)


# 12


def plain_audit(docs, labels):
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    good, toxic = ({d for d, q, x in labels if d is not None and (q, x)[k] == 1} for k in (0, 1))
    parts = {}
    for d, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = "".join(f for f, no in zip("ABCDE", (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), re.search(r"[#$%&*|]", t), d is not None and d > first[t]), strict=True) if no)
        parts.setdefault(lang or "", []).append((fails, d in good, d in toxic))
    out = {}
    for part, each in parts.items():
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                here = [x for x in each if f in x[0] and not set(x[0]) & set(order[:k])]
                shapley[f] += len(here)
                out[part, order, k + 1] = [
                    sum(not set(x[0]) & set(order[: k + 1]) for x in each), len(here), sum(f in x[0] and bool(set(x[0]) & set(order[:k])) for x in each),
                    sum(x[0] == f for x in each), sum(x[1] for x in here), sum(x[2] for x in here),
                ]
        for (p, order, k), values in out.items():
            if p == part:
                values.append(shapley[order[k - 1]])
    return out


def test_audit_of_odd_rows(spark, odd):
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, 0), (6, 0, 1), (None, 1, 1), (9, None, None), (77, 1, 1), (8, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("theirs"))
    got = {(r.part, r.filter_order, r.step): list(r)[3:] for r in audit.audit(audit.masks(odd, marks)).collect()}
    assert got == plain_audit([(r.doc_id, r.text, r.lang) for r in odd.collect()], labels)
    assert len(got) == 4 * 600
    assert audit.audit(audit.masks(odd.where("false"), marks)).count() == 0
    assert audit.audit(audit.masks(odd, marks.where("false"))).count() == 4 * 600


def test_potential_gives_the_removals_of_all_orders(spark):
    random.seed(3)
    counts = [("p", m, random.randrange(50), 0, 0) for m in range(32)]
    df = spark.createDataFrame(counts, "part string, mask int, n long, good long, toxic long")
    row = audit.potentials(audit.games(df), 5).first()
    v = [sum(n for _, m, n, *_ in counts if m & s) for s in range(32)]
    assert row.n == v and row.total == sum(c[2] for c in counts)
    for i in range(5):
        want = sum(v[(b := sum(1 << j for j in o[: o.index(i)])) | 1 << i] - v[b] for o in permutations(range(5)))
        assert row.potential[31] - row.potential[31 ^ 1 << i] == want


# 13


def plain_variants(n, ratio=5):
    near = {w: set() for w in n}
    rest = {}
    for w in n:
        for i in range(len(w)):
            short = w[:i] + w[i + 1 :]
            if short in n:
                near[w].add(short)
                near[short].add(w)
            rest.setdefault((i, short), []).append(w)
    for words in rest.values():
        for w in words:
            near[w] |= set(words) - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        yield w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None


def plain_words(docs, slips, min_length=6, min_count=5):
    n = Counter()
    low = str.maketrans(spelling.UPPER, spelling.LOWER)
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            n[run if not slips or h % slips else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: k for w, k in n.items() if len(w) >= min_length and k >= min_count}


def check_variants(spark, n):
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    assert sorted(map(tuple, spelling.variants(words).collect())) == sorted(plain_variants(n))


def test_variants_by_brute_force(spark):
    random.seed(5)
    n = {}
    for _ in range(400):  # a small alphabet and runs of equal letters: many neighbours, several ways to each
        w = "".join(random.choice("aabÀé") for _ in range(random.randint(1, 7)))
        n[w] = random.choice([5, 6, 30, 200, 5000])
    check_variants(spark, n)
    check_variants(spark, {"a" * k: 5 ** (k % 7 + 1) for k in range(1, 40)})  # one shared beginning, long chains
    check_variants(spark, {"x" * 500 + "y": 5, "x" * 30 + "z": 99, "w" * 3000: 7, "w" * 20: 8})
    check_variants(spark, {"alone": 5})


def test_variants_of_odd_rows(spark, odd):
    docs = odd.unionByName(odd.limit(0)).select("*")
    for slips in (None, 2, 199):
        words = spelling.count_words(docs, slips=slips, min_length=1, min_count=1)
        n = plain_words([(r.doc_id, r.text) for r in odd.collect()], slips, 1, 1)
        assert {r.word: r.n for r in words.collect()} == n
    got = spelling.variants(spelling.count_words(docs, slips=2, min_length=2, min_count=1))
    assert sorted(map(tuple, got.collect())) == sorted(plain_variants(plain_words([(r.doc_id, r.text) for r in odd.collect()], 2, 2, 1)))
    assert spelling.variants(spelling.count_words(odd.where("false"))).count() == 0
