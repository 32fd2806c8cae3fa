"""The operators on small made cases: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import gzip
import base64
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from graphweft.llm import dartminhash, fingerprint, inner, licences, mixing, pieces, quality, suffixes, urlrules, warc, words

LONG = " ".join(f"word{i % 997} stands{i % 31}" for i in range(20_000))


@pytest.fixture(scope="module")
def odd(spark):
    """Ids: null and repeated; texts: null, empty, blank, long, equal."""
    rows = [
        (1, LONG, "a"), (2, LONG, "a"), (2, LONG, "a"), (3, None, None), (4, "", "b"), (5, " \n ", "b"), (None, "one two three four five six", "b"),
        (None, None, "c"), (6, "one two three four five six", "a"), (7, "x" * 50_000, None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name in ("size", "key", "node", "digest", "words", "target", "keep", "host", "rule", "vec", "_row", "score"):
        df = df.withColumn(name, F.lit("mine"))
    return df


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


# 1

def test_warc_round_trip(spark, tmp_path):
    big = "p" * 100
    rows = [(1, "u", big), (3, None, big), (2, "u\r\nx", big), (4, None, None), (5, "", "short"), (6, "", "short"), (None, "", big), (2, "u", big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("payload", F.lit(2)).withColumn("id", F.lit(3))
    for compressed in (True, False):
        path = f"{tmp_path}/{compressed}"
        warc.write_archives(df, path, "page_id", F.col("html"), "url", compressed)
        got = warc.read_archives(spark, path).collect()
        assert all(r.problem is None for r in got) and len(got) == len(rows)
        view = sorted((r.id, r.type, r.refers_to, bytes(r.payload)) for r in got)
        assert ("<urn:row:1>", "response", None, big.encode()) in view
        assert view.count(("<urn:row:2>", "revisit", "<urn:row:1>", b"")) == 2 and ("<urn:row:>", "revisit", "<urn:row:1>", b"") in view
        assert view.count(("<urn:row:5>", "response", None, b"short")) == 1 and ("<urn:row:4>", "response", None, b"") in view
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "True").glob("part-*")))
    assert gzip.decompress(raw).startswith(b"WARC/1.1\r\n")  # any gzip reader takes the archives


def test_warc_of_an_empty_table(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], "page_id long, html string"), f"{tmp_path}/e", "page_id", F.col("html"))
    assert warc.read_archives(spark, f"{tmp_path}/e").count() == 0


@pytest.mark.parametrize("packed", [True, False])
def test_warc_salvage(packed):
    def record(i):
        body = f"payload {i} WARC/1.0 \x1f\x8b inside".encode()
        whole = warc._record(str(i), "u", body, len(body), __import__("hashlib").sha256(body).hexdigest(), None, "d") + warc.RECORD_END
        return warc._member(whole[:-4] + warc.RECORD_END) if packed else whole

    parts = [record(i) for i in range(8)]
    ids = lambda data: [r[2]["warc-record-id"] for r in warc.salvage(data) if r[2]]
    gaps = lambda data: [(r[0], r[1]) for r in warc.salvage(data) if r[4]]
    clean = b"".join(parts)
    assert len(ids(clean)) == 8 and not gaps(clean)
    random.seed(3)
    for _ in range(30):
        bad = random.randrange(8)
        start = sum(map(len, parts[:bad]))
        hurt = bytearray(clean)
        at = start + random.randrange(len(parts[bad]) - 4)
        hurt[at] ^= 0x55
        found, gap = ids(bytes(hurt)), gaps(bytes(hurt))
        whole = [f"<urn:row:{i}>" for i in range(8) if i != bad]
        assert [f for f in found if f in whole] == whole  # a flipped byte costs its own record at most
        assert all(start <= a and a + n <= start + len(parts[bad]) for a, n in gap)
    cut = clean[: -len(parts[7]) // 2]
    assert len(ids(cut)) == 7 and gaps(cut) == [(sum(map(len, parts[:7])), len(cut) - sum(map(len, parts[:7])))]
    junk = b"\x00junk" * 50 + clean[len(parts[0]) + 3 :]
    assert len(ids(junk)) == 6 and gaps(junk)[0][0] == 0
    assert list(warc.salvage(b"")) == []


@pytest.mark.parametrize("packed", [True, False])
def test_warc_salvage_behind_long_leading_damage(packed):
    rng = random.Random(11)

    def record(i, body):
        whole = warc._record(str(i), "u", body, len(body), hashlib.sha256(body).hexdigest(), None, "d") + warc.RECORD_END
        return warc._member(whole) if packed else whole

    parts = [record(0, rng.randbytes(100_000))] + [record(i, f"payload {i}".encode()) for i in range(1, 4)]
    rest, n = b"".join(parts[1:]), len(parts[0])
    ids = [f"<urn:row:{i}>" for i in range(1, 4)]
    broken = bytes([parts[0][0] ^ 0x55]) + parts[0][1:]  # its mark is damaged, the next is 100 000 bytes on
    for lead in (bytes(100_000), broken):
        found = list(warc.salvage(lead + rest))
        assert [(r[0], r[1]) for r in found if r[4]] == [(0, len(lead))] and [r[2]["warc-record-id"] for r in found if r[2]] == ids
    # a gzip file in the payload of a damaged first record does not decide the kind
    for inner in (gzip.compress(b"a page"), gzip.compress(b"")):
        first = bytearray(record(0, b"x" * 50 + inner + b"y" * 50))
        first[0] ^= 0x55
        found = list(warc.salvage(bytes(first) + rest))
        assert [(r[0], r[1]) for r in found if r[4]] == [(0, len(first))] and [r[2]["warc-record-id"] for r in found if r[2]] == ids


def _crawled(version, kind, ident, block, extra, content="application/http; msgtype=response"):
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {ident}", f"Content-Type: {content}", *extra, f"Content-Length: {len(block)}"]
    return f"WARC/{version}\r\n".encode() + "\r\n".join(head).encode() + b"\r\n\r\n" + block + warc.RECORD_END


def test_warc_records_of_crawlers(spark, tmp_path):
    b32 = lambda data: "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
    body = b"<html>caf\xc3\xa9</html>" * 20
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + b"%x\r\n" % 100 + body[:100] + b"\r\n%x;q=1\r\n" % (len(body) - 100) + body[100:] + b"\r\n0\r\n\r\n"
    good = [
        _crawled("1.0", "response", "both", http, [f"WARC-Block-Digest: {b32(http)}", f"WARC-Payload-Digest: {b32(body)}"]),
        _crawled("0.17", "response", "old", http, [f"WARC-Payload-Digest: {b32(body).lower()}"]),
        _crawled("0.18", "response", "hex", http, [f"WARC-Payload-Digest: SHA-256:{hashlib.sha256(body).hexdigest().upper()}"]),
        _crawled("1.1", "response", "raw-chunks", chunked, [f"WARC-Payload-Digest: {b32(chunked.partition(warc.RECORD_END)[2])}"]),
        _crawled("1.1", "response", "joined-chunks", chunked, [f"WARC-Payload-Digest: {b32(body)}"]),
        _crawled("1.1", "response", "unknown", http, ["WARC-Payload-Digest: blake9:zz"]),
        _crawled("1.1", "response", "folded", http, ["WARC-Payload-Digest: sha1:", f" {b32(body)[5:]}"]),
        _crawled("1.1", "revisit", "revisit", http.partition(body)[0], [f"WARC-Payload-Digest: {b32(body)}"]),
        _crawled("1.1", "response", "cut", http[:90], [f"WARC-Payload-Digest: {b32(body)}", "WARC-Truncated: length"]),
        _crawled("1.0", "warcinfo", "info", b"software: x\r\n", [], "application/warc-fields"),
        _crawled("1.0", "metadata", "none", b"", []),
    ]
    bad = [
        _crawled("1.0", "response", "block", http, [f"WARC-Block-Digest: {b32(body)}"]),
        _crawled("1.0", "response", "payload", http, [f"WARC-Payload-Digest: {b32(http)}"]),
        _crawled("1.x", "response", "version", http, []),
    ]
    names = ["both", "old", "hex", "raw-chunks", "joined-chunks", "unknown", "folded", "revisit", "cut", "info", "none"]
    for pack in (lambda r: r, warc._member):
        found = list(warc.salvage(b"".join(pack(r) for r in good)))
        assert [r[2]["warc-record-id"] for r in found] == names and not [r for r in found if r[4]]
        for record in bad:
            found = list(warc.salvage(pack(good[0]) + pack(record) + pack(good[1])))
            assert [r[2] and r[2]["warc-record-id"] for r in found] == ["both", None, "old"] and found[1][1] == len(pack(record))
    (tmp_path / "crawl.warc.gz").write_bytes(b"".join(map(warc._member, good)))
    got = {r.id: r for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert bytes(got["both"].payload) == body and got["both"].payload_bytes == len(body) and got["both"].http_head.startswith("HTTP/1.1 200 OK")
    assert got["info"].http_head is None and bytes(got["info"].payload) == b"software: x\r\n"


def test_warc_members_of_several_records(spark, tmp_path):
    def record(i):
        body = f"payload {i}".encode()
        return warc._record(str(i), "u", body, len(body), hashlib.sha256(body).hexdigest(), None, "d") + warc.RECORD_END

    records = [record(i) for i in range(6)]
    ids = lambda data: [r[2]["warc-record-id"] for r in warc.salvage(data) if r[2]]
    all_ids = [f"<urn:row:{i}>" for i in range(6)]
    one = gzip.compress(b"".join(records))
    few = [gzip.compress(b"".join(records[i : i + 2])) for i in (0, 2, 4)]
    assert ids(one) == all_ids and ids(b"".join(few)) == all_ids and not [r for r in warc.salvage(one + b"".join(few)) if r[4]]
    wrong = gzip.compress(records[0] + records[1].replace(b"payload 1", b"payload x") + records[2])  # packed with a wrong digest
    found = list(warc.salvage(few[0] + wrong + few[2]))
    assert [r[2]["warc-record-id"] if r[2] else None for r in found] == [all_ids[0], all_ids[1], all_ids[0], None, all_ids[2], all_ids[4], all_ids[5]]
    assert found[3][:2] == (len(few[0]), len(wrong)) and "payload digest differs" in found[3][4]
    hurt = bytearray(b"".join(few))
    hurt[len(few[0]) + 40] ^= 0x55
    assert ids(bytes(hurt)) == all_ids[:2] + all_ids[4:]
    (tmp_path / "a.warc.gz").write_bytes(one)
    assert sorted(r.id for r in warc.read_archives(spark, str(tmp_path)).collect()) == all_ids


# 2

def test_sketches(spark, odd, none):
    s = odd.withColumn("s", fingerprint.sketch(F.col("text"))).select("doc_id", "s", fingerprint.to_text(F.col("s")).alias("f"), fingerprint.from_text(fingerprint.to_text(F.col("s"))).alias("back"))
    rows = s.collect()
    assert all(r.back == r.s for r in rows) and {len(r.s) for r in rows if r.doc_id in (3, 4, 5)} == {0}
    assert len({r.f for r in rows if r.doc_id in (1, 2)}) == 1
    a, b = " ".join(f"w{i}" for i in range(3000)), " ".join(f"w{i}" for i in range(1500, 4500))
    pair = spark.createDataFrame([(a, b)], "a string, b string").select(*[fingerprint.sketch(F.col(c)).alias(c) for c in "ab"])
    r = pair.select(
        fingerprint.resemblance(F.col("a"), F.col("b")).alias("j"), fingerprint.containment(F.col("a"), F.col("b")).alias("c"), fingerprint.distinct_shingles(F.col("a")).alias("n"),
        fingerprint.merge(F.col("a"), F.col("b")).alias("m"),
    ).first()
    assert abs(r.j - 1496 / 4496) < 0.1 and abs(r.c - 0.5) < 0.12 and abs(r.n / 2996 - 1) < 0.25
    # parts that share the words at their border give the sketch of the whole
    w = a.split()
    parts = spark.createDataFrame([("k", " ".join(w[:1004])), ("k", " ".join(w[1000:])), ("e", "")], "k string, t string").withColumn("sketch", fingerprint.sketch(F.col("t")))
    merged = {x.k: x.sketch for x in fingerprint.merge_by(parts, ["k"]).collect()}
    assert merged["k"] == pair.first().a and merged["e"] == []
    assert none.select(fingerprint.sketch(F.col("text"))).count() == 0


def test_next_in_order(spark, odd, none):
    rows = fingerprint.with_next(odd.select("doc_id", "text"), "doc_id", "text", lambda d: d, ["doc_id"]).collect()
    assert sorted(r.next_doc_id or 0 for r in rows) == sorted(r.doc_id or 0 for r in rows)
    assert {r.doc_id: r.next_doc_id for r in rows if r.doc_id and r.doc_id > 3} == {7: 6, 6: 5, 5: 4, 4: 3}
    assert fingerprint.with_next(none.select("doc_id", "text"), "doc_id", "text", lambda d: d, ["doc_id"]).count() == 0
    one = spark.createDataFrame([(9, "t")], "doc_id long, text string")
    assert fingerprint.with_next(one, "doc_id", "text", lambda d: d, ["text"]).first().next_text == "t"
    many = spark.range(-500, 700).select((F.col("id") * F.col("id") * F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    ids = sorted(r.doc_id for r in many.collect())
    assert {r.doc_id: r.next_doc_id for r in fingerprint.with_next(many, "doc_id", "text", lambda d: d, ["doc_id"]).collect()} == {d: ids[i - 1] for i, d in enumerate(ids)}


# 3

def test_top_inner_products(spark):
    rng = np.random.default_rng(1)
    vec = [[float(x) for x in rng.normal(size=6) * rng.exponential()] for _ in range(400)]
    rows = [(i, v) for i, v in enumerate(vec)] + [(7, vec[7]), (500, vec[3]), (600, None), (601, [1.0, None]), (602, [float("nan")]), (603, [float("inf")]), (None, vec[0]), (700, []), (701, [2.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>").withColumn("score", F.lit(1)).withColumn("vec", F.lit(2))
    whole = df.select("id", inner.whole_numbers(F.col("v"), 256.0).alias("w"))
    got = {(r.query_id, r["rank"]): (r.id, r.score) for r in inner.top_k(whole, whole.where("id % 50 = 0"), 5, "id", "w", query_block=3).collect()}
    ints = {i: [int(np.floor(256 * x)) for x in v] + [0] * (6 - len(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = {}
    for q in ints:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(ints[q], ints[i])), i) for i in ints if i != q)[:5]
            want |= {(q, n + 1): (i, -s) for n, (s, i) in enumerate(best)}
    assert got == want
    assert inner.top_k(whole.where("false"), whole, 5, "id", "w").count() == 0 and inner.top_k(whole, whole.where("false"), 5, "id", "w").count() == 0
    with pytest.raises(ValueError):
        inner.top_k(whole, whole, 0)


# 4

def test_url_rules(spark, odd):
    urls = [
        "http://a.com/x", "http://com/", "http://com", "HTTP://WWW.Example.com/en/1?q", "http://example.com/en/", "http://b.example.com/en/#", "http://notexample.com/en/",
        "http://x.net/es/1", "http://net/fr/", "http://a,b.com/x", None, "nonsense", "x://", "http://É.com/ü", "http://a.com:80/x", "http://u?http://v/en/", "http://.com/x", "http://a.b.c.d.example.com/en/x",
    ]
    rows = [(i, u) for i, u in enumerate(urls * 3)] + [(None, "http://a.com/x")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    for name in ("host", "path", "rule", "verdict", "_key", "_row", "key"):
        df = df.withColumn(name, F.lit("mine"))
    rules = spark.createDataFrame([*urlrules.RULES, ("com", "/", "allow"), ("a/b", "/", "block"), (None, "/", "block")], "host string, path string, verdict string")
    got = urlrules.judge(df, rules, "page_id")
    assert set(got.columns) == set(df.columns)

    def plain(u):
        import re

        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")
        hits = [(len(h), len(p), h + p, v) for h, p, v in urlrules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, max(hits)[2], max(hits)[3]) if hits else (host, path, None, "allow")

    assert sorted(map(str, ((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()))) == sorted(map(str, ((i, *plain(u)) for i, u in rows)))
    assert {r.verdict for r in urlrules.judge(df, rules.where("false"), "page_id", default="block").collect()} == {"block"}
    assert urlrules.judge(df.where("false"), rules, "page_id").count() == 0


# 5

def test_dart_signatures_estimate_weighted_likeness():
    rng = np.random.default_rng(2)
    item = words.mixed(np.arange(300, dtype=np.uint64))
    a, b = rng.exponential(size=300) * 2, rng.exponential(size=300) * 2
    b[:150] = a[:150]
    owner = np.repeat([0, 1, 2], 300)
    s = dartminhash.signatures(owner, np.tile(item, 3), np.concatenate([a, b, a]), 4, 3000)
    assert abs((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04
    assert (s[0] == s[2]).all() and not s[3].any()


def test_likeness_is_exact():
    left, right = ["a b c d e f", "a " * 10, "", "x", "a b c d e f g"], ["a b c d e f", "a " * 20, " ", "y", "a b c d e f h"]
    assert np.allclose(dartminhash.likeness(pa.array(left), pa.array(right), 5), [1, 6 / 16, 1, 0, 2 / 4])


def test_near_classes(spark, odd, none):
    rows = dartminhash.near_classes(odd.select("doc_id", "text", "key", "node", "digest")).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.class_id)
    assert len(rows) == odd.count() and by[2] == {1} and by[6] == {6} and by[4] == {3} and by[5] == {5} and by[None] == {6, 3}
    kept = dartminhash.one_of_each(odd)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 6, 7] and kept.columns == odd.columns
    assert dartminhash.near_classes(none).count() == 0 and dartminhash.one_of_each(none).count() == 0
    # an id that stands for its own class lets no other text through, and the text that stays comes once
    a, u, v = ("alpha beta gamma delta epsilon zeta " * 3, "u v w x y z", "one more text of its own kind here")
    rows = spark.createDataFrame([(1, a, "s"), (None, a, "s"), (None, u, "s"), (9, a, "s"), (9, v, "t"), (9, v, "s")], "doc_id long, text string, source string")
    assert sorted(map(tuple, dartminhash.one_of_each(rows).collect()), key=str) == sorted([(1, a, "s"), (None, u, "s"), (9, v, "s")], key=str)


def test_a_large_group_of_near_copies_is_one_class(spark):
    """Copies edited apart are about 0.72 near to each other; only the original joins them."""
    random.seed(4)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(base)]
    for n in range(150):
        w = list(base)
        for at in range(0, 300, 60):
            w[at + random.randrange(50)] = f"e{n}x{at}"
        texts.append(" ".join(w))
    texts += [" ".join(f"z{i}y{n}" for i in range(300)) for n in range(20)]
    random.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    classes = {r.doc_id: r.class_id for r in dartminhash.near_classes(df).collect()}
    group = {classes[i] for i, t in enumerate(texts) if not t.startswith("z")}
    assert len(group) == 1 and len(set(classes.values())) == 21


def test_near_classes_do_not_depend_on_the_order_of_rows(spark):
    """Every column is a fact of the table, none of the comparisons that were made."""
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join([*base[:n], f"e{n}", *base[n + 1 :]]) for n in range(0, 200, 20)] + ["another text of seven words in all"] * 3
    rows = list(enumerate(texts))
    want = sorted((i, 0 if i < 10 else 10, 1 if i < 10 else 3) for i in range(13))
    for some in (rows, rows[::-1]):
        got = dartminhash.near_classes(spark.createDataFrame(some, "doc_id long, text string"))
        assert got.columns == ["doc_id", "class_id", "copies"] and sorted(map(tuple, got.collect())) == want


# 6

def test_vote_model_finds_accuracies():
    rng = np.random.default_rng(5)
    truth = rng.random(20_000) < 0.7
    votes = np.full((20_000, 5), quality.ABSTAIN)
    for j, (right, says) in enumerate([(0.95, 0.9), (0.9, 0.8), (0.8, 0.9), (0.75, 0.5), (0.55, 0.9)]):
        speaks = rng.random(20_000) < says
        votes[speaks, j] = np.where(rng.random(20_000) < right, truth, ~truth)[speaks]
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_votes(patterns, counts.astype(float))
    assert abs(model.good - 0.7) < 0.03 and abs(model.table[0, 1, 1] - 0.95) < 0.03 and abs(model.table[4, 1, 1] - 0.55) < 0.03
    majority = (votes == 1).sum(1) > (votes == 0).sum(1)
    assert ((model.posterior(votes) >= 0.5) == truth).mean() > (majority == truth).mean()


def test_quality_on_odd_rows(spark, odd, none):
    got = quality.classify(odd)
    assert set(got.columns) == set(odd.columns) | {"posterior", "score", "keep"} and got.count() == odd.count()
    assert all(r.score == 0.0 and not r.keep for r in got.where("text is null or trim(text, ' \n') = ''").collect())
    assert got.where("doc_id in (1, 2)").select("score").distinct().count() == 1
    assert quality.classify(none).count() == 0


# 7

def test_mixing(spark, odd, none):
    rng = random.Random(6)
    docs = [(i, " ".join("w" * rng.randint(0, 60)), rng.choice(["a"] * 8 + ["b", "b", "c", None])) for i in range(3000)] + [(None, "w w", "a"), (5, None, "a")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("size", F.lit(9)).withColumn("target", F.lit(1))
    rows = mixing.mix(df, shard_docs=700).collect()
    assert len(rows) == len(docs) and sorted(rows, key=str) == sorted(mixing.mix(df.repartition(5), shard_docs=700).collect(), key=str)
    size, want, got = {}, {}, {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
        size[r.source] = size.get(r.source, 0) + r["size"]
        got[r.source] = got.get(r.source, 0) + r.taken
        want[r.source] = r.target
    left, targets, total = dict(zip(sorted(size, key=lambda s: (s is None, s)), (5, 2, 1, 5))), {}, 1.5 * sum(size.values())
    while True:
        level = (total - sum(targets.values())) / sum(left.values())
        over = [s for s, w in left.items() if w * level > 2 * size[s]]
        if not over:
            break
        for s in over:
            targets[s] = 2.0 * size[s]
            del left[s]
    targets |= {s: w * level for s, w in left.items()}
    assert all(abs(targets[s] - want[s]) < 1e-6 * targets[s] for s in size)
    assert all(abs(got[s] - want[s]) <= 64 for s in size)  # a block, however many shards there are
    assert mixing.mix(odd).count() == odd.count() and mixing.mix(none).count() == 0
    heads = spark.createDataFrame([(" a  bb\tc", n, 3) for n in range(4)], "t string, n long, s long").select("n", mixing.first_words(F.col("t"), F.col("n"), F.col("s")).alias("h"))
    assert {r.n: r.h for r in heads.collect()} == {0: "", 1: " a", 2: " a  bb", 3: " a  bb\tc"}


def test_thinly_spread_sources_get_their_targets(spark):
    rows = [(i, "w " * 10, "thin") for i in range(100)] + [(100 + i, "w " * 30, "thick") for i in range(39_900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for shard_docs in (200, 5000, 100_000):
        got = mixing.mix(df, shard_docs=shard_docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
        assert all(abs(r.taken - r.target) <= 64 for r in got) and {r.target for r in got if r.source == "thin"} == {2000.0}


def test_apportion_deals_every_block_in_order(spark):
    rng = random.Random(9)
    for n, block in ((1, 64), (40, 64), (300, 7)):
        sizes = [(str(i), rng.choice([0, 3, 64, 1000, 10**5]), 0.0) for i in range(n)]
        sizes = [(s, z, float(rng.choice([z, 2 * z, z / 3, 32, 32]))) for s, z, _ in sizes]
        got = mixing.apportion(spark.createDataFrame(sizes, "source string, source_size long, target double"), block, 1e9).collect()
        left = int(sum(t for *_, t in sizes) / block + 0.5)
        quotients = sorted(((-t / (2 * a + 1), s) for s, _, t in sizes if t for a in range(int(t / block) + n + 2)))[:left]
        want = {s: sum(q[1] == s for q in quotients) * block for s, *_ in sizes}
        assert {r.source: r._words for r in got} == {s: min(w, int(1e9 * z)) for (s, z, _), w in zip(sizes, (want[s] for s, *_ in sizes))}


def test_quotas_follow_the_highest_quotients(spark):
    docs = [(i, "w " * 64, s) for i, s in enumerate("a" * 53 + "b" * 24 + "c" * 23)]
    rows = mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string"), weights=(1,), share=1.0, most=2.0, shard_docs=1000).collect()
    got = {s: sum(r.taken for r in rows if r.source == s) // 64 for s in "abc"}
    target = {r.source: r.target for r in rows}
    seats = dict.fromkeys("abc", 0)
    for _ in range(100):
        s = max("abc", key=lambda s: (target[s] / (2 * seats[s] + 1), -ord(s)))
        seats[s] += 1
    assert got == seats


# 8

def test_merge_of_transforms_gives_the_repeated_intervals():
    random.seed(7)
    for _ in range(60):
        depth = random.choice([1, 2, 4, 9])
        texts = [bytes(random.choice(b"ab") for _ in range(random.randint(1, 15))) for _ in range(random.randint(1, 9))]
        rows, parts = [], []
        for shard in (texts[:3], texts[3:4], texts[4:]):
            if shard:
                symbols = np.frombuffer(b"\xff".join(shard) + b"\xff", np.uint8) + np.uint8(1)
                ends = np.flatnonzero(symbols == 0)
                order, bwt, step = suffixes.transform(symbols, ends[np.searchsorted(ends, np.arange(len(symbols)))], depth)
                begin = np.concatenate([[-1], ends])[np.searchsorted(ends, np.arange(len(symbols)))] + 1
                suffix = [bytes(symbols[i : ends[np.searchsorted(ends, i)]] - 1) for i in order]
                assert [s[:depth] for s in suffix] == sorted(s[:depth] for s in suffix)
                rows += suffix
                parts.append((bwt, step, np.flatnonzero((np.arange(len(symbols)) - begin >= depth)[order])))
        row, block = suffixes.merge(parts, depth)
        found = {}
        for r, k in zip(row.tolist(), block.tolist()):
            found.setdefault(k, []).append(r)
        want = {}
        for r, s in enumerate(rows):
            if len(s) >= depth:
                want.setdefault(s[:depth], []).append(r)
        assert sorted(sorted(v) for v in found.values()) == sorted(v for v in want.values() if len(v) > 1)
        assert [rows[v[0]][:depth] for _, v in sorted(found.items())] == sorted(w for w, v in want.items() if len(v) > 1)


def plain_repeats(docs, length):
    first = {}
    for d, t in docs:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            first[w] = min(first.get(w, (d, i)), (d, i))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < (d, i):
                gone[i : i + length] = True
        out.append((d, len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())))
    return sorted(out)


@pytest.mark.parametrize("how", [{}, {"most": 1, "bucket": 20}])
def test_repeated_bytes(spark, how):
    random.seed(8)
    passage = "".join(random.choice("abcdé ") for _ in range(150))
    docs = [(i, "".join(random.choice("abcdé ") for _ in range(random.randint(0, 200))) + random.choice([passage, passage[20:], passage[:120], ""]) + "ab" * random.choice([0, 0, 90])) for i in range(60)]
    docs += [(60, docs[3][1]), (61, None), (62, ""), (62, ""), (63, "\x00" * 250), (64, docs[5][1]), (64, docs[5][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("doc", F.lit(2)).withColumn("spans", F.lit(3))
    got = sorted(tuple(r)[:4] for r in suffixes.digests(df, **how).collect())
    assert got == plain_repeats(docs, 100)


def test_repeated_bytes_of_rows_with_one_id(spark):
    """Of rows that share an id, null or repeated, one is an exact copy and another repeats a part."""
    rng = random.Random(12)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    first, second = text(400), text(300)
    docs = [(1, first), (2, second), (9, second), (9, text(80) + first[50:250] + text(60)), (9, text(150)), (None, first), (None, text(30) + second[:180] + text(50)), (None, text(40) + first[200:] + "é"), (None, text(200))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    numbered = [(99 if d is None else d, t) for d, t in docs]
    got = sorted((99 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.digests(df).collect())
    assert got == plain_repeats(numbered, 100) and sum(n > 0 for _, _, n, _ in got) == 5
    left = "\n".join(r.text for r in suffixes.remove(df).where("doc_id is null or doc_id > 2").collect())
    assert first[60:240] not in left and second[10:170] not in left and first[210:390] not in left


def test_repeated_bytes_of_odd_rows(spark, odd, none):
    got = suffixes.digests(odd)
    assert got.count() == odd.count()
    by = {r.doc_id: r for r in got.where("doc_id is not null").collect()}
    assert by[1].n_removed < by[1].n_bytes and by[2].n_removed == by[2].n_bytes and by[7].n_removed == by[7].n_bytes - 1 and by[7].n_spans == 1
    left = suffixes.remove(odd)
    assert left.columns == odd.columns and left.count() == odd.count()
    assert {r.text for r in left.where("doc_id = 2").collect()} == {""} and {r.text for r in left.where("doc_id = 7").collect()} == {"x"}
    assert suffixes.digests(none).count() == 0 and suffixes.remove(none).count() == 0


# 9

def test_licences(spark, odd):
    corpus = spark.createDataFrame([(i, "\n".join(f"plain line {i} {j} of some text" for j in range(4))) for i in range(60)], "doc_id long, text string").unionAll(odd.select("doc_id", "text"))
    scanner = licences.train(corpus)
    lines = [
        "Licensed under the Apache License, Version 2.0.", "released under the mit license", "// This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: MPL-2.0", "He renewed his driving license in public.", "Permission was denied.", "nothing at all",
    ]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, None), (3, ""), (4, " \n\n"), (None, lines[0]), (5, LONG), (6, lines[0]), (6, lines[0])], "doc_id long, text string")
    found = licences.scan(df.withColumn("family", F.lit("mine")).withColumn("p", F.lit(1)), scanner).collect()
    got = {r.paragraph: r.family for r in found if r.doc_id == 1 and r.confirmed}
    assert got == {0: "Apache", 1: "MIT", 2: "GPL", 3: "CC-BY-NC", 4: "CC-BY-SA", 5: "MPL"}
    assert sum(r.doc_id == 6 for r in found) == 2 and sum(r.doc_id is None for r in found) == 1 and not [r for r in found if r.doc_id in (2, 3, 4, 5)]
    assert all(0 < r.probability <= 1 for r in found)
    assert licences.scan(df.where("false"), scanner).count() == 0


def test_bare_cc_by_lines(spark):
    """Short words are features too, so notices of nothing else are scored."""
    corpus = spark.createDataFrame([(1, "a plain line")], "doc_id long, text string")
    lines = ["(c) 2021 A. Smith, CC BY 4.0", "Text and figures: CC BY 4.0", "Available under CC BY 4.0 terms", "CC BY 4.0", "He came by at 4 and left.", "The cc went out by post."]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    scanner = licences.train(corpus)
    assert {r.doc_id for r in licences.paragraphs(df, "doc_id", "text").collect()} >= {0, 1, 2, 3, 5}
    got = {r.doc_id: r.family for r in licences.scan(df, scanner).collect()}
    assert [got.get(i) for i in range(4)] == ["CC-BY"] * 4 and 4 not in got
    assert {"cc", "cc by", "by 4.0", "cc by 4.0"} <= set(licences.vocabulary())


def test_licence_templates_left_out_of_training(spark):
    """Wordings that the model has not seen, as held-out accuracy."""
    corpus = spark.createDataFrame([(1, "a plain line")], "doc_id long, text string")
    scanner = licences.train(corpus)
    unseen = [
        ("This project is licensed under the Apache License 2.0", "Apache"), ("Distributed under the MIT License, see LICENSE", "MIT"), ("Licensed under the GNU General Public License version 2 or later", "GPL"),
        ("Available under the BSD 3-Clause License", "BSD"), ("Content licensed under Creative Commons Attribution-NonCommercial 4.0", "CC-BY-NC"), ("Subject to the Mozilla Public License 2.0", "MPL"),
        ("The public library was free for all.", None), ("She works for a version control company.", None),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(unseen)], "doc_id long, text string")
    got = {r.doc_id: r.family for r in licences.scan(df, scanner).collect()}
    assert sum(got.get(i) == f for i, (_, f) in enumerate(unseen)) >= 7


# 10

@pytest.fixture(scope="module")
def model_file():
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


def test_pieces_equal_the_library(model_file):
    import sentencepiece

    model, library = pieces.Pieces(model_file), sentencepiece.SentencePieceProcessor(model_file=model_file)
    random.seed(9)
    some = ["a", "b", "e", "th", "ing", " ", "  ", "▁", "\n", "é", "́", "ß", "1", ".", "'", "梦", "😀", "\x00", "<s>", "tion", "The"]
    texts = ["", " ", "▁", "x" * 400, "the" * 300, " " * 40, "a" * 3000, "<0x0A>"] + ["".join(random.choice(some) for _ in range(random.randint(1, 60))) for _ in range(2500)]
    for t in texts:
        ids = library.encode(t)
        assert model.encode(t) == ids and model.decode(ids) == library.decode(ids), t
    for _ in range(1500):
        ids = [random.choice([random.randrange(32_000), random.randrange(300)]) for _ in range(random.randint(0, 9))]
        assert model.decode(ids) == library.decode(ids), ids


def test_pieces_on_odd_rows(spark, odd, none, model_file):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model_file)
    rows = pieces.decode(pieces.encode(odd.withColumn("ids", F.lit(1)), model_file), model_file).collect()
    assert len(rows) == odd.count()
    assert all(r.ids == library.encode(r.text or "") and r.decoded == (r.text or "") for r in rows)
    assert sorted(r.n_tokens for r in pieces.digests(odd, model_file).collect()) == sorted(len(r.ids) for r in rows)
    assert pieces.digests(none, model_file).count() == 0 and pieces.encode(none, model_file).count() == 0


def test_pieces_known_to_the_model_outlast_a_task():
    import public_tokenizers

    model = pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["one two\nthree", "a  b", " lead", "trail ", " ", "▁", "a▁b", "a▁ b", "x", "", "snow☃man zzzxq"]
    for text in texts:
        marked = (pieces.SPACE if model.dummy else "") + text.replace(" ", pieces.SPACE)
        assert model.parts(text) == (pieces._PARTS.findall(marked) if text else [])
        assert model.decode(model.encode(text)) == text.replace(pieces.SPACE, " ")
    before, pairs = [model.digest(t) for t in texts], len(model.fits)
    model.forget()
    assert pairs and len(model.fits) == pairs and not model.known
    assert [model.digest(t) for t in texts] == before


def test_quality_arrays_of_a_part_stay_small():
    import tracemalloc

    from graphweft.llm.common import parts_of

    line = "The quick brown fox jumps over the lazy dog near the old river bank. "
    batch = pa.RecordBatch.from_arrays([pa.array([f"{i} {line * 40}" for i in range(4200)])], ["text"])  # 12 MB
    scorer = quality.Scorer(np.zeros(quality.BUCKETS), 0.0)
    tracemalloc.start()
    try:
        for part in parts_of(iter([batch]), quality._PART):
            values, counts = quality.measures(part.column(0))
            scorer.score(part.column(0), values, counts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 250 << 20, peak >> 20


def test_signing_texts_of_a_batch_takes_little_memory():
    """near_dedup in the pipeline: texts are signed a part at a time, and a part's arrays are some fifty times its text."""
    import tracemalloc

    from graphweft.llm.common import parts_of

    text = pa.array([" ".join(str(n) for n in np.random.default_rng(i).integers(0, 10**6, 350)) for i in range(3500)])
    batch = pa.RecordBatch.from_arrays([text], ["text"])
    assert batch.nbytes > 8 << 20
    tracemalloc.start()
    try:
        for part in parts_of(iter([batch]), dartminhash._PART):
            dartminhash._banded(part.column(0), 5, 24, 6)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 120 << 20


def test_pairs_of_two_blocks_hash_every_text_once(monkeypatch):
    """op5_near_classes on check_h: a large family of texts that are nearly near; each was hashed once for every pair."""
    rng = np.random.default_rng(3)
    words_of = np.array([f"w{i}" for i in range(40)])
    texts = pa.array(["", "  ", "a b", "a b a b a b a b a b a b", None, *[" ".join(words_of[rng.integers(0, 40, rng.integers(1, 60))]) for _ in range(40)]])
    n = len(texts)
    i, j = (x.ravel() for x in np.indices((n, n)))
    assert np.array_equal(dartminhash._grid(texts, texts, 2, width=64)[i, j], dartminhash.likeness(texts.take(pa.array(i)), texts.take(pa.array(j)), 2))
    family = pa.array([" ".join(np.where(rng.random(200) < 0.02, "x", np.arange(200).astype(str))) for _ in range(2 * n)])
    signs = dartminhash._signs(family, 5, 144)
    blocks = [pa.table({"node": np.arange(n) + k * n, "class": np.arange(n) + k * n, "band": np.zeros(n, np.int64), "text": family.slice(k * n, n), "signs": signs.slice(k * n, n)}) for k in (0, 1)]
    few = dartminhash._links(*blocks, 0.8, 5, 24, 6)
    monkeypatch.setattr(dartminhash, "MANY", 0)
    hashed, plain = [], words.shingle_hashes
    monkeypatch.setattr(words, "shingle_hashes", lambda t, k: hashed.append(len(t)) or plain(t, k))
    many = dartminhash._links(*blocks, 0.8, 5, 24, 6)
    assert len(few[0]) and all(np.array_equal(a, b) for a, b in zip(few, many, strict=True))
    assert sum(hashed) == 2 * n
