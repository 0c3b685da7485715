import hashlib
import re

import pytest
from pyspark.sql import functions as F

from lectern.llm import fingerprints as fp


def words(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]


def brute(spark, texts, width=5, scale=8):
    """Sketches with hashes taken one shingle at a time."""
    rows = [(i, tuple(w[j : j + width])) for i, w in enumerate(map(words, texts)) for j in range(max(1, len(w) - width + 1)) if w]
    df = spark.createDataFrame([(i, list(s)) for i, s in rows], "i int, s array<string>")
    hashes = {}
    for r in df.select("i", F.xxhash64("s").alias("h")).collect():
        hashes.setdefault(r.i, set()).add(r.h)
    cut = -(1 << 63) + (1 << 64) // scale
    out = []
    for i in range(len(texts)):
        h = hashes.get(i, set())
        low = sorted(x for x in h if x < cut)
        out.append(low or sorted(h)[:1])
    return out


def likeness(a, b):
    n = min(len(a), len(b))
    return len(set(a) & set(b)) / n if n else float(len(a) == len(b))


@pytest.mark.parametrize("per_bucket", [2000, 2])
def test_edits_match_brute_force(spark, monkeypatch, per_bucket):
    texts = ["a b c d e f g h", None, "", "Émile 🙂 said " * 9, "x", *["n%d " % (i % 7) * (i % 40) + "common words stand here again " for i in range(30)]]
    docs = spark.createDataFrame([(100 - 3 * i, t, "s", 9) for i, t in enumerate(texts)], "doc_id long, text string, sketch string, n int")
    original = fp.with_next
    monkeypatch.setattr(fp, "with_next", lambda d, c: original(d, c, per_bucket))
    got = {r.doc_id: r for r in fp.fingerprint_edits(docs.repartition(3)).collect()}
    order = sorted(range(len(texts)), key=lambda i: 100 - 3 * i)
    plain = [t or "" for t in texts]
    edited, following = {}, {}
    for at, i in enumerate(order):
        nxt = order[(at + 1) % len(order)]
        cut = len(plain[i]) // 4
        edited[i] = plain[i][: len(plain[i]) - cut] + plain[nxt][:cut]
        following[i] = nxt
    a, b = brute(spark, plain), brute(spark, [edited[i] for i in range(len(texts))])
    hexed = lambda s: "".join(f"{x & (1 << 64) - 1:016x}" for x in s)
    for i in range(len(texts)):
        r = got[100 - 3 * i]
        assert r.n_chars == len(plain[i])
        assert r.edited_sha256 == hashlib.sha256(edited[i].encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (hexed(a[i]), hexed(b[i]))
        assert r.near_edited == pytest.approx(likeness(a[i], b[i]))
        assert r.near_next == pytest.approx(likeness(a[i], a[following[i]]))


def test_merge_and_containment(spark):
    long = " ".join(f"t{i}" for i in range(4000))
    part = " ".join(f"t{i}" for i in range(1000, 1400))
    row = spark.createDataFrame([(long, part, "", "other words")], "a string, b string, c string, d string").select(
        fp.containment(fp.sketch(F.col("b")), fp.sketch(F.col("a"))).alias("part"),
        fp.containment(fp.sketch(F.col("a")), fp.sketch(F.col("b"))).alias("whole"),
        fp.containment(fp.sketch(F.col("c")), fp.sketch(F.col("d"))).alias("none"),
        (fp.merge(fp.sketch(F.col("b")), fp.sketch(F.col("a"))) == fp.sketch(F.col("a"))).alias("merged"),
        (fp.merge(fp.sketch(F.col("c")), fp.sketch(F.col("d"))) == fp.sketch(F.col("d"))).alias("small"),
    ).first()
    assert row.part == 1.0 and 0.05 < row.whole < 0.16 and row.none == 0.0 and row.merged and row.small


def test_odd_rows(odd_docs, no_docs):
    got = fp.fingerprint_edits(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert len({r.fingerprint for r in got if r.doc_id in (0, 1)}) == 1
    assert fp.fingerprint_edits(no_docs).count() == 0
    one = fp.fingerprint_edits(odd_docs.where("doc_id = 6")).first()
    assert one.near_next == 1.0


@pytest.mark.parametrize("most", [16384, 2])
def test_equal_and_null_ids_split_and_follow_by_hash(spark, most):
    ids = [None] * 120 + [7] * 90 + list(range(100, 160)) + [1 << 62, (1 << 63) - 1]
    rows = [(i, f"text {n}") for n, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__h", F.xxhash64("text")).repartition(3)
    dealt, ranges = fp._ranges(docs, len(ids), 10, most)
    sizes = [r["count"] for r in dealt.groupBy("__b").count().collect()]
    assert len(sizes) == ranges and (max(sizes) <= 40 or most == 2)
    got = {r.text: r.next_text for r in fp.with_next(docs, ["text"], 10, most).collect()}
    order = sorted(((-1 if r.doc_id is None else r.doc_id, r["__h"], r.text) for r in docs.collect()))
    assert got == {a[2]: b[2] for a, b in zip(order, order[1:] + order[:1])}
