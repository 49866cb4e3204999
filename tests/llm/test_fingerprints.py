import bisect
import hashlib

import numpy as np
import pyarrow as pa
import pytest
from brute import words
from tidemark.llm import fingerprints as P
from tidemark.llm import jaccard_join as J

COMMON = set(P.common_words())


def spots(text):
    w, out = words(text), set()
    content = [k for k, x in enumerate(w) if x not in COMMON]
    for k, x in enumerate(w):
        if x in COMMON:
            at = bisect.bisect(content, k)
            chain = [w[y] for y in content[at : at + P.CHAIN]]
            if len(chain) == P.CHAIN:
                out.add((x, *chain))
    return out or ({("all", *w)} if w else {("raw", text)} if text else set())


def like(a, b):
    a, b = spots(a), spots(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [t or "" for _, t in rows]
    out = []
    for k, (i, _) in enumerate(rows):
        a, b = texts[k], texts[(k + 1) % len(texts)]
        e = a[: len(a) - len(a) // 2] + b[: len(a) // 2]
        out.append((i, len(a), hashlib.sha256(e.encode()).hexdigest(), round(like(a, e), 9), round(like(a, b), 9)))
    return sorted(out, key=str)


def run(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in P.edited_fingerprints(df).collect()), key=str)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3)
    assert run(docs) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "!!"), (3, "!!"), (3, "the big red dog"), (None, "the big red dog"), (7, "é" * 7), (9, "the cat sat down on the mat of the day before " * 3000)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, block string")
    assert run(df) == expected(rows)
    assert run(df.limit(0)) == []
    assert run(df.filter("doc_id = 9")) == expected(rows[-1:])


def test_equal_texts_have_equal_fingerprints(spark):
    rows = spark.createDataFrame([(1, "of the old grey house"), (2, "Of the OLD grey house!"), (3, "of the new grey house")], "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in P.edited_fingerprints(rows).collect()}
    assert got[1] == got[2] != got[3]
    assert len(P.decoded(got[1])) == 2


def brute_groups(texts, threshold):
    """(id, smallest id of the group, links), over all pairs."""
    sets = [spots(t) for t in texts]
    root, links = list(range(len(texts))), [0] * len(texts)
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= threshold * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = sorted((root[a], root[b]))
                root = [x if r == y else r for r in root]
    return sorted(zip(range(len(texts)), root, links, strict=True))


@pytest.mark.parametrize("block, threshold", [(1024, 0.7), (8, 0.85)])
def test_near_copies(spark, monkeypatch, block, threshold):
    monkeypatch.setattr(J, "BLOCK", block)
    random = np.random.default_rng(2)
    base = " ".join(f"the w{k} v{k} u{k}" for k in range(40)).split()
    texts = [" ".join(x if random.random() > 0.02 else f"z{random.integers(99)}" for x in base[: random.integers(100, 160)]) for _ in range(60)]
    texts += texts[:3] + ["", None, "!!", "!!", "no anchor here", "of a b"] + ["the cat sat down on the mat " * 9000, "the cat sat down on the mat " * 8000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r["id"], r.class_id, r.n_links) for r in P.near_copies(df, threshold=threshold).collect())
    assert got == brute_groups(texts, threshold) and sum(x[2] for x in got) > 20


def test_near_copies_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    df = spark.createDataFrame([(k, r.text) for k, r in enumerate(docs)], "doc_id long, text string")
    got = sorted((r["id"], r.class_id, r.n_links) for r in P.near_copies(df).collect())
    assert got == brute_groups([r.text for r in docs], 0.8) and any(n for _, _, n in got)


def test_bitmaps_bound_the_difference():
    random = np.random.default_rng(1)
    sets = [np.unique(random.integers(0, 1 << 63, random.integers(1, 900)).astype(np.uint64)) for _ in range(20)]
    sets += [np.unique(np.append(x[: int(len(x) * 0.9)], random.integers(0, 1 << 63, 30).astype(np.uint64))) for x in sets]
    maps = P.bitmaps(len(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets]), np.concatenate(sets))
    for a in range(len(sets)):
        for b in range(len(sets)):
            assert np.bitwise_count((maps[a] ^ maps[b]).view(np.uint64)).sum() <= len(np.setxor1d(sets[a], sets[b]))


def test_signature_count():
    owner, _ = P.signatures(pa.array(["the x b c d", "the x b", ""]))
    assert owner.tolist() == [0, 1]
