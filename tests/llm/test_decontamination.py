import numpy as np
import pytest
from brute import words
from tidemark.llm import decontamination as D


def expected(rows, items):
    bench = {}
    for i, text in items:
        w = words(text)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            bench.setdefault(tuple(w[k : k + n]), set()).add("" if i is None else str(i))
    out = []
    for i, text in rows:
        w = words(text)
        hit, found = set(), set()
        for n in {len(b) for b in bench}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in bench:
                    hit |= set(range(k, k + n))
                    found |= bench[x]
        out.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(docs, bench, **options):
    got = D.decontaminate(docs, bench, **options).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in got), key=str)


def test_documents_in_one_and_many_parts(spark, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    want = expected([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in bench.collect()])
    assert run(docs, bench) == want and any(w[4] for w in want)
    assert run(docs, bench, part_bytes=3000) == want


def random_text(random, n, letters="abc"):
    return " ".join(random.choice(list(letters), n))


def test_overlaps_and_ties(spark):
    random = np.random.default_rng(7)
    items = [(k % 20, random_text(random, random.integers(0, 20), "ab")) for k in range(30)] + [(None, "x y"), (50, None), (51, ""), (52, "é, É!")]
    rows = [(k, random_text(random, random.integers(0, 60))) for k in range(80)] + [(1, None), (1, ""), (None, "X-y z"), (3, "é"), (4, "É"), (5, "q " * 100_000 + "x y")]
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, n_hit long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = expected(rows, items)
    assert run(docs, bench) == want
    assert run(docs, bench, part_bytes=40) == want
    assert run(docs.limit(0), bench) == []
    assert all(not r[4] and not r[2] for r in run(docs, bench.limit(0)))


@pytest.mark.parametrize("text, left", [("aa bb one two three cc", "aa bb  cc"), ("One, two; THREE!", "!"), ("é one two three é", "é  é"), ("clean", "clean")])
def test_spans_are_removed(spark, text, left):
    docs = spark.createDataFrame([(1, text, "t")], "doc_id long, text string, source string")
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert [tuple(r) for r in D.clean(docs, bench, "spans").collect()] == [(1, left, "t")]


def test_documents_are_removed(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, "one two three" + " w" * 100), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert sorted(r.doc_id for r in D.clean(docs, bench).collect()) == [2, 3]


def test_hash_collisions_are_verified(spark, monkeypatch):
    monkeypatch.setattr(D, "windows", lambda w, n: (lambda k, h: (k, h & np.uint64(7)))(*WINDOWS(w, n)))
    index = D.build_index([("1", "a b c"), ("2", "d e")], 3)
    w = D.words(*D.string_buffers(D.pa.array(["a b c d e", "a b d e", "c a b"])))
    hit, pairs = D._hits(w, index)
    assert hit.tolist() == [True] * 5 + [False, False, True, True] + [False] * 3
    assert [(r, index.names[i]) for r, i in pairs.tolist()] == [(0, "1"), (0, "2"), (1, "2")]


WINDOWS = D.windows


@pytest.mark.parametrize("share, cut", [(0.65, 0.65), (0.05, 0.05), (1, 1.0), (0.333, 0.333), (0.5, 0.5)])
def test_shares_are_exact(spark, share, cut):
    """Documents of 1000 words whose hit words are just below, at and above the share."""
    item = " ".join(f"w{k}" for k in range(1000))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    at = round(1000 * cut)
    rows = [(n, " ".join([f"w{k}" for k in range(n)] + ["q"] * (1000 - n))) for n in {max(13, at - 1), at, min(1000, at + 1)}]
    got = D.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), bench, least_share=share).collect()
    assert {r.doc_id: r.contaminated for r in got} == {n: n >= at for n, _ in rows}
    assert all(r.n_hit == r.doc_id for r in got)


def test_the_same_window_of_many_items_is_stored_once():
    text = " ".join(f"w{k}" for k in range(40))
    index = D.build_index([(str(k), text) for k in range(50)])
    (s,) = index.sets
    assert len(s.hashes) == 28 and len(s.items) == 28 * 50
    again = D.pickle.loads(D.pickle.dumps(index, protocol=5))
    w = D.words(*D.string_buffers(D.pa.array([text])))
    assert D._hits(w, again)[1].tolist() == [[0, k] for k in range(50)]


def test_index_is_not_much_larger_than_its_text():
    random = np.random.default_rng(3)
    text = " ".join(f"{x:x}" for x in random.integers(0, 1 << 20, 100_000))
    assert len(D.pickle.dumps(D.build_index([("1", text)]), protocol=5)) < 6 * len(text)
