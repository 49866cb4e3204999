import numpy as np
import pytest
from brute import groups, shingles
from tidemark.llm import jaccard_join as J

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def run(df):
    return sorted(((r["id"], r["class_id"], r["n_links"]) for r in J.jaccard_join(df).collect()), key=str)


def test_all_documents_against_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert run(docs) == groups([(r.doc_id, r.text) for r in docs.collect()])


def test_near_copies_of_every_degree(spark):
    random = np.random.default_rng(5)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(300):
        w = list(base)
        for at in random.integers(0, 60, random.integers(0, 5)):
            w[at] = f"x{random.integers(0, 400)}"
        rows.append((k, " ".join(w), None, None, 0))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert run(df) == groups([r[:2] for r in rows])


def test_blocks_of_large_groups(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 16)
    random = np.random.default_rng(6)
    rows = [(k, " ".join(f"w{x if x != random.integers(0, 30) else 1000 + k}" for x in range(40)), None, None, 0) for k in range(120)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == groups([r[:2] for r in rows])


def test_edges(spark):
    long = " ".join(f"word{k % 977}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, "!!! ???"), (4, "!!! ???"), (5, "!!!"), (6, "One two"), (7, "one, TWO"), (8, long), (9, long + " end"), (9, long + " end"), (9, "other words than before here"), (None, long + " stop"), (None, "one two"), (10, "a b c d e"), (11, "a b c d e f")]
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA).withColumnsRenamed({"lang": "mark", "source": "digest"})
    assert run(df) == groups(rows)


def test_empty_table(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.95])
def test_pruning_keeps_pairs_at_the_threshold(threshold):
    least = J.least_matches(threshold, 1e-5)
    random = np.random.default_rng(1)
    hits = random.random((100_000, J.HASHES)) < threshold
    lost = np.zeros(len(hits), bool)
    for k in range(J.STEP, J.HASHES + 1, J.STEP):
        lost |= hits[:, :k].sum(1) < least[k]
    assert lost.sum() <= 5
    assert (np.diff(least) >= 0).all()


def test_shared_counts():
    texts = ["a b c d e f g", "a b c d e f", "x y z a b c d e", ""]
    sets = [shingles(t) for t in texts]
    names = {x: k for k, x in enumerate(sorted({x for s in sets for x in s}))}
    row = np.array([r for r, s in enumerate(sets) for _ in s])
    value = np.array([names[x] for s in sets for x in s], np.uint64)
    got = J.shared_counts((row, value), 4, (row, value), 4)
    assert got.tolist() == [[len(a & b) for b in sets] for a in sets]


def test_chained_cluster_is_verified_in_its_buckets(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 8)
    seen = []
    monkeypatch.setattr(J, "_dealt", lambda df, *a, f=J._dealt: (seen.append(df), f(df, *a))[1])
    rows = [(k, " ".join(f"w{x}" for x in range(5 * k, 5 * k + 100)), None, None, 0) for k in range(250)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == groups([r[:2] for r in rows])
    assert len(seen) == 2


@pytest.mark.parametrize("seed", range(3))
def test_deduplicated_rows_of_every_kind(spark, seed):
    """One row of every linked group stays, whatever ids repeat, and every row without links."""
    random = np.random.default_rng(seed)
    texts = [" ".join(f"{base}{x}" for x in range(30)) + end for base in "abc" for end in ("", " end", " stop")] + ["unlike and short", "", None, "!!!"]
    rows = [(None if i == 4 else int(i), texts[t]) for i, t in zip(random.integers(0, 5, 40), random.integers(0, len(texts), 40), strict=True)]
    for order in [(rows, rows[::-1], sorted(rows, key=str))[seed]]:
        df = spark.createDataFrame([(*r, None, None, 0) for r in order], SCHEMA)
        got = [(r.doc_id, r.text) for r in J.deduplicated(df).collect()]
        want = []
        for kind in {t[0] if t and t[0] in "abc" and " " in t and t[1] == "0" else t for _, t in rows}:
            group = [r for r in rows if r[1] == kind or (kind in ("a", "b", "c") and r[1] and r[1].startswith(kind + "0"))]
            want.append((kind, len(group) if not kind else 1, min((i for i, _ in group if i is not None), default=None) if kind else None))
        for kind, n, least in want:
            mine = [r for r in got if r[1] == kind or (kind in ("a", "b", "c") and r[1] and r[1].startswith(kind + "0"))]
            assert len(mine) == n
            assert not kind or mine[0][0] == least
        assert set(got) <= set(rows) and len(got) == sum(n for _, n, _ in want)


def test_nothing_is_sorted_for_aggregates(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plans = []
    keep = J.written
    J.written = lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), keep(df, name))[1]
    try:
        J.jaccard_join(docs)
    finally:
        J.written = keep
    assert len(plans) > 8 and not any("SortAggregate" in p for p in plans)
