import hashlib
import re

import numpy as np
import pytest
from tidemark.llm import mixing as M


def expected(rows, weights=(3, 1, 2), share=1.5, most=2):
    """rows: (id, text, source)."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    total = {}
    for (_, _, s), n in zip(rows, size, strict=True):
        total[s] = total.get(s, 0) + n
    names = sorted((s for s in total if s is not None)) + [None] * (None in total)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    budget, full = share * sum(size), set()
    while True:  # share again what is above the limits until none is
        free = sum(weight[s] for s in names if s not in full)
        left = budget - sum(most * total[s] for s in full)
        target = {s: most * total[s] if s in full else left * weight[s] / free for s in names}
        over = {s for s in names if s not in full and target[s] >= most * total[s]}
        if not over:
            break
        full |= over
    taken = {}
    for s in names:
        rounds = int(target[s] // total[s]) if total[s] else 0
        rest, base = target[s] - rounds * total[s], 0
        groups = {}
        for k, (i, _, other) in enumerate(rows):
            if other == s:
                groups.setdefault(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], []).append(k)
        for h in sorted(groups):
            n = sum(size[k] for k in groups[h])
            for k in groups[h]:
                taken[k] = size[k] * min(most, rounds + (base + n / 2 <= rest))
            base += n
    return sorted(((i, size[k], total[s], round(target[s], 6), taken[k]) for k, (i, _, s) in enumerate(rows)), key=str)


def run(df, **options):
    got = M.mix(df, **options).collect()
    return sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in got), key=str)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = expected([(r.doc_id, r.text, r.source) for r in docs.collect()])
    got = run(docs)
    assert got == want == run(docs.repartition(3))


@pytest.mark.parametrize("seed", range(2))
def test_sources_of_all_sizes(spark, seed):
    random = np.random.default_rng(seed)
    rows = [(int(k), "w " * int(random.integers(0, 50)), [None, "", "a", "B", "é", "Z", "zz"][min(6, int(random.exponential(1.2)))]) for k in range(400)]
    rows += [(1, "tie tie", "a"), (1, "tie tie", "a"), (None, "x", "a"), (None, "y z", None), (7, None, "none"), (8, "  ", "nbsp")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size long")
    got = run(df)
    assert got == expected(rows)
    assert all(t <= 2 * n for _, n, _, _, t in got)


def test_one_document_and_none(spark):
    schema = "doc_id long, text string, source string"
    one = [(1, "a b c", "s")]
    assert run(spark.createDataFrame(one, schema)) == expected(one)
    assert run(spark.createDataFrame([], schema)) == []
    empty = [(1, None, "s"), (2, "", None)]
    assert [r[4] for r in run(spark.createDataFrame(empty, schema))] == [0, 0]


def test_smaller_budgets_take_subsets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {}
    for share in (0.2, 0.5, 0.9):
        now = {r.doc_id: r.taken for r in M.mix(docs, share=share, weights=(1,)).collect()}
        assert all(now[k] >= v for k, v in before.items())
        before = now


def test_mixed_rows_repeat(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = M.mixed(docs)
    assert out.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {r.doc_id: r.copies for r in M.mix(docs).collect() if r.copies}


def test_no_document_is_taken_more_than_most_times(spark):
    """Empty documents of a source at its limit lie below the first hash with words."""
    rows = [(k, "" if k % 3 else "some words here", "a") for k in range(600)] + [(10_000 + k, "w " * 50, "b") for k in range(400)]
    out = M.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert max(r.copies for r in out) == 2 and {r.copies for r in out if r.source == "a" and r["size"]} == {2}


def test_very_long_texts_count_whole(spark):
    rows = [(1, "w " * 400_000, "a"), (2, "w", "a"), (3, "x " * 10, "b")]
    assert run(spark.createDataFrame(rows, "doc_id long, text string, source string")) == expected(rows)


def test_documents_are_never_sorted(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plans, keep = [], M.written
    monkeypatch.setattr(M, "written", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), keep(df, name))[1])
    plans.append(M.mix(docs)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) >= 4 and not any("SortAggregate" in p or "SortMergeJoin" in p for p in plans)
    # What is sorted is the sums by bucket and by source: every sort lies behind an aggregate.
    for p in plans:
        lines = p.splitlines()
        for k, line in enumerate(lines):
            assert "Sort [" not in line or any("HashAggregate" in x for x in lines[k + 1 :])
