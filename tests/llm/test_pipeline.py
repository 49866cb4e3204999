import corpus_pipeline as C
from brute import groups
from tidemark.llm import decontamination, langid, mixing


def test_stages_against_their_parts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.fit(docs)
    kept = C.language_id(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    rejected = {r.doc_id for r in langid.predict(docs, model).filter("rejected").collect()}
    rows = {r.doc_id: r for r in kept.collect()}
    assert rows.keys() == {r.doc_id for r in docs.collect()} - rejected and len(rejected) <= 0.02 * docs.count()
    one = C.jaccard_join(spark, kept, sf_dir)
    assert one.columns == docs.columns
    want = sorted({root for _, root, _ in groups([(r.doc_id, r.text) for r in rows.values()])})
    assert sorted(r.doc_id for r in one.collect()) == want
    clean = C.decontamination(spark, one, sf_dir)
    bad = {r.doc_id for r in decontamination.decontaminate(one, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).filter("contaminated").collect()}
    assert sorted(r.doc_id for r in clean.collect()) == [k for k in want if k not in bad]
    mixed = C.mixing(spark, clean, sf_dir)
    copies = {r.doc_id: r.copies for r in mixing.mix(clean).collect()}
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(k for k, n in copies.items() for _ in range(n))
    tokens = C.token_files(spark, mixed, sf_dir).orderBy("start").collect()
    assert [r.doc_id for r in tokens] == sorted(k for k, n in copies.items() for _ in range(n))
    assert all(b.start == a.start + a.n_tokens for a, b in zip(tokens[:-1], tokens[1:], strict=True))


def test_run(spark, sf_dir):
    assert [name for name, _ in C.STAGES] == ["language_id", "jaccard_join", "decontamination", "mixing", "token_files"]
    assert C.run(spark, sf_dir).count() > 0


def test_deduplicated_odd_rows(spark):
    rows = [(1, "one two three four five six"), (1, "one two three four five six"), (None, "one two three four five six"), (2, None), (2, None), (3, ""), (None, "a b c d e f"), (None, "a b c d e f"), (5, "other text")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in C.jaccard_join(spark, df, "").collect()), key=str)
    assert got == sorted([(1, rows[0][1]), (2, None), (2, None), (3, ""), (None, "a b c d e f"), (5, "other text")], key=str)
    assert C.jaccard_join(spark, df.limit(0), "").count() == 0


def test_clashing_names_and_no_rows(spark, sf_dir):
    extra = {"score": "n_chars", "n_hit": "n_chars", "rejected": "lang", "mark": "lang", "size": "n_chars", "copies": "lang", "hash": "lang", "own_0": "lang", "id": "n_chars", "digest": "lang"}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wide = docs.select("*", *[docs[old].alias(new) for new, old in extra.items()])
    for rows in (wide, wide.limit(0)):
        plain = rows.select(docs.columns)
        for _, stage in C.STAGES[:-1]:
            out, want = stage(spark, rows, sf_dir), stage(spark, plain, sf_dir)
            assert out.columns == wide.columns
            assert sorted(map(str, out.select(docs.columns).collect())) == sorted(map(str, want.collect()))
            assert out.filter(" OR ".join(f"NOT ({new} <=> {old})" for new, old in extra.items())).count() == 0
        assert C.token_files(spark, rows, sf_dir).count() == rows.count()


def varied(name, last=""):
    return " ".join(f"{name}{k}" for k in range(40)) + last


def kept_rows(spark, rows):
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return sorted(((r.doc_id, r.text) for r in C.jaccard_join(spark, df, "").collect()), key=str)


def test_deduplicated_ids_with_several_texts(spark):
    x, y, z = varied("x"), varied("y"), varied("z")
    rows = [(3, x), (7, varied("x", " end")), (7, z)]
    assert kept_rows(spark, rows) == sorted([(3, x), (7, z)], key=str)
    rows = [(1, x), (5, varied("x", " end")), (1, y), (6, varied("y", " end")), (1, y)]
    assert kept_rows(spark, rows) == sorted([(1, x), (1, y)], key=str)


def test_deduplicated_near_copies_without_ids(spark):
    texts = [varied("x"), varied("x", " end"), varied("x", " stop")]
    got = kept_rows(spark, [(None, t) for t in texts] + [(None, varied("y")), (None, None), (None, None)])
    assert len(got) == 4 and (None, varied("y")) in got and got.count((None, None)) == 2
    assert sum(t in texts for _, t in got) == 1
