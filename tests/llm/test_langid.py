import numpy as np
from tidemark.llm import langid as L
from tidemark.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string"
WORDS = {"aa": ["ra", "lo", "mira", "tono", "ala"], "bb": ["kütz", "schrem", "pfut", "größt"], "cc": ["żyć", "czworo", "prze", "szcz"]}


def rows(n, seed=0, length=40):
    random = np.random.default_rng(seed)
    return [(k, " ".join(random.choice(WORDS[lang], length)), lang) for k in range(n) for lang in [list(WORDS)[k % 3]]]


def test_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op8_language_id"](spark, sf_dir).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert len(got) == len(truth)
    held = [k for k, r in got.items() if r.held_out]
    assert held and np.mean([got[k].lang_pred == truth[k] for k in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_unknown_scripts_are_rejected_and_known_texts_kept(spark):
    df = spark.createDataFrame(rows(300), SCHEMA)
    model = L.fit(df)
    test = rows(90, 1) + [(1000, "Привет как дела это русский текст без меток", None), (1001, "日本語の文章です", None), (1002, None, "aa"), (1003, "12 34 !?", "aa"), (1004, "", None), (None, "ra lo mira", None), (1, "ra lo mira tono " * 50_000, "aa")]
    got = L.predict(spark.createDataFrame(test, SCHEMA).withColumnRenamed("lang", "score"), model).collect()
    by = {r.doc_id: r for r in got if r.doc_id is None or r.doc_id >= 1000}
    assert all(by[k].rejected for k in (1000, 1001, 1002, 1003, 1004))
    assert all(by[k].lang_pred == L.UNKNOWN and by[k].score == 0 for k in (1002, 1003, 1004))
    assert by[None].lang_pred == "aa" and not by[None].rejected
    known = [r for r in got if r.doc_id is not None and r.doc_id < 90 and len(r.text) < 10_000]
    assert all(r.lang_pred == list(WORDS)[r.doc_id % 3] and not r.rejected for r in known)


def test_equal_texts_get_equal_results_in_any_batch(spark):
    df = spark.createDataFrame(rows(300), SCHEMA)
    model = L.fit(df)
    texts = [t for _, t, _ in rows(50, 2)] * 3
    got = L.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), model).collect()
    by = {}
    for r in got:
        by.setdefault(r.text, set()).add((r.lang_pred, r.score))
    assert all(len(x) == 1 for x in by.values())


def test_training_ignores_the_held_out_fold_and_null_labels(spark):
    all_rows = rows(300)
    import zlib

    odd = [(k, t, "zz") if zlib.crc32(str(k).encode()) % 5 == 0 else (k, t, lang if k % 7 else None) for k, t, lang in all_rows]
    model = L.fit(spark.createDataFrame(odd, SCHEMA))
    assert model.classes == ["aa", "bb", "cc"]


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = L.fit(empty)
    got = L.predict(spark.createDataFrame([(1, "some text", None)], SCHEMA), model).collect()
    assert [(r.lang_pred, r.score, r.rejected) for r in got] == [(L.UNKNOWN, 0.0, True)]
    assert L.predict(empty, L.fit(spark.createDataFrame(rows(60), SCHEMA))).count() == 0


def test_subwords_stay_inside_rows():
    one = [np.frombuffer(t.encode(), np.uint8) for t in ("ab", "", "cde", "É")]
    offsets = np.append(0, np.cumsum([len(x) for x in one]))
    together = [set(code[ok].tolist()) for code, ok in L.subwords(np.concatenate(one), offsets)]
    apart = [set().union(*(set(code[ok].tolist()) for code, ok in [L.subwords(x, np.array([0, len(x)]))[n] for x in one])) for n in range(3)]
    assert together == apart


def test_long_rows_in_stretches():
    model = L.train([r for k, t, lang in rows(120) for r in L.rows_of(t, lang, k % 4 == 0, k)])
    raw = np.frombuffer((" ".join(t for _, t, _ in rows(60, 3)) + " é").encode(), np.uint8)
    whole = L._score(model, raw, np.array([0, len(raw)]))
    for limit in (7, 100, 999):
        assert np.allclose(L._score(model, raw, np.array([0, len(raw)]), limit), whole, atol=1e-12)


def brute_scores(model, text):
    """Mean of the subwords' rows of the table and a softmax, subword by subword."""
    low = bytearray(text.encode())
    for k, b in enumerate(low):
        if 65 <= b <= 90:
            low[k] = b + 32
        elif b < 128 and not 97 <= b <= 122:
            low[k] = 32
        elif k and text.encode()[k - 1] == 0xC3 and 0x80 <= b <= 0x9E:
            low[k] = b + 32
    padded = b" " + bytes(low) + b" "
    rows = []
    for n in (2, 3, 4):
        for k in range(len(padded) - n + 1):
            gram = padded[k : k + n]
            if 32 in gram[1:-1] or set(gram) == {32}:
                continue
            code = int.from_bytes(gram, "big")
            hashed = (code * 0x9E3779B1 + (n * 0x85EBCA6B & 0xFFFFFFFF)) * 0xC2B2AE35 & 0xFFFFFFFF
            rows.append(model.table[hashed >> 32 - L.BITS])
    z = np.exp(np.mean(rows, 0))
    return z / z.sum()


def test_scores_against_a_plain_predictor(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = L.fit(docs)
    got = L.predict(docs.select("doc_id", "text"), model).collect()
    lettered = [r for r in got if r.text and any(c.isalpha() for c in r.text) and len(r.text) < 3000]
    assert len(lettered) > 100
    for r in lettered:
        p = brute_scores(model, r.text)[:-1]
        assert r.lang_pred == model.classes[int(p.argmax())] and abs(r.score - p.max()) < 1e-5
        assert r.rejected == (r.score < model.reject)


UNSEEN = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах.",
    "def f(x):\n    return x + 1\nfor i in range(10):\n    print(f(i))\nclass A:\n    def __init__(self, name):\n        self.name = name",
    "xkq zvw qqpt lmnrs wvx zzkt prrw gfd hjk lkj qwe rty uiop asd",
    "aGVsbG8gd29ybGQgdGhpcyBpcyBiYXNlNjQgZW5jb2RlZCB0ZXh0IGZvciB0ZXN0aW5n",
]


def test_rejection_at_the_stated_error(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    model = L.fit(docs)
    df = spark.createDataFrame(list(enumerate(UNSEEN)), "doc_id long, text string")
    assert sum(r.rejected for r in L.predict(df, model).collect()) >= len(UNSEEN) - 1
    held = docs.filter("crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 AND text IS NOT NULL").collect()
    made = spark.createDataFrame([(k, L.unlike(r.text[:4000], k % L.KINDS, k)) for k, r in enumerate(held) if len(r.text) > 100], "doc_id long, text string")
    assert L.predict(made, model).filter("rejected").count() >= 0.97 * made.count()
    assert len(L.recognised(spark.createDataFrame(held), model).collect()) >= 0.985 * len(held)


def test_threshold():
    assert 0.4 < L.threshold_of(np.linspace(0.7, 1, 100), np.linspace(0, 0.3, 100), 0.01) < 0.6
    own, other = np.linspace(0.3, 1, 71), np.linspace(0, 0.6, 61)
    at = L.threshold_of(own, other, 0.01)
    assert abs((own < at).mean() - (other >= at).mean()) < 0.05
    assert L.threshold_of(own, other[:0], 0.01) == 0.0


def test_whole_long_texts_are_learned_from():
    text = "ra lo mira " * 400_000 + "żyć"
    raw = L._bytes_of(text)
    bucket, share = L.bag_of(raw)
    short, _ = L.bag_of(L._bytes_of("żyć"))
    assert set(short) <= set(bucket) and abs(share.sum() - 1) < 1e-9
