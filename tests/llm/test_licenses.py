import itertools

import zstandard
from tidemark.llm import licenses as L
from tidemark.llm.license_texts import FULL, MIT, long_text, templates


def brute(words):
    """Bytes saved by each wording, one compressor at a time."""
    raw = " ".join(words).encode()
    alone = len(zstandard.ZstdCompressor(level=19, write_checksum=False).compress(raw))
    out = []
    for _, text in templates():
        known = zstandard.ZstdCompressionDict(" ".join(L.WORD.findall(text.lower())).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        out.append(alone - len(zstandard.ZstdCompressor(level=19, dict_data=known, write_checksum=False).compress(raw)))
    return out


def test_every_wording_is_found_exactly():
    for name, text in templates():
        found = L.scan(f"Xyzzy qwop.\n{text}\nPlugh zork frobnitz.")
        assert [(x[2], x[5]) for x in found] == [(name, [])], (name, found)


def test_ranking_is_that_of_brute_force():
    for text in (MIT, "Licensed under CC BY-NC 4.0", FULL["GPL-3.0"][0]):
        words = tuple(L.WORD.findall(text.lower()))
        want = brute(words)
        got = L.saved(words)
        assert [g for g, _, _ in got] == sorted(want, reverse=True) and all(want[k] == g for g, k, _ in got)


def test_differences_are_exact():
    changed = MIT.replace("free of charge", "at no cost").replace("sublicense, ", "")
    (found,) = L.scan(f"Copyright (c) 2020 Zork\n\n{changed}")
    assert found[2] == "MIT" and sorted(found[5]) == sorted(["-free", "-of", "-charge", "+at", "+no", "+cost", "-sublicense"])


def test_versions_and_neighbours_are_told_apart():
    text = "Zork. This work is licensed under the GNU General Public License, version 3.\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0. Frob."
    assert [x[2] for x in L.scan(text)] == ["GPL-3.0", "MIT", "CC-BY-NC-4.0"]
    assert [x[2] for x in L.scan("licensed under the GNU General Public License, version 4")] == [None]
    assert all(a[1] <= b[0] for a, b in itertools.pairwise(L.scan(text)))


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted((r.doc_id, r.block, r.license, r.start, r.end) for r in L.license_scan(docs).collect())
    want = sorted((r.doc_id, k, x[2], x[0], x[1]) for r in docs.collect() for k, x in enumerate(L.scan(r.text)))
    assert got == want and any(g[2] for g in got)
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "version 3.": "GPL-3.0"}
    for r in docs.collect():
        for line, name in lines.items():
            if line in r.text:
                assert any(g[0] == r.doc_id and g[2] == name for g in got)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "nothing here"), (None, "Released under the MIT License."), (4, "Released under the MIT License."), (4, "Released under the MIT License."), (5, "license " * 5000), (6, "word " * 200_000 + "Released under the MIT License.")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, block string")
    got = L.license_scan(df).collect()
    assert sorted((r.doc_id for r in got if r.license == "MIT"), key=str) == [4, 4, 6, None]
    assert {r.doc_id for r in got} == {None, 4, 5, 6}
    assert L.license_scan(df.limit(0)).count() == 0


SPACES = [" ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u2003", " \n> "]


def test_every_wording_is_found_in_the_table_whatever_the_white_space(spark):
    made = [(len(SPACES) * k + j, name, text if space == " " else space.join(text.split())) for k, (name, text) in enumerate(templates()) for j, space in enumerate(SPACES) if len(text) < 3000 or j < 2]
    df = spark.createDataFrame([(i, f"Xyzzy qwop.\n{text}\nPlugh zork.") for i, _, text in made], "doc_id long, text string").repartition(8)
    got = {(r.doc_id, r.license) for r in L.license_scan(df).collect() if not r.differences}
    assert {(i, name) for i, name, _ in made} <= got


def test_the_filter_lets_all_through_that_the_scan_reports(spark):
    words = ["license", "LICENCES", "sublicensed", "Copyright", "permissions", "permitted", "Warranty", "redistributed", "SPDX:x", "cc", "CC0", "creative", "(cc)", "_cc_", "cc0,", "é-cc", "x", "under", "the", "by", "4.0"]
    texts = [f"{a}{gap}{b}" for a in words for b in words for gap in (" ", "\n", " \t ")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    passed = {r.doc_id for r in df.filter(L.F.col("text").rlike(L.HINT)).collect()}
    assert {k for k, t in enumerate(texts) if L.scan(t)} <= passed


def test_wordings_in_a_row_and_what_is_left_beside_them():
    parts = [FULL["BSD-3-Clause"][0], FULL["BSD-2-Clause"][0], MIT, FULL["ISC"][0]]
    assert [x[2] for x in L.scan("\n".join(parts))] == ["BSD-3-Clause", "BSD-2-Clause", "MIT", "ISC"]
    alone = "licensed under the Zork License, version 4"
    assert [x[2] for x in L.scan(alone)] == [None]
    beside = L.scan(f"{MIT}\n{alone}")
    assert [x[2] for x in beside] == ["MIT", None] and "Zork License" in f"{MIT}\n{alone}"[beside[1][0] : beside[1][1]]


def test_foreign_words_inside_a_wording():
    text = FULL["BSD-3-Clause"][0].replace("the copyright holder nor", "Acme Rocket Company Incorporated nor", 1)
    (found,) = [x for x in L.scan(text) if x[2]]
    assert found[2] == "BSD-3-Clause" and {"+acme", "+rocket", "+company", "+incorporated"} <= set(found[5])


def test_long_texts_with_changes_and_among_others():
    gpl = long_text("GPL-3.0")
    changed = gpl.replace("patent", "letters").replace("This", "That", 5)
    text = f"Zork. {long_text('Apache-2.0')} frob {changed} plugh Licensed under CC BY 4.0. " + "license " * 20_000 + MIT
    got = [x[2] for x in L.scan(text) if x[2]]
    assert got[0] == "Apache-2.0" and "GPL-3.0" in got and "CC-BY-4.0" in got and got[-1] == "MIT"


def brute_confirmed(words, wording):
    """Whether the wording lies somewhere in the words with at most a tenth of its words different, by edit distance without substitutions."""
    n = len(wording)
    if n < L.SHORT:
        return any(words[k : k + n] == wording for k in range(len(words) - n + 1))
    row = [0] * (len(words) + 1)  # the wording may begin anywhere
    for a, w in enumerate(wording, 1):
        old, row = row, [a] + [0] * len(words)
        for b, x in enumerate(words, 1):
            row[b] = old[b - 1] if w == x else 1 + min(old[b], row[b - 1])
    return min(row) <= L.DIFFERS * n


def test_documents_against_brute_force(spark, sf_dir):
    """Whole texts: the licences that a plain edit distance over all words finds, and none that it doesn't."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {}
    for r in L.license_scan(docs).collect():
        if r.license:
            found.setdefault(r.doc_id, set()).add(r.license)
    wordings = [(name, tuple(L.WORD.findall(text.lower()))) for name, text in templates()]
    rows = [r for r in docs.collect() if r.text and len(r.text) < 20_000]
    for r in rows:
        words = tuple(L.WORD.findall(r.text.lower()))
        have = L.Counter(words)
        fits = {(name, w) for name, w in wordings if (L.Counter(w) - have).total() <= (0 if len(w) < L.SHORT else L.DIFFERS * len(w)) and brute_confirmed(words, w)}
        assert found.get(r.doc_id, set()) == {name for name, _ in fits}, r.doc_id
    assert any(r.doc_id in found for r in rows)


def test_changed_notices_against_brute_force():
    import random

    choose = random.Random(4)
    for k in range(60):
        name, text = choose.choice([x for x in templates() if 20 <= len(x[1].split()) < 300])
        words = L.WORD.findall(text.lower())
        for _ in range(choose.randint(0, int(0.14 * len(words)))):
            at = choose.randrange(len(words))
            words[at : at + 1] = choose.choice([[], ["zork"], [words[at], "frob"]])
        block = ("plugh", "xyzzy") * 15 + tuple(words) + ("quux", "qwop") * 15
        (t,) = [t for t in L.known().templates if t.license == name and t.words == tuple(L.WORD.findall(text.lower()))]
        found = L.confirmed(t, block)
        assert bool(found) == brute_confirmed(block, t.words), k
