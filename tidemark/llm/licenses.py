"""Licence scans by conditional compression.

Candidate blocks are stretches of words that licence notices use, around a word such as *license* or *permission*, and stretches that have so many
runs of ``RUN`` words in common with a wording that it may be confirmed there. A block is compressed by itself
and with every wording as a raw zstandard dictionary; wordings are ranked by the bytes that they save. In
this order they are held against the block word for word, until one is confirmed: a one-line reference must be there exactly, a whole text may
differ in a tenth of its words, and the differences are reported. What lies before and behind a confirmed wording is scanned again, and reported too if it has a
word such as *license*.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._arrow import bounded_batches, tidy
from .license_texts import FILES, templates

WORD = regex.compile(r"[^\W_]+(?:[.'\-][^\W_]+)*")
KEYWORD = regex.compile(r"^(sub)?licen[sc]\w*$|^copyright\w*$|^permission\w*$|^permitted$|^warrant\w*$|^redistribut\w*$|^spdx\S*$|^cc0?$|^creative$")
# What every text with a keyword has: the keywords' beginnings, without regard to what is around them but for the shortest.
HINT = r"(?i)licen[sc]|copyright|permission|permitted|warrant|redistribut|spdx|creative|(?<![\p{L}\p{N}])cc0?(?![\p{L}\p{N}])"
GAP, SHORT, DIFFERS, RUN, CACHED = 2, 20, 0.1, 5, 600

Words = tuple[str, ...]


@dataclass(frozen=True)
class Template:
    license: str
    words: Words
    compressor: zstandard.ZstdCompressor
    count: Counter
    runs: frozenset[Words]

    @property
    def allowed(self) -> int:
        """How many words may differ."""
        return 0 if len(self.words) < SHORT else int(DIFFERS * len(self.words))

    @property
    def least_runs(self) -> int:
        """Distinct runs that a text has at least in which this wording differs in ``allowed`` words: each spoils ``RUN`` of them."""
        return len(self.runs) - RUN * self.allowed


@dataclass(frozen=True)
class Known:
    templates: list[Template]
    vocabulary: frozenset[str]
    plain: zstandard.ZstdCompressor
    of_run: dict[Words, tuple[int, ...]]
    longest: int
    shortest: int


def runs_of(words: Words) -> list[Words]:
    return [words[k : k + RUN] for k in range(len(words) - RUN + 1)]


@lru_cache(1)
def known() -> Known:
    made, of_run = [], {}
    texts = templates()
    for k, (name, text) in enumerate(texts):
        words = tuple(WORD.findall(text.lower()))
        raw = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        runs = frozenset(runs_of(words) if len(words) >= SHORT else [])
        made.append(Template(name, words, zstandard.ZstdCompressor(level=19, dict_data=raw, write_checksum=False), Counter(words), runs))
        for r in runs:
            of_run.setdefault(r, []).append(k)
    notices = made[: len(made) - len(FILES)]
    sizes = [len(t.words) for t in made]
    return Known(made, frozenset(w for t in notices for w in t.words), zstandard.ZstdCompressor(level=19, write_checksum=False), {r: tuple(x) for r, x in of_run.items()}, max(sizes), min(sizes))


def saved(words: Words) -> list[tuple[int, int, Template]]:
    """(bytes saved, wording's number, wording), most saved first, and of equals the longer wording first."""
    k = known()
    raw = " ".join(words).encode()
    alone = len(k.plain.compress(raw))
    got = [(alone - len(t.compressor.compress(raw)), n, t) for n, t in enumerate(k.templates)]
    return sorted(got, key=lambda x: (-x[0], -len(x[2].words), x[1]))


def differences(template: Words, block: Words) -> tuple[int, int, list[str]]:
    """The words of the block (from, to) in which the wording lies best, and what differs: -missing and +extra words."""
    match = SequenceMatcher(None, template, block, autojunk=False)
    a, b, size = match.find_longest_match()
    if not size:
        return 0, 0, [f"-{w}" for w in template]
    slack = int(DIFFERS * len(template))
    low, high = max(0, b - a - slack), min(len(block), b + len(template) - a + slack)
    parts = SequenceMatcher(None, template, block[low:high], autojunk=False).get_opcodes()
    equal = [p for p in parts if p[0] == "equal"]
    first, last = equal[0][3], equal[-1][4]
    out = []
    for kind, a1, a2, b1, b2 in parts:
        if kind != "equal":
            out += [f"-{w}" for w in template[a1:a2]]
            out += [f"+{w}" for k, w in enumerate(block[low:high][b1:b2], b1) if first <= k < last]
    return low + first, low + last, out


def stretches(template: Template, places: list[int]) -> Iterator[tuple[int, int]]:
    """Words (from, to) that the runs at these places cover where nothing but allowed differences lies between them."""
    start = 0
    for k in range(1, len(places) + 1):
        if k == len(places) or places[k] - places[k - 1] > RUN + 2 * template.allowed:
            if k - start >= template.least_runs:
                yield places[start], places[k - 1] + RUN
            start = k


def confirmed(template: Template, block: Words) -> tuple[int, int, list[str]] | None:
    """Where the wording is in a block (words from, to) with no more differences than allowed, and these; the first such place."""
    n = len(template.words)
    if n < SHORT:
        for k in range(len(block) - n + 1):
            if block[k : k + n] == template.words:
                return k, k + n, []
        return None
    places = [k for k, r in enumerate(runs_of(block)) if r in template.runs]
    for low, high in stretches(template, places):
        low, high = max(0, low - RUN - template.allowed), min(len(block), high + RUN + template.allowed)
        a, b, differ = differences(template.words, block[low:high])
        if len(differ) <= DIFFERS * n:
            return low + a, low + b, differ
    return None


def _uncommon(template: Template, have: Counter) -> list[str]:
    """What an unconfirmed block lacks of a wording's words, and what it has besides, wherever they are."""
    return [f"-{w}" for w in (template.count - have).elements()] + [f"+{w}" for w in (have - template.count).elements()]


Best = tuple[str, str | None, float, int, int, tuple[str, ...]]


def _best(words: Words) -> Best:
    ranked = saved(words)
    plain = len(known().plain.compress(" ".join(words).encode()))
    have = Counter(words)
    for gain, _, t in ranked:
        if gain <= 0:
            break
        if (t.count - have).total() > t.allowed:  # more words are missing than may
            continue
        if found := confirmed(t, words):
            return ranked[0][2].license, t.license, round(gain / plain, 6), found[0], found[1], tuple(found[2])
    nearest = ranked[0][2]
    return nearest.license, None, round(ranked[0][0] / plain, 6), 0, len(words), tuple(_uncommon(nearest, have))


_cached = lru_cache(20_000)(_best)


def best(words: Words) -> Best:
    """Of a block: the licence whose wording saves most; the confirmed one or None; share of bytes saved; its words (from, to); the differences."""
    return _cached(words) if len(words) <= CACHED else _best(words)


def _around_keywords(words: list[str]) -> Iterator[tuple[int, int]]:
    """Stretches of the notices' words around keywords, with up to ``GAP`` other words in a row."""
    vocabulary, done = known().vocabulary, 0
    for k, w in enumerate(words):
        if k < done or not KEYWORD.match(w):
            continue
        low, at, gap = k, k - 1, 0
        while at >= done and gap <= GAP:
            gap = 0 if words[at] in vocabulary else gap + 1
            low = low if gap else at
            at -= 1
        high, at, gap = k + 1, k + 1, 0
        while at < len(words) and gap <= GAP:
            gap = 0 if words[at] in vocabulary or KEYWORD.match(words[at]) else gap + 1
            high = high if gap else at + 1
            at += 1
        done = high
        if high - low >= known().shortest:
            yield low, high


def _of_wordings(words: list[str]) -> Iterator[tuple[int, int]]:
    """Stretches in which a long wording may be confirmed: they have enough of its runs."""
    k = known()
    places: dict[int, list[int]] = {}
    for at in range(len(words) - RUN + 1):
        for n in k.of_run.get(tuple(words[at : at + RUN]), ()):
            places.setdefault(n, []).append(at)
    for n, found in places.items():
        t = k.templates[n]
        for low, high in stretches(t, found):
            yield max(0, low - RUN - t.allowed), min(len(words), high + RUN + t.allowed)


def _candidates(words: list[str]) -> list[tuple[int, int]]:
    """Candidate stretches (from, to), in order; those that overlap are one."""
    merged: list[tuple[int, int]] = []
    for low, high in sorted([*_around_keywords(words), *_of_wordings(words)]):
        if merged and low < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def blocks(text: str) -> Iterator[tuple[Words, list[tuple[int, int]]]]:
    """Words and character spans of every candidate block, in order."""
    spans = [m.span() for m in WORD.finditer(text)]
    words = [text[a:b].lower() for a, b in spans]
    for low, high in _candidates(words):
        yield tuple(words[low:high]), spans[low:high]


def _in_window(words: Words) -> list[tuple[int, int, str | None, str, float, Words]]:
    """Confirmed wordings, and the candidate blocks that are left beside them."""
    out, todo = [], [(0, len(words))]
    while todo:
        a, b = todo.pop()
        part = words[a:b]
        if b - a < known().shortest or not any(KEYWORD.match(w) for w in part):
            continue
        nearest, name, share, low, high, differ = best(part)
        out.append((a + low, a + high, name, nearest, share, differ))
        if name is not None:
            todo += [(a + x, a + y) for x, y in _candidates(list(part[:low]))]
            todo += [(a + high + x, a + high + y) for x, y in _candidates(list(part[high:]))]
    return sorted(out)


def scan(text: str) -> list[tuple[int, int, str | None, str, float, list[str]]]:
    """(from, to, licence or None, nearest, share saved, differences) of every block of a text, in order; places are characters.

    A block that is longer than two of the longest wordings is scanned in windows of that length. The next window begins where the last confirmed wording of the
    first half ends, or in the middle, so that every wording lies whole in some window.
    """
    reach = known().longest + 2 * int(DIFFERS * known().longest)
    out = []
    for words, spans in blocks(text):
        at = 0
        while at < len(words):
            to = min(len(words), at + 2 * reach)
            found, half = _in_window(words[at:to]), to - at if to == len(words) else reach
            sure = [x for x in found if x[2] is not None and x[0] < half]
            half = max([half, *[x[1] for x in sure]])
            for low, high, name, nearest, share, differ in found:
                if name is not None and low < half or name is None and to == len(words):
                    out.append((spans[at + low][0], spans[at + high - 1][1], name, nearest, share, list(differ)))
                elif name is None and low < half:  # as far as this window decides
                    part = words[at + low : at + min(high, half)]
                    if len(part) >= known().shortest and any(KEYWORD.match(w) for w in part):
                        nearest, name, share, a, b, differ = best(part)
                        out.append((spans[at + low + a][0], spans[at + low + b - 1][1], name, nearest, share, list(differ)))
            at += half
    return sorted(out, key=lambda x: x[:2])


FOUND = "license string, nearest string, start long, end long, reduction double, differences array<string>"


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for every candidate block: id, block (from 0), license (null if no wording is confirmed), nearest, start, end, reduction, differences
    (word for word in order if confirmed, else by how often the nearest wording and the block have a word).

    Texts without any keyword never leave the JVM and have no row, nor have null and empty ones. Long texts and long blocks are scanned whole. Wordings that save the
    same are tried longest first. Rows that repeat each have their blocks. Other columns are ignored. An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    light = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.col("text").rlike(HINT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            rows = [(i, k, *x) for i, t in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True) for k, x in enumerate(scan(t))]
            schema = pa.schema([("id", batch.column("id").type), ("block", pa.int64()), ("license", pa.string()), ("nearest", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reduction", pa.float64()), ("differences", pa.list_(pa.string()))])
            if rows:
                i, k, a, b, name, near, share, differ = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((i, k, name, near, a, b, share, differ), schema, strict=True)], schema=schema)

    return light.mapInArrow(tidy(run), f"id {light.schema['id'].dataType.simpleString()}, block long, {FOUND}").withColumnRenamed("id", id_col)
