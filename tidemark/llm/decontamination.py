"""Benchmark decontamination: a broadcast hash set of normalised benchmark windows, looked up at every document window.

Words and windows: see ``_text`` and :func:`decontaminate`. A corpus is read once, in place, without a shuffle. Tasks build the index of the
benchmark as flat arrays: every word once, windows as references to their first word, hashes sorted. An index of one part is broadcast. A benchmark of more than
``part_bytes`` has several parts, files in the shared folder: a task then gathers ``GATHERED`` bytes of documents and holds them against one part after the other, so that
neither the driver nor a task holds more than one part, and nothing but a document's hits is carried from part to part.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ._arrow import bounded_batches, filesystem, tidy
from ._shared import renamed, scratch
from ._text import Words, ragged, running, slices, string_buffers, windows, words

PART_BYTES = 8 << 20
GATHERED = 32 << 20
VERIFY_ROWS = 100_000


@dataclass
class WindowSet:
    """Distinct windows of n words: hash (sorted), first word in the index, and the items that have them."""

    n: int
    hashes: np.ndarray
    word: np.ndarray
    item_at: np.ndarray
    items: np.ndarray

    def __post_init__(self) -> None:
        bits = min(26, max(10, (8 * len(self.hashes)).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[self.hashes >> self.shift] = True

    def __reduce__(self):
        return WindowSet, (self.n, self.hashes, self.word, self.item_at, self.items)


@dataclass
class Index:
    """Windows of every length; names of the items; the words' bytes without gaps and where each begins."""

    sets: list[WindowSet]
    names: list[str]
    packed: np.ndarray
    place: np.ndarray


def _same(w: Words, a: np.ndarray, packed: np.ndarray, place: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Which windows of n words, from word a of w on, are word for word those from word b of the other words on."""
    out = np.zeros(len(a), bool)
    for at in range(0, len(a), VERIFY_ROWS):
        x, y = a[at : at + VERIFY_ROWS], b[at : at + VERIFY_ROWS].astype(np.int64)
        steps = np.arange(n + 1)
        ends_x, ends_y = w.place[x[:, None] + steps], place[y[:, None] + steps].astype(np.int64)
        same = (ends_x - ends_x[:, :1] == ends_y - ends_y[:, :1]).all(axis=1)
        where = np.flatnonzero(same)
        if len(where):
            size = (ends_x[:, -1] - ends_x[:, 0])[where]
            equal = w.packed[ragged(ends_x[where, 0], size)] == packed[ragged(ends_y[where, 0], size)]
            out[at + where] = np.logical_and.reduceat(equal, running(size)[:-1])
    return out


def _window_set(w: Words, m: int, k: np.ndarray, hashes: np.ndarray, item: np.ndarray) -> WindowSet:
    """The windows at words k of items, equal ones as one."""
    order = np.lexsort((item, hashes))
    k, hashes, item = k[order], hashes[order], item[order]
    first = np.zeros(len(k), np.int64)  # the place of the first equal window
    left = np.arange(len(k))
    while len(left):  # more than one round only if different windows share a hash
        new = np.ones(len(left), bool)
        new[1:] = hashes[left[1:]] != hashes[left[:-1]]
        lead = left[np.flatnonzero(new)[np.cumsum(new) - 1]]
        same = _same(w, k[left], w.packed, w.place, k[lead], m)
        first[left[same]] = lead[same]
        left = left[~same]
    order = np.lexsort((item, first, hashes))
    first, item = first[order], item[order]
    keep = np.ones(len(first), bool)
    keep[1:] = (first[1:] != first[:-1]) | (item[1:] != item[:-1])
    first, item = first[keep], item[keep]
    starts = np.ones(len(first), bool)
    starts[1:] = first[1:] != first[:-1]
    at = np.flatnonzero(starts)
    return WindowSet(m, hashes[first[at]], k[first[at]].astype(np.int32), np.append(at, len(first)).astype(np.int32), item.astype(np.int32))


def build_index(items: list[tuple[str, str]], n: int = 13) -> Index:
    """Windows of n words of every item; an item of fewer words, but not none, is one window."""
    w = words(*string_buffers(pa.array([t for _, t in items], pa.large_string())))
    names = sorted({i for i, _ in items})
    number = {x: k for k, x in enumerate(names)}
    owner = np.array([number[i] for i, _ in items], np.int32)
    counts, rows, sets = np.diff(w.first), w.rows, []
    for m in sorted(set(np.minimum(counts, n).tolist()) - {0}):
        k, hashes = windows(w, int(m))
        keep = np.minimum(counts[rows[k]], n) == m
        sets.append(_window_set(w, int(m), k[keep], hashes[keep], owner[rows[k[keep]]]))
    return Index(sets, names, w.packed, w.place.astype(np.uint32))


def _hits(w: Words, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """For every word whether an occurring window covers it; row and item of every occurrence, once each."""
    edge = np.zeros(len(w.hashes) + 1, np.int64)
    rows, found = w.rows, [np.zeros((0, 2), np.int64)]
    for s in index.sets:
        k, hashes = windows(w, s.n)
        maybe = s.seen[hashes >> s.shift]
        k, hashes = k[maybe], hashes[maybe]
        low, high = np.searchsorted(s.hashes, hashes), np.searchsorted(s.hashes, hashes, "right")
        k, e = np.repeat(k, high - low), ragged(low, high - low)
        ok = _same(w, k, index.packed, index.place, s.word[e], s.n)
        k, e = k[ok], e[ok]
        np.add.at(edge, k, 1)
        np.add.at(edge, k + s.n, -1)
        pairs = np.unique(np.stack([rows[k], e], 1), axis=0)
        size = s.item_at[pairs[:, 1] + 1] - s.item_at[pairs[:, 1]]
        found.append(np.stack([np.repeat(pairs[:, 0], size), s.items[ragged(s.item_at[pairs[:, 1]], size)]], 1))
    return np.cumsum(edge[:-1]) > 0, np.unique(np.concatenate(found), axis=0)


def _gathered(batches: Iterator[pa.RecordBatch], text_col: str, limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Slices of the batches, in lists of about ``limit`` bytes of text, or one by one for 0."""
    held, size = [], 0
    for whole in batches:
        for at, to in slices(whole.column(text_col)):
            held.append(whole.slice(at, to - at))
            size += int(string_buffers(held[-1].column(text_col))[1][-1])
            if size >= limit:
                yield held
                held, size = [], 0
    if held:
        yield held


def _judged(batch: pa.RecordBatch, w: Words, hit: np.ndarray, found: list[set[str]], schema: pa.Schema) -> pa.RecordBatch:
    rows = w.rows
    first = hit.copy()
    first[1:] &= ~hit[:-1] | (rows[1:] != rows[:-1])
    last = hit.copy()
    last[:-1] &= ~hit[1:] | (rows[1:] != rows[:-1])
    a, b = np.flatnonzero(first), np.flatnonzero(last)
    row = rows[a]
    base, at_byte = w.first[:-1][row], w.offsets[:-1][row]
    runs = np.stack([a - base, b + 1 - base, w.starts[a] - at_byte, w.ends[b] - at_byte], 1).astype(np.int64)
    per_row = 4 * np.bincount(row, minlength=len(batch))
    new = {
        "n_words": pa.array(np.diff(w.first), pa.int64()),
        "n_hit": pa.array(np.bincount(rows[hit], minlength=len(batch)), pa.int64()),
        "item_ids": pa.array([sorted(x) for x in found], pa.list_(pa.string())),
        "hit_runs": pa.ListArray.from_arrays(pa.array(running(per_row), pa.int32()), pa.array(runs.ravel(), pa.int64())),
    }
    return pa.RecordBatch.from_arrays([new[f.name] if f.name in new else batch.column(f.name).cast(f.type) for f in schema], schema=schema)


def _scan(text_col: str, parts: list[Callable[[], Index]], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ``n_words``, ``n_hit``, ``item_ids`` and ``hit_runs``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _gathered(batches, text_col, GATHERED if len(parts) > 1 else 0):
            hits: list[np.ndarray | None] = [None] * len(held)
            found: list[list[set[str]]] = [[set() for _ in range(len(x))] for x in held]
            for part in parts:
                index = part()
                for k, batch in enumerate(held):
                    w = words(*string_buffers(batch.column(text_col)))
                    hit, pairs = _hits(w, index)
                    if hits[k] is not None:
                        hit |= np.unpackbits(hits[k], count=len(hit)).astype(bool)
                    for r, i in pairs.tolist():
                        found[k][r].add(index.names[i])
                    if part is parts[-1]:
                        yield _judged(batch, w, hit, found[k], schema)
                    else:
                        hits[k] = np.packbits(hit)
                del index

    return scan


INDEX = "path string, size long"


def _index_files(benchmark: DataFrame, item_col: str, text_col: str, part_bytes: int, n: int, folder: str) -> list[tuple[str, int]]:
    """Files of the indexes of parts of about ``part_bytes`` of text, built by tasks."""
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // part_bytes))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[tuple[str, str]] = []
        held, out = 0, []

        def put() -> None:
            raw = pickle.dumps(build_index(items, n), protocol=5)
            fs, root = filesystem(folder)
            path = f"{root}/index-{uuid.uuid4().hex}"
            with fs.open_output_stream(path, compression=None) as sink:
                sink.write(raw)
            out.append((path, len(raw)))

        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                items.append((item, text))
                held += len(text)
                if held >= 2 * part_bytes:  # dealing came out uneven
                    put()
                    items, held = [], 0
        if items or not out:
            put()
        yield pa.RecordBatch.from_pydict({"path": [p for p, _ in out], "size": [s for _, s in out]})

    dealt = rows.repartition(count, F.xxhash64("item", "text")) if count > 1 else rows.coalesce(1)
    return [tuple(r) for r in dealt.mapInArrow(tidy(build), INDEX).collect()]  # a row for each part


def _read(folder: str, path: str) -> bytes:
    fs, _ = filesystem(folder)
    with fs.open_input_file(path) as f:
        return f.read()


def _parts(benchmark: DataFrame, item_col: str, text_col: str, part_bytes: int, n: int) -> list[Callable[[], Index]]:
    spark = benchmark.sparkSession
    folder = scratch(spark, "benchmark")
    files = _index_files(benchmark, item_col, text_col, part_bytes, n, folder)
    if not files:
        return [lambda: build_index([], n)]
    if len(files) > 1:
        return [lambda p=path: pickle.loads(_read(folder, p)) for path, _ in files]
    sent = spark.sparkContext.broadcast(_read(folder, files[0][0]))  # bounded by part_bytes
    kept: list[Index] = []

    def one() -> Index:
        if not kept:
            kept.append(pickle.loads(sent.value))
        return kept[0]

    return [one]


ADDED = ("n_words", "n_hit", "item_ids", "hit_runs", "contaminated")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = 13, least_share: float = 0.05, part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``item_ids`` (sorted strings), ``hit_runs`` and ``contaminated``.

    A document word is hit if it lies in an occurrence of a benchmark window of ``n`` words (of an item's all words, if
    those are fewer). ``contaminated``: some word is hit, and hit words are at least ``least_share`` of all.
    ``hit_runs`` has four numbers for each run of hit words: first word, word after the last, first byte, byte after
    the last. Null and empty texts have no words and are clean; an empty benchmark leaves all clean. Repeated
    documents get a row each; a null item id counts as ''; items with one id count as one item. Columns of ``docs``
    that have an added name are replaced. Very long texts count whole.
    """
    bounded_batches(docs.sparkSession)
    df = docs.drop(*ADDED)
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("item_ids", T.ArrayType(T.StringType())), T.StructField("hit_runs", T.ArrayType(T.LongType()))]
    schema = T.StructType([*df.schema.fields, *added])
    arrow = to_arrow_schema(schema)
    df = df.mapInArrow(tidy(_scan(text_col, _parts(benchmark, item_col, item_text_col, part_bytes, n), arrow)), schema)
    share = Fraction(str(least_share))  # as written: 0.05 is a twentieth
    enough = F.col("n_hit").cast("decimal(38,0)") * share.denominator >= F.col("n_words").cast("decimal(38,0)") * share.numerator
    return df.withColumn("contaminated", (F.col("n_hit") > 0) & enough)


def clean(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text_col: str = "text", **options) -> DataFrame:
    """``docs``, with all its columns, without contaminated documents, or (``remove='spans'``) with the hit runs cut out of their texts.

    Null, empty and very long texts, ties, repeated rows and an empty table or benchmark as in :func:`decontaminate`; columns whose names are those of added ones are kept.
    """
    work, columns, (text,) = renamed(docs, text_col)
    judged = decontaminate(work, benchmark, text_col=text, **options)
    if remove == "documents":
        return judged.filter(~F.col("contaminated")).select(columns).toDF(*docs.columns)
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, runs = batch.column(text).to_pylist(), batch.column("hit_runs").to_pylist()
            out = []
            for t, run in zip(texts, runs, strict=True):
                if run:
                    raw, kept, at = t.encode(), [], 0
                    for a, b in zip(run[2::4], run[3::4], strict=True):
                        kept.append(raw[at:a])
                        at = b
                    t = b"".join([*kept, raw[at:]]).decode()
                out.append(t)
            cols = [pa.array(out, batch.schema.field(c).type) if c == text else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(cols, names=columns)

    return judged.drop("contaminated").mapInArrow(tidy(cut), work.schema).toDF(*docs.columns)
