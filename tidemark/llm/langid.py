"""Language ID: averaged hashed subword embeddings, a linear softmax, stochastic gradient descent in numpy, calibrated rejection.

Subwords are byte 2-, 3- and 4-grams inside words of letters with a blank on either side, hashed into buckets. A
document's vector is the mean embedding of all its subwords; unseen subwords have embedding zero. Besides the languages the softmax has one
class for what is none of them. Its rows are made of the labelled texts (see :func:`unlike`): letters shuffled, letters exchanged, words reversed, noise,
and program text; a text in an unseen language looks much like those. Training uses a bounded sample of labelled rows
(``per_lang`` rows of each language, whole texts, counted into buckets where they lie); prediction reads whole texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ._arrow import bounded_batches, tidy
from ._shared import renamed
from ._text import slices, string_buffers

BITS, SLICE_BYTES = 16, 1 << 19
UNKNOWN = "und"
# Words of programs, for rows that are no language.
PROGRAM = "def return import class for in if else elif while try except raise self None True False int str len range print public static void new null const let var function this string char double float include struct typedef main println select from where join order by group insert into values".split()
MARKS = [" ", " ", "(", ") ", " = ", ": ", ".", "_", ";\n", " {\n", "[0] "]


@lru_cache(1)
def _letters() -> np.ndarray:
    """A-Z lower-cased, every other ASCII byte but a-z a blank, non-ASCII bytes as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[np.r_[0:65, 91:97, 123:128]] = 32
    return table


def _folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes with a blank before and behind every row, and the rows' offsets in them."""
    n = len(offsets) - 1
    out = np.full(len(data) + 2 * n, 32, np.uint8)
    keep = np.ones(len(out), bool)
    at = offsets[:-1] + 2 * np.arange(n)
    keep[at] = keep[at + np.diff(offsets) + 1] = False
    out[keep] = _letters()[data]
    accented = np.flatnonzero((out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E)) + 1
    out[accented] += 32
    return out, np.append(at, len(out))


def subwords(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For 2-, 3- and 4-grams: the bucket at every byte of the padded rows, and whether a subword begins there."""
    b, at = _folded(data, offsets)
    letter = b != 32
    ok = letter.copy()
    ok[:-1] |= letter[1:]
    ok[at[1:] - 1] = False  # a row's last blank begins no subword
    code, out = b.astype(np.uint32), []
    for n in (2, 3, 4):
        ahead = np.append(b, np.full(n - 1, 32, np.uint8))[n - 1 :]
        code = code << np.uint32(8) | ahead
        if n > 2:  # all but the first and the last byte are letters
            inner = np.append(letter, np.zeros(n - 2, bool))[n - 2 :]
            if n == 3:
                ok = np.ones(len(b), bool)
                ok[at[1:] - 1] = False
            ok = ok & inner
        mixed = (code * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35)
        out.append((mixed >> np.uint32(32 - BITS), ok))
    return out


@dataclass
class Model:
    """classes; table: each bucket's share of each class's logit (the last column is for none of them), already divided by the
    temperature; reject: texts whose best language has a lower score are rejected."""

    classes: list[str]
    table: np.ndarray
    reject: float


def unlike(text: str, kind: int, seed: int) -> str:
    """A text that is in no language, of about the same length: letters shuffled over the text (0), letters exchanged by a random alphabet (1), words
    reversed (2), random letters of one of several scripts (3), program text (4)."""
    random = np.random.default_rng(seed)
    if kind == 0:
        letters = np.array(list(text.replace(" ", "")) or [" "])
        out = random.permutation(letters)
        spaces = random.random(len(out)) < 0.18
        return "".join(f"{c} " if s else c for c, s in zip(out.tolist(), spaces.tolist(), strict=True))
    if kind == 1:
        to = random.permutation(26)
        table = {97 + k: 97 + int(to[k]) for k in range(26)} | {65 + k: 65 + int(to[k]) for k in range(26)}
        return text.translate(table)
    if kind == 2:
        return " ".join(w[::-1] for w in text.split(" "))
    if kind == 3:
        low, high = [(97, 123), (0x430, 0x450), (0x3B1, 0x3CA), (0x5D0, 0x5EB), (0x4E00, 0x9FA5), (0xE0, 0x17F)][int(random.integers(0, 6))]
        points = random.integers(low, high, len(text))
        points[random.random(len(text)) < 0.15] = 32
        return "".join(map(chr, points.tolist()))
    n = len(text) // 4 + 2
    letters = "".join(map(chr, random.integers(97, 123, 9 * n).tolist()))
    known, word, size, mark = random.random(n) < 0.6, random.integers(0, len(PROGRAM), n), random.integers(1, 9, n), random.integers(0, len(MARKS), n)
    parts = [(PROGRAM[w] if k else letters[9 * at : 9 * at + z]) + MARKS[m] for at, (k, w, z, m) in enumerate(zip(known.tolist(), word.tolist(), size.tolist(), mark.tolist(), strict=True))]
    return "".join(parts)[: len(text)]


KINDS, SHORT = 5, 1 << 14


def bag_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's bytes, and the share of its subwords that each has; in stretches, so that a long text takes no more memory."""
    if len(data) <= SHORT:
        bucket, count = np.unique(np.concatenate([code[ok] for code, ok in subwords(data, np.array([0, len(data)]))]), return_counts=True)
        return bucket.astype(np.int64), count / max(1, count.sum())
    count = np.zeros(1 << BITS, np.int64)
    for part in _stretches(data, SLICE_BYTES):
        for code, ok in subwords(part, np.array([0, len(part)])):
            count += np.bincount(code[ok], minlength=1 << BITS)
    bucket = np.flatnonzero(count)
    return bucket, count[bucket] / max(1, count.sum())


def _bytes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(errors="replace"), np.uint8)


@dataclass
class Row:
    """A row to learn from: its bag, its language (None if it was made by :func:`unlike`) and whether it calibrates."""

    bucket: np.ndarray
    share: np.ndarray
    lang: str | None
    calibrates: bool


def rows_of(text: str, lang: str, calibrates: bool, seed: int) -> list[Row]:
    """A labelled text and a text of no language made of it."""
    made = unlike(text[:LONGEST_UNLIKE], seed % KINDS, seed)
    return [Row(*bag_of(_bytes_of(t)), label, calibrates) for t, label in ((text, lang), (made, None))]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def threshold_of(own: np.ndarray, other: np.ndarray, error: float) -> float:
    """The score below which texts are rejected, from calibrating rows' scores (``own``) and those of texts in no language (``other``).

    If a threshold rejects at most ``error`` of the former and accepts at most ``error`` of the latter, the middle (by logit) of all such
    thresholds; else the one at which the greater of both shares is least.
    """
    if not len(own) or not len(other):
        return 0.0
    low, high = np.quantile(other, 1 - error), np.quantile(own, error)
    if low <= high:
        a, b = (np.log(x / (1 - x)) for x in np.clip([low, high], 1e-9, 1 - 1e-9))
        return float(1 / (1 + np.exp(-(a + b) / 2)))
    at = np.unique(np.append(own, other))
    worst = np.maximum(np.searchsorted(np.sort(own), at) / len(own), 1 - np.searchsorted(np.sort(other), at) / len(other))
    return float(at[int(np.argmin(worst))])


def train(rows: list[Row], dim: int = 8, epochs: int = 3, rate: float = 0.5, seed: int = 1, error: float = 0.005) -> Model:
    """The temperature gives calibrating rows (a share ``error`` of their labels spread over all classes) their best likelihood; the threshold is that of :func:`threshold_of` for the calibrating rows that have
    subwords. Without calibrating rows all rows calibrate."""
    classes = sorted({r.lang for r in rows if r.lang is not None})
    if not classes:
        return Model([], np.zeros((1 << BITS, 0)), 1.0)
    random = np.random.default_rng(seed)
    number = {c: k for k, c in enumerate(classes)} | {None: len(classes)}
    rows = [r for r in rows if len(r.bucket)]
    fit = [r for r in rows if not r.calibrates] or rows
    check = [r for r in rows if r.calibrates] or rows
    embed, weight = np.zeros((1 << BITS, dim), np.float32), random.normal(0, 1, (dim, len(classes) + 1))
    steps, done = max(1, epochs * len(fit)), 0
    for _ in range(epochs):
        for k in random.permutation(len(fit)):
            bucket, share = fit[k].bucket, fit[k].share
            now = rate * (1 - done / steps)
            done += 1
            hidden = share @ embed[bucket]
            slope = _softmax(hidden @ weight)
            slope[number[fit[k].lang]] -= 1
            back = weight @ slope
            weight -= now * 0.1 * np.outer(hidden, slope)
            embed[bucket] -= (now * 20 * share)[:, None].astype(np.float32) * back.astype(np.float32)
    table = embed @ weight
    want = np.array([number[r.lang] for r in check], int)
    logits = np.array([r.share @ table[r.bucket] for r in check]).reshape(len(check), len(classes) + 1)
    rows_at = np.arange(len(want))
    grid = np.geomspace(0.05, 20, 61)
    # Smoothed labels: rows that are all told apart would otherwise ask for ever sharper scores.
    aim = np.full(logits.shape, error / (len(classes) + 1))
    aim[rows_at, want] += 1 - error
    loss = [-(aim * np.log(np.maximum(_softmax(logits / t), 1e-12))).sum() for t in grid]
    heat = float(grid[int(np.argmin(loss))])
    scores = _softmax(logits / heat)[:, :-1].max(1)
    made = want == len(classes)
    return Model(classes, table / heat, threshold_of(scores[~made], scores[made], error))


LONGEST_UNLIKE = 1 << 12  # characters of a made text; labelled texts count whole
BAGS = "bucket binary, share binary, lang string, calibrates boolean"


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, usable: Column, calibrates: Column, per_lang: int) -> list[Row]:
    """About ``per_lang`` usable labelled rows of every language, chosen by a hash of id and length, and a text of no language made of each.

    Whole texts are counted in the tasks; the driver gets their bags, of at most 2^16 buckets each.
    """
    mark = F.xxhash64(F.col(id_col).cast("string"), F.length(text_col))
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & usable)
    counts = rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n"))
    known = {r.lang: r.n for r in counts.collect()}  # a row for each language
    share = F.lit(0.0)
    for lang, n in known.items():
        share = F.when(F.col(lang_col) == lang, min(1.0, per_lang / n)).otherwise(share)
    chosen = rows.filter(F.pmod(F.xxhash64(mark), F.lit(1 << 30)) / (1 << 30) < share)
    chosen = chosen.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), calibrates.alias("calibrates"), F.pmod(mark, F.lit(1 << 31)).alias("seed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, lang, c, seed in zip(*[batch.column(k).to_pylist() for k in ("text", "lang", "calibrates", "seed")], strict=True):
                made = rows_of(text, lang, c, seed)
                yield pa.RecordBatch.from_pydict({"bucket": [r.bucket.astype("<u2").tobytes() for r in made], "share": [r.share.astype("<f4").tobytes() for r in made], "lang": pa.array([r.lang for r in made], pa.string()), "calibrates": [r.calibrates for r in made]})

    got = sorted(chosen.mapInArrow(tidy(run), BAGS).collect(), key=lambda r: (r.lang or "", r.calibrates, r.bucket, r.share))
    return [Row(np.frombuffer(r.bucket, "<u2"), np.frombuffer(r.share, "<f4"), r.lang, r.calibrates) for r in got]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5, per_lang: int = 300, error: float = 0.005) -> Model:
    """Trains on folds 2 to ``folds - 1`` of crc32(id as text), calibrates on fold 1, leaves fold 0 out. ``error`` is the share of texts in a known
    language that may be rejected and of texts in none that may be accepted, as measured on fold 1.

    Rows with a null id, text or language aren't learned from, nor are texts without a letter; repeated rows count each; very long texts count whole.
    Without a row to learn from the model has no class and rejects all.
    """
    bounded_batches(docs.sparkSession)
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    return train(sample(docs, id_col, text_col, lang_col, fold != 0, fold == 1, per_lang), error=error)


def _stretches(data: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A long row's bytes, cut at bytes that are blanks for subwords; no subword is lost or made."""
    at = 0
    while len(data) - at > limit:
        blank = np.flatnonzero(_letters()[data[at + limit : at + 2 * limit]] == 32)
        if not len(blank):
            break
        to = at + limit + int(blank[0])
        yield data[at:to]
        at = to + 1
    yield data[at:]


def _score(model: Model, data: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES) -> np.ndarray:
    """Every row's probabilities of the classes, and of none of them. Stretches of a long row are summed one after the other."""
    n, k = len(offsets) - 1, model.table.shape[1]
    if n > 1 or offsets[-1] <= limit:
        total, count = _sums(model, data, offsets)
    else:
        total, count = np.zeros((1, k)), np.zeros(1)
        for part in _stretches(data, limit):
            t, c = _sums(model, part, np.array([0, len(part)]))
            total, count = total + t, count + c
    return _softmax(total / np.maximum(1, count)[:, None])


def _sums(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, k = len(offsets) - 1, model.table.shape[1]
    at = offsets[:-1] + 2 * np.arange(n)
    total, count = np.zeros((n, k)), np.zeros(n)
    for bucket, ok in subwords(data, offsets):
        count += np.add.reduceat(ok.astype(np.int64), at)
        for c in range(k):
            total[:, c] += np.add.reduceat(model.table[:, c][bucket] * ok, at)
    return total, count


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``; columns of these names are replaced.

    ``score`` is the best language's probability, beside all others and none of them. A null or empty text or one without a letter is ``und`` with
    score 0 and rejected, as is every text if nothing was learned. A text whose score is below the model's ``reject`` keeps its best language and is
    rejected. Equal texts get equal results, repeated rows one each; ties go to the first language by name. Very long texts count whole, in
    stretches. Other columns are kept; an empty table stays one.
    """
    bounded_batches(docs.sparkSession)
    df = docs.drop("lang_pred", "score", "rejected")
    lettered = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)) if model.classes else F.lit(False)
    schema = T.StructType([*df.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    if not model.classes:
        return df.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "rejected": F.lit(True)})
    out = df.mapInArrow(tidy(_predictor(model, text_col, to_arrow_schema(schema))), schema)
    return out.withColumns({"lang_pred": F.when(lettered, F.col("lang_pred")).otherwise(UNKNOWN), "score": F.when(lettered, F.col("score")).otherwise(0.0)}).withColumn("rejected", (F.col("lang_pred") == UNKNOWN) | (F.col("score") < model.reject))


def recognised(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs``, with all its columns, without the rows that the model rejects: null, empty and letterless texts are among those. See :func:`predict`."""
    work, columns, (text,) = renamed(docs, text_col)
    return predict(work, model, text).filter("NOT rejected").select(columns).toDF(*docs.columns)


def _predictor(model: Model, text_col: str, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    model.table = np.asfortranarray(model.table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.classes, object)
        for whole in batches:
            for at, to in slices(whole.column(text_col), SLICE_BYTES):
                batch = whole.slice(at, to - at)
                p = _score(model, *string_buffers(batch.column(text_col)))[:, :-1]
                new = {"lang_pred": pa.array(names[p.argmax(1)], pa.string()), "score": pa.array(np.round(p.max(1), 6))}
                yield pa.RecordBatch.from_arrays([new[f.name] if f.name in new else batch.column(f.name).cast(f.type) for f in schema], schema=schema)

    return run
