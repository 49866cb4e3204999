"""Document fingerprints by spot signatures: chains of content words that follow common-word anchors.

Words are as in ``_text``. Common words are anchors and are passed over inside chains. A signature is a 64-bit hash of an anchor and the ``CHAIN`` content
words after it; a fingerprint is the set of a text's signatures. A text with words but without a signature has one of all its words, a text
without words but not empty one of its bytes, so that only equal ones are alike; null and empty texts have none, and are alike.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._arrow import bounded_batches, tidy
from ._ranges import blocks, ranges
from ._text import mix, running, seeds, slices, string_buffers, words
from .jaccard_join import Measure, Pairs, grouped, set_digests

CHAIN = 3
# Frequent function words.
COMMON = {
    "en": "a an and are as at be by for from had has have he in is it its not of on or that the they this to was were which with you",
    "fr": "au aux avec ce ces dans de des du elle en est et il la le les mais ne ou par pas pour que qui se son sur un une",
    "de": "als auch auf aus bei das dem den der des die ein eine einen er es für im in ist mit nicht sich sie sind und von war wie zu",
    "es": "al como con de del el en es esta este la las lo los más no para pero por que se sin sobre son su sus un una y",
}


@lru_cache(4)
def _common(listed: tuple[str, ...]) -> np.ndarray:
    return np.unique(words(*string_buffers(pa.array([" ".join(listed)]))).hashes)


def common_words() -> tuple[str, ...]:
    return tuple(sorted({w for x in COMMON.values() for w in x.split()}))


def signatures(texts: pa.Array, listed: tuple[str, ...] | None = None, chain: int = CHAIN) -> tuple[np.ndarray, np.ndarray]:
    """Row and signature of every distinct signature, sorted by both."""
    data, offsets = string_buffers(texts)
    w = words(data, offsets)
    anchors, rows = _common(listed or common_words()), w.rows
    at = np.minimum(np.searchsorted(anchors, w.hashes), len(anchors) - 1)
    common = anchors[at] == w.hashes
    content = np.flatnonzero(~common)
    behind = running((~common).astype(np.int64))[:-1]
    spot = np.flatnonzero(common)
    spot = spot[behind[spot] + chain <= len(content)]
    last = content[behind[spot] + chain - 1] if len(spot) else spot
    spot = spot[rows[last] == rows[spot]]
    salts = seeds(chain + 1, 5)
    sig = w.hashes[spot] * salts[0]
    for k in range(chain):
        sig = mix(sig ^ (w.hashes[content[behind[spot] + k]] * salts[k + 1]))
    owner = rows[spot]
    bare = np.setdiff1d(np.flatnonzero(np.diff(offsets) > 0), owner)
    if len(bare):
        whole = []
        for r in bare.tolist():
            a, b = w.first[r], w.first[r + 1]
            raw = w.hashes[a:b].tobytes() if b > a else data[offsets[r] : offsets[r + 1]].tobytes()
            whole.append(xxhash.xxh3_64_intdigest(raw, 1 if b > a else 2))
        owner, sig = np.append(owner, bare), np.append(sig, np.array(whole, np.uint64))
    order = np.lexsort((sig, owner))
    owner, sig = owner[order], sig[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], sig[new]


def likeness(n: int, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Jaccard similarity of n pairs of sets, given as :func:`signatures` gives them; two empty sets are alike."""
    owner, sig = np.append(a[0], b[0]), np.append(a[1], b[1])
    order = np.lexsort((sig, owner))
    owner, sig = owner[order], sig[order]
    twice = (sig[1:] == sig[:-1]) & (owner[1:] == owner[:-1])
    both = np.bincount(owner[1:][twice], minlength=n)
    either = np.bincount(owner, minlength=n) - both
    return np.where(either > 0, both / np.maximum(either, 1), 1.0)


def encoded(n: int, owner: np.ndarray, sig: np.ndarray) -> list[str]:
    """Fingerprints as text: base64 of the sorted signatures, eight little-endian bytes each."""
    at = np.searchsorted(owner, np.arange(n + 1))
    raw = sig.astype("<u8").tobytes()
    return [base64.b64encode(raw[8 * a : 8 * b]).decode() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def decoded(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u8")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and signatures (sorted array of longs) of every row; repeated rows each have one, null and empty texts an empty one.

    Very long texts count whole; other columns are ignored; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in slices(whole.column("text")):
                owner, sig = signatures(whole.column("text").slice(a, b - a))
                at = np.searchsorted(owner, np.arange(b - a + 1))
                sets = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(sig.view(np.int64)))
                yield pa.RecordBatch.from_arrays([whole.column("id").slice(a, b - a), sets], names=["id", "signatures"])

    light = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return light.mapInArrow(tidy(run), f"id {light.schema['id'].dataType.simpleString()}, signatures array<long>")


BITMAP = 512
BITMAP_COLUMNS = [f"m{k}" for k in range(BITMAP // 64)]


def bitmaps(n_rows: int, owner: np.ndarray, sig: np.ndarray) -> np.ndarray:
    """For each set the parity of how many of its signatures fall on each of ``BITMAP`` bits, as 64-bit words.

    Two sets differ in at least as many signatures as their bitmaps differ in bits.
    """
    bit = (sig >> np.uint64(64 - BITMAP.bit_length() + 1)).astype(np.int64)
    counts = np.bincount(owner * BITMAP + bit, minlength=n_rows * BITMAP)
    return np.packbits((counts & 1).astype(bool).reshape(n_rows, BITMAP), axis=1).view(np.int64)


def of_spots(threshold: float = 0.8) -> Measure:
    """Sets of spot signatures, partitioned by length: partition k holds lengths from threshold**-k on, and a set can only be like sets of its own and the next one.

    Within the two, a set of length n shares one of its n - ceil(threshold n) + 1 smallest signatures with every set like it: classes meet on those. Pairs
    that meet are pruned by their lengths and by their bitmaps, which bound how many signatures they can share.
    """

    def sketched(texts: pa.Array) -> tuple[np.ndarray, list[bytes | None], np.ndarray, np.ndarray, pa.Array]:
        owner, sig = signatures(texts)
        n = np.bincount(owner, minlength=len(texts))
        filled = np.flatnonzero(n)
        prefix = np.where(n > 0, n - np.ceil(n * threshold - 1e-9).astype(np.int64) + 1, 0)
        place = np.arange(len(sig)) - np.repeat(running(n)[:-1], n)
        first = sig[place < prefix[owner]].view(np.int64)
        own = pa.ListArray.from_arrays(pa.array(running(prefix), pa.int32()), pa.array(first))
        return n, set_digests(n, sig), bitmaps(len(texts), owner, sig)[filled], filled, own

    def spread(rows: DataFrame, classes: DataFrame) -> DataFrame:
        level = F.floor(F.log(F.col("n").cast("double")) / F.lit(-np.log(threshold)) + F.lit(1e-9))
        prefixes = rows.select("row", "own").join(classes.select("row", "cid", "n"), "row")
        met = prefixes.select("cid", "n", F.explode("own").alias("x"), level.alias("level"))
        return met.select("cid", "n", F.lit(-1).alias("band"), F.explode(F.array(F.xxhash64("x", "level"), F.xxhash64("x", F.col("level") - 1))).alias("word"))

    def keep(maps: np.ndarray, n: np.ndarray, _: np.ndarray, a: np.ndarray, b: np.ndarray) -> Pairs:
        low, high = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
        ok = low >= high * threshold - 1e-9
        a, b = a[ok], b[ok]
        apart = np.bitwise_count((maps[a] ^ maps[b]).view(np.uint64)).sum(1, dtype=np.int64)
        ok = (n[a] + n[b] - apart) / 2 >= (n[a] + n[b]) * (threshold / (1 + threshold)) - 1e-6
        return a[ok], b[ok]

    return Measure(threshold, BITMAP_COLUMNS, sketched, spread, keep, _sets)


def _sets(texts: pa.Array) -> Pairs:
    """Row and signature of every text's set, a slice of texts at a time."""
    parts = [(owner + a, sig) for a, b in slices(texts) for owner, sig in [signatures(texts.slice(a, b - a))]]
    return np.concatenate([np.zeros(0, np.int64), *[p for p, _ in parts]]), np.concatenate([np.zeros(0, np.uint64), *[x for _, x in parts]])


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """A row for every row of ``docs``: mark, id, ``copy_of`` (smallest id with the same fingerprint), ``class_id`` (smallest id of the group that links connect) and ``n_links``.

    A link joins two rows whose fingerprints have a Jaccard similarity of ``threshold`` or more. Large buckets are dealt in blocks and no pairs are listed, as in
    :mod:`.jaccard_join`. Null and empty texts are linked to none; repeated rows, null ids, ties, very long texts, extra columns and an empty table as there.
    """
    return grouped(docs, id_col, text_col, of_spots(threshold)).drop("text_key", "root")


EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text's fingerprint and that of its edited text, with the likeness of both and of the next document's.

    The edited text: the last half (rounded down) of a text's characters is replaced by as many of the first characters of the next document (or
    all of them); documents are in descending (id, then ascending text) order, null ids last, and the first follows the last. Rows are
    dealt into ranges of ids; each range also gets the first row of the next one, so that no task needs another's rows. Null texts are as empty ones, and two empty fingerprints are
    alike; repeated rows follow one another; very long texts count whole; other columns are ignored; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    df = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    cut = ranges(df, "id", blocks(df))
    df = df.withColumn("block", cut.block)
    heads = df.groupBy("block").agg(F.max("id").alias("head")).collect()  # a row for each block
    filled = sorted(r["block"] for r in heads)
    before = {b: filled[(k + 1) % len(filled)] for k, b in enumerate(filled)}  # the block whose last row b's first row follows
    table = df.sparkSession.createDataFrame([(r["block"], r["head"], before[r["block"]]) for r in heads], "block int, head long, before int")
    own = F.struct(F.col("block"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("before").alias("block"), F.lit(True).alias("guest"))
    places = F.when(F.col("id").eqNullSafe(F.col("head")), F.array(own, guest)).otherwise(F.array(own))
    df = df.join(F.broadcast(table), "block").select("id", "text", F.explode(places).alias("at")).select("id", "text", "at.block", "at.guest")
    df = df.repartitionById(cut.count, F.col("block")).sortWithinPartitions("guest", F.desc_nulls_last("id"), F.asc_nulls_first("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str]] = []
        size, ended = 0, False
        for batch in batches:
            for key, text, is_guest in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), batch.column("guest").to_pylist(), strict=True):
                if ended:
                    continue
                held.append((key, text or ""))
                size += len(text or "")
                ended = is_guest
                if size > 1 << 20 and len(held) > 1:
                    yield _compared(held)
                    held, size = held[-1:], len(held[-1][1])
        if len(held) > 1:
            yield _compared(held)

    return df.mapInArrow(tidy(run), EDITED)


def _compared(held: list[tuple[int | None, str]]) -> pa.RecordBatch:
    """Rows for all but the last of consecutive documents."""
    n = len(held) - 1
    texts = [t for _, t in held]
    edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts[:-1], texts[1:], strict=True)]
    owner, sig = signatures(pa.array(texts, pa.large_string()))
    here, after = owner < n, owner > 0
    own, following = (owner[here], sig[here]), (owner[after] - 1, sig[after])
    changed = signatures(pa.array(edited, pa.large_string()))
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array([k for k, _ in held[:-1]], pa.int64()),
            "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
            "fingerprint": encoded(n, *own),
            "edited_fingerprint": encoded(n, *changed),
            "near_edited": likeness(n, own, changed),
            "near_next": likeness(n, own, following),
        }
    )
