"""Token-ID files: independent zstandard frames, a trailing seek table with a checksum for each frame, random access.

A shard file is, in order: data frames (token ids, little-endian, of 16 bits if the vocabulary fits, else 32), the
directory frame (an Arrow IPC stream: id, first token in the shard, number of tokens) and the seek table in the
public seekable zstandard format: a skippable frame with compressed size, plain size and low 32 bits of XXH64 for every
frame before it. A reader takes the table from the file's end, then the directory, then only the frames that it needs.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._arrow import bounded_batches, filesystem, tidy
from ._ranges import blocks, ranges
from ._text import mix, powers, ragged, running, seeds

FRAME_TOKENS = 1 << 15
LONG = 1 << 20
SINGLE_BLANK = re.compile(r"(?<=\S) (?=\S)")
# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80


class ShardWriter:
    def __init__(self, sink, dtype: np.dtype, level: int = 3):
        self.sink, self.dtype, self.at, self.table = sink, np.dtype(dtype), 0, []
        self.compressor = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_tokens = 0
        self.directory: list[tuple[list, np.ndarray, np.ndarray]] = []

    def _frame(self, raw: bytes) -> None:
        packed = self.compressor.compress(raw)
        self.table.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.sink.write(packed)

    def _flush(self, all_of_it: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.dtype)
        cut = len(ids) if all_of_it else len(ids) // FRAME_TOKENS * FRAME_TOKENS
        for a in range(0, cut, FRAME_TOKENS):
            self._frame(ids[a : min(cut, a + FRAME_TOKENS)].astype(self.dtype.newbyteorder("<")).tobytes())
        self.waiting, self.n_waiting = [ids[cut:]], len(ids) - cut

    def add(self, keys: list, ids: np.ndarray, counts: np.ndarray) -> None:
        """Documents in order: keys, all their ids one after the other, and how many each has."""
        self.directory.append((keys, self.n_tokens + running(counts)[:-1], counts))
        self.n_tokens += len(ids)
        self.waiting.append(ids.astype(self.dtype))
        self.n_waiting += len(ids)
        if self.n_waiting >= 8 * FRAME_TOKENS:
            self._flush(False)

    def close(self, key_type: pa.DataType) -> None:
        self._flush(True)
        schema = pa.schema([("id", key_type), ("first", pa.int64()), ("n", pa.int64())], metadata={"header": json.dumps({"dtype": self.dtype.name, "n_tokens": self.n_tokens, "frame_tokens": FRAME_TOKENS})})
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, schema) as stream:
            for keys, first, n in self.directory:
                stream.write_batch(pa.record_batch([pa.array(keys, key_type), pa.array(first), pa.array(n.astype(np.int64))], schema=schema))
        self._frame(out.getvalue().to_pybytes())
        entries = b"".join(struct.pack("<III", *x) for x in self.table)
        footer = struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)


class ShardReader:
    """Random access to one shard; ``source`` has seek, read and a size."""

    def __init__(self, source, size: int):
        self.source, self.kept = source, {}
        source.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end")
        source.seek(size - 9 - 12 * n)
        self.table = list(struct.iter_unpack("<III", source.read(12 * n)))
        self.at = [0]
        for packed, _, _ in self.table:
            self.at.append(self.at[-1] + packed)
        self.decompressor = zstandard.ZstdDecompressor()
        stream = pa.ipc.open_stream(self._frame(n - 1))
        self.header = json.loads(stream.schema.metadata[b"header"])
        self.directory = stream.read_all().combine_chunks()
        self.dtype = np.dtype(self.header["dtype"]).newbyteorder("<")
        self.frame_at = [0]
        for _, plain, _ in self.table[:-1]:
            self.frame_at.append(self.frame_at[-1] + plain // self.dtype.itemsize)

    def _frame(self, k: int) -> bytes:
        self.source.seek(self.at[k])
        packed, plain, checksum = self.table[k]
        raw = self.decompressor.decompress(self.source.read(packed), max_output_size=max(1, plain))
        if len(raw) != plain or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} is damaged")
        return raw

    def tokens(self, first: int, n: int) -> np.ndarray:
        """Ids first to first + n of the shard; only the frames that have them are read."""
        out, end = [], first + n
        while first < end:
            k = bisect_right(self.frame_at, first) - 1
            if k not in self.kept:
                self.kept = {k: np.frombuffer(self._frame(k), self.dtype)}
            a = first - self.frame_at[k]
            part = self.kept[k][a : a + end - first]
            out.append(part)
            first += len(part)
        return np.concatenate(out).astype(np.uint32) if out else np.zeros(0, np.uint32)

    def document(self, row: int) -> np.ndarray:
        return self.tokens(self.directory["first"][row].as_py(), self.directory["n"][row].as_py())


@dataclass
class Pieces:
    """Pieces of a batch: where each begins in ``points`` and how many characters it has, its hash, and ``packed``: the characters themselves
    in 64 bits if they are at most eight of code points 1 to 255, else 0."""

    points: np.ndarray
    starts: np.ndarray
    wide: np.ndarray
    hashes: np.ndarray
    packed: np.ndarray


def packed_characters(points: np.ndarray, starts: np.ndarray, wide: np.ndarray) -> np.ndarray:
    raw = np.zeros(len(points) + 8, np.uint8)
    raw[:-8] = points
    eight = np.ndarray((len(points),), np.uint64, raw, strides=(1,))  # the eight bytes from every byte on
    odd = running(((points > 255) | (points == 0)).astype(np.int32))
    told = (wide <= 8) & (odd[starts + wide] == odd[starts])
    rest = (np.uint64(8) * (8 - np.minimum(wide, 8)).astype(np.uint64)) & np.uint64(63)
    return np.where(told, (eight[starts] << rest) >> rest, np.uint64(0))


def alike(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which stretches of n characters (one at least) are the same."""
    if not len(n):
        return np.zeros(0, bool)
    return np.logical_and.reduceat(a[ragged(at_a, n)] == b[ragged(at_b, n)], running(n.astype(np.int64))[:-1])


class PieceEncoder:
    """The tokenizer's ids of whole texts, by way of a bounded store of the ids of pieces.

    A byte-level tokenizer first cuts a text into pieces by a pattern and then encodes every piece by itself. Here numpy
    cuts whole batches by the same pattern, with character classes asked of the library; every piece that the store
    lacks goes to the library once. A store that is full is emptied. Pieces are found by 64-bit hashes and then compared character by character.
    Added tokens that a text spells out get their ids, as in the library: the text is cut there before it is cut into pieces.
    """

    SLOTS, PROBES, STORE, UNASKED = 1 << 20, 8, 1 << 22, 9

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        self.by_piece = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec["normalizer"]
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: k for k, t in added.items()}
        # The library takes the leftmost and longest of plain added tokens; those that reach beyond their own text are left to it.
        self.by_piece &= len({t.normalized for t in added.values()}) <= 1 and not any(t.lstrip or t.rstrip or t.single_word or re.search(r"\s", t.content) for t in added.values())
        self.spelled = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        self.dtype = np.dtype(np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        if self.by_piece:
            from tokenizers import Regex
            from tokenizers.pre_tokenizers import Split

            self.others = [(k, Split(Regex(p), "removed")) for k, p in ((1, r"[^\p{L}]+"), (2, r"[^\p{N}]+"), (3, r"[^\s]+"))]
            self.classes = np.full(0x110000, self.UNASKED, np.uint8)
            self.values = seeds(0x110000, 7)
        self._empty()

    def _empty(self) -> None:
        self.keys = np.zeros(self.SLOTS, np.uint64)
        self.place = np.zeros(self.SLOTS, np.uint32)
        self.size = np.zeros(self.SLOTS, np.int32)
        self.store = np.zeros(self.STORE + (1 << 20), self.dtype)
        self.begin = np.zeros(self.SLOTS, np.uint32)
        self.length = np.zeros(self.SLOTS, np.int32)
        self.packed = np.zeros(self.SLOTS, np.uint64)
        self.known = np.zeros(1 << 20, np.uint32)
        self.used = self.filled = self.seen = 0

    def _classes(self, points: np.ndarray) -> np.ndarray:
        """1 letter, 2 number, 3 white space, 0 other, as the library's patterns have it; it is asked once for each code point."""
        kind = self.classes[points]
        if (kind == self.UNASKED).any():
            new = np.unique(points[kind == self.UNASKED])
            text = "".join(map(chr, new.tolist()))
            self.classes[new] = 0
            for k, others in self.others:
                for _, (a, b) in others.pre_tokenize_str(text):
                    self.classes[new[a:b]] = k
            kind = self.classes[points]
        return kind

    def pieces(self, points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the pattern's pieces begin."""
        kind, n = self._classes(points), len(points)
        head = np.zeros(n + 1, bool)
        head[offsets] = True
        run = head.copy()
        run[1:n] |= kind[1:] != kind[:-1]
        at = np.flatnonzero(run[:n])
        end = np.append(at[1:], n)
        begin = run.copy()
        begin[n] = False
        # White space before something else: its last character is a piece, or leads the next one if it is a space.
        gap = end[(kind[at] == 3) & ~head[end]]
        begin[gap - 1] = True
        begin[gap[points[gap - 1] == 32]] = False
        # An apostrophe that begins a piece takes s, t, m, d, re, ve or ll from the letters behind it.
        one = at[(end - at == 1) & ~head[end]]
        one = one[(points[one] == 39) & begin[one]]
        one = one[kind[one + 1] == 1]
        a = points[one + 1]
        b = np.where(head[np.minimum(one + 2, n)], 0, points[np.minimum(one + 2, n - 1)])
        short = np.isin(a, [ord(c) for c in "stmd"])
        long = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        for which, take in ((short, 1), (long, 2)):
            begin[one[which] + 1] = False
            begin[one[which] + 1 + take] = True
        return np.flatnonzero(begin[:n])

    def _probe(self, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
        """Where each piece's ids are in the store, and how many; -1 for pieces that it lacks."""
        found = np.full(len(p.hashes), -1, np.int64)
        slot = (p.hashes >> np.uint64(65 - self.SLOTS.bit_length())).astype(np.int64)
        left = np.arange(len(p.hashes))
        for _ in range(self.PROBES):
            got = self.keys[slot]
            hit = got == p.hashes[left]
            found[left[hit]] = slot[hit]
            on = ~hit & (got != 0)
            left, slot = left[on], (slot[on] + 1) % self.SLOTS
        hit = np.flatnonzero(found >= 0)
        at = found[hit]
        same = (self.length[at] == p.wide[hit]) & (self.packed[at] == p.packed[hit])
        long = np.flatnonzero(same & (p.packed[hit] == 0))
        same[long] = alike(p.points, p.starts[hit[long]], self.known, self.begin[at[long]].astype(np.int64), p.wide[hit[long]])
        place, size = np.full(len(p.hashes), -1, np.int64), np.zeros(len(p.hashes), np.int64)
        place[hit[same]], size[hit[same]] = self.place[at[same]], self.size[at[same]]
        return place, size

    def _insert(self, p: Pieces, which: np.ndarray, place: np.ndarray, size: np.ndarray) -> None:
        kept = np.where(p.packed[which] == 0, p.wide[which], 0)  # characters of pieces that packed doesn't tell
        begin = self.seen + running(kept)
        while begin[-1] > len(self.known):
            self.known = np.append(self.known, np.zeros(len(self.known), np.uint32))
        self.known[self.seen : begin[-1]] = p.points[ragged(p.starts[which], kept)]
        self.seen = int(begin[-1])
        slot = (p.hashes[which] >> np.uint64(65 - self.SLOTS.bit_length())).astype(np.int64)
        left = np.arange(len(which))
        for _ in range(self.PROBES):
            free = np.flatnonzero(self.keys[slot] == 0)
            mine, first = np.unique(slot[free], return_index=True)
            put = free[first]
            of = which[left[put]]
            self.keys[mine], self.place[mine], self.size[mine] = p.hashes[of], place[left[put]], size[left[put]]
            self.begin[mine], self.length[mine], self.packed[mine] = begin[:-1][left[put]], p.wide[of], p.packed[of]
            self.filled += len(put)
            on = np.ones(len(left), bool)
            on[put] = False
            left, slot = left[on], (slot[on] + 1) % self.SLOTS

    def _parts(self, texts: list[str], end_id: int) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The texts cut at added tokens, the id behind each part (the added token's or end_id), and how many parts each text has."""
        parts, tails, n_parts = [], [], np.ones(len(texts), np.int64)
        for k, text in enumerate(texts):
            at = 0
            for m in self.spelled.finditer(text):
                parts.append(text[at : m.start()])
                tails.append(self.added[m[0]])
                n_parts[k] += 1
                at = m.end()
            parts.append(text[at:])
            tails.append(end_id)
        return parts, np.array(tails, np.uint32), n_parts

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by end_id, and how many ids each text has with it."""
        if not self.by_piece:
            got = [np.array([*e.ids, end_id], np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.concatenate(got or [np.zeros(0, np.uint32)]), np.array([len(x) for x in got], np.int64)
        texts, tails, n_parts = self._parts(texts, end_id)
        text = "".join(texts)
        offsets = running(np.array([len(x) for x in texts], np.int64))
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if max(self.used, self.seen) > self.STORE or self.filled > 0.6 * self.SLOTS:
            self._empty()
        starts = self.pieces(points, offsets) if len(points) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(points))[: len(starts)]
        up, down = powers(len(points) + 1)
        sums = running(self.values[points] * up[: len(points)])
        hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)) | np.uint64(1)
        wide = ends - starts
        p = Pieces(points, starts, wide, hashes, packed_characters(points, starts, wide) if len(points) else np.zeros(0, np.uint64))
        place, size = self._probe(p)
        miss = np.flatnonzero(place < 0)
        if len(miss):
            _, first, back = np.unique(hashes[miss], return_index=True, return_inverse=True)
            lead = first[back]
            same = (wide[miss] == wide[miss[lead]]) & (p.packed[miss] == p.packed[miss[lead]])
            long = np.flatnonzero(same & (p.packed[miss] == 0))
            same[long] = alike(points, starts[miss[long]], points, starts[miss[lead[long]]], wide[miss[long]])
            lead[~same] = np.flatnonzero(~same)  # another piece with an equal hash stands for itself
            first, back = np.unique(lead, return_inverse=True)
            a, b = starts[miss[first]].tolist(), ends[miss[first]].tolist()
            got = [e.ids for e in self.tokenizer.encode_batch_fast([text[x:y] for x, y in zip(a, b, strict=True)], add_special_tokens=False)]
            lengths = np.array([len(x) for x in got], np.int64)
            at = self.used + running(lengths)
            while at[-1] > len(self.store):
                self.store = np.append(self.store, np.zeros(len(self.store), self.dtype))
            self.store[self.used : at[-1]] = np.fromiter((i for x in got for i in x), self.dtype, int(lengths.sum()))
            self.used = int(at[-1])
            self._insert(p, miss[first], at[:-1], lengths)
            place[miss], size[miss] = at[:-1][back], lengths[back]
        ids = self.store[ragged(place, size)]
        of_piece = running(size)
        counts = np.diff(of_piece[np.searchsorted(starts, offsets)])
        out = np.empty(len(ids) + len(texts), np.uint32)
        keep = np.ones(len(out), bool)
        keep[running(counts + 1)[1:] - 1] = False
        out[keep], out[~keep] = ids, tails
        return out, np.diff(running(counts + 1)[running(n_parts)])

    def encode_long(self, text: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long text, in stretches that end before a single blank between other characters: there a piece always begins."""
        if not self.by_piece:
            return self.encode([text], end_id)
        out, at = [], 0
        while at < len(text):
            cut = SINGLE_BLANK.search(text, min(at + LONG, len(text)))
            to = cut.start() if cut else len(text)
            out.append(self.encode([text[at:to]], end_id)[0][:-1])
            at = to
        ids = np.append(np.concatenate(out or [np.zeros(0, np.uint32)]), np.uint32(end_id)).astype(np.uint32)
        return ids, np.array([len(ids)], np.int64)


@lru_cache(1)
def encoder_of(path: str) -> PieceEncoder:
    """One encoder for each worker process."""
    return PieceEncoder(path)


def _texts(column: pa.Array) -> list[str]:
    try:
        return [x or "" for x in column.to_pylist()]
    except UnicodeDecodeError:
        return [(x or b"").decode(errors="replace") for x in column.cast(pa.binary()).to_pylist()]


SHARDS = "shard int, path string, n_docs long, n_tokens long"


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Encodes every text and writes one shard file for each range of ids; returns the shards in order, with ``start``.

    Documents lie in ascending (id, text) order, null ids first, over shards and within them. Ids are numbers. Null and empty texts have the end
    id alone; repeated rows are each written. An empty table gives empty shards. Other columns are ignored.
    A file is named after the task attempt that wrote it and only files of successful attempts are listed, so
    a lost executor or a second attempt does no harm. Very long texts are encoded whole, in stretches that change no id.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    cut = ranges(df, "id", blocks(df))
    df = df.repartitionById(cut.count, cut.block).sortWithinPartitions(F.asc_nulls_first("id"), F.asc_nulls_first("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard = context.partitionId()
        fs, root = filesystem(folder)
        path = f"{root}/tokens-{shard:06d}-{context.taskAttemptId()}.zst"
        encoder = encoder_of(tokenizer)
        n_docs = 0
        with fs.open_output_stream(path, compression=None) as sink:
            out = ShardWriter(sink, encoder.dtype)
            kind = pa.int64()
            for batch in batches:
                kind = batch.column("id").type
                at, keys, texts = 0, batch.column("id").to_pylist(), _texts(batch.column("text"))
                while at < len(texts):
                    to, size = at, 0
                    while to < len(texts) and (to == at or size + len(texts[to]) <= LONG):
                        size += len(texts[to])
                        to += 1
                    long = to == at + 1 and size > LONG
                    out.add(keys[at:to], *(encoder.encode_long(texts[at], end_id) if long else encoder.encode(texts[at:to], end_id)))
                    at = to
                n_docs += len(keys)
            out.close(kind)
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [path], "n_docs": [n_docs], "n_tokens": [out.n_tokens]})

    manifest = f"{folder}/manifest"
    df.mapInArrow(tidy(write), SHARDS).write.parquet(manifest)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(SHARDS).parquet(manifest).withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(shards: DataFrame, folder: str, id_type: str = "long", with_ids: bool = True) -> DataFrame:
    """Documents of the shards: id, start (ids of all documents before it), n_tokens, ids_crc32, and ids if asked for."""
    n = shards.count()
    schema = f"id {id_type}, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                size = fs.get_file_info(path).size
                with fs.open_input_file(path) as source:
                    reader = ShardReader(source, size)
                    for part in reader.directory.to_batches(max_chunksize=1000):
                        first, count = part["first"].to_pylist(), part["n"].to_pylist()
                        ids = [reader.tokens(a, k) for a, k in zip(first, count, strict=True)]
                        cols = {"id": part["id"], "start": [start + a for a in first], "n_tokens": count, "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]}
                        if with_ids:
                            cols["ids"] = pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64()))
                        yield pa.RecordBatch.from_pydict(cols)

    return shards.repartitionById(max(1, n), F.col("shard")).mapInArrow(tidy(read), schema)
