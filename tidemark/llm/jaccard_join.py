"""N-gram Jaccard join with Bayesian candidate pruning.

1. Every text becomes its set of distinct five-word shingles (64-bit hashes), the set's 128-bit digest and a signature: ``HASHES`` MinHash
   values of 16 bits. Texts with equal sets are one class, which gets a number; only classes go on.
2. Four values are a band, and a signature's bands are 64-bit words; classes that share a word meet in a bucket. A pair at the threshold 0.8
   meets nowhere with probability 5e-8. A bucket of more than ``BLOCK`` classes is dealt into pairs of blocks.
3. In a bucket a pair's MinHash values are compared ``STEP`` at a time, and a pair is dropped as soon as the
   posterior probability (even prior) that its similarity reaches the threshold is below ``tolerance``. Pairs that are left are not listed:
   a bucket reports the classes that have some, each with the smallest class that it hangs together with. Their components are clusters.
4. The pairs that are left are found again and verified exactly, where their texts are: shared shingles are counted by products of incidence
   matrices. A cluster is dealt into pairs of blocks; if that takes more copies of texts than its buckets do (a long chain), its
   buckets are verified instead, which hold no pairs but those that meet there. A task reports each class's number of links and a forest
   of them; the links' components are the groups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._arrow import bounded_batches, tidy
from ._components import components
from ._shared import dropped, renamed, written
from ._skew import lookup, small
from ._text import mix, running, seeds, shingles, slices, string_buffers, words

HASHES, BAND, STEP, BLOCK = 128, 4, 16, 1024
CLUSTER_SHINGLES = 1 << 20
COLUMNS = 4096


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For every number of compared values, the fewest matches with which the similarity may still reach the threshold.

    With an even prior, m matches of k make the similarity Beta(m + 1, k - m + 1); it is at least t with the probability
    that k + 1 draws of chance t succeed m times at most. The tolerance is shared by all the steps of a comparison.
    """
    tolerance /= HASHES // STEP
    out = []
    for k in range(HASHES + 1):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
        out.append(m)
    return out


BANDS = HASHES // BAND
WORDS = [f"b{k}" for k in range(BANDS)]
SKETCH = "mark string, text_key long, id {}, n long, digest binary, own array<long>, {}"


Pairs = tuple[np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Measure:
    """Sets whose Jaccard similarity is compared: how a text's set is made (``sets``: row and value of its elements) and sketched (size, digest, a row of
    ``columns`` for texts with elements, and an array of longs that only ``spread`` uses), in which buckets classes meet (``spread``: cid, n, band, word), and which pairs that meet may reach the
    threshold (``keep``: of signatures, sizes, bands and pairs). ``once``: a pair is kept in one bucket at most; else clusters are always verified whole."""

    threshold: float
    columns: list[str]
    sketch: Callable[[pa.Array], tuple[np.ndarray, list[bytes | None], np.ndarray, np.ndarray, pa.Array]]
    spread: Callable[[DataFrame, DataFrame], DataFrame]
    keep: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], Pairs]
    sets: Callable[[pa.Array], Pairs]
    once: bool = False


def of_shingles(threshold: float = 0.8, width: int = 5, tolerance: float = 1e-5) -> Measure:
    """Runs of ``width`` words; classes meet in MinHash bands and are pruned by comparing MinHash values step by step."""
    least = least_matches(threshold, tolerance)

    def sketched(texts: pa.Array) -> tuple[np.ndarray, list[bytes | None], np.ndarray, np.ndarray, pa.Array]:
        n, digests, values, filled = sketch(texts, width, seeds(HASHES, 11) | np.uint64(1))
        return n, digests, values.view(np.int64), filled, pa.nulls(len(texts), pa.list_(pa.int64()))

    def spread(_: DataFrame, classes: DataFrame) -> DataFrame:
        return classes.filter("n > 0").select("cid", "n", F.posexplode(F.array(*WORDS)).alias("band", "word"))

    return Measure(threshold, WORDS, sketched, spread, lambda bands, n, band, a, b: survivors(bands, n, band, a, b, threshold, least), lambda texts: sets_of(texts, width), once=True)


def _mark(id_col: str, text_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("~"), F.xxhash64(text_col).cast("string")))


def sketches(docs: DataFrame, id_col: str, text_col: str, measure: Measure) -> DataFrame:
    """mark (a row's id as text, or for a null id a hash of its text), text_key (a hash of the text), id, size of the set, digest, and the measure's columns."""
    light = docs.select(_mark(id_col, text_col).alias("mark"), F.xxhash64(text_col).alias("text_key"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = ["mark", "text_key", "id", "n", "digest", "own", *measure.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in slices(whole.column("text")):
                batch = whole.slice(a, b - a)
                n, digests, values, filled, own = measure.sketch(batch.column("text"))
                longs = np.zeros((len(batch), len(measure.columns)), np.int64)
                longs[filled] = values
                columns = [pa.array(longs[:, k], mask=n == 0) for k in range(len(measure.columns))]
                yield pa.RecordBatch.from_arrays([batch.column("mark"), batch.column("text_key"), batch.column("id"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), own, *columns], names=names)

    return light.mapInArrow(tidy(run), SKETCH.format(light.schema["id"].dataType.simpleString(), ", ".join(f"{c} long" for c in measure.columns)))


def sketch(texts: pa.Array, width: int, factors: np.ndarray) -> tuple[np.ndarray, list[bytes | None], np.ndarray, np.ndarray]:
    """Numbers of shingles, digests (None for empty texts), signatures (16-bit values) of the rows that have shingles, and these rows."""
    data, offsets = string_buffers(texts)
    row, value = shingles(words(data, offsets), width)
    n = np.bincount(row, minlength=len(texts))
    filled = np.flatnonzero(n)
    digests = set_digests(n, value)
    for r in np.flatnonzero((n == 0) & (np.diff(offsets) > 0)).tolist():  # no words: only equal texts are alike
        raw = data[offsets[r] : offsets[r + 1]].tobytes()
        digests[r] = xxhash.xxh3_128_digest(raw, 1)
    values = np.zeros((len(filled), HASHES), np.uint16)
    if len(filled):
        heads = running(n[filled])[:-1]
        for k in range(HASHES):
            values[:, k] = mix(np.minimum.reduceat(value * factors[k], heads)) >> np.uint64(48)
    return n, digests, values, filled


def sets_of(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of every text's shingles, a slice of texts at a time."""
    rows, values = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for a, b in slices(texts):
        row, value = shingles(words(*string_buffers(texts.slice(a, b - a))), width)
        rows.append(row + a)
        values.append(value)
    return np.concatenate(rows), np.concatenate(values)


def set_digests(n: np.ndarray, value: np.ndarray) -> list[bytes | None]:
    """128-bit digests of sets of n values each, None for an empty set."""
    out: list[bytes | None] = [None] * len(n)
    filled = np.flatnonzero(n)
    if len(filled):
        heads = running(n[filled])[:-1]
        sums = np.stack([np.add.reduceat(mix(value ^ s), heads) + n[filled].astype(np.uint64) for s in seeds(2, 17)], 1)
        for r, x in zip(filled.tolist(), np.ascontiguousarray(sums), strict=True):
            out[r] = x.tobytes()
    return out


class Forest:
    """Sets of row numbers, merged by pairs."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            on = x != y
            a, b, x, y = a[on], b[on], x[on], y[on]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while (self.root != self.root[self.root]).any():
                self.root = self.root[self.root]


def group_starts(keys: list[np.ndarray]) -> np.ndarray:
    """Where a new combination of sorted keys begins."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold whole groups of the sorted input; a group's rows are at most two blocks."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        starts = group_starts([np.asarray(table[k]) for k in keys])
        if len(starts) > 1:
            yield table.slice(0, starts[-1])
            held = table.slice(starts[-1]).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def paired(starts: np.ndarray, n: int, side: np.ndarray, most: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (a before b) of every group, a stretch at a time. side: 0 and 1 for a group of two blocks, which pairs one with the other; else 2."""
    end = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    a = np.arange(n)
    many = end - a - 1
    at = 0
    total = running(many)
    while at < n:
        to = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
        x = np.repeat(a[at:to], many[at:to])
        y = np.arange(len(x)) - np.repeat(total[at:to] - total[at], many[at:to]) + x + 1
        ok = (side[x] == 2) | (side[x] != side[y])
        yield x[ok], y[ok]
        at = to


def survivors(bands: np.ndarray, n: np.ndarray, band: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose set sizes allow the threshold, that meet in this band first (in any, if it is -1), and that no step of comparisons drops."""
    low, high = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
    ok = low >= high * threshold - 1e-9
    a, b = a[ok], b[ok]
    same = bands[a] == bands[b]
    ok = np.where(band[a] < 0, same.any(1), same.argmax(1) == band[a])
    a, b = a[ok], b[ok]
    values = bands.view(np.uint16)
    matches = np.zeros(len(a), np.int64)
    for k in range(0, HASHES, STEP):
        matches += (values[a, k : k + STEP] == values[b, k : k + STEP]).sum(1)
        ok = matches >= least[min(HASHES, k + STEP)]
        a, b, matches = a[ok], b[ok], matches[ok]
    return a, b


def _left(table: pa.Table, keys: list[str], measure: Measure) -> Iterator[Pairs]:
    """The pairs of rows that pruning leaves in the groups of a table."""
    starts = group_starts([np.asarray(table[k]) for k in keys])
    i, j, block, band = (np.asarray(table[k]) for k in ("i", "j", "block", "band"))
    side = np.where(i == j, 2, (block == j).astype(int))
    signatures, n = np.ascontiguousarray(np.stack([np.asarray(table[c]) for c in measure.columns], 1)), np.asarray(table["n"])
    for a, b in paired(starts, len(table), side):
        yield measure.keep(signatures, n, band, a, b)


PLACE = ["band", "word", "i", "j"]
MET = "band int, word long, i int, j int, block int, cid long, root long"


def _pruner(measure: Measure) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, PLACE):
            if not len(table):
                continue
            forest, active = Forest(len(table)), np.zeros(len(table), bool)
            for a, b in _left(table, PLACE, measure):
                forest.add(a, b)
                active[a] = active[b] = True
            k = np.flatnonzero(active)
            cid = np.asarray(table["cid"])
            yield pa.RecordBatch.from_arrays([*[pa.array(np.asarray(table[c])[k]) for c in (*PLACE, "block", "cid")], pa.array(cid[forest.root[k]])], names=[*PLACE, "block", "cid", "root"])

    return run


def shared_counts(rows_a: tuple[np.ndarray, np.ndarray], n_a: int, rows_b: tuple[np.ndarray, np.ndarray], n_b: int) -> np.ndarray:
    """How many values each set of a shares with each set of b; sets are (row, value) lists."""
    values, place = np.unique(np.append(rows_a[1], rows_b[1]), return_inverse=True)
    pa_, pb = place[: len(rows_a[1])], place[len(rows_a[1]) :]
    both = (np.bincount(pa_, minlength=len(values)) > 0) & (np.bincount(pb, minlength=len(values)) > 0)
    number = np.cumsum(both) - 1
    out = np.zeros((n_a, n_b))
    ka, kb = both[pa_], both[pb]
    ra, ca, rb, cb = rows_a[0][ka], number[pa_[ka]], rows_b[0][kb], number[pb[kb]]
    for at in range(0, int(both.sum()), COLUMNS):
        x, y = np.zeros((n_a, COLUMNS), np.float32), np.zeros((n_b, COLUMNS), np.float32)
        on = (ca >= at) & (ca < at + COLUMNS)
        x[ra[on], ca[on] - at] = 1
        on = (cb >= at) & (cb < at + COLUMNS)
        y[rb[on], cb[on] - at] = 1
        out += x @ y.T
    return out


def _verifier(measure: Measure) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    keys = ["gkey", "band", "i", "j"]

    def of_group(table: pa.Table) -> pa.RecordBatch:
        row, value = measure.sets(table["text"].combine_chunks())
        n = np.bincount(row, minlength=len(table))
        asked = table["digest"].to_pylist()
        first = {d: r for r, (d, x) in reversed(list(enumerate(zip(asked, set_digests(n, value), strict=True)))) if d == x}
        if len(first) < len(table):  # other texts with an equal hash, or a row that repeats
            return of_group(table.take(pa.array(sorted(first.values()), pa.int64())))
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        cid, copies, block = (np.asarray(table[c]) for c in ("cid", "copies", "block"))
        left, right = (np.flatnonzero(block == x) for x in (i, j))
        place = np.zeros(len(table), np.int64)
        place[left] = np.arange(len(left))
        place[right] = np.arange(len(right))
        asked_for = np.zeros((len(left), len(right)), bool)
        for a, b in _left(table, keys, measure):
            if i == j:
                asked_for[place[a], place[b]] = asked_for[place[b], place[a]] = True
            else:
                swap = block[a] == j
                asked_for[place[np.where(swap, b, a)], place[np.where(swap, a, b)]] = True
        in_a, in_b = np.isin(row, left), np.isin(row, right)
        shared = shared_counts((place[row[in_a]], value[in_a]), len(left), (place[row[in_b]], value[in_b]), len(right))
        either = n[left][:, None] + n[right][None, :] - shared
        linked = asked_for & (shared >= measure.threshold * either - 1e-6)
        links = np.zeros(len(table), np.int64)
        links[left] += linked @ copies[right]
        if i != j:
            links[right] += linked.T @ copies[left]
        forest = Forest(len(table))
        x, y = np.nonzero(linked)
        forest.add(left[x], right[y])
        return pa.RecordBatch.from_arrays([pa.array(cid), pa.array(links), pa.array(cid[forest.root])], names=["cid", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            if not len(table):
                continue
            starts = np.append(group_starts([np.asarray(table[k]) for k in keys]), len(table))
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                yield of_group(table.slice(a, b - a))

    return run


def _dealt(df: DataFrame, blocks, key: str) -> DataFrame:
    """A row for every pair of blocks (i <= j) that its own block takes part in."""
    block = F.pmod(F.xxhash64(key), blocks).cast("int")
    df = df.withColumns({"blocks": blocks.cast("int"), "block": block})
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("i"), F.greatest(o, F.col("block")).alias("j")))
    return df.withColumn("p", F.explode(pair)).select("*", "p.i", "p.j").drop("p", "blocks")


def _repeats(rows: DataFrame) -> bool:
    """Whether some text is in more than one row."""
    return not rows.groupBy("text_key").count().filter("count > 1").isEmpty()


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, width: int = 5, tolerance: float = 1e-5) -> DataFrame:
    """A row for every row of ``docs``: mark, id, ``copy_of`` (smallest id with the same shingle set), ``class_id`` (smallest id of the group that links connect), ``n_links``.

    A link joins two rows whose shingle sets have a Jaccard similarity of ``threshold`` or more; copies count as links. A text with fewer
    than ``width`` words has one shingle of all; texts without words are linked only to equal ones; null and empty texts to none. Rows that
    repeat an id each have a row and are linked if their texts are alike. Rows with a null id take part; they are named by their group's smallest
    id, or null. Very long texts count whole. An empty table gives an empty result. Extra columns are ignored.
    """
    return grouped(docs, id_col, text_col, of_shingles(threshold, width, tolerance)).drop("text_key", "root")


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", measure: Measure | None = None) -> DataFrame:
    """:func:`jaccard_join` by any measure, with two more columns: ``text_key``, which with ``mark`` tells rows of one id and different texts apart, and ``root``, a name of the group that no other group has (null without links)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    measure, parts = measure or of_shingles(), max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Numbers, once written, stay.
    sketched = written(sketches(docs, id_col, text_col, measure).withColumn("row", F.monotonically_increasing_id()), "jaccard")
    total = sketched.count()
    # All aggregates are of numbers, so that nothing is sorted for them.
    of_set = sketched.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("id").alias("copy_of"), F.min("text_key").alias("text_key"), F.count("*").alias("copies"), F.min("n").alias("n"), F.min("row").alias("row"), *[F.max(c).alias(c) for c in measure.columns])
    classes = written(of_set.withColumn("cid", F.monotonically_increasing_id()), "jaccard")
    rows = sketched.select("mark", "text_key", "id", "digest")
    spread = measure.spread(sketched, classes).withColumn("word", F.xxhash64("band", "word"))
    shared = spread.groupBy("word").agg(F.count("*").alias("size"), F.sum("n").alias("all_n")).filter("size > 1")
    met = lookup(spread.drop("n"), written(shared, "jaccard"), "word", "size", max(1, BANDS * classes.count())).filter("size IS NOT NULL")
    met = met.join(classes.select("cid", "n", *measure.columns), "cid")
    met = _dealt(met, F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("all_n") / CLUSTER_SHINGLES)), "cid")
    met = met.repartition(parts, *PLACE).sortWithinPartitions(*PLACE)
    near = written(met.mapInArrow(tidy(_pruner(measure)), MET), "jaccard")
    clusters = written(components(near.select(F.col("cid").alias("a"), F.col("root").alias("b")).distinct()), "jaccard")
    light = classes.select(F.col("cid").alias("node"), "n")
    of_cluster = clusters.join(light, "node").groupBy("root").agg(F.count("*").alias("members"), F.sum("n").alias("all_n"))
    places = near.select(F.col("cid").alias("node")).join(clusters, "node").groupBy("root").agg(F.count("*").alias("places"))
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("all_n") / CLUSTER_SHINGLES))
    of_cluster = written(of_cluster.join(places, "root").withColumn("blocks", blocks).withColumn("whole", ~F.lit(measure.once) | (F.col("members") * F.col("blocks") <= F.col("places"))), "jaccard")
    member = lookup(clusters, of_cluster, "root", "members", max(1, clusters.count()))
    member = written(member.select(F.col("node").alias("cid"), "root", "blocks", "whole"), "jaccard")
    whole = _dealt(member.filter("whole").drop("whole"), F.col("blocks"), "cid").select("cid", F.xxhash64("root").alias("gkey"), F.lit(-1).alias("band"), "i", "j", "block")
    by_bucket = near.join(member.filter("NOT whole").select("cid"), "cid").select("cid", F.col("word").alias("gkey"), "band", "i", "j", "block")
    places = whole.unionByName(by_bucket).join(classes.select("cid", "text_key", "digest", "copies", "n", *measure.columns), "cid")
    places = written(places, "jaccard")
    wanted = small(places.select("text_key").distinct())
    texts = docs.select(F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")).join(wanted, "text_key", "left_semi")
    once = texts.dropDuplicates(["text_key", "text"]) if _repeats(rows) else texts
    texts = once.join(small(places), "text_key")
    texts = texts.repartition(parts, "gkey", "band", "i", "j").sortWithinPartitions("gkey", "band", "i", "j")
    checked = written(texts.mapInArrow(tidy(_verifier(measure)), "cid long, links long, root long"), "jaccard")
    links = checked.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(checked.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    linked = roots.withColumnRenamed("node", "cid").join(links, "cid").join(classes.select("cid", "copy_of"), "cid")
    linked = written(linked, "jaccard")
    groups = written(linked.groupBy("root").agg(F.min("copy_of").alias("class_id"), F.count("*").alias("members")), "jaccard")
    named = lookup(linked.select("cid", "root", "links"), groups, "root", "members", max(1, linked.count())).select("cid", "class_id", "links", "root")
    table = classes.select("cid", "digest", "copy_of", "copies").join(named, "cid", "left").filter("copies > 1 OR links > 0")
    table = written(table.withColumns({"class_id": F.coalesce("class_id", "copy_of"), "root": F.coalesce("root", "cid")}).drop("cid"), "jaccard")
    dropped(classes, near, clusters, of_cluster, member, places, checked, linked, groups)
    out = lookup(rows, table, "digest", "copies", max(1, total))
    n_links = F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))
    return out.select("mark", "text_key", "id", F.coalesce("copy_of", "id").alias("copy_of"), F.coalesce("class_id", "id").alias("class_id"), n_links.cast("long").alias("n_links"), "root")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", measure: Measure | None = None) -> DataFrame:
    """``docs``, with all its columns, with one row of every group that links connect: the one with the smallest id (of several with it, or without any, the one with the smallest hash of its text).

    Rows are told apart by id and text, so an id that repeats with other texts takes none of them along. Rows without links stay, and so do null and
    empty texts; of rows that repeat another whole one stays, if they have words. Very long texts count whole; an empty table stays one.
    """
    own = ["mark", "text_key"]
    linked = written(grouped(docs, id_col, text_col, measure).filter("n_links > 0").select(*own, "id", "root"), "jaccard")
    total = max(1, linked.count())
    first = written(linked.groupBy("root").agg(F.min("id").alias("least"), F.count("*").alias("members")), "jaccard")
    led = lookup(linked, first, "root", "members", total).filter("id <=> least")
    keeper = written(led.groupBy("root").agg(F.min("text_key").alias("text_key"), F.first("least").alias("id")), "jaccard")
    keeper = keeper.select("text_key", F.coalesce(F.col("id").cast("string"), F.concat(F.lit("~"), F.col("text_key").cast("string"))).alias("mark"))
    gone = written(linked.join(keeper, own, "left_anti").select(own).distinct(), "jaccard")
    twice = written(linked.groupBy(own).count().filter("count > 1").select(own), "jaccard")
    work, columns, (own_id, own_text) = renamed(docs, id_col, text_col)
    kept = work.withColumns({"mark": _mark(own_id, own_text), "text_key": F.xxhash64(own_text)}).join(small(gone), own, "left_anti")
    if not twice.isEmpty():
        repeated = small(twice)
        once = kept.join(repeated, own, "left_semi").dropDuplicates(own)
        kept = kept.join(repeated, own, "left_anti").unionByName(once)
    return kept.select(columns).toDF(*docs.columns)
