"""The raw zone: one object for each fetched window, under a key that the window alone decides."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from contextlib import suppress
from datetime import date

from pyspark.sql import SparkSession


def raw_key(start: date, end: date, prefix: str = "nav") -> str:
    """Fetching a window again overwrites it."""
    return f"period={start:%Y-%m}/{prefix}_{start:%Y%m%d}_{end:%Y%m%d}.txt"


def filesystem(spark: SparkSession, path: str):
    """The store that has a path, and the path in it."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def put_bytes(spark: SparkSession, root: str, key: str, body: bytes) -> str:
    """Writes an object in any store that Spark reaches; gives its path as the store spells it."""
    fs, hpath = filesystem(spark, f"{root.rstrip('/')}/{key}")
    out = fs.create(hpath, True)
    try:
        out.write(body)
    finally:
        out.close()
    return hpath.toString()


def period_paths(spark: SparkSession, root: str, periods: list[str]) -> list[str]:
    """Sorted paths of the periods' objects; an error if there are none."""
    found = []
    for period in sorted(set(periods)):
        if not re.fullmatch(r"\d{4}-\d{2}", period):
            raise ValueError(f"not a period: {period}")
        fs, hpath = filesystem(spark, f"{root.rstrip('/')}/period={period}/*")
        found += [str(s.getPath()) for s in fs.globStatus(hpath) or []]
    if not found:
        raise FileNotFoundError(f"no files for periods {periods}")
    return sorted(found)


def delivery(body: bytes, header: str) -> bytes:
    """``body``, if it begins with the header; a page that says something else is an error."""
    if body.strip()[: len(header)] != header.encode():
        raise ValueError("the body doesn't begin with the header")
    return body


def fetch(get: Callable[[date, date], bytes], start: date, end: date, header: str, pauses: tuple[float, ...] = (5.0, 10.0), sleep: Callable[[float], None] = time.sleep) -> bytes:
    """A window's delivery from ``get``: after each failure but the last the next pause is kept, and the last failure is the caller's."""
    for rest in pauses:
        with suppress(Exception):
            return delivery(get(start, end), header)
        sleep(rest)
    return delivery(get(start, end), header)


def land(spark: SparkSession, root: str, get: Callable[[date, date], bytes], windows: list[tuple[date, date]], header: str, prefix: str = "nav", between: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> list[str]:
    """Fetches and writes every window."""
    out = []
    for k, (start, end) in enumerate(windows):
        if k:
            sleep(between)
        out.append(put_bytes(spark, root, raw_key(start, end, prefix), fetch(get, start, end, header, sleep=sleep)))
    return out


def text_at(spark: SparkSession, path: str) -> str | None:
    """A small text object, or None if it isn't there."""
    fs, hpath = filesystem(spark, path)
    if not fs.exists(hpath):
        return None
    source = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def replaced(spark: SparkSession, path: str, text: str) -> None:
    """Puts a small text object in the place of another at once: readers see the old one or the new one."""
    folder, _, name = path.rpartition("/")
    put_bytes(spark, folder, f"_{name}.next", text.encode())
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    old, new = (jvm.org.apache.hadoop.fs.Path(x) for x in (f"{folder}/_{name}.next", path))
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    qualified = old.getFileSystem(conf).makeQualified(old)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), conf).rename(qualified, new.getFileSystem(conf).makeQualified(new), over)
