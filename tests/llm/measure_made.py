"""Figures for tables that the driver's data lack: pages with redirects, conversations with tool calls, a large benchmark. Run by hand: python tests/llm/measure_made.py {op2,op7,op9}."""

import json
import os
import sys
import tempfile
import threading
import time

import psutil

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT  # for executors of a local cluster

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def session(master):
    at = tempfile.mkdtemp()
    conf = {"spark.master": master, "spark.driver.memory": "750m" if "cluster" in master else "4g", "spark.executor.memory": "1800m", "spark.sql.shuffle.partitions": "24", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": f"file://{at}", "spark.sql.warehouse.dir": f"file://{at}/w"}
    spark = SparkSession.builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pages(spark, n):
    """A third of the rows have one URL; a third lead to one hub by canonical links; the rest are chains of eight pages. Some members are blocked."""
    k, third = F.col("id"), n // 3
    link = F.when(k < third, None).when(k < 2 * third, "http://hub.fr/").when(k % 8 == 0, F.concat(F.lit("http://x.com/en/"), k.cast("string"))).otherwise(F.concat(F.lit("http://c"), (k - 1).cast("string"), F.lit(".fr/p")))
    url = F.when(k < third, "http://hot.fr/page").when(k < 2 * third, F.concat(F.lit("http://s"), k.cast("string"), F.lit(".fr/"))).otherwise(F.concat(F.lit("http://c"), k.cast("string"), F.lit(".fr/p")))
    html = F.when(link.isNotNull(), F.concat(F.lit('<html><head><link rel="canonical" href="'), link, F.lit('"></head>')))
    return spark.range(n).select(k.alias("page_id"), url.alias("url"), html.alias("html"))


def conversations(spark, n):
    """n calls with a result each: a third in one conversation, where all need the first; the others in conversations of ten that need one another in a chain."""
    k, third = F.col("id"), n // 3
    conv = F.when(k < third, F.lit(-1)).otherwise(F.floor(k / 10))
    need = F.when(k == 0, F.array().cast("array<string>")).when(k < third, F.array(F.lit("c0"))).when(k % 10 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("c"), (k - 1).cast("string"))))
    name = F.concat(F.lit("c"), k.cast("string"))
    call = F.struct(name.alias("id"), F.lit("search").alias("name"), F.struct(F.lit("q").alias("query")).alias("arguments"), need.alias("after"))
    calls = spark.range(n).select(conv.alias("conv_id"), (2 * k).alias("turn"), F.lit("assistant").alias("role"), F.to_json(F.struct(F.array(call).alias("tool_calls"))).alias("text"))
    results = spark.range(n).select(conv.alias("conv_id"), (2 * k + 1).alias("turn"), F.lit("tool").alias("role"), F.to_json(F.struct(name.alias("tool_call_id"), F.lit("found").alias("content"))).alias("text"))
    return calls.unionByName(results)


def timed(df):
    began = time.time()
    rows = df.count()
    return rows, round(time.time() - began, 1)


def main(which):
    from tidemark.llm import chat, decontamination, url_filters
    from tidemark.llm.queries import RULES, TOOLS

    out = {"which": which}
    if which == "op9":
        spark = session("local-cluster[3,2,3000]")
        me, peak = psutil.Process(), [0]
        jvm = [p for p in me.children() if "java" in p.name()]

        def watch():
            while True:
                peak[0] = max(peak[0], sum(p.memory_info().rss for p in (me, *jvm)))
                time.sleep(0.2)

        threading.Thread(target=watch, daemon=True).start()
        docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").repartition(12)
        words = F.expr("array_join(transform(sequence(1, 700), x -> conv(hash(id, x), 10, 36)), ' ')")
        bench = spark.range(14_000).select(F.col("id").alias("item_id"), words.alias("text")).unionByName(spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").select("item_id", "text"))
        bench.write.parquet(f"{spark.conf.get('spark.checkpoint.dir')}/bench")
        bench = spark.read.parquet(f"{spark.conf.get('spark.checkpoint.dir')}/bench")
        out["benchmark_mb"] = bench.agg(F.sum(F.octet_length("text"))).first()[0] >> 20
        began = time.time()
        out["contaminated"] = decontamination.decontaminate(docs, bench).filter("contaminated").count()
        out |= {"seconds": round(time.time() - began, 1), "driver_mb": peak[0] >> 20}
    else:
        spark = session("local[8]")
        for n in (100_000, 400_000):
            if which == "op2":
                began = time.time()
                rows, _ = timed(url_filters.url_filter(pages(spark, n), RULES).filter("verdict = 'block'"))
            else:
                began = time.time()
                rows, _ = timed(chat.linked(conversations(spark, n // 2), TOOLS).filter("status = 'ok'"))
            out[n] = {"rows": rows, "seconds": round(time.time() - began, 1)}
    print(json.dumps(out))


if __name__ == "__main__":
    main(sys.argv[1])
