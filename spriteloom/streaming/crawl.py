"""A crawl as a stateful stream, which goes on where it was stopped.

Every url that was ever seen is state by the url's hash, so one large host is
spread too.  Each host is a group with a queue of those that wait, in blocks.  A
timer for each host lets up to ``burst`` urls go and sets the next one ``delay``
later for each of them, so hosts are treated politely and side by side; without
a delay all that wait go at once, block by block, so the number of micro-batches
follows the depth of the crawl and not its size.  What is due in a micro-batch is fetched, written
under the batch's number, and its links are written to the frontier's folder, from
which the stream reads them.

The state is committed with every micro-batch.  A batch that runs again, after
a lost executor or driver, fetches only those of its pages that aren't written
yet; no url of an earlier batch is fetched a second time.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from spriteloom.operators.crawl import Fetch, absolute, file_name, links
from spriteloom.sources import storage

#: From pages (url, kind, content) of status 200 to the urls (url, kind) that they lead to.
Step = Callable[[DataFrame], DataFrame]
_FRONTIER = "host string, url string, kind string"
_EVENTS = "host string, url string, kind string, event string"
_PAGES = "url string, kind string, status int, content binary"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks_state(spark: SparkSession):
    """Queries that are started inside keep their state in RocksDB, which states of several kinds need."""
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before)


#: Urls of a queue's block.
BLOCK = 500


class Host(StatefulProcessor):
    """Gives out every url of a host, which comes once: as ``new`` when it is seen, and as ``due`` when its turn comes."""

    def __init__(self, delay: float, burst: int):
        self.delay, self.burst = int(delay * 1000), burst

    def init(self, handle) -> None:
        self.handle = handle
        self.queue = handle.getMapState("queue", "block long", "urls array<string>, kinds array<string>")
        self.ends = handle.getValueState("ends", "first long, taken long, last long")

    def handleInputRows(self, key, rows, timerValues):
        first, taken, last = self.ends.get() or (0, 0, 0)
        idle, before = first == last, last
        for frame in rows:
            urls, kinds = frame["url"].tolist(), frame["kind"].tolist()
            for at in range(0, len(urls), BLOCK):
                self.queue.updateValue((last,), (urls[at : at + BLOCK], kinds[at : at + BLOCK]))
                last += 1
            yield _events(key[0], urls, kinds, "new")
        if idle and last > before:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs())
        self.ends.update((first, taken, last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        first, taken, last = self.ends.get()
        n = 0
        while first < last and (n < self.burst or not self.delay):
            urls, kinds = self.queue.getValue((first,))
            upto = min(len(urls), taken + self.burst - n) if self.delay else len(urls)
            n += upto - taken
            yield _events(key[0], urls[taken:upto], kinds[taken:upto], "due")
            if upto < len(urls):
                taken = upto
            else:
                self.queue.removeKey((first,))
                first, taken = first + 1, 0
        self.ends.update((first, taken, last))
        if first < last:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.delay * n)

    def close(self) -> None:
        pass


def _events(host: str, urls: list[str], kinds: list[str], event: str) -> pd.DataFrame:
    return pd.DataFrame({"host": host, "url": urls, "kind": kinds, "event": event}, dtype=object)


def host_of(url) -> F.Column:
    return F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def gallery_step(pages: DataFrame) -> DataFrame:
    """From listings to details, and from details to image files and archives, which lead nowhere."""
    read = pages.select("url", "kind", F.decode("content", "UTF-8").alias("html"))
    details = links(read.where("kind = 'listing'")).where(F.col("href").startswith("/content/")).select(absolute("url", "href").alias("url"), F.lit("detail").alias("kind"))
    files = links(read.where("kind = 'detail'"), tag="span", css_class="file").where("href <> ''").select(absolute("url", "href").alias("url"), F.lit("file").alias("kind"))
    return details.unionByName(files.where(F.lower(file_name(F.col("url"))).rlike(r"\.(png|gif|zip)$")))


class _Progress:
    """What is still to come, from the events so far; kept in the crawl's folder, so that a later run knows it too."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder, self.done = folder, threading.Event()
        stored = spark.read.schema(_EVENTS).parquet(f"{folder}/events/*") if storage.names(f"{folder}/events", "_SUCCESS") else None
        self.by_batch = {} if stored is None else {r["b"]: r["n"] for r in _by_batch(stored.withColumn("b", F.regexp_extract(F.input_file_name(), "/events/([0-9]+)/", 1).cast("int"))).collect()}

    def note(self, batch: int, waiting: int, found: int) -> None:
        self.by_batch[batch] = waiting
        if not found and not sum(self.by_batch.values()) and not self.done.is_set():
            self.done_at = batch
            self.done.set()


def _by_batch(events: DataFrame) -> DataFrame:
    """(b, n): by how many urls a batch made the queues longer."""
    return events.groupBy("b").agg((F.count_if(F.col("event") == "new") - F.count_if(F.col("event") == "due")).alias("n"))


def crawl(seeds: DataFrame, fetch: Fetch, step: Step, folder: str, delay: float = 0.5, burst: int = 1, timeout: float | None = None) -> DataFrame:
    """(url, kind, status, content): every page that ``seeds`` (url, kind) and the links that ``step`` finds lead to, each once.

    All is kept under ``folder``: run again there, the crawl goes on with what
    is new.  ``timeout`` (seconds) stops it before its end.
    """
    spark = seeds.sparkSession

    def hosted(rows: DataFrame) -> DataFrame:
        return rows.where("url IS NOT NULL").select(host_of(F.col("url")).alias("host"), "url", "kind").distinct()

    def batch(events: DataFrame, number: int) -> None:
        own = {part: f"{folder}/{part}/{number}" for part in ("events", "pages", "frontier")}
        events.write.mode("overwrite").parquet(own["events"])  # the same as before, if the batch runs again
        events = spark.read.schema(_EVENTS).parquet(own["events"])
        due = events.where("event = 'due'").select("url", "kind")
        missing = due
        if storage.names(own["pages"], "_SUCCESS"):
            missing = due.join(spark.read.schema(_PAGES).parquet(own["pages"]).select("url"), "url", "left_anti")
        fetch(missing.select("url")).join(missing, "url").select("url", "kind", F.col("status").cast("int"), "content").write.mode("append").parquet(own["pages"])
        found = hosted(step(spark.read.schema(_PAGES).parquet(own["pages"]).where("status = 200")))
        found.write.mode("overwrite").parquet(own["frontier"])
        n = _by_batch(events.withColumn("b", F.lit(number))).first()
        progress.note(number, n["n"] if n else 0, spark.read.schema(_FRONTIER).parquet(own["frontier"]).count())

    progress = _Progress(spark, folder)
    hosted(seeds).write.mode("append").parquet(f"{folder}/frontier/seeds")
    with rocks_state(spark):
        frontier = spark.readStream.schema(_FRONTIER).parquet(f"{folder}/frontier/*").dropDuplicates(["url"])
        events = frontier.groupBy("host").transformWithStateInPandas(Host(delay, burst), _EVENTS, "Append", "processingTime")
        query = events.writeStream.foreachBatch(batch).outputMode("append").option("checkpointLocation", f"{folder}/checkpoint").trigger(processingTime="0 seconds").start()
    ends = None if timeout is None else time.monotonic() + timeout
    while query.isActive and (ends is None or time.monotonic() < ends):
        last = query.lastProgress
        if progress.done.wait(0.1) and last and last["batchId"] >= progress.done_at:
            break
    failed = None if query.isActive else query.exception()
    query.stop()  # a batch in flight runs again next time
    if failed:
        raise failed
    return spark.read.schema(_PAGES).parquet(f"{folder}/pages/*").dropDuplicates(["url"])
