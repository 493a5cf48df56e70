import time

import pytest
from pyspark.sql import functions as F

from spriteloom.operators import crawl as pages
from spriteloom.streaming.crawl import crawl, gallery_step


def site(spark, n=6):
    rows = [(f"https://a.example/search?page={p}", 200, "".join(f'<a href="/content/{k}">x</a><a href="/other">y</a>' for k in range(p, p + 3))) for p in range(n)]
    rows += [(f"https://a.example/content/{k}", 500 if k == 2 else 200, f'<span class="file"><a href="https://b.example/{k}.png">f</a><a href="/files/{k}.zip?x">n</a><a href="/files/{k}.gif">g</a></span>') for k in range(n + 1)]
    rows += [(f"https://b.example/{k}.png", 200, f"image {k}") for k in range(n)]
    return spark.createDataFrame(rows, "url string, status int, content string")


def wanted(n=6):
    details = {f"https://a.example/content/{k}" for k in range(n + 2)}
    good = [k for k in range(n + 1) if k != 2]
    files = {f"https://b.example/{k}.png" for k in good} | {f"https://a.example/files/{k}.gif" for k in good}
    return {f"https://a.example/search?page={p}" for p in range(n)} | details | files


def counting_fetch(spark, stored, folder):
    """Notes every url that it is asked for."""
    fetch = pages.from_table(stored)

    def ask(urls):
        urls.write.mode("append").parquet(folder)
        return fetch(urls)

    return ask


def seeds(spark, numbers):
    return spark.createDataFrame([(f"https://a.example/search?page={p}", "listing") for p in numbers], "url string, kind string")


def test_each_url_once_and_on_where_it_stopped(spark, tmp_path):
    stored, asked, folder = site(spark), str(tmp_path / "asked"), str(tmp_path / "crawl")
    fetch = counting_fetch(spark, stored, asked)
    first = crawl(seeds(spark, [0, 1]), fetch, gallery_step, folder, delay=0, burst=100, timeout=120)
    part = {r["url"] for r in first.collect()}
    assert "https://a.example/content/3" in part and "https://a.example/search?page=4" not in part
    got = crawl(seeds(spark, range(6)), fetch, gallery_step, folder, delay=0, burst=100, timeout=120).collect()
    assert {r["url"] for r in got} == wanted() and len(got) == len(wanted())
    assert {r["url"]: r["status"] for r in got}["https://a.example/content/2"] == 500
    urls = [r["url"] for r in spark.read.parquet(asked).collect()]
    assert len(urls) == len(set(urls)) == len(got)


def test_a_stopped_crawl_waits_politely_and_goes_on(spark, tmp_path):
    stored, asked, folder = site(spark), str(tmp_path / "asked"), str(tmp_path / "crawl")
    fetch = counting_fetch(spark, stored, asked)
    began = time.time()
    some = crawl(seeds(spark, range(6)), fetch, gallery_step, folder, delay=2, burst=1, timeout=12).count()
    assert 1 <= some <= 2 * ((time.time() - began) / 2 + 1)  # two hosts, one url in two seconds each
    got = crawl(seeds(spark, []), fetch, gallery_step, folder, delay=0, burst=100, timeout=120).collect()
    assert {r["url"] for r in got} == wanted() and len(got) == len(wanted())
    urls = [r["url"] for r in spark.read.parquet(asked).collect()]
    assert len(urls) == len(set(urls))


def test_a_batch_that_fails_is_run_again(spark, tmp_path):
    stored, folder = site(spark, 2), str(tmp_path / "crawl")
    fetch, failures = pages.from_table(stored), []

    def broken_once(found):
        if not failures and found.count():
            failures.append(1)
            raise RuntimeError("lost")
        return gallery_step(found)

    with pytest.raises(Exception, match="lost"):
        crawl(seeds(spark, [0, 1]), fetch, broken_once, folder, delay=0, burst=100, timeout=120)
    asked = []
    again = crawl(seeds(spark, [0, 1]), lambda urls: asked.append({r["url"] for r in urls.collect()}) or fetch(urls), broken_once, folder, delay=0, burst=100, timeout=120)
    got = [r["url"] for r in again.where(F.col("url").isNotNull()).collect()]
    assert set(got) == wanted(2) and len(got) == len(set(got))
    assert not any("search" in url for batch in asked for url in batch)  # these pages were there already


def test_without_delay_batches_follow_the_depth(spark, tmp_path):
    stored, folder, asked = site(spark, 40), str(tmp_path / "crawl"), []
    fetch = pages.from_table(stored)

    def ask(urls):
        asked.append(urls.count())
        return fetch(urls)

    got = {r["url"] for r in crawl(seeds(spark, range(40)), ask, gallery_step, folder, delay=0, burst=5, timeout=200).collect()}
    assert got == wanted(40) and sum(asked) == len(got)
    assert sum(n > 0 for n in asked) <= 4  # listings, details, and the files of two hosts
