"""Link discovery and downloads as DataFrame steps; how pages are fetched is a parameter.

A fetch takes rows (url) and gives rows (url, status, content).  ``from_table``
joins them with pages that are stored already, ``over_http`` asks the hosts.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from spriteloom.sources.codec import expand_zips

Fetch = Callable[[DataFrame], DataFrame]
#: Elements that have no end tag.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_PAGE = "url string, status int, content binary"


class _Links(HTMLParser):
    """The ``href`` of every ``a``, in document order; only inside ``tag`` of class ``css_class``, if given."""

    def __init__(self, tag: str | None = None, css_class: str | None = None):
        super().__init__(convert_charrefs=True)
        self.tag, self.css_class, self.open, self.found = tag, css_class, [], []

    def _inside(self) -> bool:
        return self.tag is None or any(t == self.tag and (self.css_class is None or self.css_class in c) for t, c in self.open)

    def handle_starttag(self, tag, attrs):
        values = dict(reversed(attrs))  # the first of repeated attributes counts
        if tag == "a" and values.get("href") is not None and self._inside():
            self.found.append(values["href"])
        if tag not in _VOID:
            self.open.append((tag, (values.get("class") or "").split()))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                break


def hrefs_of(html: str | None, tag: str | None = None, css_class: str | None = None) -> list[str]:
    parser = _Links(tag, css_class)
    parser.feed(html or "")
    parser.close()
    return parser.found


def links(pages: DataFrame, html: str = "html", tag: str | None = None, css_class: str | None = None) -> DataFrame:
    """Adds pos and href: one row for each link of a page, in document order; pages without links give none."""

    @F.pandas_udf("array<string>")
    def found(batch: pd.Series) -> pd.Series:
        return batch.map(lambda text: hrefs_of(text, tag, css_class))

    others = [c for c in pages.columns if c != html]
    return pages.select(*others, F.posexplode(found(html)).alias("pos", "href"))


@F.pandas_udf(StringType())
def _joined(base: pd.Series, href: pd.Series) -> pd.Series:
    def one(b, h):
        try:
            return None if h is None else urljoin(b or "", h)
        except ValueError:
            return None

    return pd.Series([one(b, h) for b, h in zip(base, href)], dtype=object)


def absolute(base: Column | str, href: Column | str) -> Column:
    """The link's target, seen from ``base``; null for a null link or one that is no url."""
    return _joined(base, href)


def file_name(url: Column) -> Column:
    """The last path segment, with its query."""
    return F.element_at(F.split(url, "/"), -1)


def numbered_pages(spark: SparkSession, template: str, start: int, end: int) -> DataFrame:
    """(url) for page numbers from ``start`` up to ``end``, which stand for ``{page}`` in the template."""
    return spark.range(start, end).select(F.replace(F.lit(template), F.lit("{page}"), F.col("id").cast("string")).alias("url"))


def frontier(sites: DataFrame) -> DataFrame:
    """(url) of the numbered pages of every site (template, first, last), ``last`` not included."""
    numbers = F.explode(F.sequence(F.col("first"), F.col("last") - 1)).alias("page")
    return sites.where("first < last").select("template", numbers).select(F.replace(F.col("template"), F.lit("{page}"), F.col("page").cast("string")).alias("url"))


def from_table(pages: DataFrame) -> Fetch:
    """A fetch from stored pages (url, status, content); urls that aren't stored get status 404."""
    stored = pages.select(F.col("url").alias("stored_url"), F.col("status").cast("int").alias("status"), F.col("content").cast("binary").alias("content"))
    return lambda urls: urls.join(stored, F.col("url") == F.col("stored_url"), "left").select("url", F.coalesce("status", F.lit(404)).alias("status"), "content")


def over_http(headers: dict[str, str] | None = None, delay: float = 0.5, timeout: float = 30, tasks: int = 8) -> Fetch:
    """A fetch over HTTP.  A host's urls are in one task, which waits ``delay`` seconds between them; errors give status 0."""

    def ask(frames):
        for frame in frames:
            for url in frame["url"]:
                try:
                    with urllib.request.urlopen(urllib.request.Request(url, headers=headers or {}), timeout=timeout) as got:
                        row = (url, got.status, got.read())
                except urllib.error.HTTPError as error:
                    row = (url, error.code, None)
                except (OSError, ValueError):
                    row = (url, 0, None)
                yield pd.DataFrame([row], columns=["url", "status", "content"])
                time.sleep(delay)

    host = F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return lambda urls: urls.select("url").repartition(tasks, host).mapInPandas(ask, _PAGE)


def follow(urls: DataFrame, fetch: Fetch, matches: Column | None = None, tag: str | None = None, css_class: str | None = None) -> DataFrame:
    """(url, pos, href, target) of the wanted links on the pages at the distinct ``urls``; only status 200 counts."""
    pages = fetch(urls.select("url").where("url IS NOT NULL").distinct()).where("status = 200")
    found = links(pages.select("url", F.decode("content", "UTF-8").alias("html")), tag=tag, css_class=css_class).where("href <> ''")
    return (found if matches is None else found.where(matches)).withColumn("target", absolute("url", "href"))


def details_files(details: DataFrame, fetch: Fetch) -> DataFrame:
    """(url, name): image files and archives on detail pages."""
    files = follow(details, fetch, tag="span", css_class="file").select(F.col("target").alias("url"), file_name(F.col("target")).alias("name"))
    return files.where(F.lower("name").rlike(r"\.(png|gif|zip)$"))


def gallery_files(frontier: DataFrame, fetch: Fetch) -> DataFrame:
    """(url, name): files on the detail pages that listing pages lead to."""
    return details_files(follow(frontier, fetch, F.col("href").startswith("/content/")).select(F.col("target").alias("url")), fetch)


def is_game(console: str) -> Column:
    """Whether ``href`` is a game of the console: /console/name/ with a name of two letters at least."""
    parts = F.split("href", "/", -1)
    return F.col("href").startswith(f"/{console}/") & (F.size(parts) == 4) & F.col("href").endswith("/") & (F.length(parts[2]) > 1)


def first_media(assets: DataFrame, fetch: Fetch) -> DataFrame:
    """(url, href, target): the first file of each asset page."""
    first = follow(assets, fetch, F.col("href").contains("/media/assets/")).groupBy("url").agg(F.min_by(F.struct("href", "target"), "pos").alias("first"))
    return first.select("url", "first.*")


def console_files(index: DataFrame, fetch: Fetch, console: str, start: int, end: int) -> DataFrame:
    """(url, name): from a console's index the games from ``start`` up to ``end``, their assets, and each one's first file."""
    games = follow(index, fetch, is_game(console))
    first_seen = games.groupBy("target").agg(F.min("pos").alias("pos")).orderBy("pos", "target")
    chosen = first_seen.offset(start).limit(max(0, end - start)).select(F.col("target").alias("url"))
    assets = follow(chosen, fetch, F.col("href").contains("/asset/")).select(F.col("target").alias("url"))
    return first_media(assets, fetch).select(F.col("target").alias("url"), F.concat(F.lit("tsr_"), F.substring_index(file_name(F.col("target")), "?", 1)).alias("name"))


def without_icons(files: DataFrame, skip: str = "avatar|icon") -> DataFrame:
    """The files whose names do not match ``skip``, in any case of letters."""
    return files.where(~F.lower("name").rlike(skip))


def download(files: DataFrame, fetch: Fetch, have: DataFrame | None = None, skip: str = "avatar|icon") -> DataFrame:
    """(name, content, source_url) of files (url, name) that aren't in ``have`` (name) yet; zip archives are expanded.

    Names that match ``skip`` are left out, but not inside archives.  Of files
    with equal names the one with the smallest url is taken.
    """
    wanted = without_icons(files, skip).groupBy("name").agg(F.min("url").alias("url"))
    if have is not None:
        wanted = wanted.join(have.select("name").distinct(), "name", "left_anti")
    got = fetch(wanted.select("url").distinct()).where("status = 200").join(wanted, "url").select("name", "content", F.col("url").alias("source_url"))
    zipped = F.lower("name").endswith(".zip")
    inside = expand_zips(got.where(zipped))
    origin = got.where(zipped).select(F.col("name").alias("archive"), "source_url")
    return got.where(~zipped).unionByName(inside.join(origin, "archive").select("name", "content", "source_url"))


def image_column(table: DataFrame, columns: tuple[str, ...] = ("image", "img")) -> Column:
    """The first image of a row in ``columns`` that the table has (bytes, or a struct with ``bytes``), else the table's first binary column."""
    here = [c for c in columns if c in table.columns] or [f.name for f in table.schema if f.dataType.typeName() == "binary"][:1]
    if not here:
        raise ValueError("the table has no image column")
    return F.coalesce(*(F.col(f"{c}.bytes") if table.schema[c].dataType.typeName() == "struct" else F.col(c) for c in here))


def hosted_images(table: DataFrame, dataset: str, index: str, columns: tuple[str, ...] = ("image", "img"), limit: int = 1000) -> DataFrame:
    """(name, content, source_url): the first ``limit`` rows by ``index`` whose image isn't null, named by their index."""
    first = table.select(F.col(index).cast("long").alias("i"), image_column(table, columns).alias("content")).where("content IS NOT NULL").orderBy("i").limit(limit)
    flat = dataset.replace("/", "_").replace("%", "%%")
    return first.select(F.format_string(f"hf_{flat}_%06d.png", "i").alias("name"), "content", F.lit(dataset).alias("source_url"))
