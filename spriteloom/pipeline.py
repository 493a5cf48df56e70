"""From raw image files to annotated tar shards; also a command: ``python -m spriteloom.pipeline --help``."""

from __future__ import annotations

import argparse
import importlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spriteloom.operators import crawl
from spriteloom.operators.annotate import ANSWERS, Annotator, annotate, metadata_json
from spriteloom.operators.clean import MAX_COLORS, VERDICTS, clean_images
from spriteloom.operators.ordering import numbered
from spriteloom.operators.shards import assign_shards
from spriteloom.sources.jpeg import jpegs_as_png
from spriteloom.sources.webdataset import WebDataset
from spriteloom.streaming import crawl as stateful

IMAGE_FILES = r"\.(png|gif|jpg|jpeg|webp)$"


@dataclass(frozen=True)
class Options:
    """What a run may change; the defaults are those of production."""

    max_colors: int = MAX_COLORS
    shard_bytes: int = 1000 * 1024 * 1024
    annotator: Callable[[], Annotator] | None = None


def described(accepted: DataFrame, answers: DataFrame) -> DataFrame:
    """(name, bucket, json): metadata with the annotator's answers, where it gave any."""
    got = accepted.select("name", "metadata").join(answers, "name", "left")
    m = F.col("metadata")
    for field in ("description", "is_animation", "frames"):
        m = m.withField(field, F.coalesce(F.col(field), F.col(f"metadata.{field}")))
    return got.select("name", F.col("metadata.dataset_bucket").alias("bucket"), metadata_json(m).alias("json"))


def curate(images: DataFrame, out: str, options: Options = Options()) -> DataFrame:
    """Cleans, annotates and packs rows (name, content, license_type, source_url) with unique names into tar files
    under ``out``; returns (verdict, n).

    Each step is written under ``out/_work`` and read again, so no page is
    fetched and no model asked twice; answers stay in ``out/_answers`` for later
    runs.  Verdicts are counted by the pass that writes them.  Without an
    annotator, descriptions stay empty; without accepted images none is made and
    nothing is packed.
    """
    spark, work = images.sparkSession, f"{out}/_work/{uuid.uuid4().hex}"

    def kept(df: DataFrame, step: str) -> DataFrame:
        df.write.parquet(f"{work}/{step}")
        return spark.read.parquet(f"{work}/{step}")

    files = kept(images.where(F.col("name").rlike(IMAGE_FILES)), "files")
    seen = Observation()
    cleaned = clean_images(jpegs_as_png(files, work), options.max_colors)
    cleaned = kept(cleaned.observe(seen, *[F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS]), "cleaned")
    accepted = cleaned.where("verdict = 'accepted'")
    if seen.get["accepted"]:
        answers = annotate(accepted, options.annotator, f"{out}/_answers") if options.annotator else spark.createDataFrame([], ANSWERS)
        texts = kept(described(accepted, answers), "described")
        sized = accepted.select("name", F.length("png").alias("bytes")).join(texts, "name")
        sized = sized.select("name", "bucket", (F.col("bytes") + F.octet_length("json")).cast("long").alias("size"), F.xxhash64("name").alias("mix"))
        order = kept(numbered(sized, "mix", "id", ties=("name",)), "order")
        placed = order.join(assign_shards(order, options.shard_bytes).select("id", "shard"), "id").select("name", "shard")
        rows = accepted.select("name", "png").join(texts.join(placed, "name"), "name")
        rows = rows.select("bucket", "shard", F.substring_index("name", ".", 1).alias("name"), F.col("name").alias("file"), "png", "json")
        spark.dataSource.register(WebDataset)
        rows = rows.repartition("bucket", "shard").sortWithinPartitions("bucket", "shard", "file").drop("file")
        rows.write.format("webdataset").mode("append").save(out)
    return spark.createDataFrame([(v, seen.get[v]) for v in VERDICTS if seen.get[v]], "verdict string, n long")


def image_files(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder, by their names; the listing leaves out other kinds than images, so those aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{png,gif,jpg,jpeg,webp}").option("recursiveFileLookup", "true").load(folder)
    return files.select(crawl.file_name(F.col("path")).alias("name"), "content", F.col("path").alias("source_url"))


def gather(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """(name, content, source_url) from the source that the command names."""
    if args.source == "folder":
        return image_files(spark, args.input)
    if args.source == "table":
        table = spark.read.parquet(args.input)
        return crawl.hosted_images(table, args.dataset, args.index, limit=args.samples)
    fetch = crawl.from_table(spark.read.parquet(args.input)) if args.input else crawl.over_http(delay=args.delay)
    if args.source == "gallery" and args.state:
        seeds = crawl.numbered_pages(spark, args.url, args.start, args.end).withColumn("kind", F.lit("listing"))
        pages = stateful.crawl(seeds, fetch, stateful.gallery_step, args.state, delay=args.delay, burst=50)
        files = pages.where("kind = 'file'").select("url", crawl.file_name(F.col("url")).alias("name"))
        return crawl.download(files, crawl.from_table(pages))
    if args.source == "gallery":
        files = crawl.gallery_files(crawl.numbered_pages(spark, args.url, args.start, args.end), fetch)
    else:
        index = crawl.numbered_pages(spark, args.url.replace("{console}", args.console), 0, 1)
        files = crawl.console_files(index, fetch, args.console, args.start, args.end)
    return crawl.download(files, fetch)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Curates sprites into tar shards")
    p.add_argument("--source", choices=["gallery", "console", "table", "folder"], default="gallery")
    p.add_argument("--input", help="folder of images, Parquet table of images, or stored pages (url, status, content) to crawl instead of the network")
    p.add_argument("--url", default="", help="address of listing pages, with {page} or {console}")
    p.add_argument("--start", type=int, default=0)
    p.add_argument("--end", type=int, default=5)
    p.add_argument("--dataset", default="dataset", help="name of the table's dataset, for file names")
    p.add_argument("--index", default="idx", help="the table's index column")
    p.add_argument("--samples", type=int, default=1000)
    p.add_argument("--console", default="snes")
    p.add_argument("--delay", type=float, default=0.5, help="seconds between two requests to a host")
    p.add_argument("--state", help="folder that keeps the state of a gallery's crawl: a later run goes on there and fetches nothing twice")
    p.add_argument("--annotator", help="module:function that makes an annotator; without one, descriptions stay empty")
    p.add_argument("--prefix", default="00", help="names this run's output folder")
    p.add_argument("--out", default="datasets_ready")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> DataFrame:
    args, options = parser().parse_args(argv), Options()
    if args.annotator:
        module, _, name = args.annotator.partition(":")
        options = replace(options, annotator=getattr(importlib.import_module(module), name))
    spark = spark or SparkSession.builder.appName("spriteloom").getOrCreate()
    images = gather(spark, args).withColumn("license_type", F.lit(None).cast("string"))
    counts = curate(images, f"{args.out}/{args.prefix}", options)
    counts.show()
    return counts


if __name__ == "__main__":
    main()
