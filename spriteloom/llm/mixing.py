"""Mixing sources to target weights by capped water-filling.

Sources share all words by weight.  A source whose share is over ``max_epochs``
times its size is clamped there, and the excess goes to the others by weight,
until no share is above.  A source then repeats its documents: every document
as often as whole epochs fit into its target, and for the rest of the target
the source's documents in an order seeded by their ids and texts, the last of
them in part.  So a source's mix has its target's words, rounded down.

Where that seeded order is cut is found without sorting a source: words are
summed up by the first digits of the order's key, source by source; only the
bucket in which the rest of the target ends is looked at with more digits, and
rows that are alike to the last digit are told apart by where they were read.

Everything is DataFrame functions.  The driver holds a few sums a round; the
sources' weights and targets are broadcast behind a check of their bytes and
joined otherwise.

Cases: a null text has no words and is never taken; null is a source of its
own, the last; a null id mixes like any other; rows that repeat id and text
each count, and which of them is taken is open; other columns are ignored; an
empty table gives an empty mix; a text of any length is counted as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
#: By rank of the source, again and again.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Hexadecimal digits of the order's key that a round looks at, of 32 in all.
DIGITS = (3, 6, 9)
#: Bytes of source names that are broadcast; with more, rows are joined with their sources by a shuffle.
BROADCAST_BYTES = 8 << 20
#: Beside its name, a source takes so many bytes of a broadcast at most.
_ROW_BYTES = 200
_BIG = "decimal(38,0)"


def word_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, with_text: bool = False) -> DataFrame:
    """(doc_id, source, size, mix, row_no): the words of every document and its place in the seeded order; its text too, if wanted."""
    text = text_or_empty(text_col)
    mark = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.md5(text.cast("binary")))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(mark.cast("binary")).alias("mix"),
        F.monotonically_increasing_id().alias("row_no"),
        *([text.alias("text")] if with_text else []),
    )


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) by water-filling; shares are compared as whole numbers, so nothing is rounded before the last step."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    sources = cut(sizes.select("source", "source_size", weight.cast("long").alias("weight"), (F.lit(max_epochs).cast(_BIG) * F.col("source_size")).alias("most")))
    words, weight_left = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).cast(_BIG), F.coalesce(F.sum("weight"), F.lit(1)).cast(_BIG)).first()
    left, n_clamped = words, 0
    while True:
        # the level only rises, so a source that was over its limit stays clamped
        clamped = F.col("weight") * F.lit(left).cast(_BIG) > F.col("most") * F.lit(weight_left).cast(_BIG)
        gone, n = sources.where(clamped).agg(F.coalesce(F.sum("most"), F.lit(0)).cast(_BIG), F.count("*")).first()
        if n == n_clamped:
            break
        left, n_clamped = words - gone, n
        weight_left = sources.where(~clamped).agg(F.sum("weight").cast(_BIG)).first()[0]
    share = F.col("weight") * F.lit(float(left)) / F.lit(float(weight_left))
    return sources.select("source", "source_size", F.when(clamped, F.col("most").cast("double")).otherwise(share).alias("target"))


def _with_sources(rows: DataFrame, sources: DataFrame, broadcast: bool) -> DataFrame:
    named = sources.withColumnRenamed("source", "of_source")
    return rows.join(F.broadcast(named) if broadcast else named, rows["source"].eqNullSafe(named["of_source"])).drop("of_source")


def _ends(inside: DataFrame, *order: str) -> DataFrame:
    """Of each source the bucket (by the columns ``order``) in which the rest of its target ends, and what of the rest is left there."""
    buckets = inside.groupBy("source", *order).agg(F.sum("size").alias("words"), F.max("rest").alias("rest"))
    earlier = F.sum("words").over(Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    placed = buckets.withColumn("earlier", F.coalesce(earlier, F.lit(0))).where("earlier <= rest AND rest < earlier + words")
    return placed.select(F.col("source").alias("end_source"), *[F.col(c).alias(f"end_{c}") for c in order], (F.col("rest") - F.col("earlier")).alias("end_rest"))


def mix_plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED, with_text: bool = False, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, whole (times it is taken as a whole), part (words of one more, partial time), text if wanted."""
    rows = cut(word_rows(docs, id_col, text_col, source_col, seed, with_text))
    sources = source_targets(rows, weights, max_epochs).withColumn("epochs", F.coalesce(F.expr("floor(target) div nullif(source_size, 0)"), F.lit(0)))
    sources = cut(sources.withColumn("rest", F.floor("target") - F.col("epochs") * F.col("source_size")))
    n, name_bytes = sources.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("source")), F.lit(0))).first()
    broadcast = name_bytes + n * _ROW_BYTES <= broadcast_bytes

    # digits after digits: the bucket in which each source's rest ends
    inside = _with_sources(rows.where("size > 0").select("source", "size", "mix", "row_no"), sources.where("rest > 0").select("source", "rest"), broadcast)
    for digits in DIGITS:
        inside = inside.withColumn("head", F.substring("mix", 1, digits))
        ends = cut(_ends(inside, "head"))
        on = F.col("source").eqNullSafe(F.col("end_source")) & (F.col("head") == F.col("end_head"))
        inside = inside.join(F.broadcast(ends) if broadcast else ends, on).select("source", "size", "mix", "row_no", F.col("end_rest").alias("rest"))

    # rows that share these digits: by the whole key, then by the partition (a row number's upper part) and the place where they were read
    inside = cut(inside.withColumn("read_in", F.shiftrightunsigned("row_no", 33)))
    on = F.col("source").eqNullSafe(F.col("end_source")) & (F.col("mix") == F.col("end_mix")) & (F.col("read_in") == F.col("end_read_in"))
    among = inside.join(_ends(inside, "mix", "read_in"), on)
    nth = F.row_number().over(Window.partitionBy("source", "mix", "read_in").orderBy("row_no")) - 1
    among = among.withColumn("first_word", nth * F.col("size")).where("first_word <= end_rest AND end_rest < first_word + size")
    cuts = among.select("end_source", F.col("mix").alias("cut_mix"), F.col("row_no").alias("cut_row"), (F.col("end_rest") - F.col("first_word")).alias("cut_words"))

    known = sources.join(cuts, F.col("source").eqNullSafe(F.col("end_source")), "left").select("source", "source_size", "target", "epochs", "cut_mix", "cut_row", "cut_words")
    joined = _with_sources(rows, cut(known), broadcast)
    earlier = F.coalesce((F.col("mix") < F.col("cut_mix")) | ((F.col("mix") == F.col("cut_mix")) & (F.col("row_no") < F.col("cut_row"))), F.lit(False))
    part = F.when(F.col("row_no") == F.col("cut_row"), F.col("cut_words")).otherwise(0)
    whole = F.col("epochs") + earlier.cast("long")
    return joined.select("doc_id", "source", "size", "source_size", "target", whole.alias("whole"), part.cast("long").alias("part"), *(["text"] if with_text else []))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: (doc_id, source, repetition from 0, text) for every time that a document is taken; a partial repetition has its first words, with blanks between."""
    plan = mix_plan(docs, with_text=True, **options).where("size > 0 AND (whole > 0 OR part > 0)")
    times = F.sequence(F.lit(0), (F.col("whole") + (F.col("part") > 0).cast("long") - 1).cast("int"))
    taken = plan.select("doc_id", "source", F.explode(times).alias("repetition"), "text", "whole", "part")
    head = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)), 1, F.col("part").cast("int")), " ")
    return taken.select("doc_id", "source", "repetition", F.when(F.col("repetition") < F.col("whole"), F.col("text")).otherwise(head).alias("text"))


def mixing(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken (words that the mix takes, repeats counted) of every document."""
    plan = mix_plan(docs)
    return plan.select("doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("part")).alias("taken"))


OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, ''))) AS mix
  FROM documents),
sources AS (
  SELECT source, source_size, 3 * source_size AS most,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM (SELECT source, CAST(sum(size) AS HUGEINT) AS source_size FROM words GROUP BY source)),
filled AS (  -- by rising limit for a unit of weight: a source is over its limit if it would be with all before it clamped
  SELECT *, weight * (all_words - coalesce(sum(most) OVER earlier, 0)) > most * (all_weight - coalesce(sum(weight) OVER earlier, 0)) AS clamped
  FROM (SELECT *, sum(source_size) OVER () AS all_words, sum(weight) OVER () AS all_weight FROM sources)
  WINDOW earlier AS (ORDER BY CAST(most AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT CAST(any_value(all_words) - coalesce(sum(most) FILTER (WHERE clamped), 0) AS DOUBLE) AS words_left,
         CAST(any_value(all_weight) - coalesce(sum(weight) FILTER (WHERE clamped), 0) AS DOUBLE) AS weight_left
  FROM filled),
targets AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
         CASE WHEN clamped THEN CAST(most AS DOUBLE) ELSE weight * words_left / weight_left END AS target
  FROM filled, level)
SELECT doc_id, size, source_size, target,
       CAST(coalesce(CAST(floor(target) AS BIGINT) // nullif(source_size, 0), 0) * size
            + greatest(0, least(size, CAST(floor(target) AS BIGINT) % nullif(source_size, 0) - earlier)) AS BIGINT) AS taken
FROM (SELECT w.*, source_size, target,
             coalesce(sum(size) OVER (PARTITION BY w.source ORDER BY mix ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
      FROM words w JOIN targets t ON w.source IS NOT DISTINCT FROM t.source)
"""
