"""Ranked lexical search over a clustered index.

Documents are reordered by recursive graph bisection (``bisection.py``); the
leaves of its tree, cut into blocks of bounded size, are the index's shards.  A
shard has a posting list for each of its terms (the documents' places in the
shard, and what an occurrence adds to a score before the term's weight), the
largest of these impacts, and the documents' ids.

A query's bound on a shard is the sum of its terms' weights times their largest
impacts there: no document of the shard scores more.  Queries visit shards by
falling bound in rounds, each round's shards in parallel, and stop when no shard
that is left has a bound of the tenth score so far; a bound that equals it is
visited too, since equal scores rank by ``doc_id``.  So the ranking is exact,
whatever the order of documents; a good order only spares visits.

Scores are whole numbers.  A shard's queries are scored together, a term at a
time, in numpy; a task holds one shard.  The tree (16 MB at most) and the table
of leaves (at most 1,024) are broadcast, the queries' terms only behind a check
of their bytes.  Copies of one text are one leaf but many blocks.

Cases: null and empty texts, and texts without a term, are in no shard and
don't count; an item without terms gets no rows; a null id ranks after others of
its score; rows that repeat are documents of their own; an item that repeats is
ranked as often; other columns are ignored; without documents or items the
result is empty; a text of any length is read as a whole, in pieces cut where
terms end.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bisection import FEATURES, MAX_LEVELS, SAMPLE_PER_LEAF, Tree, features, fit
from .common import LOWER, UPPER, broadcast_if_small, cut, shared_folder, text_or_empty

TOP = 10
#: Documents and postings of a shard.
SHARD_DOCS, SHARD_POSTINGS = 1024, 500_000
#: Shards that a query visits in the first rounds; the last visits all that are left and may hold a better document.
ROUNDS = (8, 64)
#: Stands for a null id: after all others.
NO_ID = (1 << 63) - 1
#: Terms in UTF-8, and what ends them.
_find_terms = re.compile(rb"[0-9a-z\x80-\xff]+").findall
_find_end = re.compile(rb"[^0-9a-z\x80-\xff]").search
_TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Bytes of a text whose terms are listed at a time, and of texts in one batch.
_PIECE, _BLOCK = 1 << 20, 1 << 20
#: Scores held at a time: queries of a shard times its documents.
_CELLS = 4_000_000

#: Numbers are packed (32 bits each, ids 64), terms joined by a blank: a row is few values, whatever its document.
_FORWARD = "leaf int, doc_id long, salt long, n long, n_terms int, terms binary, tfs binary"
_INDEX = "shard int, term binary, places binary, impacts binary, most long, ids binary"
_FOUND = "item long, doc_id long, score long"


def term_counts(text: bytes) -> Counter:
    """How often each term occurs in a text of UTF-8."""
    text, counts, at = text.translate(_TO_LOWER), Counter(), 0
    while at < len(text):
        end = at + _PIECE
        if end < len(text):
            found = _find_end(text, end)
            end = found.start() if found else len(text)
        counts.update(_find_terms(text, at, end))
        at = end
    return counts


def _packed(numbers: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The numbers, so many a row, as rows of bytes."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * numbers.itemsize
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(numbers))])


def _forward(tree: Tree):
    def blocks(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
        ids, counted, held = [], [], 0
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            text = text.as_py()
            if counts := term_counts(text):
                ids.append(doc_id.as_py())
                counted.append(counts)
            held += len(text)
            if held > _BLOCK:
                yield ids, counted
                ids, counted, held = [], [], 0
        yield ids, counted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId() * 7919
        for batch in batches:
            for ids, counted in blocks(batch):
                if not ids:
                    continue
                counts = np.array([len(c) for c in counted])
                tfs = np.fromiter((n for c in counted for n in c.values()), np.int32)
                leaf = tree.leaf(features(t for c in counted for t in c), counts).astype(np.int32)
                salts = np.arange(salt, salt + len(ids))
                salt += len(ids)
                columns = [pa.array(leaf), pa.array(ids, pa.int64()), pa.array(salts), pa.array([c.total() for c in counted]), pa.array(counts.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([b" ".join(c) for c in counted]), _packed(tfs, counts)], ["leaf", "doc_id", "salt", "n", "n_terms", "terms", "tfs"])

    return run


def _fit(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = [np.unique(features(term_counts(t.as_py()))) for b in batches for t in b.column("text")]
        tree = fit(docs, levels)
        yield pa.RecordBatch.from_arrays([pa.array([tree.scores.tobytes()]), pa.array([tree.thresholds.tobytes()])], ["scores", "thresholds"])

    return run


def fit_tree(texts: DataFrame, n_docs: int, shard_docs: int, seed: int = 13) -> Tree:
    """The tree of splits for ``n_docs`` texts, from a sample of some SAMPLE_PER_LEAF texts a leaf."""
    levels = min(MAX_LEVELS, max(0, math.ceil(math.log2(max(1, n_docs) / shard_docs))))
    wanted = SAMPLE_PER_LEAF * 2**levels
    if not levels:
        return fit([], 0)
    sample = texts.select("text").sample(min(1.0, wanted / n_docs), seed).limit(2 * wanted)
    got = sample.coalesce(1).mapInArrow(_fit(levels), "scores binary, thresholds binary").first()
    return Tree(levels, np.frombuffer(got["scores"], np.float32).reshape(-1, FEATURES), np.frombuffer(got["thresholds"], np.float64))


def _norms(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of every document; in whole numbers of any size where 64 bits don't hold the product."""
    if len(n) and 75 * int(n.max()) * n_docs >= 1 << 63:
        return np.array([25 + 75 * int(x) * n_docs // n_terms for x in n], np.int64)
    return 25 + 75 * n * n_docs // n_terms


def _invert(n_docs: int, n_terms: int):
    def run(key, shard):
        ids, counts = pc.fill_null(shard.column("doc_id"), NO_ID).to_numpy(), shard.column("n_terms").to_numpy()
        place = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
        tf = np.frombuffer(b"".join(shard.column("tfs").to_pylist()), np.int32).astype(np.int64)
        m = np.repeat(_norms(shard.column("n").to_numpy(), n_docs, n_terms), counts)
        impact = ((1_000_000_000 * tf) // (1000 * tf + 8 * m)).astype(np.int32)
        coded = pa.array(b" ".join(shard.column("terms").to_pylist()).split(b" "), pa.binary()).dictionary_encode()
        code = coded.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        df = np.bincount(code, minlength=len(coded.dictionary))
        impact = impact[order]
        most = np.maximum.reduceat(impact, np.concatenate([[0], np.cumsum(df)[:-1]])).astype(np.int64)
        n = len(df)
        words = pa.table(
            {
                "shard": pa.array(np.full(n, key[0].as_py(), np.int32)), "term": coded.dictionary, "places": _packed(place[order], df),
                "impacts": _packed(impact, df), "most": pa.array(most), "ids": pa.nulls(n, pa.binary()),
            }
        )
        # one row without a term has the ids of the shard's places
        own = {"shard": pa.array([key[0].as_py()], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary())}
        head = pa.table({f.name: own.get(f.name, pa.nulls(1, f.type)) for f in words.schema})
        return pa.concat_tables([head, words])

    return run


@dataclass(frozen=True)
class Index:
    """Rows (shard, term, places, impacts, most, ids) and how many documents and terms they are made of."""

    rows: DataFrame
    n_docs: int
    n_terms: int


def build_index(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = SHARD_DOCS) -> Index:
    """Indexes all documents; the reordered documents and the index are written under ``folder``."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("text"))
    tree = fit_tree(texts, docs.count(), shard_docs)
    texts.mapInArrow(_forward(tree), _FORWARD).write.parquet(f"{folder}/forward")
    forward = spark.read.parquet(f"{folder}/forward")
    leaves = forward.groupBy("leaf").agg(F.count("*").alias("docs"), F.sum("n_terms").alias("postings"), F.sum("n").alias("terms")).orderBy("leaf").collect()
    n_docs, n_terms = sum(r["docs"] for r in leaves), sum(r["terms"] for r in leaves)
    cuts, shards = [], 0
    for r in leaves:
        blocks = max(math.ceil(r["docs"] / (1.5 * shard_docs)), math.ceil(r["postings"] / SHARD_POSTINGS))
        cuts.append((r["leaf"], shards, blocks))
        shards += blocks
    cuts = spark.createDataFrame(cuts, "leaf int, first int, blocks int")
    dealt = forward.join(F.broadcast(cuts), "leaf").select((F.col("first") + F.pmod("salt", "blocks")).cast("int").alias("shard"), "doc_id", "n", "n_terms", "terms", "tfs")
    dealt.groupBy("shard").applyInArrow(_invert(n_docs, max(1, n_terms)), _INDEX).write.parquet(f"{folder}/index")
    return Index(spark.read.parquet(f"{folder}/index"), n_docs, n_terms)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(item, item_id, term, n) for item, item_id, text in zip(*(c.to_pylist() for c in batch.columns)) for term, n in term_counts(text).items()]
        kinds = {"item": pa.int64(), "item_id": pa.int64(), "term": pa.binary(), "times": pa.int64()}
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds.values())], list(kinds))


def _score(key, shard, asked):
    """The best documents of a shard for each of the items that visit it, none below the item's ``least``."""
    none = pa.table({"item": pa.array([], pa.int64()), "doc_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
    if not len(shard) or not len(asked):
        return none
    rows = {t: k for k, t in enumerate(shard.column("term").to_pylist())}
    ids = np.frombuffer(shard.column("ids")[rows[None]].as_py(), np.int64)
    places, impacts = shard.column("places"), shard.column("impacts")
    items, item = np.unique(asked.column("item").to_numpy(), return_inverse=True)
    least = np.ones(len(items), np.int64)
    least[item] = asked.column("least").to_numpy()
    row = np.array([rows.get(t, -1) for t in asked.column("term").to_pylist()])
    weight, order = asked.column("weight").to_numpy(), np.argsort(row, kind="stable")
    order = order[row[order] >= 0]
    found, step = [], max(1, _CELLS // len(ids))
    for low in range(0, len(items), step):
        scores = np.zeros((min(step, len(items) - low), len(ids)), np.int64)
        own = order[(item[order] >= low) & (item[order] < low + step)]
        for group in np.split(own, np.flatnonzero(np.diff(row[own])) + 1) if len(own) else []:
            r = row[group[0]]
            place, impact = np.frombuffer(places[r].as_py(), np.int32), np.frombuffer(impacts[r].as_py(), np.int32).astype(np.int64)
            scores[np.ix_(item[group] - low, place)] += weight[group][:, None] * impact
        for k, line in enumerate(scores):
            good = np.flatnonzero(line >= least[low + k])
            good = good[np.lexsort((ids[good], -line[good]))[:TOP]]
            found.append((np.full(len(good), items[low + k]), ids[good], line[good]))
    return pa.table({name: pa.array(np.concatenate(c).astype(np.int64)) for name, c in zip(none.schema.names, zip(*found))})


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def search(index: Index, items: DataFrame, id_col: str = "item_id", text_col: str = "text", rounds: tuple[int, ...] = ROUNDS, visits: list[int] | None = None) -> DataFrame:
    """The TOP best documents of every item: item_id, rank, doc_id, score.  ``visits`` gets the number of shards visited by all items in each round."""
    spark = items.sparkSession
    texts = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).cast("long").alias("item_id"), text_or_empty(text_col).cast("binary").alias("text"))
    terms = cut(texts.mapInArrow(_item_terms, "item long, item_id long, term binary, times long"))
    vocabulary = cut(terms.select(F.col("term").alias("asked")).distinct())
    small = broadcast_if_small(vocabulary, "asked", 50)
    hits = index.rows.join(small, F.col("term") == F.col("asked"), "left_semi")

    df = hits.groupBy("term").agg(F.sum((F.octet_length("places") / 4).cast("long")).alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * index.n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = cut(df.select(F.col("term").alias("of_term"), weight.alias("w")).where("w > 0"))
    weighed = terms.join(broadcast_if_small(weights, "of_term", 50), F.col("term") == F.col("of_term"))
    weighed = cut(weighed.select("item", F.col("term").alias("asked"), (F.col("times") * F.col("w")).alias("weight")))
    asked = broadcast_if_small(weighed, "asked", 50)
    bounds = hits.select("shard", "term", "most").join(asked, F.col("term") == F.col("asked"))
    bounds = cut(bounds.groupBy("item", "shard").agg(F.sum(F.col("weight") * F.col("most")).alias("bound")).where("bound > 0"))

    by_bound = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "shard"))
    first = cut(bounds.withColumn("nth", by_bound).where(F.col("nth") <= sum(rounds)))
    last = first.where(F.col("nth") == sum(rounds)).select(F.col("item").alias("last_item"), F.col("bound").alias("last_bound"), F.col("shard").alias("last_shard"))
    rest = bounds.join(last, F.col("item") == F.col("last_item")).where("bound < last_bound OR (bound = last_bound AND shard > last_shard)")
    starts = [0, *np.cumsum(rounds).tolist()]
    steps = [first.where(f"nth > {low} AND nth <= {high}") for low, high in zip(starts, starts[1:])] + [rest]

    best = spark.createDataFrame([], f"{_FOUND}, rank int")
    for step in steps:
        tenth = best.where(F.col("rank") == TOP).select(F.col("item").alias("best_item"), F.col("score").alias("tenth"))
        pairs = step.join(tenth, F.col("item") == F.col("best_item"), "left").withColumn("least", F.coalesce("tenth", F.lit(1)))
        pairs = cut(pairs.where("bound >= least").select("shard", F.col("item").alias("of_item"), "least"))
        n = pairs.count()
        if visits is not None:
            visits.append(n)
        if not n:
            continue
        questions = pairs.join(asked, F.col("of_item") == F.col("item")).select("shard", "item", F.col("asked").alias("term"), "weight", "least")
        visited = cut(pairs.select(F.col("shard").alias("visited")).distinct())
        lists = index.rows.join(small, F.col("term") == F.col("asked"), "left_semi").unionByName(index.rows.where("term IS NULL"))
        lists = lists.join(F.broadcast(visited), F.col("shard") == F.col("visited"), "left_semi")
        found = lists.groupBy("shard").cogroup(questions.groupBy("shard")).applyInArrow(_score, _FOUND)
        best = cut(_best(best.drop("rank").unionByName(found), TOP))

    names = terms.select(F.col("item").alias("of_item"), "item_id").distinct()
    ranked = best.join(names, F.col("item") == F.col("of_item"))
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ranked_search(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Indexes ``docs`` in the shared folder, ranks them for all ``items``, and takes the index away again."""
    folder = f"{shared_folder(docs.sparkSession)}/search-{uuid.uuid4().hex}"
    try:
        return cut(search(build_index(docs, folder, **options), items))
    finally:
        _delete(docs.sparkSession, folder)


OP13_SQL = r"""
WITH words AS (
  SELECT row_id, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS row_id FROM documents)),
counts AS (SELECT row_id, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM words GROUP BY row_id, term),
lengths AS (SELECT row_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY row_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
norms AS (SELECT row_id, 25 + (75 * n * docs) // terms AS m FROM lengths, totals),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, totals GROUP BY term),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, row_id, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN norms USING (row_id) GROUP BY item_id, row_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
