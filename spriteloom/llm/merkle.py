"""A Merkle manifest of a dataset: a tree of hashes for every source, and one over the sources.

Bottom-up, a level's nodes are grouped by sixteen into the nodes of the next,
each with the hashes of its children; every level is written into the shared
folder.  Top-down, proofs are pushed from the root: a node hands each child the
child's siblings, put before the proof suffix that the node got from above.  The
rows of documents are met once on the way down, so only the nodes over them, a
sixteenth as many, carry whole proof suffixes through a shuffle.

Leaves of a source stand in the order of their ids.  Positions come from ranges
of (source, id, leaf, row): a range counts its own rows by source, and the only
thing that is summed up in order is one count for each source of a range.  So a
source that holds a third of all rows, and rows that are all alike, are spread
like others.

Cases: null fields are ``-`` in a leaf, empty ones ``0:``; a null text is not
tampered with; null is a source of its own, the first; a null id comes first in
its source; of rows with one id the smaller leaf comes first; rows that repeat
are leaves of their own with equal hashes; other columns are ignored; an empty
table gives an empty result; a text of any length is hashed as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, lower_ascii

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Where the number divides the CRC-32 of a document's id, its text is tampered with.
TAMPER_EVERY = 5
_HEX = 64


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_hash(fields: dict[str, Column]) -> Column:
    """SHA-256 of the fields in order: ``-`` for null, else byte count, ``:`` and the value."""

    def framed(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return sha256(F.concat(*[framed(fields[f]) for f in FIELDS]))


def tampered_leaf() -> Column:
    """The leaf with the text's A-Z lower-cased, of the documents whose id's CRC-32 is a multiple of TAMPER_EVERY; null for others."""
    fields = {f: F.col(f) for f in FIELDS}
    chosen = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % TAMPER_EVERY == 0
    return F.when(chosen, leaf_hash(fields | {"text": lower_ascii(F.col("text").cast("string"))}))


def _starts(keys: pa.Array) -> np.ndarray:
    """Where a new key begins in sorted keys, nulls among them."""
    if not len(keys):
        return np.zeros(0, np.int64)
    before, after = keys.slice(0, len(keys) - 1), keys.slice(1)
    same = pc.fill_null(pc.equal(before, after), False).to_numpy(zero_copy_only=False)
    same |= (pc.is_null(before).to_numpy(zero_copy_only=False)) & (pc.is_null(after).to_numpy(zero_copy_only=False))
    return np.concatenate([[0], np.flatnonzero(~same) + 1])


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the number of the range and the row's place among the range's rows of its tree."""
    from pyspark import TaskContext

    part, last, held = TaskContext.get().partitionId(), object(), 0
    for batch in batches:
        keys = batch.column("tree")
        if not len(keys):
            continue
        starts = _starts(keys)
        nth = np.arange(len(keys)) - np.repeat(starts, np.diff([*starts, len(keys)]))
        if keys[0].as_py() == last:
            nth[: starts[1] if len(starts) > 1 else None] += held
        last, held = keys[len(keys) - 1].as_py(), int(nth[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(keys), part, np.int32)), pa.array(nth.astype(np.int64))], [*batch.schema.names, "part", "nth"])


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """Adds ``idx``, the row's place from 0 in its tree, and ``n``, the tree's rows; ``order`` must tell all rows of a tree apart."""
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields)
    numbered = cut(ranged.mapInArrow(_number, f"{fields}, part int, nth long"))
    counts = numbered.groupBy("tree", "part").agg(F.count("*").alias("rows"))
    tree = Window.partitionBy("tree")
    earlier = F.sum("rows").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = cut(counts.select(F.col("tree").alias("of_tree"), F.col("part").alias("of_part"), F.coalesce(earlier, F.lit(0)).alias("earlier"), F.sum("rows").over(tree).alias("n")))
    joined = numbered.join(broadcast_if_small(counts, "of_tree"), F.col("tree").eqNullSafe(F.col("of_tree")) & (F.col("part") == F.col("of_part")))
    return joined.withColumn("idx", F.col("earlier") + F.col("nth")).drop("part", "nth", "of_tree", "of_part", "earlier")


def _parents(nodes: DataFrame, *carried: str) -> DataFrame:
    """The nodes over ``nodes`` (tree, idx, n, hash): (tree, idx, n, hash, children), the children in order."""
    child = F.struct("idx", "hash", *carried)
    grouped = nodes.groupBy("tree", F.floor(F.col("idx") / FAN).alias("parent")).agg(F.sort_array(F.collect_list(child)).alias("children"), F.max("n").alias("of"))
    joined = sha256(F.array_join(F.transform("children", lambda c: c["hash"]), ""))
    return grouped.select("tree", F.col("parent").alias("idx"), F.ceil(F.col("of") / FAN).alias("n"), joined.alias("hash"), "children")


def build(leaves: DataFrame, *carried: str) -> tuple[list[DataFrame], DataFrame]:
    """The levels over ``leaves`` (tree, idx, n, hash, columns carried), lowest first, and the top (tree, hash) of every tree.

    A lone leaf is its tree's top and in no level.
    """
    levels, tops, below, kept = [], leaves.where("n = 1").select("tree", "hash"), leaves, carried
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        level = cut(_parents(below.where("n > 1"), *kept))
        levels.append(level)
        tops = tops.unionByName(level.where("n = 1").select("tree", "hash"))
        below, kept, most = level, (), -(-most // FAN)
    return levels, tops


def _handed(nodes: DataFrame) -> DataFrame:
    """The children of ``nodes``, each with its siblings put before the suffix of its parent."""
    spread = nodes.withColumn("run", F.array_join(F.transform("children", lambda c: c["hash"]), "")).select("tree", "top", "suffix", "run", F.posexplode("children").alias("nth", "child"))
    left, right = F.expr(f"substring(run, 1, nth * {_HEX})"), F.expr(f"substring(run, (nth + 1) * {_HEX} + 1)")
    return spread.select("tree", "top", "child", F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), "suffix").alias("suffix"))


def proofs(levels: list[DataFrame], leaves: DataFrame, tops: DataFrame, *carried: str) -> DataFrame:
    """Every leaf (tree, idx, hash, columns carried, top, suffix): ``tops`` (of_tree, top, suffix) has each tree's top and the proof suffix that it starts from."""

    def begun(nodes: DataFrame) -> DataFrame:
        return nodes.where("n = 1").join(tops, F.col("tree").eqNullSafe(F.col("of_tree"))).drop("of_tree")

    found, pushed = begun(leaves).select("tree", "idx", "hash", *carried, "top", "suffix"), None
    for k, level in reversed([*enumerate(levels)]):
        nodes = begun(level)
        if pushed is not None:
            inner = level.where("n > 1").join(pushed, F.col("tree").eqNullSafe(F.col("in_tree")) & (F.col("idx") == F.col("in_idx")))
            nodes = nodes.unionByName(inner.drop("in_tree", "in_idx"))
        handed = _handed(nodes)
        if k:
            pushed = handed.select(F.col("tree").alias("in_tree"), F.col("child.idx").alias("in_idx"), "top", "suffix")
        else:
            found = found.unionByName(handed.select("tree", "child.idx", "child.hash", *[f"child.{c}" for c in carried], "top", "suffix"))
    return found


def folded(hash: Column, suffix: Column) -> Column:
    """The root that a leaf and its siblings, level by level, lead to."""
    return F.aggregate(suffix, hash, lambda below, run: sha256(F.concat(run["left"], below, run["right"])))


def merkle_proofs(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """The manifest, one row per document: doc_id, source, idx (its place in its source), leaf, subroot, root, proof, and the leaf ``altered``, if asked for.

    ``proof`` has one entry for each level from the leaf to the root: the
    joined hashes of the siblings to the left, and of those to the right.
    """
    rows = cut(
        docs.select(
            F.col("source").cast("string").alias("tree"),
            F.col("doc_id").cast("long").alias("doc_id"),
            leaf_hash({f: F.col(f) for f in FIELDS}).alias("hash"),
            (F.lit(None).cast("string") if altered is None else altered).alias("altered"),
            F.monotonically_increasing_id().alias("row_no"),
        )
    )
    leaves = placed(rows, "doc_id", "hash", "row_no").select("tree", "idx", "n", "hash", "doc_id", "altered")
    levels, subroots = build(leaves, "doc_id", "altered")

    # the subroots are the leaves of one more tree
    sources = placed(subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("source"), "hash"), "source").select("tree", "idx", "n", "hash", "source")
    upper, roots = build(sources, "source")
    root = roots.first()
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    above = proofs(upper, sources, roots.select(F.col("tree").alias("of_tree"), F.col("hash").alias("top"), nothing.alias("suffix")), "source")
    tops = cut(above.select(F.col("source").alias("of_tree"), F.col("hash").alias("top"), "suffix"))

    found = proofs(levels, leaves, tops, "doc_id", "altered")
    return found.select("doc_id", F.col("tree").alias("source"), "idx", F.col("hash").alias("leaf"), F.col("top").alias("subroot"), F.lit(root and root["hash"]).cast("string").alias("root"), F.col("suffix").alias("proof"), "altered")


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, and after tampering folded_root and verified, of every document."""
    manifest = merkle_proofs(docs, tampered_leaf())
    siblings = F.array_join(F.transform("proof", lambda run: F.concat(run["left"], run["right"])), "")
    manifest = manifest.select("doc_id", "leaf", "subroot", "root", sha256(siblings).alias("proof_sha256"), folded(F.coalesce("altered", "leaf"), F.col("proof")).alias("folded_root"))
    return manifest.withColumn("verified", F.col("folded_root") == F.col("root"))


def _levels_sql(name: str, leaves: str, depth: int) -> str:
    """Levels 1 to ``depth`` of trees (tree, idx, n, hash), and every child's siblings (left and right) by level."""
    sql = f"{name}0 AS (SELECT tree, idx, n, hash FROM {leaves})"
    for k in range(depth):
        sql += f""",
{name}{k + 1} AS (
  SELECT tree, idx // 16 AS idx, (any_value(n) + 15) // 16 AS n, sha256(string_agg(hash, '' ORDER BY idx)) AS hash
  FROM {name}{k} WHERE n > 1 GROUP BY tree, idx // 16),
{name}s{k} AS (
  SELECT tree, idx, coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k} WHERE n > 1 WINDOW run AS (PARTITION BY tree, idx // 16 ORDER BY idx))"""
    return sql


def _folds_sql(sides: list[str]) -> str:
    """``start`` after all levels, one subquery each; a level that the tree doesn't have leaves the hash as it is."""
    sql = "folds"
    for k, side in enumerate(sides):
        before = "start" if not k else f"fold{k - 1}"
        sql = f"(SELECT *, CASE WHEN l_{side} IS NULL THEN {before} ELSE sha256(l_{side} || {before} || r_{side}) END AS fold{k} FROM {sql})"
    return sql


def _manifest_sql(depth: int, upper: int) -> str:
    """DuckDB SQL for trees of at most ``depth`` levels, and as many as ``upper`` over the sources."""

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || {v}, '-')" for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    joins = "".join(f"\n  LEFT JOIN as{k} ON as{k}.tree IS NOT DISTINCT FROM leaves.tree AND as{k}.idx = leaves.idx // {16**k}" for k in range(depth))
    joins += "".join(f"\n  LEFT JOIN bs{k} ON bs{k}.idx = top.idx // {16**k}" for k in range(upper))
    sides = [f"as{k}" for k in range(depth)] + [f"bs{k}" for k in range(upper)]
    siblings = " || ".join(f"coalesce({side}.l || {side}.r, '')" for side in sides)
    tops = " UNION ALL ".join(f"SELECT tree, hash FROM a{k} WHERE n = 1" for k in range(depth + 1))
    roots = " UNION ALL ".join(f"SELECT hash FROM b{k} WHERE n = 1" for k in range(upper + 1))
    return f"""
WITH leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, hash) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n
  FROM (SELECT doc_id, source AS tree, {leaf("text")} AS hash,
               {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS other,
               list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')],
                           lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))) AS crc
        FROM documents)),
{_levels_sql("a", "leaves", depth)},
top AS (
  SELECT CAST(0 AS BIGINT) AS tree, tree AS source, hash, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM ({tops})),
{_levels_sql("b", "top", upper)},
root AS ({roots}),
folds AS (
  SELECT doc_id, leaves.hash AS leaf, top.hash AS subroot, root.hash AS root, sha256({siblings}) AS proof_sha256,
         CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN other ELSE leaves.hash END AS start,
         {", ".join(f"{side}.l AS l_{side}, {side}.r AS r_{side}" for side in sides)}
  FROM leaves JOIN top ON top.source IS NOT DISTINCT FROM leaves.tree CROSS JOIN root{joins})
SELECT doc_id, leaf, subroot, root, proof_sha256, fold{len(sides) - 1} AS folded_root, fold{len(sides) - 1} = root AS verified
FROM {_folds_sql(sides)}"""


OP12_SQL = _manifest_sql(5, 3)
