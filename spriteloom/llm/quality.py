"""Quality rules: document statistics and cross-document line frequency.

One pass over the texts yields each document's statistics and the hashes of its
lines, normalised (A-Z lower-cased, digits as 0, blanks collapsed).
Distinct texts are counted per host and line, with partial sums before the
shuffle.  A line of any length is boilerplate on its host when it stands in more
than ``min_docs`` of the host's distinct texts, however many the host has; a
caller may also ask for more than ``min_share`` of them, or set aside lines of
over ``max_line_words`` words.  A document that loses so many words with its
boilerplate lines that less than ``min_left`` of them remain is depleted and
rejected.  Texts that are exact copies count as one.

``without_boilerplate`` takes the lines out.  Asked for ``everywhere``, it takes a
line that is boilerplate on one host out of the texts of all hosts, so that what
stays of a text depends on the text alone and copies on different hosts stay
copies; a text of which less than ``min_left`` would stay is then left as it is.

Cases: a null text counts as empty and fails the base rules; a null host is a
host of its own; repeated rows are judged alike; extra columns are ignored; an
empty table gives an empty result; a text of any length is read as a whole, and
every line of it counts.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import cut, same, text_or_empty

MAX_LINE_WORDS, MIN_DOCS, MIN_SHARE, MIN_LEFT = None, 10, 0.0, 0.3
#: Documents of which the scan holds the lines at a time.
BLOCK_ROWS = 500
_SYMBOLS = re.compile(r"[#*$%&|<>]").findall
_BLANK = re.compile(r"[\x20\x09-\x0D]").findall
_DIGITS = bytes.maketrans(b"123456789", b"000000000")
_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def text_stats(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of one text."""
    words = text.encode().split()  # bytes: exactly the ASCII blanks separate
    lines = [line for line in text.split("\n") if line.encode().split()]
    return len(words), len(text) - len(_BLANK(text)), len(_SYMBOLS(text)), len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    count, end = 0, 0
    for i, window in enumerate(windows):
        if seen[window] > 1:
            count += i + 3 - max(i, end)
            end = i + 3
    return count


def line_hash(line: bytes) -> tuple[int, int]:
    """Hash of the normalised line, and its words."""
    words = line.lower().translate(_DIGITS).split()
    return xxhash.xxh64_intdigest(b" ".join(words)) - (1 << 63), len(words)


def _scan(max_line_words: int | None):
    lines_type = pa.list_(pa.struct([("h", pa.int64()), ("w", pa.int32()), ("n", pa.int32())]))
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("host", pa.string()), ("text_hash", pa.int64()), *((n, pa.int64()) for n in _STATS), ("lines", lines_type)])

    def scan(batches):
        for batch in (b.slice(at, BLOCK_ROWS) for b in batches for at in range(0, max(1, len(b)), BLOCK_ROWS)):
            out = []
            for doc_id, key, host, text in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode()
                found = Counter(line_hash(line) for line in data.split(b"\n"))
                lines = [{"h": h, "w": w, "n": n} for (h, w), n in found.items() if 0 < w and (max_line_words is None or w <= max_line_words)]
                out.append((doc_id, key, host, xxhash.xxh64_intdigest(data) - (1 << 63), *text_stats(text), lines))
            columns = zip(*out) if out else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return scan


def boilerplate(lines: DataFrame, texts: DataFrame, min_docs: int, min_share: float) -> DataFrame:
    """(host, h): lines in too many distinct texts of their host."""
    per_line = lines.select("host", "h", "text_hash").distinct().groupBy("host", "h").agg(F.count("*").alias("n"))
    often = per_line.where(F.col("n") > min_docs)
    if not min_share:
        return often.select("host", "h")
    per_host = texts.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("n_texts"))
    return often.join(per_host, same(often, per_host, "host")).where(F.col("n") > F.col("n_texts") * min_share).select(often["host"], "h")


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    host_col: str = "source",
    max_line_words: int | None = MAX_LINE_WORDS,
    min_docs: int = MIN_DOCS,
    min_share: float = MIN_SHARE,
    min_left: float = MIN_LEFT,
    key_col: str | None = None,
    lines_of: str | None = None,
) -> DataFrame:
    """One row per document: its statistics, base_failed, n_boilerplate_words and kept; with ``key_col`` also key (that
    binary column), and with ``lines_of`` also boilerplate: hashes of its lines that are boilerplate on its "host", or
    "everywhere": on any host, unless too little would be left.

    The scan's result (some numbers a document and a hash a line) is cut
    into the shared folder; texts are read once and never shuffled.
    """
    schema = "doc_id long, key binary, host string, text_hash long, " + ", ".join(f"{n} long" for n in _STATS) + ", lines array<struct<h:long,w:int,n:int>>"
    key = (F.col(key_col) if key_col else F.lit(None)).cast("binary").alias("key")
    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), key, F.col(host_col).cast("string").alias("host"), text_or_empty().alias("text"))
    rows = cut(wanted.mapInArrow(_scan(max_line_words), schema).withColumn("row_no", F.monotonically_increasing_id()))
    lines = rows.select("row_no", "host", "text_hash", F.explode("lines").alias("line")).select("row_no", "host", "text_hash", "line.*")
    bad = boilerplate(lines, rows, min_docs, min_share).withColumnsRenamed({"host": "bad_host", "h": "bad_h"})
    hit = lines.join(bad, (lines["h"] == bad["bad_h"]) & lines["host"].eqNullSafe(bad["bad_host"]))
    lost = hit.groupBy(F.col("row_no").alias("lost_row")).agg(F.sum(F.col("w") * F.col("n")).alias("lost"))
    judged = rows.join(lost, rows["row_no"] == lost["lost_row"], "left")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    lost_words = F.coalesce(F.col("lost"), F.lit(0)).cast("long")
    gone = []
    if lines_of:
        anywhere = bad.select(F.col("bad_h").alias("any_h")).distinct()
        own = lines.join(anywhere, F.col("h") == F.col("any_h")) if lines_of == "everywhere" else hit
        own = own.groupBy(F.col("row_no").alias("own_row")).agg(F.collect_list("h").alias("hashes"), F.sum(F.col("w") * F.col("n")).alias("words"))
        judged = judged.join(own, F.col("row_no") == F.col("own_row"), "left")
        few_left = F.lit(lines_of == "everywhere") & (F.col("n_words") - F.col("words") < F.col("n_words") * min_left)
        gone = [F.when(~few_left, F.col("hashes")).alias("boilerplate")]
    return judged.select(
        "doc_id",
        *_STATS,
        failed.alias("base_failed"),
        (~failed & (F.col("n_words") - lost_words >= F.col("n_words") * min_left)).alias("kept"),
        lost_words.alias("n_boilerplate_words"),
        *(["key"] if key_col else []),
        *gone,
    )


@F.pandas_udf(StringType())
def _stripped(texts: pd.Series, hashes: pd.Series) -> pd.Series:
    def strip(text, gone):
        gone = set(gone)
        return "\n".join(line for line in text.split("\n") if line_hash(line.encode())[0] not in gone)

    return pd.Series([strip(t, g) for t, g in zip(texts, hashes)], dtype=object)


def strip_lines(docs: DataFrame, hashes: str) -> DataFrame:
    """The documents without the lines whose hashes the column ``hashes`` has, and without that column."""
    some = F.size(F.coalesce(F.col(hashes), F.array().cast("array<long>"))) > 0
    text = F.when(some, _stripped(F.when(some, F.col("text")).otherwise(""), F.when(some, F.col(hashes)).otherwise(F.array().cast("array<long>")))).otherwise(F.col("text"))
    return docs.withColumn("text", text).drop(hashes)


def without_boilerplate(docs: DataFrame, host_col: str = "source", everywhere: bool = False, **limits) -> DataFrame:
    """The documents with boilerplate lines taken out of ``text``; other columns stay."""
    rows = cut(docs.withColumn("__row", F.monotonically_increasing_id()))
    key = F.expr("unhex(lpad(hex(__row), 16, '0'))")
    found = quality_rules(rows.withColumn("__key", key), "__row", host_col, key_col="__key", lines_of="everywhere" if everywhere else "host", **limits)
    found = found.where("boilerplate IS NOT NULL").select(F.col("doc_id").alias("__own"), F.col("boilerplate").alias("__gone"))
    return strip_lines(rows.join(found, F.col("__row") == F.col("__own"), "left"), "__gone").select(*docs.columns)


OP7_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS body FROM documents),
w AS (
  SELECT r, list_filter(regexp_split_to_array(body, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
win AS (
  SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS k FROM win) WHERE k > 1)
  GROUP BY r),
l AS (
  SELECT r, host, body, unnest(string_split(body, chr(10))) AS line FROM d),
dup AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM l
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
norm AS (
  SELECT r, host, body, trim(regexp_replace(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[1-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS x FROM l),
whole AS (
  SELECT r, host, body, x, len(string_split(x, ' ')) AS k FROM norm WHERE x <> ''),
bad AS (
  SELECT host, x FROM whole GROUP BY host, x HAVING count(DISTINCT body) > 10),
lost AS (
  SELECT r, sum(k) AS n FROM whole s JOIN bad b ON s.host IS NOT DISTINCT FROM b.host AND s.x = b.x GROUP BY r),
f AS (
  SELECT d.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(lost.n, 0) AS BIGINT) AS n_boilerplate_words
  FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN lost USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       (NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_boilerplate_words >= 0.3 * n_words) AS kept,
       n_boilerplate_words
FROM f
"""
