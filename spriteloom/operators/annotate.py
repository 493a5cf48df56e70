"""Captions from a pluggable annotator, and the parsing of its answers."""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from spriteloom.operators.steps import cut
from spriteloom.sources.codec import decode_png, encode_png

#: Takes an instruction and RGB images as PNG files, gives one answer an image.
Annotator = Callable[[str, Iterable[bytes]], Iterator[str]]
ANSWERS = "name string, description string, is_animation boolean, frames int"
PROMPT = "Answer with one JSON object: description (what the sprite shows), is_animation (true if it holds several frames), frames (how many)."


#: What a model's answer follows, and the fence that may stand around its JSON.
_ANSWER, _FENCE = "ASSISTANT:", "```json"
_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def said_in(answer: Column) -> Column:
    """What follows the last ``ASSISTANT:``, without blanks around it."""
    return F.regexp_replace(F.element_at(F.split(answer, _ANSWER, -1), -1), F.lit(_BLANKS), F.lit(""))


def json_in(said: Column) -> Column:
    """The text in the first JSON fence, else all; without the backslash that models write before an underscore."""
    fenced = F.split(F.element_at(F.split(said, _FENCE, 2), 2), "```", 2)[0]
    return F.replace(F.when(F.contains(said, F.lit(_FENCE)), fenced).otherwise(said), F.lit("\\_"), F.lit("_"))


def answer_fields(answer: Column) -> Column:
    """A struct of description, is_animation and frames from a model's answer, as VARIANT in the JVM.

    Text that is no JSON object becomes the description as it is, and the other
    fields are null.  A description that isn't a string is kept as JSON; one
    that is missing or null is ``No description``.  Frames that are no whole
    number count as 1.  Objects that name a field twice are no JSON here.
    """
    said = said_in(answer)
    body = json_in(said)
    # what follows a value would be overlooked: as a list's only value and as an object's it must be all there is
    listed, named = (F.try_parse_json(F.concat(F.lit(a), body, F.lit(b))) for a, b in (("[", "]"), ('{"is":', "}")))
    alone = named.isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull()
    value = F.when(alone, F.try_variant_get(listed, "$[0]", "variant"))

    def kind(path: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(value, path, "variant"))

    def text(path: str) -> Column:
        return F.try_variant_get(value, path, "string")

    description = F.when(kind("$.description").isNull() | (kind("$.description") == "VOID"), "No description")
    description = description.when(kind("$.description") == "STRING", text("$.description")).otherwise(F.to_json(F.try_variant_get(value, "$.description", "variant")))
    frames = F.when(kind("$.frames").isin("BIGINT", "STRING") & text("$.frames").rlike("^[0-9]{1,9}$"), text("$.frames").cast("int")).otherwise(1)
    moving = (kind("$.is_animation") == "BOOLEAN") & (text("$.is_animation") == "true")
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    return F.struct(
        F.when(is_object, description).otherwise(said).alias("description"),
        F.when(is_object, F.coalesce(moving, F.lit(False))).alias("is_animation"),
        F.when(is_object, frames).alias("frames"),
    )


@F.pandas_udf(StringType())
def _indented(text: pd.Series) -> pd.Series:
    return text.map(lambda t: json.dumps(json.loads(t), indent=2, ensure_ascii=False))


def metadata_json(metadata: Column | str) -> Column:
    """A struct as indented JSON with all its fields, nulls too; letters outside ASCII stay as they are."""
    return _indented(F.to_json(metadata, {"ignoreNullFields": "false"}))


def rgb_png(png: bytes) -> bytes:
    """The image without its alpha channel, transparent pixels as the black that the cleaner gave them."""
    rgba = decode_png(png)
    rgba[..., 3] = 255
    return encode_png(rgba)


def stub(prompt: str, images: Iterable[bytes]) -> Iterator[str]:
    """Answers that tell an image's size, for tests and dry runs."""
    for image in images:
        width, height = struct.unpack(">II", image[16:24])
        yield f'ASSISTANT: {{"description": "sprite of {width} x {height} pixels", "is_animation": false, "frames": 1}}'


def dry_run() -> Annotator:
    return stub


#: Images that an annotator gets at a time.
BATCH = 64


def asked(images: DataFrame, make: Callable[[], Annotator], prompt: str = PROMPT, batch: int = BATCH) -> DataFrame:
    """(digest, answer) for rows (digest, png).  ``make`` runs once in a Python worker, which keeps the model from task to task."""

    def load():
        annotator = make()

        def predict(pngs: np.ndarray) -> np.ndarray:
            return np.array(list(annotator(prompt, map(rgb_png, pngs))), object)

        return predict

    ask = predict_batch_udf(load, return_type=StringType(), batch_size=batch)
    return images.select("digest", ask("png").alias("answer"))


def stored_answers(spark: SparkSession, store: str) -> DataFrame:
    """(digest, answer) of a store, one for each digest; empty if there is none yet."""
    try:
        rows = spark.read.schema("digest string, answer string").parquet(store)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "digest string, answer string")
    return rows.groupBy("digest").agg(F.min("answer").alias("answer"))  # two runs at a time may both have asked


def annotate(images: DataFrame, make: Callable[[], Annotator], store: str, prompt: str = PROMPT) -> DataFrame:
    """(name, description, is_animation, frames) for rows (name, png).

    Answers are kept in ``store``, a Parquet folder, by a digest of the image and
    the prompt: equal images are asked once, and a run over images of which some
    have answers asks the others only.
    """
    spark = images.sparkSession
    keyed = cut(images.select("name", "png", F.sha2(F.concat(F.sha2(F.lit(prompt), 256).cast("binary"), "png"), 256).alias("digest")))
    new = keyed.groupBy("digest").agg(F.first("png").alias("png")).join(stored_answers(spark, store), "digest", "left_anti")
    asked(new, make, prompt).write.mode("append").parquet(store)
    answers = stored_answers(spark, store).select("digest", answer_fields(F.col("answer")).alias("said"))
    return keyed.select("name", "digest").join(answers, "digest").select("name", "said.*")
