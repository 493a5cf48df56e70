import numpy as np
import pytest

from spriteloom.operators.codebook import learn_codebook, nearest
from spriteloom.operators.positions import build_positions, count_rows, rows_at
from spriteloom.streaming.crawl import rocks_state
from spriteloom.streaming.shards import PLACED, shard_stream


def one_machine(x, book, rounds, decay):
    losses = []
    for _ in range(rounds):
        code, d = nearest(x, book)
        losses.append(d.sum() / x.size)
        book = np.array([decay * c + (1 - decay) * x[code == k].mean(axis=0) if (code == k).any() else c for k, c in enumerate(book)])
    return book, losses


def test_codebook_is_that_of_one_machine(spark, tmp_path):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").repartition(7)
    x = np.array([r["embedding"] for r in vectors.orderBy("vec_id").collect()], np.float64)
    book, losses = learn_codebook(vectors, x[:16], 5, reseed=False, folder=str(tmp_path / "rounds"))
    want, want_losses = one_machine(x, x[:16], 5, 0.5)
    np.testing.assert_allclose(book, want, rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(losses, want_losses, rtol=1e-9)
    assert all(b < a for a, b in zip(losses, losses[1:]))
    # rounds that are written are not done again: other vectors make no difference to them
    again, more = learn_codebook(vectors.limit(0), x[:16], 5, folder=str(tmp_path / "rounds"))
    assert (again == book).all() and more == losses


def test_dead_codewords_are_set_on_the_worst_vectors(spark):
    rows = [(k, [float(k % 2) * 10, float(k % 3)]) for k in range(60)] + [(99, [500.0, 500.0]), (100, None)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    start = np.array([[0.0, 1.0], [10.0, 1.0], [9e9, 9e9]])
    book, losses = learn_codebook(vectors.where("embedding IS NOT NULL"), start, 2, decay=0.0)
    assert (book[2] == 500).all() and losses[1] < losses[0]
    assert learn_codebook(vectors.limit(0), start, 1)[1] == [0.0]


def test_positions_open_only_what_is_asked_for(spark, tmp_path):
    table, index = str(tmp_path / "t"), str(tmp_path / "i")
    spark.range(5000).selectExpr("id", "repeat('x', 50) AS pad", "id * 2 AS twice").repartitionByRange(5, "id").sortWithinPartitions("id").write.option("parquet.block.size", 4096).parquet(table)
    build_positions(spark, table, index)
    assert count_rows(spark, index) == 5000
    wanted = spark.createDataFrame([(p,) for p in (0, 17, 17, 999, 1000, 4999, 5000, -1, None)], "position long")
    got = rows_at(wanted, index, spark.read.parquet(table).select("twice", "id"))
    assert sorted(tuple(r) for r in got.collect()) == [(p, 2 * p, p) for p in (0, 17, 17, 999, 1000, 4999)]
    # files that aren't asked for may even be gone
    gone = spark.read.parquet(index + "/positions").where("first >= 2000").select("file").distinct().collect()
    for row in gone[:1]:
        path = row["file"].removeprefix("file:").replace("///", "/")
        (tmp_path / "t" / path.split("/")[-1]).unlink()
    few = rows_at(spark.createDataFrame([(3,), (4,)], "position long"), index, spark.createDataFrame([], "id long"))
    assert sorted(tuple(r) for r in few.collect()) == [(3, 3), (4, 4)]


def test_shards_of_many_batches_are_those_of_one(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(b, i, int(rng.integers(0, 400))) for i in range(300) for b in ("a", None, "c")[: 1 + i % 3]]
    shape = "bucket string, id long, size long"

    def run(name, parts):
        for k in range(parts):
            spark.createDataFrame([r for r in rows if r[1] * parts // 300 == k], shape).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
            with rocks_state(spark):
                stream = spark.readStream.schema(shape).parquet(str(tmp_path / name))
                query = shard_stream(stream, 1000).writeStream.format("parquet").option("path", str(tmp_path / f"{name}-out")).option("checkpointLocation", str(tmp_path / f"{name}-c")).trigger(availableNow=True).start()
            query.awaitTermination()
        return sorted(map(str, spark.read.schema(PLACED).parquet(str(tmp_path / f"{name}-out")).collect()))

    whole = run("one", 1)
    assert len(whole) == len(rows) and run("three", 3) == whole
    spark.createDataFrame([("a", 5, 1)], shape).write.mode("append").parquet(str(tmp_path / "one"))
    with rocks_state(spark):
        stream = spark.readStream.schema(shape).parquet(str(tmp_path / "one"))
        query = shard_stream(stream, 1000).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "one-c")).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="came after"):
        query.awaitTermination()
