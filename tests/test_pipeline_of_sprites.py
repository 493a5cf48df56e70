import io
import json
import tarfile
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from spriteloom.operators import crawl
from spriteloom.pipeline import main
from spriteloom.plans import drawing
from spriteloom.sources.codec import encode_png


def art(seed, size=6):
    return encode_png(np.random.default_rng(seed).integers(0, 9, (size, size, 4)).astype(np.uint8))


def stored(spark, pages):
    return spark.createDataFrame([(u, s, c if isinstance(c, bytes) else c.encode()) for u, s, c in pages], "url string, status int, content binary")


@pytest.fixture
def gallery(spark):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("a/icon.png", art(3))
        z.writestr("__MACOSX/b.png", art(4))
    at = "https://art.example"
    return stored(
        spark,
        [
            (f"{at}/list?page=0", 200, '<a href="/content/a">x</a><a href="/content/a">again</a><!-- <a href="/content/no"> --><a href="/user">u</a>'),
            (f"{at}/list?page=1", 503, '<a href="/content/z"></a>'),
            (f"{at}/content/a", 200, '<span class="big file"><b><a href="/f/hero.png">h</a></b></span><a href="/f/out.png"></a>'
             '<span class="file"><a href="/f/my_Avatar.png"></a><a href="/f/pack.zip"></a><a href=""></a><a href="/f/tiny.PNG?x=1"></a><a href="/f/gone.gif"></a></span>'),
            (f"{at}/f/hero.png", 200, art(1)),
            (f"{at}/f/out.png", 200, art(2)),
            (f"{at}/f/pack.zip", 200, data.getvalue()),
        ],
    )


def test_links_and_targets(spark):
    assert crawl.hrefs_of('<a href="/a&amp;b">x<br><a href=\'c\'></a><script>"<a href=d>"</script>') == ["/a&b", "c"]
    assert crawl.hrefs_of(None) == crawl.hrefs_of("") == []
    rows = spark.createDataFrame([("https://h.example/a/b", "../c?q#f"), ("https://h.example/", "//o.example/x"), (None, "y"), ("https://h.example", None)], "b string, h string")
    assert [r[0] for r in rows.select(crawl.absolute("b", "h")).collect()] == ["https://h.example/c?q#f", "https://o.example/x", "y", None]


def test_gallery_to_shards(spark, gallery, tmp_path):
    gallery.write.parquet(str(tmp_path / "pages"))
    command = ["--input", str(tmp_path / "pages"), "--url", "https://art.example/list?page={page}", "--end", "2", "--out", str(tmp_path / "out"), "--prefix", "07"]
    command += ["--annotator", "spriteloom.operators.annotate:dry_run"]
    assert {r["verdict"]: r["n"] for r in main(command, spark).collect()} == {"accepted": 2}
    (tar,) = (tmp_path / "out" / "07" / "private_train").iterdir()
    assert tar.name == "private_train_shard_000000.tar"
    with tarfile.open(tar) as t:
        assert sorted(t.getnames()) == ["hero.json", "hero.png", "pack_icon.json", "pack_icon.png"]
        text = t.extractfile("hero.json").read().decode()
    got = json.loads(text)
    assert text == json.dumps(got, indent=2, ensure_ascii=False)
    assert list(got)[:2] == ["license_type", "dataset_bucket"] and got["fps"] is None and got["description"].startswith("sprite of")
    assert got["source_url"] == "https://art.example/f/hero.png"


def test_gallery_with_a_state_fetches_nothing_twice(spark, gallery, tmp_path):
    gallery.write.parquet(str(tmp_path / "pages"))
    command = ["--input", str(tmp_path / "pages"), "--url", "https://art.example/list?page={page}", "--delay", "0", "--state", str(tmp_path / "state"), "--out", str(tmp_path / "out")]
    assert {r["verdict"]: r["n"] for r in main([*command, "--end", "1", "--prefix", "a"], spark).collect()} == {"accepted": 2}
    fetched = spark.read.parquet(str(tmp_path / "state" / "pages" / "*"))
    before = {r["url"] for r in fetched.collect()}
    assert {r["verdict"]: r["n"] for r in main([*command, "--end", "2", "--prefix", "b"], spark).collect()} == {"accepted": 2}
    after = [r["url"] for r in spark.read.parquet(str(tmp_path / "state" / "pages" / "*")).collect()]
    assert len(after) == len(set(after)) and set(after) - before == {"https://art.example/list?page=1"}


def test_downloads_skip_what_is_there(spark, gallery):
    files = spark.createDataFrame([("https://art.example/f/hero.png", "hero.png"), ("https://art.example/f/out.png", "out.png")], "url string, name string")
    have = spark.createDataFrame([("hero.png",)], "name string")
    assert [r["name"] for r in crawl.download(files, crawl.from_table(gallery), have).collect()] == ["out.png"]


def test_console(spark):
    at = "https://s.example"
    games = "".join(f'<a href="/snes/{g}/">g</a>' for g in ("one", "two", "one", "x", "three")) + '<a href="/snes/deep/er/"></a>'
    pages = [(f"{at}/snes/", 200, games)]
    pages += [(f"{at}/snes/{g}/", 200, f'<a href="/asset/{g}">a</a><a href="/asset/{g}">a</a>') for g in ("one", "two", "three")]
    pages += [(f"{at}/asset/{g}", 200, f'<a href="/media/assets/1/{g}.png?v=1">f</a><a href="/media/assets/2/no.png">f</a>') for g in ("one", "two", "three")]
    files = crawl.console_files(crawl.numbered_pages(spark, f"{at}/snes/", 0, 1), crawl.from_table(stored(spark, pages)), "snes", 1, 3)
    assert sorted(r["name"] for r in files.collect()) == ["tsr_three.png", "tsr_two.png"]


def test_hosted_table(spark):
    rows = spark.createDataFrame([(2, None, b"c"), (0, b"a", None), (1, None, None), (3, b"d", b"e")], "idx int, img binary, image binary")
    got = crawl.hosted_images(rows, "some/art", "idx", limit=2).orderBy("name").collect()
    assert [(r["name"], bytes(r["content"])) for r in got] == [("hf_some_art_000000.png", b"a"), ("hf_some_art_000002.png", b"c")]
    with pytest.raises(ValueError):
        crawl.hosted_images(spark.range(1), "d", "id")


def test_folder_without_images(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "broken.png").write_bytes(b"no png")
    (tmp_path / "in" / "notes.txt").write_bytes(b"x")
    got = main(["--source", "folder", "--input", str(tmp_path / "in"), "--out", str(tmp_path / "out")], spark)
    assert [tuple(r) for r in got.select("verdict", F.col("n")).collect()] == [("unreadable", 1)]


def test_folder_of_all_kinds(spark, tmp_path):
    (tmp_path / "in" / "more").mkdir(parents=True)
    grey = np.arange(30).reshape(5, 6) * 8
    files = {"hero.png": art(1), "more/hero.gif": drawing.gif(np.full((6, 6, 4), 255, np.uint8)), "photo.jpg": drawing.grey_jpeg(grey), "more/same.jpeg": drawing.grey_jpeg(grey)}
    files |= {"new.webp": b"RIFF\x10\0\0\0WEBPVP8 ", "cut.png": art(2)[:-40], "UPPER.PNG": art(3), "long.txt": b"x" * 3000}
    for name, data in files.items():
        (tmp_path / "in" / name).write_bytes(data)
    before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "2000")  # the text is longer: reading it would fail
    try:
        got = main(["--source", "folder", "--input", str(tmp_path / "in"), "--out", str(tmp_path / "out")], spark)
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", before)
    assert {r["verdict"]: r["n"] for r in got.collect()} == {"accepted": 4, "unreadable": 1, "unsupported_webp": 1}
    (tar,) = (tmp_path / "out" / "00").rglob("*.tar")
    with tarfile.open(tar) as t:
        assert sorted(n for n in t.getnames() if n.endswith(".png")) == ["hero-2.png", "hero.png", "photo.png", "same.png"]
        assert {json.loads(t.extractfile(f"{n}.json").read())["width"] for n in ("photo", "same")} == {6}
