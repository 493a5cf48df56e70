import re

import corpus_pipeline
from spriteloom.llm.quality import quality_rules
from tests_llm_helpers import brute_prints_components

DATA = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = {r["doc_id"] for r in quality_rules(docs).collect() if r["kept"]}
    for (_, stage), expect in zip(corpus_pipeline.STAGES[:3], (lambda ids: want, once, near), strict=True):
        docs = stage(spark, docs, DATA).cache()
        assert docs.columns == columns
        want = expect(want) if stage is corpus_pipeline.quality_stage else expect({d: texts[d] for d in want})
        rows = docs.collect()
        assert len(rows) == len(want) and {r["doc_id"] for r in rows} == want
        assert all(r["text"] == texts[r["doc_id"]] for r in rows)
    clean = corpus_pipeline.pii_stage(spark, docs, DATA).collect()
    assert {r["doc_id"] for r in clean} == want and all(r["n_chars"] == len(r["text"]) for r in clean)
    assert not any(re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r["text"]) for r in clean)


def once(texts):
    best = {}
    for d, t in texts.items():
        key = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[key] = min(best.get(key, (1, 0)), (-len(t), d))
    return {d for _, d in best.values()}


def near(texts):
    return {c for d, c in brute_prints_components(texts).items() if c == d}


def test_run(spark):
    got = corpus_pipeline.run(spark, DATA).collect()
    assert got and {"doc_id", "piece", "sequence_id", "offset"} <= set(got[0].__fields__)


def test_edge_cases(spark, edge):
    docs = edge
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
        docs.collect()


def test_columns_of_any_name_stay(spark):
    names = "kept_id kept_key wanted_id wanted_key __key __row __gone gone boilerplate key root row row_no rest text_hash host spans kept kind n component_id length".split() + ["with.dot"]
    text = " ".join(f"word{k}" for k in range(80))
    rows = [(i, f"{text} mail me{i}@example.com" + " tail" * i, "en", "h", 1, *names) for i in range(5)] + [(None, None, None, None, None, *names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA).cache()
        assert docs.columns == columns
        got = docs.collect()
        assert got and all([r[n] for n in names] == names for r in got)
    assert all("[EMAIL]" in r["text"] and r["n_chars"] == len(r["text"]) for r in got)
    assert corpus_pipeline.packing_stage(spark, docs, DATA).count() == len(got)


def test_empty(spark, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
        assert docs.collect() == []


def test_boilerplate_lines_go(spark):
    notice = " ".join(f"notice{k}" for k in range(30))
    own = {i: " ".join(f"own{i}x{k}" for k in range(70)) for i in range(12)}
    rows = [(i, f"{notice}\n{own[i]}", "en", "h", 1) for i in range(12)] + [(50, f"{notice}\n{own[3]}", "en", "other", 1), (None, f"{notice}\nshort", "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in corpus_pipeline.quality_stage(spark, docs, DATA).collect()}
    assert {d: r["text"] for d, r in got.items()} == own | {50: own[3]}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_repeated_rows_and_null_ids(spark, edge):
    kept = corpus_pipeline.exact_stage(spark, edge, DATA).collect()
    assert len(kept) == len({re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "") for r in edge.collect()})


def test_documents_are_known_by_id_and_text(spark):
    def words(name):
        return " ".join(f"{name}{k}" for k in range(60))

    same = [(1, words("a")), (2, words("a").replace(" ", "  ")), (None, words("a")), (None, words("lonely")), (None, words("other")), (2, words("of two")), (2, words("of two"))]
    same += [(2, words("of two").replace(" ", "\t")), (2, words("of two ").replace(" ", "  ")), (3, words("z")), (None, None), (4, ""), (None, words("lonely"))]
    rows = [(*r, "h") for r in same] + [(3, "too short", "h"), (None, "short", None), (5, words("a"), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    best = {}
    for d, t, _ in rows:
        key, t = re.sub(r"[\x20\x09-\x0D]", "", t or ""), t or ""
        rank = (-len(t), d is None, d or 0)
        best[key] = min(best.get(key, (rank, d)), (rank, d), key=lambda x: x[0])
    kept = corpus_pipeline.exact_stage(spark, docs, DATA).collect()
    assert sorted((re.sub(r"[\x20\x09-\x0D]", "", r["text"] or ""), str(r["doc_id"]), len(r["text"] or "")) for r in kept) == sorted(
        (key, str(d), -rank[0]) for key, (rank, d) in best.items()
    )
    good = corpus_pipeline.quality_stage(spark, docs, DATA).collect()
    assert sorted(map(str, good)) == sorted(str(r) for r in docs.collect() if len((r["text"] or "").split()) >= 50)
    near = corpus_pipeline.near_stage(spark, corpus_pipeline.exact_stage(spark, docs, DATA).cache(), DATA).collect()
    prints = {r["text"] or "": r["doc_id"] for r in kept}
    groups = brute_prints_components({t: t for t in prints})
    want = {}
    for t, c in groups.items():
        want[c] = min(want.get(c, (True, 0)), (prints[t] is None, prints[t] or 0))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in near) == sorted(want.values())
