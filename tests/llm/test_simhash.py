import numpy as np
import xxhash
from pyspark.sql import functions as F

from spriteloom.llm.components import components
from spriteloom.llm.simhash import near_links, simhash_dedup, tile_links


def brute_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """prints: (doc_id, fingerprint)."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 4:
                root[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(prints):
        ids.setdefault(find(i), []).append(doc_id)
    return [min((d for d in ids[find(i)] if d is not None), default=None) for i in range(len(prints))]


def check(df):
    rows = [(r["doc_id"], brute_print(r["text"])) for r in df.collect()]
    want = sorted(((d, f"{p:016x}", c) for (d, p), c in zip(rows, brute_components(rows))), key=str)
    assert sorted((tuple(r) for r in simhash_dedup(df, tile=64).collect()), key=str) == want


def test_edge_cases(edge):
    check(edge)


def test_documents(small):
    check(small)


def test_empty(empty):
    assert simhash_dedup(empty).collect() == []


def test_links_connect_what_the_radius_connects(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    values = {int(b) ^ sum(1 << int(k) for k in rng.integers(0, 64, rng.integers(0, 4))) for b in base for _ in range(20)}
    signed = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(5)
    roots = {r["node"]: r["root"] for r in components(near_links(df, 4, 16)).collect()}
    want = brute_components([(v, v & (1 << 64) - 1) for v in signed])
    assert [roots.get(v, v) for v in signed] == want


def test_one_crowded_tile_gives_a_forest():
    crowd = np.array([1 << i | 1 << j for i in range(64) for j in range(i)], np.uint64)
    links = tile_links(crowd, crowd, 4)
    assert len(links) == len(crowd) - 1


def test_components_of_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(path + hub + [(5000, 5000)], "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}


def test_fingerprint_hash_is_the_engines_own(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(b"a b c d", 42)
