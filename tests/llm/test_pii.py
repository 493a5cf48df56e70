import hashlib
import random
import re

from spriteloom.llm.pii import estimate, pii_spans, redact, train

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {
        "email": True,
        "ip": kind == "ip" and all(int(p) <= 255 for p in text.split(".")),
        "card": 12 <= len(digits) <= 19 and luhn(digits),
        "phone": 9 <= len(digits) <= 15,
    }[kind]


def brute(text):
    spans = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        if {"email": "@", "ip": "."}.get(kind, "") in text:  # else the plain patterns find nothing, in quadratic time
            spans += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text) if passes(kind, m.group())]
    spans.sort()
    listed = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)
    return (*(sum(s[2] == k for s in spans) for k in PATTERNS), hashlib.sha256(listed.encode()).hexdigest(), listed)


def check(df):
    want = sorted((str(r["doc_id"]), *brute(r["text"] or "")) for r in df.collect())
    got = sorted((str(r["doc_id"]), *r[1:6], r["spans"]) for r in map(tuple_row, pii_spans(df).collect()))
    assert [g[:6] for g in got] == [w[:6] for w in want]
    for g, w in zip(got, want):
        assert set(filter(None, w[6].split(","))) <= set(g[6].split(","))


class tuple_row(tuple):
    def __new__(cls, row):
        self = super().__new__(cls, row)
        self.row = row
        return self

    def __getitem__(self, k):
        return self.row[k] if isinstance(k, str) else super().__getitem__(k)


def test_edge_cases(edge):
    check(edge)


def test_documents(small):
    check(small)


def test_random_texts(spark):
    random.seed(7)
    parts = ["a@b.co", "a@b", ".", "_", "1", "23", " ", "-", "+1 (555) 123-4567", "+", "255", "256", "4111 1111 1111 1111", "4111111111111112", "1.2.3.4", "@", "x", "é", "\x1e", "\n", "0", "(", ")", "\U0001f600"]
    texts = ["".join(random.choices(parts, k=random.randint(1, 25))) for _ in range(600)]
    check(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))


def test_very_many_matches_in_one_text(spark):
    text = " ".join(f"a{i}@b.example and {i % 256}.1.2.3" for i in range(30_000))
    (got,) = pii_spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert (got["n_email"], got["n_ip"], got["base_sha256"]) == (30_000, 30_000, brute(text)[4])


def test_names_and_local_numbers(spark):
    rows = [(i, f"Dear Dr. Anna Bell{'abcdefghij'[i % 10]}, please call 0171 23{i:05d} or phone: (030) 44{i:04d}.") for i in range(60)]
    rows += [(100 + i, f"Drum and Ms paint {i} calls 12 of 345") for i in range(60)]
    got = {r["doc_id"]: (r["spans"], r["n_spans"]) for r in pii_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(s.count("local:") == 2 and s.count("name:5:") == 1 and n == 3 for d, (s, n) in got.items() if d < 100)
    assert all(n == 0 for d, (_, n) in got.items() if d >= 100)


def test_long_runs_take_linear_time(spark):
    runs = ["1" * 200_000, "a" * 200_000, "1." * 4_000, "+1" * 4_000, "1-" * 100_000 + "1", "a@" * 50_000]
    got = pii_spans(spark.createDataFrame([(i, t) for i, t in enumerate(runs)], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["base_sha256"]) for r in got) == sorted((i, brute(t)[4]) for i, t in enumerate(runs))


def test_secrets_are_added_and_redacted(spark):
    rows = [(i, f"Write to ab.c{i}@mail.example.com please. token = \"{hashlib.sha1(str(i).encode()).hexdigest()}\" and AKIAABCDEFGH{i:08d} end", i) for i in range(50)]
    rows += [(100 + i, f"nothing personal but thisisaverylongwordindeed{i} here", 0) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rest int")
    got = {r["doc_id"]: r["spans"] for r in pii_spans(df).collect()}
    assert all("secret:" in got[i] and "email:" in got[i] for i in range(50))
    clean = {r["doc_id"]: r for r in redact(df).collect()}
    assert clean[3]["text"] == 'Write to [EMAIL] please. token = "[SECRET]" and [SECRET] end' and clean[3]["rest"] == 3
    assert clean[0].__fields__ == df.columns


def test_empty(empty):
    assert pii_spans(empty).collect() == []
    assert redact(empty).collect() == []


def test_labelers_are_told_apart():
    patterns = [("secret", (1, 1, 1, 1, 0), 50), ("secret", (-1, 0, 0, -1, 0), 60), ("secret", (1, 0, 1, 1, 0), 20), ("secret", (-1, 0, -1, -1, 0), 30)]
    posterior, reliability = estimate(patterns)
    assert posterior[0] > 0.9 and posterior[1] < 0.1 and reliability[0] > 0.8
    weights, bias = train(patterns, posterior)
    score = lambda v: bias["secret"] + sum(w * x for w, x in zip(weights, v))
    assert score((1, 1, 1, 1, 0)) > 0 > score((-1, 0, 0, -1, 0))
