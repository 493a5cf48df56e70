import re

from spriteloom.llm.licenses import BODIES, PHRASES, TEMPLATES, license_scan, tokens_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(text):
    words = WORD.findall(ascii_lower(text))
    places = [(i, label) for i in range(len(words)) for phrase, label in PHRASES.items() if words[i : i + len(phrase.split())] == phrase.split()]
    shares = {}
    lines, paragraphs = text.split("\n"), [p for p in re.split(r"\n[\x20\x09\x0B-\x0D]*\n", text) if "\n" in p]
    for blocks, templates in ((lines, TEMPLATES + BODIES), (paragraphs, BODIES)):
        for block in blocks:
            tokens = set(WORD.findall(block.lower()))
            for label, template in templates:
                want = tokens_of(template)
                share = len(tokens & set(want)) / len(want)
                phrase = re.findall("[a-z0-9]+", template.lower())
                words_of = WORD.findall(block.lower())
                if len(phrase) <= 4 and not any(words_of[i : i + len(phrase)] == phrase for i in range(len(words_of))):
                    continue
                if share >= 0.8:
                    shares[label] = max(share, shares.get(label, 0))
    base = {label for _, label in places}
    ends = (places[0][0], places[-1][0]) if places else (None, None)
    return len(words), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(base | set(shares))), max(shares.values(), default=0.0)


def check(df):
    got = sorted((str(r["doc_id"]), *r[1:]) for r in license_scan(df).collect())
    assert got == sorted((str(r["doc_id"]), *brute(r["text"] or "")) for r in df.collect())


def test_edge_cases(edge):
    check(edge)


def test_documents(small):
    check(small)


def test_crafted_blocks(spark):
    texts = [
        "CC BY cc by Cc-By", "All rights reserved. all  rights\nreserved", "cc by", "acc by", "general public licenses", "GNU General Public License",
        "This is free and unencumbered software released into the domain", "free software\nreleased into the public domain",
        "license the of MIT", "the license of MIT students", "MIT License", "License: Apache license, MIT", "by cc nd", "cc by-nd", "Public Mozilla License", "mozilla\tpublic-license", "amit license", "Redistribution and use in source and binary forms are permitted with modification", "écc by", "ccé by", "K cc by",
        "License Apache " * 500, "x\n" * 2000 + "isc license", " ".join(t for _, t in TEMPLATES + BODIES),
        *("Notice\n \n" + t.replace(" ", "\n", 9)[:k] + "\n\nEnd" for _, t in BODIES for k in (70, 90, 400)), "Apache\nLicense",
    ]
    check(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))


def test_empty(empty):
    assert license_scan(empty).collect() == []


def test_no_python_runs(small):
    plan = license_scan(small)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
