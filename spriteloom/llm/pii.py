"""Personal data by weak supervision, in DataFrame expressions only.

Candidate spans come from one regular expression a kind.  Five labelers vote on
every candidate (+1, -1, or 0 to abstain): the kind's own regular expression or
checksum, a gazetteer of words nearby, what stands just before the span, the
mix of its characters, and its length.  Candidates with the same kind and votes
are alike, so a partial aggregation counts them by pattern: a few hundred rows
at any size of input.  Over these counts expectation-maximisation estimates the
labelers' reliabilities, and a logistic span classifier is trained on its
posteriors; the weights go back into the plan as literals.  Verified email, ip,
card and phone spans always stay, and candidates of these kinds that fail their
test never do; candidates of the other kinds (secrets, ssns, local phone numbers
after a word for them, names after a title) stay if the classifier says so.

Texts are read once: spans and votes are written into the shared folder, and
counts, weights and results come from there.  A candidate is found by setting
marks around it and splitting at the marks; places are sums over blocks of about
the root of the number of parts, so very many matches in one text are no trouble.

Cases: a null text counts as empty and has no spans; positions are code points;
quantifiers never give back what they took and starts are anchored at the start
of a run, so long runs take linear time; repeated rows are judged alike; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_or_empty

#: Kind: pattern of its candidates, and a cheaper one that any text with a candidate contains.  The first four
#: are in the order in which spans that start together are listed.
KINDS = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "[0-9][ -]?[0-9]"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    "secret": (r"(?<![A-Za-z0-9_])(?=[A-Za-z_]*+[0-9])[A-Za-z0-9_]{16,}+", "[A-Za-z0-9_]{16}"),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-[0-9]{2}-"),
    "local": (r"(?i)(?<=(?:tel|phone|fax|mobile|call|anruf)[.:\x20]{1,3})\(?[0-9][0-9\x20()./-]{5,18}[0-9]", r"[.:\x20]\(?[0-9]"),
    "name": (
        r"(?<![A-Za-z])(?:M(?:rs?|s|adame|onsieur)|Dr|Prof|Herr|Frau|Señora?)\.?\x20[A-Z][a-z]+(?:\x20[A-Z][a-z]+)?",
        r"(?:M(?:rs?|s|adame|onsieur)|Dr|Prof|Herr|Frau|Señora?)\.?\x20[A-Z]",
    ),
}
BASE = ("email", "ip", "card", "phone")
#: Words whose presence shortly before a span speaks for its kind.
GAZETTEER = {
    "email": "mail|contact|write|correo|courriel|kontakt",
    "ip": r"\bip|host|server|addr|client",
    "card": "card|visa|credit|karte|carte|tarjeta",
    "phone": "tel|phone|call|fax|mobile|anruf",
    "secret": "token|secret|passw|passwd|pwd|api.?key|credential|bearer|akia",
    "ssn": "ssn|social|security",
    "local": "tel|phone|call|fax|mobile|anruf",
    "name": "name|author|dear|signed|from|contact|patient|customer|sincerely",
}
#: Characters before a span that count as its context.
CONTEXT = 24
VOTES = ("v_regex", "v_words", "v_before", "v_mix", "v_length")
#: A mark around candidates, and what stands for it in texts that hold it; no pattern knows either.
_MARK, _OTHER = "\x1e", "\x1f"


def _let(value: Column, body) -> Column:
    """``body`` of the value, which is computed once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def _each_match(parts: Column, of) -> Column:
    """``of(start, match, text before)`` of each match; matches are every second of the parts."""
    n = F.size(parts)
    width = F.ceil(F.sqrt(n)).cast("int")

    def placed(blocks, offsets):
        def one(j):
            k = F.floor(j / width).cast("int")
            return of(offsets[k] + _sum(F.slice(blocks[k], 1, j % width)), parts[j], parts[j - 1])

        return F.transform(F.sequence(F.lit(1), n - 2, F.lit(2)), one)

    def summed(blocks):
        sums = F.transform(blocks, _sum)
        return _let(sums, lambda t: _let(F.transform(F.sequence(F.lit(0), F.size(t) - 1), lambda k: _sum(F.slice(t, 1, k))), lambda o: placed(blocks, o)))

    def cut_up(lengths):
        return _let(F.transform(F.sequence(F.lit(0), F.floor((n - 1) / width).cast("int")), lambda k: F.slice(lengths, k * width + 1, width)), summed)

    return F.when(n > 2, _let(F.transform(parts, F.length), cut_up))


def _spans(kind: str) -> Column:
    """(start, stop, votes) of the kind's candidates in ``text``; null where there are none."""
    pattern, hint = KINDS[kind]
    marked = F.regexp_replace(F.translate("text", _MARK, _OTHER), F.lit(pattern), F.lit(f"{_MARK}$0{_MARK}"))

    def span(start, match, before):
        cast = votes(kind, match, F.right(before, F.lit(CONTEXT)))
        return F.struct(start.alias("start"), (start + F.length(match)).alias("stop"), *(v.cast("int").alias(n) for n, v in cast.items()))

    return F.when(F.col("text").rlike(hint), _let(F.split(marked, _MARK, -1), lambda parts: _each_match(parts, span)))


def candidates(docs: DataFrame, rest: Column | None = None, with_text: bool = False) -> DataFrame:
    """doc_id, text if asked for, rest, and for each kind an array of its candidate spans with their votes, written once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), (F.lit(0) if rest is None else rest).alias("rest"))
    none = F.array().cast(f"array<struct<start:int,stop:int,{','.join(f'{v}:int' for v in VOTES)}>>")
    return cut(rows.select("doc_id", *(["text"] if with_text else []), "rest", *(F.coalesce(_spans(k), none).alias(k) for k in KINDS)))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    digits = _digits(text)
    n = F.length(digits)
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    digit = lambda i: F.substring(digits, n - i, F.lit(1)).cast("int")
    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + F.when(i % 2 == 1, doubled(digit(i))).otherwise(digit(i)))
    return F.when(n.between(12, 19), total % 10 == 0).otherwise(F.lit(False))


def verified(kind: str, text: Column) -> Column:
    """Does the candidate pass its kind's own test?"""
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
        return text.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return _luhn(text)
    if kind == "phone":
        return F.length(_digits(text)).between(9, 15)
    if kind == "secret":
        return text.rlike("^(?:AKIA[0-9A-Z]{16}|[0-9a-f]{16,}|[A-Za-z]+_[A-Za-z0-9]{16,})$")
    if kind == "local":
        return F.length(_digits(text)).between(7, 12)
    if kind == "name":
        return text.rlike(r"\x20[A-Z][a-z]+\x20[A-Z][a-z]+$")
    return F.lit(True)


def votes(kind: str, text: Column, before: Column) -> dict[str, Column]:
    """The labelers' votes on a candidate and what stands before it."""
    before = F.lower(before)
    n, n_digits = F.length(text), F.length(_digits(text))
    low, high = {"email": (8, 60), "ip": (7, 15), "card": (12, 23), "phone": (10, 22), "secret": (18, 64), "ssn": (11, 11), "local": (8, 18), "name": (6, 40)}[kind]
    sign = lambda yes: F.when(yes, 1).otherwise(-1)
    mixed = {"secret": (n_digits >= 4) & (n_digits < n), "email": text.rlike(r"\.[A-Za-z]{2,}$"), "name": n_digits == 0}.get(kind, n_digits * 2 > n)
    return {
        "v_regex": sign(verified(kind, text)),
        "v_words": F.when(F.concat(before, F.lower(text)).rlike(GAZETTEER[kind]), 1).otherwise(0),
        "v_before": F.when(before.rlike(r"[=:]\s*[\"']?$"), 1).when(before.rlike(r"[\w.-]$"), -1).otherwise(0),
        "v_mix": sign(mixed),
        "v_length": sign(n.between(low, high)),
    }


def pattern_counts(found: DataFrame) -> list[tuple[str, tuple[int, ...], int]]:
    """(kind, votes, number of candidates): at most 243 rows a kind."""

    def voted(kind):
        return lambda s: F.struct(F.lit(kind).alias("kind"), *(s[v].alias(v) for v in VOTES))

    spans = [F.transform(F.col(k), voted(k)) for k in KINDS]
    counted = found.select(F.explode(F.concat(*spans)).alias("s")).groupBy("s.kind", *(f"s.{v}" for v in VOTES)).agg(F.count("*").alias("n"))
    return sorted((r["kind"], tuple(r[v] for v in VOTES), r["n"]) for r in counted.collect())


def estimate(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = 40) -> tuple[list[float], list[float]]:
    """Expectation-maximisation over pattern counts: each pattern's posterior, and each labeler's reliability."""
    total = sum(n for *_, n in patterns) or 1
    posterior = [min(0.95, max(0.05, 0.5 + 0.15 * sum(v))) for _, v, _ in patterns]
    hit = miss = [0.5] * len(VOTES)
    for _ in range(rounds):
        prior = sum(p * n for p, (*_, n) in zip(posterior, patterns)) / total
        prior = min(0.99, max(0.01, prior))

        def rate(j, weight):
            cast = [(weight(p) * n, v[j]) for p, (_, v, n) in zip(posterior, patterns) if v[j]]
            return (1 + sum(w for w, v in cast if v > 0)) / (2 + sum(w for w, _ in cast))

        hit = [rate(j, lambda p: p) for j in range(len(VOTES))]  # votes yes on a true span
        miss = [rate(j, lambda p: 1 - p) for j in range(len(VOTES))]  # votes yes on another
        for k, (_, v, _) in enumerate(patterns):
            z = math.log(prior / (1 - prior))
            for j, x in enumerate(v):
                if x:
                    z += math.log(hit[j] / miss[j]) if x > 0 else math.log((1 - hit[j]) / (1 - miss[j]))
            posterior[k] = 1 / (1 + math.exp(-max(-30, min(30, z))))
    return posterior, [(h + 1 - m) / 2 for h, m in zip(hit, miss)]


def train(patterns: list, posterior: list[float], steps: int = 400, rate: float = 0.5) -> tuple[list[float], dict[str, float]]:
    """Logistic span classifier on the posteriors: a weight for each labeler, a bias for each kind."""
    weights, bias = [0.0] * len(VOTES), dict.fromkeys(KINDS, 0.0)
    total = {k: sum(n for kind, _, n in patterns if kind == k) or 1 for k in KINDS}
    everything = sum(total[k] for k in {p[0] for p in patterns}) or 1
    for _ in range(steps):
        dw, db = [0.0] * len(VOTES), dict.fromkeys(KINDS, 0.0)
        for (kind, v, n), p in zip(patterns, posterior):
            z = bias[kind] + sum(w * x for w, x in zip(weights, v))
            error = p - 1 / (1 + math.exp(-max(-30, min(30, z))))
            dw = [d + error * n * x / everything for d, x in zip(dw, v)]
            db[kind] += error * n / total[kind]
        weights = [w + rate * d for w, d in zip(weights, dw)]
        bias = {k: b + rate * db[k] for k, b in bias.items()}
    return weights, bias


def span_table(docs: DataFrame, rest: Column | None = None, with_text: bool = False) -> DataFrame:
    """doc_id, text if asked for, rest, base and spans: arrays of (start, kind_no, kind, stop), sorted."""
    found = candidates(docs, rest, with_text)
    patterns = pattern_counts(found)
    weights, bias = train(patterns, estimate(patterns)[0])
    kinds = list(KINDS)
    carried = [c for c in ("doc_id", "text", "rest") if c in found.columns]

    def named(kind, keep):
        spans = F.filter(F.col(kind), keep)
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kinds.index(kind)).alias("kind_no"), F.lit(kind).alias("kind"), s["stop"].alias("stop")))

    def likely(kind):
        return lambda s: sum((F.lit(w) * s[v] for w, v in zip(weights, VOTES)), F.lit(bias[kind])) > 0

    rows = found.select(
        *carried,
        F.array_sort(F.concat(*(named(k, lambda s: s["v_regex"] > 0) for k in BASE))).alias("base"),
        F.concat(*(named(k, likely(k)) for k in kinds if k not in BASE)).alias("more"),
    )
    apart = F.filter("more", lambda s: ~F.exists("base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
    return rows.select(*carried, "base", F.array_sort(F.concat("base", apart)).alias("spans"))


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(F.col(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def pii_spans(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans (all of them)."""

    def of(kind):
        return lambda s: s["kind"] == kind

    counts = [F.size(F.filter("base", of(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return span_table(docs).select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span of ``text`` replaced by its kind in brackets; other columns stay."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    spans = span_table(docs, F.struct(*others) if others else None, with_text=True)

    def step(acc, s):
        clear = s["start"] >= acc["pos"]
        gap = F.concat(F.substring(F.col("text"), acc["pos"] + 1, s["start"] - acc["pos"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["pos"], s["stop"]).alias("pos"), F.when(clear, F.concat(acc["out"], F.array(gap))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate("spans", start, step)
    rebuilt = spans.withColumn("__done", F.when(F.size("spans") > 0, done))
    text = F.when(F.col("__done").isNull(), F.col("text")).otherwise(
        F.concat(F.array_join("__done.out", ""), F.substring(F.col("text"), F.col("__done.pos") + 1, F.length("text")))
    )
    return rebuilt.select(*[text.alias("text") if c == "text" else F.col(c) if c == "doc_id" else F.col("rest")[c].alias(c) for c in docs.columns])
