"""Language-model scores: a unigram base and a gated recurrent network.

Counts of all training tokens come from one distributed aggregation.  The most
frequent ``known`` tokens (a fixed bound) are broadcast with their counts; the
counts of all others meet the documents' remaining tokens in an equi-join, so
every count is exact and nothing that grows with the corpus is broadcast.

The network is a GRU over all tokens: each of the ``words`` most frequent is an
input of its own, all others, never seen ones included, go by the class of their
last two bytes.  Its output is factored: a softmax over classes of about equal
probability and the ``tails`` classes of the other tokens, then a softmax within
the class; tokens of a tail class share it by their smoothed counts.  The most
frequent endings have a class each, all others one.

Texts are read twice: for the counts, and to write each document's network ids
(two bytes a token) into the shared folder, from which training and scoring
read.  Training documents are dealt by a hash to as many copies of the network
as there are ``copy_tokens`` tokens, each in the order of that hash, so the
result depends neither on how the input is partitioned nor on the order of its
rows, and a copy sees as much at every size.  A copy's documents are one group
of about eight megabytes of ids.  Copies learn by truncated
backpropagation through time in numpy, carrying the state from window to window.
After each of three rounds (an eighth, three eighths and half of the documents)
parameters and squared gradients are averaged by a tree of fixed-size blocks,
and the next round starts there; every training document is used once.  Scoring
carries the state through complete documents.

Cases: a null text counts as empty (one end token); a null ``doc_id`` counts
as training, and such rows are dealt to copies by their place too, so that equal
ones spread; without training documents counts are zero and the network stays
at its start; repeated rows are scored alike; extra columns are ignored; an
empty table gives an empty result; memory follows the tokens of the documents
that are laid out together, however long one of them is.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, text_or_empty

#: Tokens broadcast with their counts, network words, their classes, classes of other tokens, hidden units.
KNOWN, WORDS, CLASSES, TAILS, HIDDEN = 100_000, 1_024, 24, 32, 12
#: Training tokens of a copy of the network, about, and the rounds: of each the eighths of documents that it sees.
COPY_TOKENS, ROUNDS = 4_000_000, ((0, 1), (1, 4), (4, 8))
#: Truncation of backpropagation, parallel streams, tokens laid out at a time, learning rate.
WINDOW, STREAMS, LAYOUT_TOKENS, RATE = 16, 512, 1_500_000, 0.01
#: Tokens whose classes are looked at together, so that they stay in a core's cache.
COLUMNS = 1_024
#: Tokens of each stream that are laid out at a time: a multiple of WINDOW.
SEGMENT = 1_024
#: Tokens of a document after which training starts afresh, so that one long document keeps all streams busy; scoring never does.
STRETCH = 8_192
#: The token that ends a text; no word is empty.
END = b""
_BLOCKS = 32


def with_fold(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, eighth and text; a document is held out if crc32 of its id, as text, is 1 modulo 5."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(crc % 5 == 1, F.lit(False)).alias("held_out"),
        F.coalesce(F.floor(crc / 5) % 8, F.lit(0)).cast("int").alias("eighth"),
        text_or_empty().alias("text"),
    )


def tokens_of(text: str) -> list[bytes]:
    words = text.encode().lower().split()  # of bytes: A-Z and ASCII blanks only
    words.append(END)
    return words


def token_counts(folds: DataFrame, flush: int = 200_000) -> DataFrame:
    """(token, n) over all training documents."""

    def rows(batches):
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["token", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(tokens_of(text))
                if len(seen) > flush:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    return folds.where("not held_out").select("text").mapInArrow(rows, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, known: int) -> DataFrame:
    """Up to ``known`` of the most frequent tokens: those above a count that no more tokens have.

    The count is found from sizes of logarithmic steps, of which there are a
    few hundred, so nothing is sorted and no candidates meet in one place.
    """
    step = F.floor(F.log("n") * 20)
    sizes = sorted(((r["step"], r["k"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("k")).collect()), reverse=True)
    least, held = float("inf"), 0
    for at, k in sizes:
        if held + k > known:
            break
        least, held = at, held + k
    return counts.where(step >= F.lit(least))


@dataclass
class Vocabulary:
    """What the corpus counts give the network; its size is bounded by KNOWN."""

    rank: dict[bytes, int]
    counts: np.ndarray
    total: int
    distinct: int
    words: int
    starts: np.ndarray  # first word of each class
    endings: dict[bytes, int]  # tail classes of the other tokens; the last is that of any ending not named
    masses: np.ndarray  # what smoothed counts of a tail class's tokens are divided by

    @classmethod
    def of(cls, tokens: list[bytes], counts: list[int], total: int, distinct: int, words: int, classes: int, endings: dict[bytes, tuple[int, int]] | None = None, tails: int = 1) -> Vocabulary:
        """``endings`` says how many training tokens have an ending, and how many distinct ones."""
        counts = np.array(counts, np.float64)
        words = min(words, len(tokens))
        share = np.cumsum(np.sqrt(counts[:words])) / max(1e-9, np.sqrt(counts[:words]).sum())
        starts = np.searchsorted(share, np.arange(classes) / classes) if words else np.zeros(0)
        starts = np.unique(np.clip(starts, 0, max(words - 1, 0))).astype(np.int64)
        left = {e: list(n) for e, n in (endings or {}).items()}
        for token, n in zip(tokens[:words], counts[:words].tolist()):
            if left:
                left[token[-2:]][0] -= n
                left[token[-2:]][1] -= 1
        named = sorted((e for e in left if left[e][1]), key=lambda e: (-left[e][0], e))[: tails - 1]
        masses = np.array([left[e][0] + 0.5 * (left[e][1] + 1) for e in named])  # of each class one token may never have been seen
        n, d = total - counts[:words].sum() - sum(left[e][0] for e in named), distinct - words - sum(left[e][1] for e in named)
        masses = np.append(masses, n + 0.5 * (d + 1))
        return cls({t: i for i, t in enumerate(tokens)}, counts, total, distinct, words, starts if words else np.zeros(0, np.int64), {e: k for k, e in enumerate(named)}, masses)

    def tail_classes(self, tokens) -> np.ndarray:
        get, other = self.endings.get, len(self.masses) - 1
        return np.array([get(t[-2:], other) for t in tokens], np.int64)


class Network:
    """Parameters by name; inputs are words, then the tail classes, and then the start."""

    def __init__(self, vocabulary: Vocabulary, hidden: int, flat: np.ndarray | None = None):
        v, self.hidden, self.words, tails = vocabulary, hidden, vocabulary.words, len(vocabulary.masses)
        self.last = v.words + tails - 1
        self.starts, self.ends = v.starts, np.append(v.starts[1:], v.words) if v.words else v.starts
        self.n_classes = len(v.starts) + tails
        self.class_of = np.append(np.repeat(np.arange(len(v.starts)), self.ends - self.starts), np.arange(len(v.starts), self.n_classes)).astype(_narrow(self.n_classes))
        self.shapes = {"x": (3 * hidden, self.last + 2), "u": (3 * hidden, hidden), "wc": (self.n_classes, hidden), "bc": (self.n_classes,), "wm": (v.words, hidden), "bm": (v.words,)}
        sizes = [math.prod(s) for s in self.shapes.values()]
        if flat is None:
            rng = np.random.default_rng(1)
            flat = np.concatenate([(rng.standard_normal(s[::-1]) * 0.1).T.ravel() if k in ("x", "u", "wc") else rng.standard_normal(math.prod(s)) * 0.1 for k, s in self.shapes.items()])
        self.flat = flat.astype(np.float32)
        at = np.cumsum([0, *sizes])
        for (name, shape), a, b in zip(self.shapes.items(), at, at[1:]):
            setattr(self, name, self.flat[a:b].reshape(shape))
        self.offsets = dict(zip(self.shapes, at))

    def start_at_counts(self, v: Vocabulary) -> Network:
        """Output biases from the smoothed counts, so that training starts from the unigram model."""
        mass = np.log(v.counts[: v.words] + 0.5)
        self.bm[:] = mass
        by_class = [np.exp(mass[a:b]).sum() for a, b in zip(self.starts, self.ends)] + v.masses.tolist()
        self.bc[:] = np.log(np.array(by_class) / sum(by_class))
        self.wm[:], self.wc[:] = 0.1 * self.wm, 0.1 * self.wc
        return self

    def run(self, x: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: bool):
        """States (unit, time, stream) after each row of ``x`` (time, stream); what the way back needs if ``keep``.

        Units come first in all arrays, so every slice of them is contiguous.
        """
        n, kept = self.hidden, []
        states = np.empty((n, *x.shape), np.float32)
        for t in range(len(x)):
            h = h * fresh[t]
            gate, rec = np.take(self.x, x[t], axis=1), self.u @ h
            zr = gate[: 2 * n] + rec[: 2 * n]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r = zr[:n], zr[n:]
            new = np.tanh(gate[2 * n :] + r * rec[2 * n :])
            if keep:
                kept.append((h, z, r, new, rec[2 * n :]))
            h = new + z * (h - new)
            states[:, t] = h
        return states, h, kept

    def output(self, states: np.ndarray, y: np.ndarray, grads: dict | None = None):
        """Natural log probability of each target given its state (unit, row); adds gradients of their sum, if asked."""
        cls = self.class_of[y]
        order = np.argsort(cls, kind="stable")
        states, cls, y, every = states[:, order], cls[order], y[order], np.arange(len(y))
        logs, back = np.empty(len(y), np.float32), None if grads is None else np.empty_like(states)
        for at in range(0, len(y), COLUMNS):
            part = slice(at, at + COLUMNS)
            logit = self.wc @ states[:, part]
            logit += self.bc[:, None]
            logs[part], d = _log_softmax(logit, cls[part], every[: logit.shape[1]], grads is not None)
            if grads is not None:
                grads["wc"] += d @ states[:, part].T
                grads["bc"] += d.sum(axis=1)
                back[:, part] = self.wc.T @ d
        cuts = np.searchsorted(cls, np.arange(len(self.starts) + 1))
        for c, (i, j) in enumerate(zip(cuts, cuts[1:])):
            if i == j:
                continue
            a, b = self.starts[c], self.ends[c]
            s = states[:, i:j]
            more, d = _log_softmax(self.wm[a:b] @ s + self.bm[a:b, None], y[i:j] - a, every[: j - i], grads is not None)
            logs[i:j] += more
            if grads is not None:
                grads["wm"][a:b] += d @ s.T
                grads["bm"][a:b] += d.sum(axis=1)
                back[:, i:j] += self.wm[a:b].T @ d
        score = np.empty_like(logs)
        score[order] = logs
        if back is not None:
            ordered, back = back, np.empty_like(back)
            back[:, order] = ordered
        return score, back

    def back(self, x, fresh, kept, d_states, grads) -> None:
        """Truncated backpropagation through the window."""
        n, dh = self.hidden, 0.0
        d_gates = np.empty((3 * n, *x.shape), np.float32)
        for t in range(len(x) - 1, -1, -1):
            h, z, r, new, rec = kept[t]
            d = d_states[:, t] + dh
            d_new = d * (1 - z) * (1 - new * new)
            d_rec = np.empty((3 * n, x.shape[1]), np.float32)
            d_rec[:n] = d * (h - new) * z * (1 - z)
            d_rec[n : 2 * n] = d_new * rec * r * (1 - r)
            d_rec[2 * n :] = d_new
            d_gates[:, t] = d_rec
            d_rec[2 * n :] *= r
            grads["u"] += d_rec @ h.T
            dh = (d * z + self.u.T @ d_rec) * fresh[t]
        flat_x, flat_g = x.ravel(), d_gates.reshape(3 * n, -1)
        order = np.argsort(flat_x, kind="stable")
        ordered = flat_x[order]
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        grads["x"][:, ordered[first]] += np.add.reduceat(flat_g[:, order], first, axis=1)


def _narrow(n: int):
    """A type for numbers below ``n``; those of 16 bits sort in linear time."""
    return np.uint16 if n <= 1 << 16 else np.int32


def _log_softmax(logit: np.ndarray, hit: np.ndarray, every: np.ndarray, grad: bool):
    """Log probability of outcome ``hit`` in each column, and its gradient, if asked."""
    logit -= logit.max(axis=0)
    logs = logit[hit, every]
    p = np.exp(logit, out=logit)
    norm = p.sum(axis=0)
    logs -= np.log(norm)
    if not grad:
        return logs, None
    p /= -norm
    p[hit, every] += 1
    return logs, p


class Streams:
    """Documents end to end in parallel streams of about equal length, longest first, cut into windows.

    Memory follows the tokens: arrays of SEGMENT tokens of the streams that
    still go on are laid out when they are asked for, so one long document pads
    nothing beyond a segment.
    """

    def __init__(self, docs: list[np.ndarray], n_streams: int, last: int):
        streams: list[list[int]] = [[] for _ in range(n_streams)]
        load = [(0, k) for k in range(n_streams)]
        for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
            n, k = heapq.heappop(load)
            streams[k].append(i)
            heapq.heappush(load, (n + len(docs[i]), k))
        load.sort(reverse=True)
        order = [i for _, k in load for i in streams[k]]
        sizes = np.array([len(docs[i]) for i in order], np.int64)
        self.lengths = np.array([n for n, _ in load], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.y = np.concatenate([docs[i] for i in order])
        self.x = np.empty(len(self.y), _narrow(last + 2))
        self.x[1:] = self.y[:-1]
        self.fresh = np.ones(len(self.y), np.float32)
        first = (np.cumsum(sizes) - sizes)[sizes > 0]
        self.x[first], self.fresh[first] = last + 1, 0
        self.doc = np.repeat(np.array(order, np.int32), sizes)

    def windows(self):
        """As time by stream: input, target (-1 where there is none), 0 where a document starts, and document number."""
        for at in range(0, int(self.lengths[0]), SEGMENT):
            going = self.lengths[self.lengths > at]
            shape = len(going), int(min(SEGMENT, going[0] - at))
            parts = [np.full(shape, *kind) for kind in ((0, self.x.dtype), (-1, np.int32), (1, np.float32), (0, np.int32))]
            for k, (start, n) in enumerate(zip((self.starts + at).tolist(), np.minimum(going - at, shape[1]).tolist())):
                for part, flat in zip(parts, (self.x, self.y, self.fresh, self.doc)):
                    part[k, :n] = flat[start : start + n]
            x, y, fresh, doc = (part.T.copy() for part in parts)
            for step in range(0, shape[1], WINDOW):
                w = slice(step, step + WINDOW), slice(int((going > at + step).sum()))
                yield x[w], y[w], fresh[w], doc[w]


def _streams(docs: list[np.ndarray]) -> int:
    return max(1, min(STREAMS, sum(map(len, docs)) // 128))


def train(net: Network, docs: list[np.ndarray], moments: list[np.ndarray]) -> int:
    """One pass over the documents, by Adam; returns the tokens seen.  Longer ones are learnt in stretches that start afresh."""
    docs = [part for d in docs for part in np.split(d, range(STRETCH, len(d), STRETCH))]
    n = _streams(docs)
    h, seen = np.zeros((net.hidden, n), np.float32), 0
    grad, step = np.zeros_like(net.flat), np.empty_like(net.flat)
    grads = {k: grad[o : o + math.prod(net.shapes[k])].reshape(net.shapes[k]) for k, o in net.offsets.items()}
    for x, y, fresh, _ in Streams(docs, n, net.last).windows():
        real = y >= 0
        count = int(real.sum())
        states, h, kept = net.run(x, fresh, h[:, : x.shape[1]], keep=True)
        grad[:] = 0
        _, back = net.output(states[:, real], y[real], grads)
        d_states = np.zeros_like(states)
        d_states[:, real] = back
        net.back(x, fresh, kept, d_states, grads)
        grad /= count
        moments[2] += 1
        moments[0] *= 0.9
        moments[0] += np.multiply(grad, 0.1, out=step)
        grad *= grad
        grad *= 0.01
        moments[1] *= 0.99
        moments[1] += grad
        fix = np.sqrt(1 - 0.99 ** moments[2]) / (1 - 0.9 ** moments[2])
        np.sqrt(moments[1], out=step)
        step += 1e-6
        np.divide(moments[0], step, out=step)
        step *= np.float32(RATE * fix.item())
        net.flat += step  # gradients point uphill
        seen += count
    return seen


def score(net: Network, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each document's tokens, by class and word of the network."""
    n = _streams(docs)
    h, out = np.zeros((net.hidden, n), np.float32), np.zeros(len(docs))
    for x, y, fresh, doc in Streams(docs, n, net.last).windows():
        real = y >= 0
        states, h, _ = net.run(x, fresh, h[:, : x.shape[1]], keep=False)
        logs, _ = net.output(states[:, real], y[real])
        out += np.bincount(doc[real], weights=logs, minlength=len(docs))
    return out


def _layouts(batches, *columns):
    """Some documents' ids at a time, with the values of other columns, a list each."""
    held, other, size = [], [[] for _ in columns], 0
    for batch in batches:
        for ids, *row in zip(*(batch.column(c).to_pylist() for c in ("ids", *columns))):
            held.append(np.frombuffer(ids, np.uint16).astype(np.int32))
            for values, value in zip(other, row):
                values.append(value)
            size += len(held[-1])
            if size > LAYOUT_TOKENS:
                yield held, other
                held, other, size = [], [[] for _ in columns], 0
    if held:
        yield held, other


_COPY = "part int, block int, weight double, values binary"
_COPY_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("weight", pa.float64()), ("values", pa.binary())])


def _mean_copies(key, rows):
    """One block's mean over a group of copies, always taken in the same order."""
    got = sorted(rows.to_pylist(), key=lambda r: r["part"])
    weight = sum(r["weight"] for r in got)
    values = sum(np.frombuffer(r["values"], np.float32).astype(np.float64) * r["weight"] for r in got) / weight
    one = {"part": key[1].as_py(), "block": got[0]["block"], "weight": weight, "values": values.astype(np.float32).tobytes()}
    return pa.Table.from_pylist([one], schema=_COPY_ARROW)


def train_copies(rows: DataFrame, n_copies: int, shared, state: np.ndarray, hidden: int, fan_in: int = 16) -> np.ndarray:
    """Trains ``n_copies`` copies of the network on rows (mix, ids), from a state of parameters and squared gradients; returns the mean of their states, weighted by tokens."""
    start = rows.sparkSession.sparkContext.broadcast(state)

    def copy(key, rows):
        flat, squares = np.split(start.value.copy(), 2)
        net = Network(shared.value, hidden, flat)
        moments, seen = [np.zeros_like(net.flat), squares, np.full(1, 100.0 if squares.any() else 0.0)], 0
        for docs, _ in _layouts(rows.sort_by("mix").to_batches()):
            seen += train(net, docs, moments)
        parts = np.array_split(np.concatenate([net.flat, moments[1]]).astype(np.float32), _BLOCKS)
        return pa.Table.from_pylist([{"part": key[0].as_py(), "block": k, "weight": float(seen), "values": p.tobytes()} for k, p in enumerate(parts)], schema=_COPY_ARROW)

    means = rows.withColumn("copy", F.pmod("mix", F.lit(n_copies)).cast("int")).groupBy("copy").applyInArrow(copy, _COPY)
    while n_copies > 1:
        means = means.groupBy("block", F.floor(F.col("part") / fan_in).cast("int").alias("parent")).applyInArrow(_mean_copies, _COPY)
        n_copies = math.ceil(n_copies / fan_in)
    blocks = sorted((r["block"], bytes(r["values"])) for r in means.collect())  # _BLOCKS rows
    return np.concatenate([np.frombuffer(v, np.float32) for _, v in blocks]) if blocks else state


#: What is known of a document before the network: sums of log10(c + 0.5) over known tokens, and over those of them in tail classes; of log10 of the classes' masses over all tokens in these.
_KNOWN = {"doc_id": pa.int64(), "held_out": pa.bool_(), "eighth": pa.int32(), "n_tokens": pa.int64(), "n_known": pa.int64(), "sum_known": pa.float64(), "sum_tail": pa.float64(), "sum_mass": pa.float64()}
_READ = _KNOWN | {"tokens": pa.list_(pa.binary()), "times": pa.list_(pa.int32()), "ids": pa.binary()}
_KNOWN_DDL = "doc_id long, held_out boolean, eighth int, n_tokens long, n_known long, sum_known double, sum_tail double, sum_mass double"


def _read(shared):
    """Reads each text once: its network ids, its known tokens' sums, and its other tokens."""

    def rows(batches):
        v = shared.value
        logs, get, masses = np.log10(v.counts + 0.5), v.rank.get, np.log10(v.masses)
        id_of = np.append(np.arange(v.words), v.words + v.tail_classes(list(v.rank)[v.words :]))
        for batch in batches:
            out = []
            for doc_id, held, eighth, text in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = tokens_of(text)
                ranks = np.fromiter(map(get, tokens, repeat(-1)), np.int64, len(tokens))
                known, other = ranks[ranks >= 0], np.flatnonzero(ranks < 0)
                rest = [tokens[i] for i in other.tolist()]
                ids = id_of[ranks] if len(known) else ranks
                ids[other] = v.words + v.tail_classes(rest)
                in_tail, rest = known[known >= v.words], Counter(rest)
                mass = masses[ids[ids >= v.words] - v.words].sum()
                out.append((doc_id, held, eighth, len(tokens), len(known), logs[known].sum(), logs[in_tail].sum(), mass, list(rest), list(rest.values()), ids.astype(np.uint16).tobytes()))
            columns = zip(*out) if out else [[]] * len(_READ)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _READ.values())], names=list(_READ))

    return rows, _KNOWN_DDL + ", tokens array<binary>, times array<int>, ids binary"


def _scored(shared, state, hidden: int):
    """Adds the network's log10 probability of each document's ids to what is known of it."""
    kinds = {"row_no": pa.int64()} | _KNOWN | {"sum_net": pa.float64()}

    def rows(batches):
        net = Network(shared.value, hidden, np.split(state.value, 2)[0])
        for docs, columns in _layouts(batches, *list(kinds)[:-1]):
            columns = [*columns, score(net, docs) / math.log(10)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], names=list(kinds))

    return rows, f"row_no long, {_KNOWN_DDL}, sum_net double"


def lm_score(docs: DataFrame, known: int = KNOWN, words: int = WORDS, classes: int = CLASSES, hidden: int = HIDDEN, copy_tokens: int = COPY_TOKENS, tails: int = TAILS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``words`` and ``tails`` are 65,535 at most together: network ids take two bytes.
    """
    sc, folds = docs.sparkSession.sparkContext, with_fold(docs)
    counts = cut(token_counts(folds))
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = sorted(most_frequent(counts, known).collect(), key=lambda r: (-r["n"], r["token"]))  # ``known`` rows at most
    by_ending = counts.groupBy(F.substring("token", -2, 2).alias("ending")).agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()  # of two bytes at most
    endings = {bytes(r["ending"]): (r["n"], r["k"]) for r in by_ending}
    v = Vocabulary.of([bytes(r["token"]) for r in top], [r["n"] for r in top], total, distinct, min(words, 65_535 - tails), classes, endings, tails)
    shared = sc.broadcast(v)
    read, schema = _read(shared)
    texts = cut(folds.mapInArrow(read, schema).withColumn("row_no", F.monotonically_increasing_id()))
    flat = Network(v, hidden).start_at_counts(v).flat
    state = np.concatenate([flat, np.zeros_like(flat)])
    if v.words:
        learnt = texts.where("not held_out").select("eighth", "ids", F.xxhash64("doc_id", "ids", F.when(F.col("doc_id").isNull(), F.col("row_no"))).alias("mix"))
        for first, last in ROUNDS:
            state = train_copies(learnt.where(F.col("eighth").between(first, last - 1)), max(1, round(total / copy_tokens)), shared, state, hidden)

    rows, schema = _scored(shared, sc.broadcast(state), hidden)
    scored = texts.select("row_no", *_KNOWN, "ids").mapInArrow(rows, schema)
    tail = texts.select("row_no", F.explode(F.arrays_zip("tokens", "times")).alias("t")).select("row_no", F.col("t.tokens").alias("token"), F.col("t.times").alias("times"))
    met = tail.join(counts, "token", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    per_row = met.groupBy(F.col("row_no").alias("tail_row")).agg(
        F.sum(F.col("times") * F.log10(F.col("c") + 0.5)).alias("sum_rest"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known_rest")
    )
    joined = scored.join(per_row, F.col("row_no") == F.col("tail_row"), "left")
    rest = F.coalesce("sum_rest", F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known_rest", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("sum_known") + rest - F.col("n_tokens") * F.lit(math.log10(total + 0.5 * (distinct + 1)))).alias("base_score"),
        (F.col("sum_net") + F.col("sum_tail") + rest - F.col("sum_mass")).alias("score"),
    )
