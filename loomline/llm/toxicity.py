"""Toxic spans by a linear-chain conditional random field over words.

Labels exist per document only, so words are labelled first: a word of a toxic document
is toxic if it, or a prefix of it, occurs in many toxic documents and in hardly any clean
one. A two-state chain is then trained on these labelled words by maximum likelihood, on a
bounded sample of documents. Scoring runs over whole texts: forward-backward gives each
word's marginal, the document's score is the probability that any word is toxic, were they
independent, and words with a marginal of a half or more are reported with their offsets.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bounds of the sample that the chain is fitted on: toxic and clean documents, and the longest text in it.
TOXIC_DOCS, CLEAN_DOCS, LONGEST = 1500, 3000, 20_000
EDGE = ".,;:!?\"'()[]{}<>*#$%&|-_/\\"
PREFIXES = (3, 4, 5)
#: A feature marks a toxic word if so many toxic documents hold it, and a share of them so many times that of the clean ones.
LEAST_DOCS, LEAST_RATIO = 3, 50.0
WINDOW, STEPS, RATE, PENALTY = 32, 100, 0.3, 1e-4
SPANS = "array<struct<start:int,length:int,marginal:double>>"


def features(word: str) -> list[str]:
    """The word without edge punctuation, and its prefixes."""
    w = word.strip(EDGE)
    return [f"={w}", *[w[:n] for n in PREFIXES if len(w) >= n]] if w else []


class Chain:
    """A two-state chain: transition scores, and a score of the toxic state from a word's features."""

    def __init__(self, weights: dict[str, float], bias: float, moves: np.ndarray, start: float):
        self.weights, self.bias, self.moves, self.start = weights, bias, np.exp(moves), start
        plain = self.moves * np.array([1.0, np.exp(bias)])
        values, self.right = np.linalg.eig(plain)
        order = np.argsort(-values.real)
        self.right, self.decay = self.right[:, order].real, (values[order] / values[order[0]]).real
        self.left = np.linalg.inv(self.right)

    def emission(self, word: str) -> float:
        """What the word's features add to the toxic state; 0 for words without a known feature."""
        get = self.weights.get
        return sum(get(f, 0.0) for f in features(word))

    def run(self, n: int) -> np.ndarray:
        """The transfer over n words without a known feature, up to a factor."""
        return (self.right * self.decay**n) @ self.left if n else np.eye(2)

    def marginals(self, n: int, at: list[int], scores: list[float]) -> list[float]:
        """Probability of the toxic state at those of n words that have known features."""
        gains = [np.array([1.0, np.exp(min(self.bias + s, 50.0))]) for s in scores]
        gaps = [at[0] - 1, *[b - a - 1 for a, b in zip(at, at[1:], strict=False)], n - 1 - at[-1]]
        first = np.array([1.0, np.exp(self.start + self.bias)])
        forward, a = [], None
        for i, g in enumerate(gains):
            if i == 0:
                a = np.array([1.0, np.exp(self.start)]) * g if at[0] == 0 else first @ self.run(gaps[0]) @ self.moves * g
            else:
                a = a @ self.run(gaps[i]) @ self.moves * g
            a = a / a.sum()
            forward.append(a)
        out, b = [], self.run(gaps[-1]) @ np.ones(2)
        for i in range(len(at) - 1, -1, -1):
            b = b / b.sum()
            both = forward[i] * b
            out.append(float(both[1] / both.sum()))
            b = self.run(gaps[i]) @ (self.moves @ (gains[i] * b))
        return out[::-1]


def weak_labels(docs: list[tuple[str, int]]) -> tuple[list[tuple[list[str], np.ndarray]], set[str]]:
    """([(words, word labels)], the marking features). Near copies count as one document.

    Each distinct word is held once, however many texts have it.
    """
    groups: dict[int, tuple[list[str], int]] = {}
    held: dict[str, str] = {}
    for text, toxic in docs:
        words = [held.setdefault(w, w) for w in text.lower().split()]
        key = min((xxhash.xxh3_64_intdigest(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0)
        groups.setdefault(key, (words, toxic))
    sides = Counter(toxic for _, toxic in groups.values())
    counts = {0: Counter(), 1: Counter()}
    for words, toxic in groups.values():
        counts[toxic].update({f for w in set(words) for f in features(w)})
    share = lambda n, side: n / max(1, sides[side])
    marks = {f for f, n in counts[1].items() if n >= LEAST_DOCS and share(n, 1) >= LEAST_RATIO * share(counts[0][f] + 0.5, 0)}
    known = {w: any(f in marks for f in features(w)) for words, toxic in groups.values() if toxic for w in set(words)}
    return [(words, np.fromiter((bool(toxic) and known[w] for w in words), np.int8, len(words))) for words, toxic in groups.values()], marks


def train(docs: list[tuple[str, int]]) -> Chain:
    """Fit the chain by gradient steps on the likelihood of the labelled words, in windows.

    All windows with a known feature are used, and of the others one in ten. Without toxic
    documents the chain marks nothing.
    """
    labelled, marks = weak_labels(docs)
    relevant = {f for words, ys in labelled for w, y in zip(words, ys, strict=True) if y for f in features(w)} if marks else set()
    # Features of harmless words that share a prefix with toxic ones, so that those can weigh against it.
    near = Counter(f for words, _ in labelled for w in words if not relevant.isdisjoint(features(w)) for f in features(w))
    relevant |= {f for f, n in near.items() if n >= LEAST_DOCS}
    ids = {f: i + 1 for i, f in enumerate(sorted(relevant))}
    if not ids:
        return Chain({}, -10.0, np.zeros((2, 2)), 0.0)
    columns, ys, plain = [], [], 0
    for words, labels in labelled:
        for a in range(0, len(words), WINDOW):
            part = [[ids.get(f, 0) for f in features(w)] for w in words[a : a + WINDOW]]
            if not any(map(any, part)):
                plain += 1
                if plain % 10:
                    continue
            window, marked = np.zeros((WINDOW, 1 + len(PREFIXES)), np.int32), np.full(WINDOW, -1, np.int8)
            for i, r in enumerate(part):
                window[i, : len(r)] = r
            marked[: len(part)] = labels[a : a + WINDOW]
            columns.append(window)
            ys.append(marked)
    del labelled
    x, y = np.array(columns), np.array(ys)
    del columns, ys
    seen, y = y >= 0, np.maximum(y, 0)
    theta = np.zeros(len(ids) + 1 + 5)  # weights (0 for no feature), bias, three transitions, start
    theta[len(ids) + 1] = -3.0
    speed, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        grad = gradient(theta, x, y, seen, len(ids)) + PENALTY * np.r_[theta[: len(ids) + 1], np.zeros(5)]
        grad[0] = 0.0
        speed, square = 0.9 * speed + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        theta -= RATE * (speed / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    bias, t01, t10, t11, start = theta[len(ids) + 1 :]
    return Chain({f: float(theta[i]) for f, i in ids.items()}, float(bias), np.array([[0.0, t01], [t10, t11]]), float(start))


def gradient(theta: np.ndarray, x: np.ndarray, y: np.ndarray, seen: np.ndarray, n_features: int) -> np.ndarray:
    """Gradient of the mean negative log-likelihood: expected counts under the model less observed ones."""
    weights, (bias, t01, t10, t11, start) = theta[: n_features + 1], theta[n_features + 1 :]
    moves = np.exp(np.array([[0.0, t01], [t10, t11]]))
    emit = np.ones((*y.shape, 2))
    emit[..., 1] = np.exp(np.clip(sum(weights[x[..., k]] for k in range(x.shape[-1])) + bias, -40, 40))
    n, length = y.shape
    f, b = np.zeros((length, n, 2)), np.ones((length, n, 2))
    f[0] = emit[:, 0] * np.array([1.0, np.exp(start)])
    f[0] /= f[0].sum(1, keepdims=True)
    for t in range(1, length):
        nxt = f[t - 1] @ moves * emit[:, t]
        f[t] = np.where(seen[:, t, None], nxt / nxt.sum(1, keepdims=True), f[t - 1])
    for t in range(length - 2, -1, -1):
        back = (b[t + 1] * emit[:, t + 1]) @ moves.T
        b[t] = np.where(seen[:, t + 1, None], back / back.sum(1, keepdims=True), b[t + 1])
    p = np.empty(y.shape)
    for t in range(length):
        both = f[t] * b[t]
        p[:, t] = both[:, 1] / both.sum(-1)
    expected = np.zeros((2, 2))
    for t in range(1, length):  # a place at a time, so that no array holds all pairs
        pair = f[t - 1, :, :, None] * moves * (b[t] * emit[:, t])[:, None, :]
        expected += (pair / pair.sum((1, 2), keepdims=True) * seen[:, t, None, None]).sum(0)
    counted = np.zeros((2, 2))
    np.add.at(counted, (y[:, :-1][seen[:, 1:]], y[:, 1:][seen[:, 1:]]), 1)
    error = (p - y) * seen
    by_feature = sum(np.bincount(x[..., k].ravel(), error.ravel(), n_features + 1) for k in range(x.shape[-1]))
    moved = expected - counted
    return np.r_[by_feature, error.sum(), moved[0, 1], moved[1, 0], moved[1, 1], error[:, 0].sum()] / max(1, n)


class Memo(dict):
    """Emission scores by word, made when first asked for; starts anew when it is full."""

    def __init__(self, chain: Chain):
        self.chain = chain

    def __missing__(self, word: str) -> float:
        if len(self) > 400_000:
            self.clear()
        self[word] = score = self.chain.emission(word)
        return score


def score_text(chain: Chain, memo: Memo, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
    """(document score, [(start, length, marginal)] of the toxic words in characters)."""
    words = (text or "").lower().split()
    scores = list(map(memo.__getitem__, words))
    at = [i for i, s in enumerate(scores) if s]
    if not at:
        return 0.0, []
    marginals = chain.marginals(len(words), at, [scores[i] for i in at])
    clean = 1.0
    for m in marginals:
        clean *= 1.0 - m
    wanted = {i: m for i, m in zip(at, marginals, strict=True) if m >= 0.5}
    spans = [(m.start(), len(m[0]), wanted[i]) for i, m in enumerate(re.finditer(r"\S+", text)) if i in wanted] if wanted else []
    return 1.0 - clean, spans


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def labelled_sample(docs: DataFrame, labels: DataFrame) -> list[tuple[str, int]]:
    """Texts and labels of up to TOXIC_DOCS and CLEAN_DOCS documents outside the held-out fold, by the hash of doc_id."""
    usable = labels.where("toxic is not null and doc_id is not null").where(fold(F.col("doc_id")) != 0).select("doc_id", F.col("toxic").cast("int").alias("_toxic"))
    picked = [usable.where(F.col("_toxic") == side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for side, most in ((1, TOXIC_DOCS), (0, CLEAN_DOCS))]
    ids = picked[0].union(picked[1])
    # At most TOXIC_DOCS + CLEAN_DOCS ids, and texts of at most LONGEST characters each.
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").where(F.length("text").between(1, LONGEST))
    rows = found.select("doc_id", "text", "_toxic").orderBy("doc_id", "text").limit(2 * (TOXIC_DOCS + CLEAN_DOCS)).collect()
    return [(r["text"], r["_toxic"]) for r in rows]


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with ``toxicity`` (0 to 1) and ``toxic_spans`` (start, length, marginal of each toxic word).

    Only the text decides the score: null, empty and spotless texts score 0. Repeated rows
    score alike. Labels of doc_ids whose CRC-32 is divisible by 5 are never read.
    """
    chain = train(labelled_sample(docs, labels))
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def scan(batches):
        memo = Memo(shared.value)
        for batch in batches:
            made = [score_text(shared.value, memo, t.as_py()) for t in batch.column("text")]
            spans = pa.array([[{"start": a, "length": n, "marginal": m} for a, n, m in s] for _, s in made], pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("marginal", pa.float64())])))
            kept = [i for i, name in enumerate(batch.schema.names) if name not in ("toxicity", "toxic_spans")]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], pa.array([s for s, _ in made], pa.float64()), spans], [*[batch.schema.names[i] for i in kept], "toxicity", "toxic_spans"])

    rest = docs.drop("toxicity", "toxic_spans")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return rest.mapInArrow(scan, f"{fields}, toxicity double, toxic_spans {SPANS}")
