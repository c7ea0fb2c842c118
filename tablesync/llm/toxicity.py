"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A word enters as its own vector, if it was frequent among the training words,
beside the mean vector of all its character trigrams. Long runs without a blank
enter as several overlapping words. The network reads a window of
words in both directions, attention pools the states, and a logistic output
scores the window. All overlapping windows of a text are scored; the largest
counts, and a logistic curve fitted on whole documents turns it into the score.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.llm.decontaminate import words as folded_words
from tablesync.llm.frames import bytes_of, map_batches, packed, text_of, written

WINDOW, STEP = 64, 32
_CHAR_BUCKETS = 4096
_BLOCK = 1024
#: Words of more than ``_LONG`` bytes are cut after every ``_PIECE``; two bytes overlap, so no trigram is lost.
_LONG, _PIECE = 48, 16
#: Blanks, dashes, quotes and full stops beyond ASCII.
_BETWEEN = re.compile(rb"\xc2[\xa0\xab\xbb]|\xe2\x80[\x80-\xaf]|\xe3\x80[\x80-\x82]|\xef\xbc[\x81\x8c\x9a\x9b\x9f]")


@dataclass(frozen=True)
class Settings:
    """Bounds of the training sample and sizes of the network.

    ``docs_per_class`` labelled documents of each class, the first by a hash of
    their id, are the sample. Training takes ``windows_per_doc`` windows of each,
    drawn from all of its windows, and of each toxic one the worst of all. The
    curve of scores, like scoring, covers every window of every text.
    """

    docs_per_class: int = 1500
    windows_per_doc: int = 24
    vocabulary: int = 20_000
    word_size: int = 10
    char_size: int = 10
    hidden: int = 12
    attention: int = 8
    epochs: int = 5
    batch: int = 128
    rate: float = 0.01
    seed: int = 5


def words_of(text: bytes) -> list[bytes]:
    """Words as the network reads them; every byte of a word is in one of them."""
    own = folded_words(text if text.isascii() else _BETWEEN.sub(b" ", text))
    if not own or max(map(len, own)) <= _LONG:
        return own
    return [p for w in own for p in ([w] if len(w) <= _LONG else [w[i : i + _PIECE + 2] for i in range(0, len(w) - 2, _PIECE)])]


def window_bounds(n_words: int) -> list[tuple[int, int]]:
    """All windows of ``WINDOW`` words, ``STEP`` apart; the last one reaches the end."""
    if n_words <= WINDOW:
        return [(0, n_words)] if n_words else []
    starts = range(0, n_words - WINDOW + STEP, STEP)
    return [(s, min(s + WINDOW, n_words)) for s in starts]


def _grams(word: bytes) -> list[int]:
    """Buckets of all trigrams of a word."""
    marked = b"^" + word + b"$"
    return [xxhash.xxh32_intdigest(marked[s : s + 3]) % _CHAR_BUCKETS + 1 for s in range(len(marked) - 2)]


def _features(words: list[bytes], known: dict[bytes, int]):
    """Word numbers, the trigram buckets of all words behind each other, and how many each word has."""
    ids = np.array([known.get(w, 0) for w in words], np.int64)
    grams = [_grams(w) for w in words]
    sizes = np.fromiter(map(len, grams), np.int64, len(grams))
    return ids, np.fromiter((g for own in grams for g in own), np.int64, int(sizes.sum())), sizes


def _picked(features, used: np.ndarray):
    """The features of some words."""
    ids, grams, sizes = features
    starts, own = np.cumsum(sizes) - sizes, sizes[used]
    at = np.arange(own.sum()) + np.repeat(starts[used] - (np.cumsum(own) - own), own)
    return ids[used], grams[at], own


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


@dataclass
class Network:
    known: dict[bytes, int]
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    #: Slope and offset of the curve from a text's largest window to its score.
    curve: tuple[float, float] = (1.0, 0.0)

    @classmethod
    def fresh(cls, known: dict[bytes, int], s: Settings) -> Network:
        rng = np.random.default_rng(s.seed)
        size = s.word_size + s.char_size

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return cls(known, {
            "word": normal(len(known) + 1, s.word_size, scale=0.1) * (np.arange(len(known) + 1) > 0)[:, None].astype(np.float32),
            "char": normal(_CHAR_BUCKETS + 1, s.char_size, scale=0.3),
            "w": normal(2, size, 3 * s.hidden, scale=size**-0.5),
            "u": normal(2, s.hidden, 3 * s.hidden, scale=s.hidden**-0.5),
            "b": np.zeros((2, 1, 3 * s.hidden), np.float32),
            "att_w": normal(2 * s.hidden, s.attention, scale=(2 * s.hidden) ** -0.5),
            "att_b": np.zeros(s.attention, np.float32),
            "att_v": normal(s.attention, scale=s.attention**-0.5),
            "out_w": normal(2 * s.hidden, scale=(2 * s.hidden) ** -0.5),
            "out_b": np.zeros(1, np.float32),
        })

    def inputs(self, ids, grams, sizes) -> np.ndarray:
        p = self.weights
        out = np.empty((len(ids), p["word"].shape[1] + p["char"].shape[1]), p["char"].dtype)
        out[:, : p["word"].shape[1]] = p["word"][ids]
        ends = np.cumsum(sizes)
        for i in range(0, len(ids), 8192):  # the vectors of all trigrams would take much memory
            own, start = sizes[i : i + 8192], ends[i] - sizes[i]
            stop = ends[i + len(own) - 1]
            sums = np.add.reduceat(p["char"][grams[start:stop]], np.cumsum(own) - own, axis=0)
            out[i : i + 8192, p["word"].shape[1] :] = sums / own[:, None].astype(sums.dtype)
        return out

    def projected(self, x: np.ndarray) -> np.ndarray:
        """What a word adds to the gates, for both directions."""
        return np.matmul(x[None], self.weights["w"]) + self.weights["b"]

    def states(self, gates: np.ndarray, index: np.ndarray, mask: np.ndarray | None, keep: list | None = None):
        """Hidden states [time, both directions, window, hidden], in the order of reading."""
        u = self.weights["u"]
        n, steps, size = index.shape[0], index.shape[1], u.shape[1]
        h = np.zeros((2, n, size), np.float32)
        out = np.empty((steps, 2, n, size), np.float32)
        for t in range(steps):
            own = index[:, t], index[:, steps - 1 - t]
            x = np.stack([gates[0][own[0]], gates[1][own[1]]])
            hu = np.matmul(h, u)
            zr = _sigmoid(x[..., : 2 * size] + hu[..., : 2 * size])
            z, r = zr[..., :size], zr[..., size:]
            new = np.tanh(x[..., 2 * size :] + r * hu[..., 2 * size :])
            after = new + z * (h - new)
            if mask is not None:
                m = np.stack([mask[:, t], mask[:, steps - 1 - t]])[..., None]
                after = h + m * (after - h)
            if keep is not None:
                keep.append((h, z, r, new, hu[..., 2 * size :]))
            h = out[t] = after
        return out

    def pooled(self, states: np.ndarray, mask: np.ndarray | None):
        p = self.weights
        both = np.concatenate([states[:, 0], states[::-1, 1]], axis=-1)  # [time, window, 2 * hidden]
        hidden = np.tanh(both @ p["att_w"] + p["att_b"])
        logits = hidden @ p["att_v"]
        if mask is not None:
            logits = np.where(mask.T > 0, logits, np.float32(-1e9))
        share = np.exp(logits - logits.max(0))
        share /= share.sum(0)
        pool = np.einsum("tn,tnh->nh", share, both)
        return both, hidden, share, pool, pool @ p["out_w"] + p["out_b"]

    def logits(self, gates: np.ndarray, index: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
        return self.pooled(self.states(gates, index, mask), mask)[-1]

    def gradients(self, features, index, mask, labels) -> dict[str, np.ndarray]:
        """Of the mean logistic loss, by back-propagation through time."""
        p = self.weights
        used, local = np.unique(index, return_inverse=True)
        local = local.reshape(index.shape)
        ids, grams, sizes = _picked(features, used)
        x = self.inputs(ids, grams, sizes)
        gates, kept = self.projected(x), []
        states = self.states(gates, local, mask, kept)
        both, hidden, share, pool, logit = self.pooled(states, mask)
        size, steps, n = p["u"].shape[1], index.shape[1], len(index)

        d_logit = (_sigmoid(logit) - labels) / np.float32(n)
        g = {"out_w": pool.T @ d_logit, "out_b": d_logit.sum(keepdims=True)}
        d_pool = d_logit[:, None] * p["out_w"]
        d_both = share[..., None] * d_pool
        d_share = np.einsum("tnh,nh->tn", both, d_pool)
        d_att = share * (d_share - (share * d_share).sum(0))
        g["att_v"] = np.einsum("tna,tn->a", hidden, d_att)
        d_hidden = d_att[..., None] * p["att_v"] * (1 - hidden**2)
        g["att_w"] = np.einsum("tnh,tna->ha", both, d_hidden)
        g["att_b"] = d_hidden.sum((0, 1))
        d_both = d_both + d_hidden @ p["att_w"].T
        d_states = np.stack([d_both[..., :size], d_both[::-1, :, size:]], axis=1)

        d_gates = np.zeros_like(gates)
        g["u"], d_h = np.zeros_like(p["u"]), np.zeros((2, n, size), np.float32)
        u_t = p["u"].transpose(0, 2, 1)
        for t in range(steps - 1, -1, -1):
            h, z, r, new, hu_n = kept[t]
            d_h = d_h + d_states[t]
            m = np.stack([mask[:, t], mask[:, steps - 1 - t]])[..., None]
            d_after = d_h * m
            d_new = d_after * (1 - z) * (1 - new**2)
            d_z = d_after * (h - new) * z * (1 - z)
            d_r = d_new * hu_n * r * (1 - r)
            d_x = np.concatenate([d_z, d_r, d_new], axis=-1)
            d_hu = np.concatenate([d_z, d_r, d_new * r], axis=-1)
            g["u"] += np.matmul(h.transpose(0, 2, 1), d_hu)
            d_h = d_h * (1 - m) + d_after * z + np.matmul(d_hu, u_t)
            np.add.at(d_gates[0], local[:, t], d_x[0])
            np.add.at(d_gates[1], local[:, steps - 1 - t], d_x[1])
        g["b"] = d_gates.sum(1, keepdims=True)
        g["w"] = np.matmul(x.T[None], d_gates)
        d_word_input = np.matmul(d_gates, p["w"].transpose(0, 2, 1)).sum(0)
        words = p["word"].shape[1]
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], ids, d_word_input[:, :words])
        g["word"][0] = 0
        np.add.at(g["char"], grams, np.repeat(d_word_input[:, words:] / sizes[:, None].astype(x.dtype), sizes, axis=0))
        g["char"][0] = 0
        return g


class _Adam:
    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, weights: dict[str, np.ndarray], gradients: dict[str, np.ndarray]) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g**2).sum()) for g in gradients.values()))
        scale = min(1.0, 1.0 / (norm + 1e-9))
        for k, g in gradients.items():
            self.m[k] += 0.1 * (g * scale - self.m[k])
            self.v[k] += 0.001 * ((g * scale) ** 2 - self.v[k])
            top = self.m[k] / (1 - 0.9**self.t)
            weights[k] -= (self.rate * top / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)).astype(np.float32)


def _matrix(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of word numbers beside each other, and which places hold a word."""
    steps = max(map(len, rows))
    index, mask = np.zeros((len(rows), steps), np.int64), np.zeros((len(rows), steps), np.float32)
    for k, row in enumerate(rows):
        index[k, : len(row)], mask[k, : len(row)] = row, 1
    return index, mask


def _window_logits(network: Network, gates: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Blocks of windows of like length; full windows need no mask."""
    lengths = np.array([len(r) for r in rows])
    out, order = np.empty(len(rows), np.float32), np.argsort(lengths, kind="stable")
    cut = np.searchsorted(lengths[order], WINDOW)
    for part in (order[:cut], order[cut:]):
        for i in range(0, len(part), _BLOCK):
            own = part[i : i + _BLOCK]
            index, mask = _matrix([rows[k] for k in own])
            out[own] = network.logits(gates, index, None if mask.all() else mask)
    return out


def train(windows: list[list[list[bytes]]], labels: list[int], worst: Callable[[Network], dict], s: Settings) -> Network:
    """From windows of words by document; the curve is left as it is.

    A toxic document has its label in some of its windows only. The first epoch
    takes all that are given. Then ``worst`` names, of all windows of a toxic
    document, the one that the network finds worst, which joins the others; the
    later epochs take of each toxic document the worst of those so far.
    """
    counts: dict[bytes, int] = {}
    for doc in windows:
        for window in doc:
            for word in window:
                counts[word] = counts.get(word, 0) + 1
    frequent = sorted((w for w, n in counts.items() if n > 2), key=lambda w: (-counts[w], w))
    known = {w: i + 1 for i, w in enumerate(frequent[: s.vocabulary])}
    number = {w: i for i, w in enumerate(counts)}
    features = _features(list(number), known)
    numbered = [[np.array([number[w] for w in window]) for window in doc] for doc in windows]
    network, rng = Network.fresh(known, s), np.random.default_rng(s.seed)
    toxic = [k for k, label in enumerate(labels) if label]
    adam = _Adam(network.weights, s.rate)
    for epoch in range(s.epochs):
        best = {}
        if epoch == 1:
            for k, window in worst(network).items():
                numbered[k].append(np.array([number.setdefault(w, len(number)) for w in window]))
            features = _features(list(number), known)
        if epoch:
            gates = network.projected(network.inputs(*features))
            scores = _window_logits(network, gates, [w for k in toxic for w in numbered[k]])
            at = 0
            for k in toxic:
                best[k] = int(np.argmax(scores[at : at + len(numbered[k])]))
                at += len(numbered[k])
        chosen = [(k, w) for k in range(len(labels)) for w in range(len(numbered[k])) if best.get(k, w) == w]
        order = rng.permutation(len(chosen))
        for i in range(0, len(order), s.batch):
            own = [chosen[j] for j in order[i : i + s.batch]]
            index, mask = _matrix([numbered[k][w] for k, w in own])
            target = np.array([labels[k] for k, _ in own], np.float32)
            adam.step(network.weights, network.gradients(features, index, mask, target))
    return network


def _curve(tops: list[float], labels: list[int], prior: float) -> tuple[float, float]:
    """From the largest logits of whole texts to scores, weighted to ``prior``, the share of toxic labels."""
    if not tops:
        return 1.0, 0.0
    top, y = np.array(tops, np.float64), np.array(labels, np.float64)
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    weight = np.where(y > 0, prior / share, (1 - prior) / (1 - share))
    a, b = 1.0, 0.0
    for _ in range(500):  # Newton's method with a small ridge
        p = 1 / (1 + np.exp(-np.clip(a * top + b, -30, 30)))
        g = np.array([(weight * (p - y) * top).sum() + 0.1 * (a - 1), (weight * (p - y)).sum() + 0.01 * b])
        v = weight * p * (1 - p)
        hess = np.array([[(v * top * top).sum() + 0.1, (v * top).sum()], [(v * top).sum(), v.sum() + 0.01]])
        step = np.linalg.solve(hess, g)
        step *= min(1.0, 1.0 / (np.abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def _training_windows(limit: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text in zip(batch.column("key").to_pylist(), bytes_of(batch, "text")):
                own = words_of(text)
                bounds = window_bounds(len(own))
                if len(bounds) > limit:
                    drawn = np.random.default_rng(key % 2**64).choice(len(bounds), limit, replace=False)
                    bounds = [bounds[i] for i in sorted(drawn)]
                out.append([b" ".join(own[a:b]) for a, b in bounds])
            columns = [batch.column("key"), batch.column("label"), pa.array(out, pa.list_(pa.large_binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "label", "windows"])

    return cut


def _worst_windows(model):
    """The largest logit of all windows of a text, and the words of that window; null without words."""

    def worst(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model.value)
        for batch in batches:
            found = list(scorer.tops(bytes_of(batch, "text")))
            tops = pa.array([t if own else None for t, own in found], pa.float64())
            words = pa.array([b" ".join(own) for _, own in found], pa.large_binary())
            columns = [batch.column("key"), batch.column("label"), tops, words]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "label", "top", "words"])

    return worst


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def fit_network(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    settings: Settings = Settings(),
) -> Network:
    """Learns from labelled documents, those for testing left out.

    The sample is bounded by ``settings``; rows with null ids or labels, and
    texts without words, teach nothing.
    """
    marks = labels.select(labels[id_col].alias("id"), labels[label_col].alias("label"))
    marks = marks.where(F.col("label").isNotNull() & ~held_out(F.col("id")))
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).where("text is not null")
    counts = {r["label"]: r["n"] for r in marks.groupBy(F.col("label") > 0).agg(F.count("*").alias("n")).toDF("label", "n").collect()}
    prior = counts.get(True, 0) / max(1, sum(counts.values()))
    sample = reduce(DataFrame.union, (
        marks.where((F.col("label") > 0) == label).orderBy(F.xxhash64("id"), "id").limit(settings.docs_per_class)
        for label in (True, False)
    ))
    curve = F.pmod(F.xxhash64("id", F.lit("curve")), F.lit(5)) == 0
    sample = written(sample.select("id", (F.col("label") > 0).cast("int").alias("label"), curve.alias("curve")))
    chosen = texts.join(F.broadcast(sample), "id")  # of bounded size
    chosen = written(chosen.select(F.xxhash64("text").alias("key"), "label", "curve", "text"))
    taught, held = chosen.where("NOT curve").drop("curve"), chosen.where("curve").drop("curve")
    cut = map_batches(taught, _training_windows(settings.windows_per_doc), "key long, label int, windows array<binary>")
    # An order that doesn't depend on how the rows arrived.
    rows = sorted((r for r in cut.collect() if r["windows"]), key=lambda r: (r["key"], r["label"]))
    windows, target = [[bytes(w).split() for w in r["windows"]] for r in rows], [r["label"] for r in rows]
    if len(set(target)) < 2:
        network = Network.fresh({}, settings)
        network.curve = (0.0, -20.0 if not any(target) else 20.0)
        return network

    def tops(network: Network, texts: DataFrame) -> DataFrame:
        model = docs.sparkSession.sparkContext.broadcast(network)
        return map_batches(texts, _worst_windows(model), "key long, label int, top double, words binary").where("top IS NOT NULL")

    def worst(network: Network) -> dict[int, list[bytes]]:
        found = {r["key"]: bytes(r["words"]).split() for r in tops(network, taught.where("label = 1")).collect()}
        return {k: found[r["key"]] for k, r in enumerate(rows) if r["label"] and r["key"] in found}

    network = train(windows, target, worst, settings)
    known = sorted((r["top"], r["label"]) for r in tops(network, held).select("top", "label").collect())
    network.curve = _curve([t for t, _ in known], [y for _, y in known], prior)
    return network


class _Scorer:
    """Scores batches of texts; what a word adds to the gates is kept per word, up to a bound."""

    kept = 80_000

    def __init__(self, network: Network):
        self.network = network
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.gates = np.empty((2, 0, self.network.weights["b"].shape[-1]), np.float32)

    def learn(self, words: list[bytes]) -> None:
        if not words:
            return
        self.numbers.update(zip(words, range(len(self.numbers), len(self.numbers) + len(words))))
        new = self.network.projected(self.network.inputs(*_features(words, self.network.known)))
        self.gates = np.concatenate([self.gates, new], axis=1)

    def scores(self, texts: list[bytes]) -> list[float]:
        a, b = self.network.curve
        top = np.array([t for t, _ in self.tops(texts)], np.float64)
        scores = np.zeros(len(texts))
        some = np.isfinite(top)
        scores[some] = 1 / (1 + np.exp(-np.clip(a * top[some] + b, -30, 30)))
        return scores.tolist()

    def tops(self, texts: list[bytes]) -> Iterator[tuple[float, list[bytes]]]:
        """The largest logit of each text and the words of its window; -inf and none without words."""
        some, size = [], 0
        for text in texts:  # about 1 MB of text at once
            some.append(text)
            size += len(text)
            if size > 1 << 20:
                yield from self._tops(some)
                some, size = [], 0
        yield from self._tops(some)

    def _tops(self, texts: list[bytes]) -> list[tuple[float, list[bytes]]]:
        if len(self.numbers) > self.kept:
            self.forget()
        split = [words_of(t) for t in texts]
        self.learn([w for w in dict.fromkeys(w for own in split for w in own) if w not in self.numbers])
        rows, owner, bounds = [], [], []
        for k, own in enumerate(split):
            index = np.fromiter(map(self.numbers.__getitem__, own), np.int64, len(own))
            for a, b in window_bounds(len(own)):
                rows.append(index[a:b])
                owner.append(k)
                bounds.append((a, b))
        out: list[tuple[float, list[bytes]]] = [(-np.inf, [])] * len(texts)
        if rows:
            logits = _window_logits(self.network, self.gates, rows).astype(np.float64)
            order = np.lexsort((logits, owner))  # the largest of each text comes last
            for w in order[np.flatnonzero(np.diff(np.array(owner)[order], append=-1))]:
                out[owner[w]] = float(logits[w]), split[owner[w]][slice(*bounds[w])]
        return out


def _scoring(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model.value)
        for batch in batches:
            scores = scorer.scores(bytes_of(batch, "text"))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64())], names=["row", "score"])

    return score


def score_toxicity(docs: DataFrame, network: Network, text_col: str = "text") -> DataFrame:
    """``row`` and ``score`` (0 to 1) of every row; no shuffle.

    The network is broadcast; its size is bounded by the settings. Only the text
    is looked at. Texts without words score 0.
    """
    base = packed(docs, text=text_col).withColumn("text", text_of())
    model = docs.sparkSession.sparkContext.broadcast(network)
    schema = T.StructType([base.schema["row"], T.StructField("score", T.DoubleType())])
    return map_batches(base, _scoring(model), schema)
