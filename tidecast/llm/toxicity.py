"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Every word is an input of word and character evidence: for the whole word
and for prefixes and suffixes of its characters, the shrunken log-odds that a
labelled document with it is toxic, from hashed tables.  A forward and a
backward gated recurrent unit read a window of ``WINDOW`` words, attention
pools their states, and a logistic output scores the window.  Windows overlap
by half and cover the whole text; a document's score is that of its highest
window, shifted so that the threshold chosen in training is 0.5.

The network is trained in numpy, in one task, on a bounded sample of labelled rows
(``toxic_rows`` and ``clean_rows``; at most ``SAMPLE_WINDOWS`` evenly spread windows of each).
Evidence of a training document leaves the document itself out, so rare
words look to the network as they will on unseen documents.

Cases: a null or blank text has one empty window; labels of a doc_id that
occurs more than once count as toxic if one of them is; labels that are null
or have no document are not used; without labels of both classes all scores are 0;
null ids are not held out; repeated rows are scored alike; an empty
table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import passes, text_of

WINDOW, STRIDE = 64, 32
HIDDEN, ATTENTION = 8, 8
#: Character inputs: bytes of a word's start and end.
PREFIXES, SUFFIXES = (3, 4, 5, 6, 8), (3, 5)
KINDS = 1 + len(PREFIXES) + len(SUFFIXES)
SLOT_BITS = 17
#: Labelled documents' worth of prior evidence in each slot.
PRIOR = 3.0
SAMPLE_WINDOWS = 12
#: Bytes of text scored in one step.
SCORED_BYTES = 1 << 20

_WORD = np.zeros(256, bool)
_WORD[[39, *range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends) of the words of all texts and the number of words in each."""
    solid = np.zeros(len(data) + len(offs), bool)  # a gap before each text and at the end
    n = len(offs) - 1
    place = np.arange(len(data)) + 1 + np.repeat(np.arange(n), np.diff(offs))
    solid[place] = _WORD[data]
    edge = np.flatnonzero(np.diff(solid.view(np.int8)))
    text = np.searchsorted(offs + np.arange(n + 1), edge[::2], "right") - 1
    start, end = edge[::2] - text, edge[1::2] - text
    return start, end, np.bincount(text, minlength=n)


def word_slots(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Slot of each word in the table of each kind; -1 where it is too short for it."""
    raw = np.concatenate([np.zeros(8, np.uint8), data, np.zeros(24, np.uint8)])
    eight = np.ndarray((len(raw) - 7,), "<u8", raw.tobytes(), 0, (1,))
    length = end - start
    mask = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    mix = np.uint64(0x9E3779B97F4A7C15)
    head, tail = eight[start + 8], eight[end]
    first = head & mask[np.minimum(length, 8)]
    second = eight[start + 16] & mask[np.clip(length - 8, 0, 8)]
    last = np.where(length > 16, tail, np.uint64(0))
    whole = ((first * mix) ^ (second + np.uint64(1))) * mix ^ (last + length.astype(np.uint64))
    out = np.empty((len(start), KINDS), np.int32)
    shift = np.uint64(64 - SLOT_BITS)

    def put(column, key, fits):
        out[:, column] = np.where(fits, (key * mix ^ (key >> np.uint64(31))) * mix >> shift, -1)

    put(0, whole, True)
    for i, k in enumerate(PREFIXES, 1):
        put(i, head & mask[k], length >= k)
    for i, k in enumerate(SUFFIXES, 1 + len(PREFIXES)):
        put(i, tail >> np.uint64(64 - 8 * k), length >= k)
    return out


def evidence(toxic: np.ndarray, clean: np.ndarray, share: float) -> np.ndarray:
    """Shrunken log-odds against the share of toxic documents, scaled."""
    toxic, clean = np.maximum(toxic, 0), np.maximum(clean, 0)
    odds = np.log((toxic + PRIOR * share) / (clean + PRIOR * (1 - share))) - np.log(share / (1 - share))
    return np.clip(odds / 3, -1, 2).astype(np.float32)


def _sigmoid(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Parameters, training and scoring of the recurrent network."""

    def __init__(self, seed: int = 0, inputs: int = KINDS, hidden: int = HIDDEN, attention: int = ATTENTION):
        r = np.random.default_rng(seed)

        def normal(*shape):
            return (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.h = hidden
        self.p = {
            "Wf": normal(inputs, 3 * hidden), "Uf": normal(hidden, 3 * hidden), "bf": np.zeros(3 * hidden, np.float32),
            "Wb": normal(inputs, 3 * hidden), "Ub": normal(hidden, 3 * hidden), "bb": np.zeros(3 * hidden, np.float32),
            "Wa": normal(2 * hidden, attention), "ba": np.zeros(attention, np.float32), "va": normal(attention),
            "wo": normal(2 * hidden), "bo": np.zeros(1, np.float32),
        }

    def _step(self, g, prev, U):
        h = self.h
        a = prev @ U
        zr = _sigmoid(g[:, : 2 * h] + a[:, : 2 * h])
        z, r = zr[:, :h], zr[:, h:]
        n = np.tanh(g[:, 2 * h:] + r * a[:, 2 * h:])
        return n + z * (prev - n), (z, r, n, a[:, 2 * h:])

    def _pool(self, states, mask):
        """states (T, B, 2h), mask (T, B): pooled (B, 2h) and what went into it."""
        u = np.tanh(states @ self.p["Wa"] + self.p["ba"])
        e = u @ self.p["va"]
        e = np.where(mask, e - np.max(np.where(mask, e, -np.inf), axis=0, initial=-1e9), -np.inf)
        w = np.exp(e)
        w = w / np.maximum(w.sum(0), 1e-9)
        return np.einsum("tb,tbh->bh", w, states), u, w

    def loss_and_gradients(self, x, mask, y, weight):
        """x (T, B, D), mask (T, B): weighted log loss and its gradients."""
        T, B, _ = x.shape
        h, p = self.h, self.p
        states, kept = np.zeros((T, B, 2 * h), x.dtype), {}
        for side, order in (("f", range(T)), ("b", range(T - 1, -1, -1))):
            g = x @ p["W" + side] + p["b" + side]
            prev = np.zeros((B, h), x.dtype)
            for t in order:
                new, gates = self._step(g[t], prev, p["U" + side])
                kept[side, t] = (prev, gates)
                prev = np.where(mask[t][:, None], new, prev)
                states[t, :, slice(0, h) if side == "f" else slice(h, None)] = prev
        pooled, u, w = self._pool(states, mask)
        logit = pooled @ p["wo"] + p["bo"][0]
        loss = float((weight * (np.logaddexp(0, logit) - y * logit)).sum())
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        d = weight * (_sigmoid(logit) - y)
        grad["wo"], grad["bo"] = pooled.T @ d, np.array([d.sum()], x.dtype)
        dp = np.outer(d, p["wo"])
        ds = w[:, :, None] * dp
        de = w * (np.einsum("tbh,bh->tb", states, dp) - (dp * pooled).sum(1))
        grad["va"] = np.einsum("tb,tbk->k", de, u)
        du = de[:, :, None] * p["va"] * (1 - u * u)
        grad["Wa"], grad["ba"] = np.einsum("tbh,tbk->hk", states, du), du.sum((0, 1))
        ds += du @ p["Wa"].T
        for side, order in (("f", range(T - 1, -1, -1)), ("b", range(T))):
            part = slice(0, h) if side == "f" else slice(h, None)
            U, carry = p["U" + side], np.zeros((B, h), x.dtype)
            for t in order:
                prev, (z, r, n, an) = kept[side, t]
                dh = ds[t, :, part] + carry
                m = mask[t][:, None]
                dn_h, carry = np.where(m, dh, 0), np.where(m, 0, dh)
                dn = dn_h * (1 - z) * (1 - n * n)
                dz = dn_h * (prev - n) * z * (1 - z)
                dr = dn * an * r * (1 - r)
                dg = np.concatenate([dz, dr, dn], 1)
                da = np.concatenate([dz, dr, dn * r], 1)
                carry = carry + dn_h * z + da @ U.T
                grad["U" + side] += prev.T @ da
                grad["W" + side] += x[t].T @ dg
                grad["b" + side] += dg.sum(0)
        return loss, grad

    def train(self, x, mask, y, weight, state: dict, rate: float, batch: int, rng) -> None:
        """One pass of Adam over the windows."""
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            own = order[at: at + batch]
            _, grad = self.loss_and_gradients(x[:, own], mask[:, own], y[own], weight[own] / weight[own].sum())
            state["t"] = t = state.get("t", 0) + 1
            size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            for k, g in grad.items():
                g = g * min(1.0, 5.0 / (size + 1e-9))
                m, v = state.get(k, (0.0, 0.0))
                m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
                state[k] = (m, v)
                self.p[k] = (self.p[k] - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)).astype(np.float32)

    def logits(self, x: np.ndarray, start: np.ndarray, length: np.ndarray, most: int = 4096) -> np.ndarray:
        """Logit of each window ``x[start: start + length]`` of the words' inputs."""
        h, p = self.h, self.p
        weights, bias = np.concatenate([p["Wf"], p["Wb"]], 1), np.concatenate([p["bf"], p["bb"]])
        out = np.empty(len(start), np.float32)
        for at in range(0, len(start), most):  # windows are in order, so each step needs one range of words
            own = at + np.argsort(-length[at: at + most], kind="stable")
            s, n = start[own], length[own]
            T = int(n[0])
            if not T:
                out[own] = p["bo"][0]
                continue
            low = int(s.min())
            project = x[low: int((s + n).max())] @ weights + bias
            s = s - low
            alive = np.searchsorted(-n, -np.arange(1, T + 1), "right")  # windows longer than t come first
            states = np.zeros((T, len(own), 2 * h), np.float32)
            prev = np.zeros((len(own), h), np.float32)
            for t in range(T):
                b = alive[t]
                prev[:b], _ = self._step(project[s[:b] + t, : 3 * h], prev[:b], p["Uf"])
                states[t, :b, :h] = prev[:b]
            prev[:] = 0
            for t in range(T - 1, -1, -1):
                b = alive[t]
                prev[:b], _ = self._step(project[s[:b] + t, 3 * h:], prev[:b], p["Ub"])
                states[t, :b, h:] = prev[:b]
            pooled, _, _ = self._pool(states, np.arange(T)[:, None] < n)
            out[own] = pooled @ p["wo"] + p["bo"][0]
        return out


def window_starts(words: int) -> np.ndarray:
    """Starts of the overlapping windows that cover a text of so many words."""
    return np.arange(0, max(words - STRIDE, 1), STRIDE)


def all_windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, index of each text's first window) for texts of so many words."""
    n = np.maximum(-(-(counts - STRIDE) // STRIDE), 1)
    first = np.r_[0, np.cumsum(n)]
    within = (np.arange(first[-1]) - np.repeat(first[:-1], n)) * STRIDE
    begin = np.r_[0, np.cumsum(counts)[:-1]]
    return np.repeat(begin, n) + within, np.minimum(np.repeat(counts, n) - within, WINDOW), first[:-1]


class Model:
    def __init__(self, table: np.ndarray, network: Network | None, shift: float):
        self.table, self.network, self.shift = table, network, shift

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Score of each whole text."""
        if self.network is None:
            return np.zeros(len(offs) - 1)
        start, end, counts = word_spans(data, offs)
        slots = word_slots(data, start, end)
        x = self.table[np.arange(KINDS), slots]  # slot -1 is the last one, which is kept at 0
        begin, length, first = all_windows(counts)
        logit = np.maximum.reduceat(self.network.logits(x, begin, length), first).astype(np.float64)
        return _sigmoid(logit - self.shift)


def fit(texts: list[str], labels: list[int], seed: int = 0, rounds: int = 12, batch: int = 128) -> Model:
    """Train on lower-cased sample texts and their labels."""
    y = np.array(labels, np.float32)
    empty = np.zeros((KINDS, (1 << SLOT_BITS) + 1), np.float32)
    if not 0 < y.sum() < len(y):
        return Model(empty, None, 0.0)
    raw = [t.encode() for t in texts]
    data, offs = np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])]
    start, end, counts = word_spans(data, offs)
    slots = np.empty((len(start), KINDS), np.int32)
    for at in range(0, len(start), 1 << 16):
        own = slice(at, at + (1 << 16))
        low, high = int(start[own][0]), int(end[own][-1])
        slots[own] = word_slots(data[low:high], start[own] - low, end[own] - low)
    doc = np.repeat(np.arange(len(y)), counts)
    seen = np.zeros((2, KINDS, (1 << SLOT_BITS) + 1), np.float32)
    for k in range(KINDS):
        there = slots[:, k] >= 0
        pairs = np.unique((doc[there] << (SLOT_BITS + 1)) | slots[there, k])
        np.add.at(seen, (y[pairs >> (SLOT_BITS + 1)].astype(int), k, pairs & ((1 << (SLOT_BITS + 1)) - 1)), 1)
    share = float(y.mean())
    table = evidence(seen[1], seen[0], share)
    table[:, -1] = 0
    own = y[doc]  # what a document's own label added is taken off again
    x = np.empty(slots.shape, np.float32)
    for k in range(KINDS):
        at = slots[:, k]
        x[:, k] = np.where(at < 0, 0, evidence(seen[1, k, at] - own, seen[0, k, at] - (1 - own), share))
    del slots
    begin, length, first = all_windows(counts)
    of = np.repeat(np.arange(len(y)), np.diff(np.r_[first, len(begin)]))
    network, state, rng = Network(seed), {}, np.random.default_rng(seed)
    mean, steps = {}, 0
    total = np.r_[0, np.cumsum(np.maximum(x.max(1), 0))] if len(x) else np.zeros(1)
    rank = total[begin + length] - total[begin]
    for i in range(rounds):
        # of each document the window that now looks most toxic, of clean ones also one at random
        top = np.lexsort((rank, of))[np.r_[first[1:], len(begin)] - 1]
        chance = first + (rng.random(len(y)) * np.diff(np.r_[first, len(begin)])).astype(int)
        pick = np.r_[top, chance[y == 0]]
        pick = pick[length[pick] > 0]
        if not len(pick):
            return Model(empty, None, 0.0)
        t = np.arange(WINDOW)[:, None]
        mask = t < length[pick]
        inputs = np.where(mask[:, :, None], x[np.minimum(begin[pick] + t, max(len(x) - 1, 0))], 0).astype(np.float32)
        target = y[of[pick]]
        weight = np.where(target == 1, len(target) / max(target.sum(), 1), len(target) / max((1 - target).sum(), 1))
        for _ in range(max(1, 4000 // len(pick))):
            network.train(inputs, mask, target, weight.astype(np.float32), state, 0.01 if i < rounds - 4 else 0.003, batch, rng)
            if i >= rounds - 4:  # the result is the mean of the last steps' parameters
                mean = {k: mean.get(k, 0) + v for k, v in network.p.items()}
                steps += 1
        rank = network.logits(x, begin, length)
    network.p = {k: (v / steps).astype(np.float32) for k, v in mean.items()}
    rank = network.logits(x, begin, length)
    best = np.maximum.reduceat(rank, first).astype(np.float64)
    return Model(table, network, threshold(best, y))


def threshold(logits: np.ndarray, y: np.ndarray) -> float:
    """Cut with the highest F1, in the middle between its neighbours."""
    order = np.argsort(-logits, kind="stable")
    z, hit = logits[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][z[:-1] == z[1:]] = -1
    k = int(np.argmax(f1))
    return float(z[k] - 0.5 if k + 1 == len(z) else (z[k] + z[k + 1]) / 2)


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of sample documents cut down to evenly spread windows."""
    for b in batches:
        texts = []
        for text in b.column(0).to_pylist():
            raw = text.encode()
            data = np.frombuffer(raw, np.uint8)
            start, end, counts = word_spans(data, np.array([0, len(raw)]))
            at = window_starts(int(counts[0]))
            if len(at) > SAMPLE_WINDOWS:
                at = at[np.linspace(0, len(at) - 1, SAMPLE_WINDOWS).round().astype(int)]
                text = "\n".join(raw[start[a]: end[min(a + WINDOW, len(end)) - 1]].decode(errors="ignore") for a in at)
            texts.append(text)
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), b.column(1)], ["text", "toxic"])


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = 1500, clean_rows: int = 3000, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on at most so many labelled rows that are not held out, taken in hash order."""
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.lower(text_of(text)).alias("text"))
    known = known.join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    some = None
    for kind, n in ((1, toxic_rows), (0, clean_rows)):
        part = known.where((F.col("toxic") > 0) == bool(kind)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        ids = [r.doc_id for r in part.select("doc_id").collect()]  # at most n ids
        frame = docs.sparkSession.createDataFrame([(i, kind) for i in ids], "doc_id long, toxic int")
        some = frame if some is None else some.unionByName(frame)
    sample = rows.join(F.broadcast(some), "doc_id").select("text", "toxic", "doc_id").dropDuplicates(["doc_id"])
    windows = sample.select("text", "toxic").mapInArrow(_spread, "text string, toxic int")
    # the sample is bounded, so one task can hold it; the driver only gets the model
    fitted = windows.repartition(1).mapInArrow(_fit, "model binary").first()
    return pickle.loads(fitted.model) if fitted else fit([], [])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted(x for b in batches for x in zip(b.column(1).to_pylist(), b.column(0).to_pylist()))
    model = fit([t for _, t in rows], [y for y, _ in rows])
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in passes(batches, "text", SCORED_BYTES):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(shared.value.score(data, offs), pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.lower(text_of(text)).alias("text")).mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
