"""Token counts: greedy longest-match word pieces by a linear automaton.

The vocabulary of byte strings forms a trie.  Every node has a failure link:
the node reached by taking the longest pieces off its string until what is
left is a path of the trie again, and the number of pieces taken off that
way.  Reading a byte either goes down the trie or follows failure links
and adds their counts, so a word costs time linear in its length and no
piece is ever built.  All distinct words of a batch run through the automaton
side by side, one byte position at a time.

A word is a maximal run of bytes that are not white space (``[\\x20\\x09-\\x0D]``),
matched with ``prefix`` before it (the vocabulary's mark of a word's
start) and ``suffix`` after it.  Where no piece matches, one byte is skipped and
counts as one token.

Cases: a null or blank text has 0 tokens; texts and words of any length are
read whole; null ids and repeated rows are returned as they are; an empty
table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import passes, text_of


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies, by rule:
    printable Latin-1 stands for itself, the other bytes follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> list[bytes]:
    """Pieces of a byte-level tokenizer file (``model.vocab``) as bytes."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    back = byte_alphabet()
    return sorted({bytes(back[c] for c in piece) for piece in vocab if piece and all(c in back for c in piece)})


class Automaton:
    """Trie with failure links; edges in an open-addressing table of ``node * 256 + byte``."""

    def __init__(self, pieces: Iterable[bytes]):
        children: list[dict[int, int]] = [{}]
        final = [False]
        parent, via = [0], [0]
        for piece in pieces:
            at = 0
            for byte in piece:
                to = children[at].get(byte)
                if to is None:
                    to = children[at][byte] = len(children)
                    children.append({})
                    final.append(False)
                    parent.append(at)
                    via.append(byte)
                at = to
            final[at] = True
        n = len(children)
        order, at = [0], 0
        while at < len(order):
            order.extend(children[order[at]].values())
            at += 1
        link, pops = [-1] * n, [0] * n
        for v in order[1:]:
            if final[v]:
                link[v], pops[v] = 0, 1
                continue
            # go on from where the parent's string leads, as long as that takes whole pieces off
            c, state, count = via[v], link[parent[v]], pops[parent[v]]
            while state > 0 and c not in children[state]:
                state, count = link[state], count + pops[state]
            if parent[v] and c in children[state]:
                link[v], pops[v] = children[state][c], count
                continue
            # no piece fits somewhere: read the string anew after its longest piece, or else its first byte
            path, u = [], v
            while u and not (final[u] and path):
                path.append(via[u])
                u = parent[u]
            rest = path[::-1] if u else path[-2::-1]
            state, count = 0, 1
            for c in rest:
                while state and c not in children[state]:
                    state, count = link[state], count + pops[state]
                if c in children[state]:
                    state = children[state][c]
                else:
                    count += 1
            link[v], pops[v] = state, count
        self.link, self.pops = np.array(link, np.int32), np.array(pops, np.int32)
        # tokens that what is read so far at a node ends in
        drained = np.zeros(n, np.int64)
        for v in order[1:]:
            drained[v] = pops[v] + drained[link[v]]
        self.drained = drained
        keys = np.array([v * 256 + c for v in range(n) for c in children[v]], np.int64)
        nodes = np.array([to for v in range(n) for to in children[v].values()], np.int32)
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.keys, self.nodes = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        at, left = self._place(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at] < 0
            self.keys[at[free]], self.nodes[at[free]] = keys[left[free]], nodes[left[free]]
            lost = self.keys[at] != keys[left]
            at, left = (at[lost] + 1) & ((1 << self.bits) - 1), left[lost]

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Child of each state, -1 where it has none."""
        keys = state.astype(np.int64) * 256 + byte
        at = self._place(keys)
        out = np.full(len(keys), -1, np.int32)
        left = np.arange(len(keys))
        while len(left):
            there = self.keys[at]
            hit = there == keys[left]
            out[left[hit]] = self.nodes[at[hit]]
            on = ~hit & (there >= 0)
            at, left = (at[on] + 1) & ((1 << self.bits) - 1), left[on]
        return out

    def read(self, state: np.ndarray, count: np.ndarray, byte: np.ndarray) -> None:
        """Read one byte at each state, in place."""
        left = np.arange(len(state))
        while len(left):
            to = self.step(state[left], byte[left])
            down = to >= 0
            state[left[down]] = to[down]
            left = left[~down]
            lost = state[left] == 0  # no piece starts with this byte
            count[left[lost]] += 1
            left = left[~lost]
            count[left] += self.pops[state[left]]
            state[left] = self.link[state[left]]

    def count_words(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, prefix: bytes = b"", suffix: bytes = b"") -> np.ndarray:
        """Tokens of each word ``data[start: start + length]``."""
        state, count = np.zeros(len(start), np.int32), np.zeros(len(start), np.int64)
        for c in prefix:
            self.read(state, count, np.full(len(start), c, np.uint8))
        order = np.argsort(-length, kind="stable")
        state, count, start, length = state[order], count[order], start[order], length[order]
        for i in range(int(length[0]) if len(length) else 0):
            n = int(np.searchsorted(-length, -i, "left"))  # words longer than i
            self.read(state[:n], count[:n], data[start[:n] + i])
        for c in suffix:
            self.read(state, count, np.full(len(start), c, np.uint8))
        out = np.empty(len(start), np.int64)
        out[order] = count + self.drained[state]
        return out


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal runs that hold no white space; the
    caller sees to it that texts are kept apart."""
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.flatnonzero(np.diff(np.r_[False, solid, False].view(np.int8)))
    return edge[::2], edge[1::2] - edge[::2]


def distinct(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word of each kind, kind of each word)."""
    ends = np.empty(2 * len(start) + 1, np.int64)  # words and gaps take turns
    ends[:-1:2], ends[1::2], ends[-1] = start, start + length, start[-1] + length[-1]
    runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), 2 * len(start), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    kind = runs.take(pa.array(np.arange(0, 2 * len(start), 2))).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.full(kind.max() + 1, len(start), np.int64)
    np.minimum.at(first, kind, np.arange(len(start)))
    return first, kind


def token_counts(docs: DataFrame, pieces: list[bytes], prefix: bytes = b" ", suffix: bytes = b"", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens.

    The vocabulary is what is shared with the executors; its size does not
    depend on the documents."""
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for rows, data, offs in passes(batches, "text"):
            # a blank between texts keeps their words apart
            n = len(offs) - 1
            apart = np.full(len(data) + n, 32, np.uint8)
            apart[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offs))] = data
            start, length = words(apart)
            of = np.searchsorted(offs + np.arange(n + 1), start, "right") - 1
            tokens = np.zeros(0, np.int64)
            if len(start):
                first, kind = distinct(apart, start, length)
                tokens = automaton.count_words(apart, start[first], length[first], prefix, suffix)[kind]
            n_words = np.bincount(of, minlength=n)
            n_tokens = np.bincount(of, weights=tokens, minlength=n).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"]
            )

    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return base.mapInArrow(run, "doc_id long, n_words long, n_tokens long")
