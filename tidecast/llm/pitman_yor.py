"""Language-model scores of a hierarchical Pitman-Yor model of word pairs.

A restaurant for each context (the word before, or the start of a text)
serves the words that follow it.  All of them share one parent, the
restaurant of single words, whose base gives each of the V known words and
the unknown one 1 / (V + 1).  A customer is a token in training; a table is a
customer of the parent.  With c customers at t tables of a dish, and totals
C and T of its restaurant,

    p(w | u) = (c - d t) / (theta + C)  +  (theta + d T) / (theta + C) * p(w).

Seatings are sampled by Gibbs: a customer leaves its table and takes a table of
its dish with weight (size - d), or a new one with weight (theta + d T) p(w).
Step j moves the j-th customer of all dishes of a task at once, so within a
step T is the one before it.  Customers come in one after the other
first, ``BURN`` sweeps follow and then ``SAMPLES`` sweeps that are kept; the
context restaurants see the parent as its tokens' shares, the parent is then
seated with the tables of each kept sweep.  Predictive probabilities are
averaged over the kept seatings.  Discounts come from counts of counts, n1 /
(n1 + 2 n2) at each level.

How it is spread: texts are encoded once as blocks of about ``BLOCK_BYTES``
(local token numbers and the hashes of their words), written to the shared
folder.  A block sends each pair once to the bucket of its context, with its
training count; all counts grow with the input and live in Spark tables.  Its
words go once to each part of the vocabulary (hash mod ``parts``) to be counted
and again to be looked up in the finished lexicon.  A context of
over ``ROOM`` tokens is dealt over the buckets by the word, the parent over
rooms.  These are seated twice: once by themselves, and again with the
tables that the first seating counted in all other places.  A dish of m times
``SEATS`` customers is seated as m dishes, each with a share 1/m of the
new-table weight, all of which are seated.  Only the
list of such contexts (at most tokens / ROOM) is broadcast.

Words are told apart by 64-bit XXH64.  Cases: a null text is empty and
consists of the end token; null ids train and are returned as they are;
repeated rows count as often as they occur; ties cannot arise; a text is
encoded whole in one task; without training rows every p is 1; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import passes, text_of
from tidecast.llm.common import written as kept

#: Bytes of text in a block; tokens of a bucket; tokens from which a context is dealt over the buckets.
BLOCK_BYTES, BUCKET, ROOM = 10 << 20, 1_250_000, 1_000_000
#: Tokens for each part of the vocabulary.
PART = 2_500_000
#: Customers of a dish that are seated one by one.
SEATS = 1024
#: Dishes of a step that are seated without numpy.
FEW = 64
#: Sweeps before the kept ones, and kept ones.
BURN, SAMPLES = 1, 2
STRENGTH = 1.0
SEED = 20

END = xxhash.xxh64_intdigest(b" end", SEED) - (1 << 63)
START = xxhash.xxh64_intdigest(b" start", SEED) - (1 << 63)
ENCODED = "block long, tokens long, doc_id array<long>, held array<boolean>, size binary, token binary, word array<long>"
#: A block's words in a part of the vocabulary, in order of their hashes.
WORDS = "block long, bucket int, words binary, c binary"
#: Answers to a block: of a part of the vocabulary (bucket -1 - part, ``at`` places among the words asked for), of a bucket (a).
TOLD = "block long, bucket int, at binary, c binary, v binary, a binary"
#: ``words`` holds distinct hashes in order, ``w`` places in it; a context's pairs lie together, ``n`` of them, in order of w.
ASKED = "block long, bucket int, u array<long>, n binary, room array<boolean>, words binary, w binary, c binary"
MERGED = "bucket int, u array<long>, n binary, room array<boolean>, words binary, w binary, c binary, n1 long, n2 long, blocks array<long>, asked binary, place binary"
#: A seated bucket's totals (block NULL), and the weights of the pairs that a block asked for.
SEATED = "bucket int, block long, u array<long>, customers binary, tables binary, words binary, sent binary, a binary"
#: Numbers of binary columns, which hold all first bytes, then all second bytes and so on (the high ones shrink to nothing), compressed.
PACKED = {
    "size": "<i4", "token": "<i4", "n": "<i4", "w": "<i4", "c": "<i8", "a": "<f4", "v": "<f4", "at": "<i4", "customers": "<i8", "tables": "<i8", "sent": "<i8", "asked": "<i4", "place": "<i4",
    "words": "<i8",
}
#: Floating-point columns keep 16 significant bits (a 1e-5 share of a probability).
LOW_BITS = np.uint32(0xFF)
#: Columns whose numbers ascend are kept as differences.
ASCENDING = ("words", "at")
KINDS = {
    "block": pa.int64(), "tokens": pa.int64(), "bucket": pa.int32(), "n1": pa.int64(), "n2": pa.int64(), "u": pa.list_(pa.int64()), "word": pa.list_(pa.int64()),
    "room": pa.list_(pa.bool_()), "doc_id": pa.list_(pa.int64()), "blocks": pa.list_(pa.int64()), "held": pa.list_(pa.bool_()), **dict.fromkeys(PACKED, pa.binary()),
}


#: Spark's setting that removes a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table of the shared folder; the shuffle files behind it,
    which nothing reads again, are removed at once instead of some time later."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return kept(df)
    finally:
        conf.set(CLEANUP, before) if before is not None else conf.unset(CLEANUP)


def _remove(df: DataFrame) -> None:
    """Remove a written table that nothing reads any more."""
    spark, files = df.sparkSession, df.inputFiles()
    for folder in {f.rsplit("/", 1)[0] for f in files}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@cache
def _codec():
    """A worker's (de)compressor: making one takes longer than packing a short column."""
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _pack(name: str, x) -> bytes:
    kind = np.dtype(PACKED[name])
    if name in ASCENDING and len(x):
        x = np.r_[x[:1], x[1:] - x[:-1]]
    x = np.asarray(x, kind)
    if kind.kind == "f":
        x = ((x.view(np.uint32) + (LOW_BITS + 1) // 2) & ~LOW_BITS).view(kind)
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, kind.itemsize).T)
    return _codec()[0].compress(planes)


def _unpack(name: str, raw) -> np.ndarray:
    kind = np.dtype(PACKED[name])
    planes = np.frombuffer(_codec()[1].decompress(raw), np.uint8)
    out = np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).ravel()
    return np.cumsum(out) if name in ASCENDING else out


def _lists(batch, row: int, *names: str) -> list[np.ndarray]:
    cells = [batch.column(batch.schema.get_field_index(n))[row] for n in names]
    return [_unpack(n, c.as_buffer()) if n in PACKED else c.values.to_numpy(zero_copy_only=False) for n, c in zip(names, cells)]


def _row(schema: str, **values) -> pa.RecordBatch:
    """One row, with nulls where no value is given; none without values."""
    names = [x.split()[0] for x in schema.split(", ")]
    cells = {k: _pack(k, v) if k in PACKED else v for k, v in values.items()}
    return pa.RecordBatch.from_arrays([pa.array([cells.get(k)] if cells else [], KINDS[k]) for k in names], names)


# --- encoding -----------------------------------------------------------------

def encode(docs: DataFrame, doc_id: str, text: str, held: Column) -> DataFrame:
    """Blocks of texts: token numbers by text, and the hash of each number's word."""
    def block(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts)
        split = pc.ascii_split_whitespace(pc.ascii_lower(rows["text"].combine_chunks()))
        words, offsets = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
        some = pc.greater(pc.binary_length(words), 0)  # leading and trailing white space give empty words
        before = np.r_[0, np.cumsum(some.to_numpy(zero_copy_only=False))]
        size = before[offsets[1:]] - before[offsets[:-1]] + 1
        words = words.filter(some).dictionary_encode()
        local, names = words.indices.to_numpy(), words.dictionary
        order = np.argsort(-np.bincount(local, minlength=len(names)), kind="stable")  # frequent words get small numbers
        rank = np.empty(len(names), np.int32)
        rank[order] = np.arange(len(names))
        digest = np.fromiter(map(xxhash.xxh64_intdigest, names.take(order).to_numpy(zero_copy_only=False), repeat(SEED)), np.uint64, len(names))
        hashes = np.r_[(digest ^ np.uint64(1 << 63)).view(np.int64), END]  # less 1 << 63, as END
        token = np.full(int(size.sum()), len(hashes) - 1, np.int32)
        inner = np.ones(len(token), bool)
        inner[np.cumsum(size) - 1] = False
        token[inner] = rank[local]
        return _row(ENCODED, block=number, tokens=len(token), doc_id=rows["doc_id"].to_pylist(), held=rows["held"].to_pylist(), size=size, token=token, word=hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, n = [], 0
        for rows, data, _ in passes(batches, "text", BLOCK_BYTES):
            if held and n + len(data) > BLOCK_BYTES:
                yield block(number, held)
                number, held, n = number + 1, [], 0
                pa.default_memory_pool().release_unused()
            held.append(rows)
            n += len(data)
        if held:
            yield block(number, held)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held"), text_of(text).alias("text"))
    return rows.mapInArrow(run, ENCODED)


class Block:
    """A block's distinct pairs (context, word), in order of their local numbers."""

    def __init__(self, batch, row: int):
        self.size, self.token, self.word = _lists(batch, row, "size", "token", "word")
        self.held = _lists(batch, row, "held")[0].astype(bool)
        before = np.empty_like(self.token)
        before[1:] = self.token[:-1]
        before[np.cumsum(self.size) - self.size] = len(self.word) - 1  # the end of the text before stands for the start
        self.code = before.astype(np.int64) * len(self.word) + self.token
        # sorted with the fold in the last bit: the runs are the pairs, their even members train
        fold = np.sort(2 * self.code + np.repeat(self.held, self.size))
        code = fold >> 1
        first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        self.pair = code[first]
        self.count = np.add.reduceat(1 - (fold & 1), first)
        context = self.word.copy()
        context[-1] = START
        self.context = self.pair // len(self.word)  # local number of the word before
        self.u = context.take(self.context)
        self.w = self.pair - self.context * len(self.word)

    def places(self) -> np.ndarray:
        """Place in ``pair`` of every token."""
        bits = len(self.code).bit_length()
        if 2 * len(self.word).bit_length() + bits > 63:
            return np.searchsorted(self.pair, self.code)
        own = np.sort(self.code << bits | np.arange(len(self.code)))  # sorting numbers is much faster than looking them up
        out = np.empty(len(own), np.int64)
        code = own >> bits
        out[own & ((1 << bits) - 1)] = np.cumsum(np.r_[False, code[1:] != code[:-1]][: len(own)])
        return out

    def buckets(self, buckets: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, dealt by the word) of each pair."""
        room = np.isin(self.u, hot)
        key = self.u.copy()
        key[room] ^= self.word[self.w[room]] * np.int64(0x2545F4914F6CDD1D)
        key = key.view(np.uint64)
        key = (key ^ (key >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return ((key >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64), room


def word_places(word: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a block's words by part of the vocabulary (hash mod ``parts``)
    and in order of their hashes; where each part begins, and the end."""
    by_hash = np.argsort(word)
    part = np.mod(word[by_hash], parts)
    order = by_hash[np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")]
    return order, np.r_[0, np.cumsum(np.bincount(part, minlength=parts))]


def vocabulary(blocks: DataFrame, parts: int, counted: bool) -> DataFrame:
    """The words of every block by part of the vocabulary (:data:`WORDS`); if
    ``counted`` those that training rows hold, with their training counts."""
    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                word, c = _lists(b, r, "word")[0], None
                order, edges = word_places(word, parts)
                if counted:
                    size, token, held = _lists(b, r, "size", "token", "held")
                    c = np.bincount(token[np.repeat(~held.astype(bool), size)], minlength=len(word))
                block = b.column(b.schema.get_field_index("block"))[r].as_py()
                for k in np.flatnonzero(np.diff(edges)).tolist():
                    at = order[edges[k]: edges[k + 1]]
                    at = at[c[at] > 0] if counted else at
                    if len(at):
                        yield _row(WORDS, block=block, bucket=k, words=word[at], c=c[at] if counted else [])

    return blocks.mapInArrow(run, WORDS)


def word_counts(blocks: DataFrame, parts: int) -> DataFrame:
    """(w, c): training count of every word, the end token among them."""
    def run(t: pa.Table) -> pa.Table:
        several = [_lists(b, r, "words", "c") for b in t.to_batches() for r in range(b.num_rows)]
        w, c = (np.concatenate(x) for x in zip(*several))
        order = np.argsort(w)
        w, first = w[order], _runs(w[order])
        return pa.table({"w": w[first], "c": np.add.reduceat(c[order], first)})

    return vocabulary(blocks, parts, True).groupBy("bucket").applyInArrow(run, "w long, c long")


def requests(blocks: DataFrame, buckets: int, hot) -> DataFrame:
    """A block's pairs by bucket (:data:`ASKED`)."""
    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                b = Block(batch, r)
                bucket, room = b.buckets(buckets, hot.value)
                order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                by_hash = np.argsort(b.word)
                words, rank = b.word[by_hash], np.empty_like(by_hash)
                rank[by_hash] = np.arange(len(by_hash))
                held, place = np.zeros(len(words), bool), np.empty_like(rank)
                for k in np.flatnonzero(np.diff(edges)).tolist():
                    at = order[edges[k]: edges[k + 1]]
                    u, first, w = b.u[at], _runs(b.context[at]), rank[b.w[at]]
                    if 16 * len(at) < len(words):  # with many buckets, a pass over the block's words for each would be the most work
                        own, w = np.unique(w, return_inverse=True)
                    else:
                        held[w] = True
                        own = np.flatnonzero(held)
                        held[own] = False
                        place[own] = np.arange(len(own))
                        w = place[w]
                    yield _row(ASKED, block=batch.column(0)[r].as_py(), bucket=k, u=u[first], n=np.diff(np.r_[first, len(u)]), room=room[at][first], words=words[own], w=w, c=b.count[at])

    return blocks.mapInArrow(run, ASKED)


def _runs(x: np.ndarray) -> np.ndarray:
    """Places where a run of equal values begins."""
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]][: len(x)])


def _distinct(x: np.ndarray) -> np.ndarray:
    """Distinct numbers in order; sorting them is faster than numpy's hashing."""
    x = np.sort(x)
    return x[_runs(x)]


def _used(x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of 0 .. n - 1 occur in ``x``, and the place of each of x's numbers among them."""
    held = np.zeros(n, bool)
    held[x] = True
    return np.flatnonzero(held), np.cumsum(held)[x] - 1


def _merge(t: pa.Table) -> pa.Table:
    """Dishes of a bucket that training rows hold, by context and word, and for
    every pair that a block asked for the place of its dish, or -1."""
    us, ws, cs, rooms, ns, words, blocks, sizes = [], [], [], [], [], [], [], []
    for batch in t.to_batches():
        for r in range(batch.num_rows):
            u, n, room, word, w, c = _lists(batch, r, "u", "n", "room", "words", "w", "c")
            blocks.append(batch.column(0)[r].as_py())
            sizes.append(len(w))
            for x, y in ((us, u), (ns, n), (rooms, room), (words, word), (ws, w), (cs, c)):
                x.append(y)
    context, which = np.unique(np.concatenate(us), return_inverse=True)
    hot = np.zeros(len(context), bool)
    hot[which] = np.concatenate(rooms)
    word = _distinct(np.concatenate(words))
    code = np.repeat(which, np.concatenate(ns)) * len(word) + np.concatenate([np.searchsorted(word, x)[w] for x, w in zip(words, ws)])
    order = np.argsort(code)
    code, first = code[order], _runs(code[order])
    c = np.add.reduceat(np.concatenate(cs)[order], first)
    trained = c > 0
    place = np.empty(len(order), np.int64)
    place[order] = np.repeat(np.where(trained, np.cumsum(trained) - 1, -1), np.diff(np.r_[first, len(order)]))
    code, c = code[first][trained], c[trained]
    u = code // max(len(word), 1)
    served, w = _used(code - u * len(word), len(word))
    at = _runs(u)
    return pa.Table.from_batches([_row(
        MERGED, bucket=t["bucket"][0].as_py(), u=context[u[at]], n=np.diff(np.r_[at, len(u)]), room=hot[u[at]], words=word[served], w=w, c=c,
        n1=int((c == 1).sum()), n2=int((c == 2).sum()), blocks=blocks, asked=sizes, place=place,
    )])


def _shared(dealt: bool):
    """The words of dishes with several customers, by bucket; of ``dealt`` contexts only."""
    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                n, room, word, w, c = _lists(batch, r, "n", "room", "words", "w", "c")
                w = word[_used(w[(c > 1) & np.repeat(room.astype(bool), n) if dealt else c > 1], len(word))[0]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), batch.column(0)[r].as_py()), pa.int32()), pa.array(w)], ["bucket", "w"])

    return run


def _unpacked(samples: int):
    """Rows (key, values ...) of array columns; the last holds ``samples`` values for each key."""
    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                *single, several = _lists(batch, r, *batch.schema.names)  # the first column is the key
                columns = [*single, *several.reshape(-1, samples).T]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x, np.int64)) for x in columns], ["key", *["c"][: len(single) - 1], *[f"s{i}" for i in range(samples)]])

    return run


# --- seating ------------------------------------------------------------------

class Seating:
    """Tables of many dishes; dish i has ``c[i]`` customers, stands in
    restaurant ``rest[i]`` and has the parent's probability ``p[i]``.

    ``spread[r]``: by how much restaurant r's tables are multiplied for its
    total, where nothing is known of its other places.  ``outside[r]``: its tables there.
    The position of a customer is the number of its table; table sizes lie
    at these numbers.
    """

    def __init__(self, c: np.ndarray, rest: np.ndarray, p: np.ndarray, spread: np.ndarray, singles: np.ndarray, discount: float, strength: float, seed: int, outside: np.ndarray | float = 0.0):
        self.parts = -(-c // SEATS)
        dish = np.repeat(np.arange(len(c), dtype=np.int32), self.parts)
        own = self.parts[dish]
        nth = np.arange(len(own)) - (np.cumsum(self.parts) - self.parts)[dish]
        c = (c[dish] // own + (nth < c[dish] % own)).astype(np.int32)
        del nth
        order = np.argsort(-c, kind="stable")
        self.dish = dish[order]
        self.c, self.rest, self.p = c[order], rest[self.dish], p[self.dish] / own[order]
        self.d, self.theta, self.rng = discount, strength, np.random.default_rng(seed)
        self.spread, self.outside = spread, np.broadcast_to(np.asarray(outside, np.float64), len(spread))
        self.off = np.cumsum(self.c, dtype=np.int64) - self.c
        self.at = np.zeros(int(self.c.sum()), np.int32)    # a customer's table
        self.size = np.zeros(len(self.at), np.int32)
        self.t = np.zeros(len(self.c), np.int32)
        self.singles = singles.astype(np.float64)  # dishes of one customer have one table
        self.total = self.singles  # tables of each restaurant
        self._sweep(first=True)

    def _sweep(self, first: bool = False) -> None:
        c, t, at, size, random = self.c, self.t, self.at, self.size, self.rng.random
        load = self.total * self.spread + self.outside  # tables of each restaurant as they count
        single = bool((self.spread == 1).all())
        lives = np.searchsorted(-c, -np.arange(int(c[0]) if len(c) else 0), "left")  # dishes with over j customers
        fresh_, taken_, drawn_, place_, table_ = (np.empty(len(c), k) for k in (float, float, float, np.intp, at.dtype))  # of every step
        for j, live in enumerate(lives.tolist()):
            off, rest = self.off[:live], self.rest[:live]
            fresh, taken, drawn, table = fresh_[:live], taken_[:live], drawn_[:live], table_[:live]
            place = np.add(off, j, out=place_[:live])
            others = j if first else c[:live] - 1
            if not first:
                at.take(place, out=table, mode="clip")
                left = size.take(table, mode="clip")
                left -= 1
                size[table] = left
                gone = (left == 0).nonzero()[0]
                if len(gone) > FEW // 4:
                    t[gone] -= 1
                    where = rest.take(gone)
                    np.subtract.at(load, where, 1.0 if single else self.spread[where])
                else:
                    for i in gone.tolist():
                        t[i] -= 1
                        load[r := rest.item(i)] -= 1.0 if single else self.spread.item(r)
            random(out=drawn)
            if first and j == 0:
                opened = np.arange(live)
            else:
                load.take(rest, out=fresh, mode="clip")  # (theta + d T) p
                fresh *= self.d
                fresh += self.theta
                fresh *= self.p[:live]
                np.multiply(t[:live], self.d, out=taken)
                np.subtract(others, taken, out=taken)
                np.maximum(taken, 0.0, out=taken)
                taken += fresh
                drawn *= taken
                new = drawn < fresh
                if not first and live > lives[1]:
                    new |= others == 0
                opened, pick = new.nonzero()[0], np.logical_not(new, out=new).nonzero()[0]
                while len(pick) > FEW:  # a random other customer's table, with its share of (size - d)
                    k = (random(len(pick)) * (others if first else others.take(pick))).astype(np.int64)
                    if not first:
                        k += k >= j
                    k += off.take(pick)
                    own = at.take(k)
                    n = size.take(own)
                    sit = random(len(pick)) * n < n - self.d
                    chosen, own = pick[sit], own[sit]
                    at[place.take(chosen)] = own
                    size[own] += 1
                    pick = pick[np.logical_not(sit, out=sit)]
                self._sit(pick, j, first)
            if len(opened) <= FEW // 2:
                for i in opened.tolist():
                    begin = off.item(i)
                    to = own = begin + j
                    if not first:
                        free = c.item(i)
                        while size.item(own) > 0:  # the next number without a table
                            own = begin + (own + 1 - begin) % free
                    at[to] = own
                    size[own] = 1
                    t[i] += 1
                    load[r := rest.item(i)] += 1.0 if single else self.spread.item(r)
            else:
                to = place.take(opened)
                own = to.copy()
                if not first:
                    begin, free = off.take(opened), c.take(opened)
                    busy = (size.take(own) > 0).nonzero()[0]
                    while len(busy):  # the next number without a table
                        own[busy] = begin[busy] + (own[busy] + 1 - begin[busy]) % free[busy]
                        busy = busy[size.take(own[busy]) > 0]
                at[to] = own
                size[own] = 1
                t[opened] += 1
                where = rest.take(opened)
                np.add.at(load, where, 1.0 if single else self.spread[where])
        self.total = self.singles + np.bincount(self.rest, t, len(self.singles))

    def _sit(self, pick: np.ndarray, j: int, first: bool) -> None:
        """The j-th customers of a few dishes join tables, as above, one by one: numpy's calls would take longer than the work."""
        at, size, d = self.at, self.size, self.d
        dishes = list(zip(self.off.take(pick).tolist(), [j] * len(pick) if first else (self.c.take(pick) - 1).tolist()))
        while dishes:
            random = self.rng.random(2 * len(dishes)).tolist()
            left = []
            for dish, x, y in zip(dishes, random, random[len(dishes):]):
                begin, others = dish
                k = int(x * others)
                if not first and k >= j:
                    k += 1
                own = at.item(begin + k)
                n = size.item(own)
                if y * n < n - d:
                    at[begin + j] = own
                    size[own] = n + 1
                else:
                    left.append(dish)
            dishes = left

    def tables(self) -> np.ndarray:
        """Tables of each dish."""
        return np.bincount(self.dish, self.t, len(self.parts)).astype(np.int64)

    def sweep(self) -> tuple[np.ndarray, np.ndarray]:
        """(tables of each dish, of each restaurant) after another sweep."""
        self._sweep()
        return self.tables(), self.total.astype(np.int64)


def _read(t: pa.Table):
    """A merged bucket: its columns, the restaurant of each dish, single customers by restaurant."""
    batch = t.combine_chunks().to_batches()[0]
    u, n, room, word, w, c = _lists(batch, 0, "u", "n", "room", "words", "w", "c")
    rest = np.repeat(np.arange(len(u), dtype=np.int32), n)
    return batch, u, room.astype(bool), word, w, c, rest, np.bincount(rest[c == 1], minlength=len(u))


def _share(t: pa.Table, word: np.ndarray) -> np.ndarray:
    share = np.zeros(len(word))
    share[np.searchsorted(word, t["w"].to_numpy())] = t["p"].to_numpy()
    return share


#: A bucket's tables of a context that is dealt over the buckets.
DEALT = "bucket int, w long, t long"


def _seat_dealt(discount: float, strength: float, buckets: int):
    """Buckets with the shares of their words -> tables of the contexts dealt over the buckets, every dish seated once."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"bucket": pa.array([], pa.int32()), "w": pa.array([], pa.int64()), "t": pa.array([], pa.int64())})
        batch, u, room, word, w, c, rest, singles = _read(left)
        bucket = batch.column(0)[0].as_py()
        own = np.flatnonzero((c > 1) & room[rest])
        p = _share(right, word)[w[own]]
        seating = Seating(c[own], rest[own].astype(np.int64), p, np.full(len(u), float(buckets)), singles, discount, strength, SEED + bucket)
        at = np.flatnonzero(room)
        return pa.table({"bucket": pa.array(np.full(len(at), bucket), pa.int32()), "w": pa.array(u[at]), "t": pa.array(seating.total[at].astype(np.int64))})

    return run


def _seat(discount: float, strength: float, burn: int, samples: int, hot):
    """Buckets with the shares of their words, and the tables in all other buckets
    of contexts dealt over them (p NULL) -> seated buckets and answers."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_batches([_row(SEATED)])
        batch, u, _, word, w, c, rest, singles = _read(left)
        bucket = batch.column(0)[0].as_py()
        customers = np.bincount(rest, c, len(u)).astype(np.int64)
        shared = np.flatnonzero(c > 1)
        p = _share(right.filter(right["p"].is_valid()), word)[w[shared]]
        dealt = right.filter(right["p"].is_null())
        outside = np.zeros(len(u))
        outside[np.searchsorted(u, dealt["w"].to_numpy())] = dealt["t"].to_numpy()
        seating = Seating(c[shared], rest[shared].astype(np.int64), p, np.ones(len(u)), singles, discount, strength, SEED + bucket, outside)
        for _ in range(burn):
            seating.sweep()
        mean, tables, sent = np.ones(len(w)), [], []
        mean[shared] = 0.0
        for _ in range(samples):
            t, total = seating.sweep()
            mean[shared] += t / samples
            every = np.ones(len(w), np.int32)
            every[shared] = t
            tables.append(total)
            sent.append(np.bincount(w, every, len(word)).astype(np.int64))
        del seating, every, shared
        whole = customers.copy()  # of a context dealt over the buckets: all of it
        at = np.searchsorted(hot.value[0], u)
        inside = np.flatnonzero((at < len(hot.value[0])) & (hot.value[0][np.minimum(at, max(len(hot.value[0]) - 1, 0))] == u)) if len(hot.value[0]) else []
        whole[inside] = hot.value[1][at[inside]] if len(hot.value[0]) else whole[inside]
        a = np.maximum(c - discount * mean, 0.0) / (strength + whole[rest])
        own = _row(SEATED, bucket=bucket, u=u, customers=customers, tables=np.stack(tables, 1).ravel(), words=word, sent=np.stack(sent, 1).ravel())
        a = np.r_[a, 0.0].astype(np.float32)  # as it is packed
        blocks, sizes, place = _lists(batch, 0, "blocks", "asked", "place")
        edges = np.r_[0, np.cumsum(sizes)].tolist()
        return pa.Table.from_batches([own, *[_row(SEATED, bucket=bucket, block=k, a=a[place[i:j]]) for k, i, j in zip(blocks.tolist(), edges, edges[1:])]])

    return run


def _seat_parent(discount: float, strength: float, base: float, samples: int, rooms: int, outside: dict[int, list[int]] | None):
    """Words of a room with their customers in each kept sweep -> their tables.
    ``outside``: tables of all other rooms, by room and sweep, once they are counted."""
    def run(t: pa.Table) -> pa.Table:
        n = t.num_rows
        k = t["k"].combine_chunks().flatten().to_numpy().reshape(n, samples)
        out = np.ones((n, samples), np.int64)
        others = [0] * samples if outside is None else outside[t["room"][0].as_py()]
        for s in range(samples):
            shared = np.flatnonzero(k[:, s] > 1)
            spread = np.array([float(rooms) if outside is None else 1.0])
            seating = Seating(k[shared, s], np.zeros(len(shared), np.int64), np.full(len(shared), base), spread, np.array([n - len(shared)]), discount, strength, SEED + s, others[s])
            out[shared, s] = seating.sweep()[0]
        return pa.table({"room": t["room"], "w": t["w"], "c": t["c"], "k": t["k"], "t": pa.ListArray.from_arrays(np.arange(0, n * samples + 1, samples, np.int32), out.ravel())})

    return run


def _discount(n1: int | None, n2: int | None) -> float:
    return min(max((n1 or 0) / max((n1 or 0) + 2 * (n2 or 0), 1), 0.05), 0.95)


# --- the model ----------------------------------------------------------------

class Model:
    """Spark tables: ``lexicon`` (w, its training count c, and for each kept sweep
    the parent's p(w), then what the context w hands to the parent) and
    ``seated`` (the weights of the pairs that blocks asked for); and the totals."""

    def __init__(self, blocks: DataFrame, strength: float = STRENGTH, burn: int = BURN, samples: int = SAMPLES):
        spark = blocks.sparkSession
        self.blocks, self.samples = blocks, samples
        tokens = blocks.agg(F.sum("tokens")).first()[0] or 0
        self.buckets, self.parts = (int(max(1, -(-tokens // size))) for size in (BUCKET, PART))
        counts = written(word_counts(blocks, self.parts))
        self.tokens, self.known = (x or 0 for x in counts.agg(F.sum("c"), F.count("w")).first())
        texts = counts.where(F.col("w") == END).select(F.sum("c")).first()[0] or 0
        large = counts.where((F.col("c") > ROOM) & (F.col("w") != END)).collect()  # at most tokens / ROOM
        pairs = sorted([(r.w, r.c) for r in large] + ([(START, texts)] if texts > ROOM else []))
        hot = spark.sparkContext.broadcast((np.array([x for x, _ in pairs], np.int64), np.array([x for _, x in pairs], np.int64)))
        self.hot = spark.sparkContext.broadcast(hot.value[0])

        asked = requests(blocks, self.buckets, self.hot).repartition(self.buckets, "bucket")
        merged = written(asked.groupBy("bucket").applyInArrow(_merge, MERGED))
        d = _discount(*merged.agg(F.sum("n1"), F.sum("n2")).first())

        total = float(max(self.tokens, 1))

        def shares(dealt: bool) -> DataFrame:
            return merged.mapInArrow(_shared(dealt), "bucket int, w long").join(counts, "w").select("bucket", "w", (F.col("c") / F.lit(total)).alias("p"))

        known = shares(False).withColumn("t", F.lit(None).cast("long"))
        dealt = None
        if pairs and self.buckets > 1:
            dealt = written(merged.groupBy("bucket").cogroup(shares(True).groupBy("bucket")).applyInArrow(_seat_dealt(d, strength, self.buckets), DEALT))
            every = F.broadcast(dealt.groupBy("w").agg(F.sum("t").alias("every")))  # a line for each such context
            known = known.unionByName(dealt.join(every, "w").select("bucket", "w", F.lit(None).cast("double").alias("p"), (F.col("every") - F.col("t")).alias("t")))
        seat = _seat(d, strength, burn, samples, hot)
        self.seated = written(merged.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(seat, SEATED))
        for table in [merged] if dealt is None else [merged, dealt]:
            _remove(table)

        def unpacked(names: list[str], schema: str) -> DataFrame:
            return self.seated.where("block is null").select(*names).mapInArrow(_unpacked(samples), schema)

        sums = [F.sum(f"s{i}").alias(f"s{i}") for i in range(samples)]
        flat = ", ".join(f"s{i} long" for i in range(samples))
        contexts = unpacked(["u", "customers", "tables"], f"key long, c long, {flat}").groupBy("key").agg(F.sum("c").alias("c"), *sums)
        back_off = F.array(*[((strength + d * F.col(f"s{i}")) / (strength + F.col("c"))).cast("float") for i in range(samples)])
        # the start of a text shares its line of the lexicon with the end
        contexts = contexts.select(F.when(F.col("key") == START, END).otherwise(F.col("key")).alias("w"), back_off.alias("b"))

        sent = unpacked(["words", "sent"], f"key long, {flat}").groupBy("key").agg(*sums)
        sent = sent.select(F.col("key").alias("w"), F.array(*[F.col(f"s{i}").cast("long") for i in range(samples)]).alias("k"))
        rooms = int(max(1, -(-self.known // ROOM)))
        parents = written(counts.join(sent, "w").withColumn("room", F.pmod(F.xxhash64("w"), F.lit(rooms)).cast("int")))
        d0 = _discount(*parents.agg(*[F.sum(sum((F.col("k")[i] == n).cast("long") for i in range(samples))) for n in (1, 2)]).first())
        base = 1.0 / (self.known + 1)
        outside = None
        for _ in range(2 if rooms > 1 else 1):  # the second time each room knows the tables of all others
            if outside is not None:
                _remove(words)
            seat = _seat_parent(d0, strength, base, samples, rooms, outside)
            words = written(parents.groupBy("room").applyInArrow(seat, "room int, w long, c long, k array<long>, t array<long>"))
            found = {r[0]: list(r)[1:] for r in words.groupBy("room").agg(*[F.sum(F.col("t")[i]) for i in range(samples)]).collect()}
            outside = {room: [sum(x[i] for x in found.values()) - own[i] for i in range(samples)] for room, own in found.items()}
        sums = words.agg(*[F.sum(F.col(x)[i]) for i in range(samples) for x in ("k", "t")]).first()
        customers, tables = [s or 0 for s in sums[0::2]], [s or 0 for s in sums[1::2]]
        #: Of a word that training rows don't hold, in each kept sweep.
        self.unknown = [(strength + d0 * t) / (strength + k) * base for k, t in zip(customers, tables)]
        p = [((F.col("k")[i] - d0 * F.col("t")[i]) / (strength + customers[i]) + self.unknown[i]) for i in range(samples)]
        values = F.concat(F.array(*p).cast("array<float>"), F.coalesce("b", F.array_repeat(F.lit(1.0).cast("float"), samples)))
        self.lexicon = written(words.join(contexts, "w", "left").select("w", "c", values.alias("v")))
        for table in (counts, parents, words):
            _remove(table)


def _look_up(left: pa.Table, right: pa.Table) -> pa.Table:
    """Words of blocks and the lexicon of their part of the vocabulary -> answers."""
    w = right["w"].to_numpy()
    order = np.argsort(w)
    w, c, v = w[order], right["c"].to_numpy(), right["v"].combine_chunks().flatten().to_numpy().reshape(len(w), -1) if len(w) else np.zeros((0, 1))
    rows = [_row(TOLD)]
    for batch in left.to_batches():
        for r in range(batch.num_rows):
            words = _lists(batch, r, "words")[0]
            place = np.searchsorted(w, words)
            at = np.flatnonzero(w.take(place, mode="clip") == words) if len(w) else []
            if not len(at):
                continue
            own = order[place[at]]
            rows.append(_row(TOLD, block=batch.column(0)[r].as_py(), bucket=-1 - batch.column(1)[r].as_py(), at=at, c=c[own], v=v[own].ravel(), a=[]))
    return pa.Table.from_batches(rows)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(model: Model):
    buckets, parts, hot, samples, tokens, known, unknown = model.buckets, model.parts, model.hot, model.samples, model.tokens, model.known, model.unknown
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        batch = left.combine_chunks().to_batches()[0]
        b = Block(batch, 0)
        bucket, _ = b.buckets(buckets, hot.value)
        order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        words, begin = word_places(b.word, parts)
        seen = np.zeros(len(b.pair))
        c, p, back = np.zeros(len(b.word), np.int64), np.tile(unknown, (len(b.word), 1)), np.ones((len(b.word), samples))
        for told in right.to_batches():
            for r in range(told.num_rows):
                k = told.column(1)[r].as_py()
                if k >= 0:
                    seen[order[edges[k]: edges[k + 1]]] = _lists(told, r, "a")[0]
                    continue
                at, counts, values = _lists(told, r, "at", "c", "v")
                at = words[begin[-1 - k]: begin[-k]][at]
                c[at] = counts
                p[at], back[at] = np.split(values.reshape(len(at), -1), 2, axis=1)
        mixed = np.zeros(len(b.pair))
        for s in range(samples):
            told = np.ascontiguousarray(back[:, s]).take(b.context)
            told *= np.ascontiguousarray(p[:, s]).take(b.w)
            told += seen
            mixed += told
        mixed /= samples
        logs = np.log10(mixed, out=mixed).take(b.places())
        base = np.log10((c + 0.5) / (tokens + 0.5 * (known + 1)))[b.token]
        first = np.cumsum(b.size) - b.size
        ids = batch.column(batch.schema.get_field_index("doc_id"))[0].values
        return pa.table([ids, pa.array(b.held), pa.array(b.size.astype(np.int64)), pa.array(np.add.reduceat((c > 0).astype(np.int64)[b.token], first)),
                         pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(logs, first))], schema=schema)

    return run


def score(docs: DataFrame, held: Column, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score (smoothed shares of single words), score (log10
    probability of its tokens under the model learnt from the rows that
    ``held`` does not select)."""
    blocks = written(encode(docs, doc_id, text, held))
    model = Model(blocks, **settings)
    none = F.lit(None).cast("binary")
    pairs = model.seated.where("block is not null").select("block", "bucket", none.alias("at"), none.alias("c"), none.alias("v"), "a")
    lexicon = model.lexicon.withColumn("bucket", F.pmod("w", F.lit(model.parts)).cast("int"))
    own = written(vocabulary(blocks, model.parts, False).groupBy("bucket").cogroup(lexicon.groupBy("bucket")).applyInArrow(_look_up, TOLD))
    told = pairs.unionByName(own)
    rows = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_score(model), SCORED)
    return rows.withColumn("train_tokens", F.lit(model.tokens).cast("long"))
