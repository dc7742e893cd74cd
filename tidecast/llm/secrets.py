"""Secret scans with built-in functions only.

Base kinds are patterns.  ``regexp_extract_all`` gives the matches of a
pattern and ``split`` what lies between them, so running lengths give spans
in code points without a user function.

The entropy kinds look at candidate strings: runs of a character class that
are at least a window long.  Matches of the allow list, plain words between
slashes and base spans are cut out of a candidate, and what is left of it is
searched piece by piece.  A window slides over the piece; one character enters
and one leaves, so the class's counters and the sum of ``n * log2(n)`` change
in two places, and the Shannon entropy is ``log2(w) - sum / w``.  Windows whose
entropy reaches the class's threshold (a higher one where the piece holds no
digit, as long words do) make up the piece's span, from the first to the last
such window.

Every array is folded in runs of about the square root of its length
(:func:`_scan`), so that appending to a result copies little; the counters of
a window are packed into a few longs.  A text thus costs about its length,
whether it is one candidate or full of matches.

Cases: a null text counts as empty and has no span; null ids and repeated
rows are returned as they are; texts of any length are read whole; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import text_of

#: Fixed values: (kind, pattern, group that counts, least characters in it).
KINDS = (
    ("assign", r"""((?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 6),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 20),
    ("hex", r"([0-9a-f]+)", 1, 24),
)
#: A pattern of the same matches that keeps only those long enough, where there is one: runs are maximal.
DIRECT = {"access": r"(AKIA[A-Z0-9]{16,})", "hex": r"([0-9a-f]{24,})"}
WINDOW = 20
#: (kind, candidates, alphabet, least entropy in bits of a window, the same for pieces without a digit).
ENTROPY = (
    ("entropy64", r"((?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,})", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.9, 4.05),
    ("entropyhex", r"((?<![A-Za-z0-9])[0-9A-F]{20,}(?![A-Za-z0-9]))", "0123456789ABCDEF", 3.2, 3.2),
)
#: A counter goes up to WINDOW; this many bits of a long hold it.
BITS = 5
#: Parts of candidates that are placeholders or the start of links.
ALLOW = r"(?i)example|sample|placeholder|changeme|dummy|xxxx|0123456789|abcdefgh|^https?|^www"
#: The same, and plain words between slashes.
CUT = rf"((?i:{ALLOW.removeprefix('(?i)')})|/[A-Za-z][a-z]{{2,}}(?=/))"


SPAN = "array<struct<start:int,end:int>>"
PIECE = "array<struct<start:int,end:int,found:string>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scan(items: Column, zero: Column, step, kind: str) -> Column:
    """Fold ``items``, and join the arrays that the steps put out: ``step(state,
    item)`` gives struct<state, out>.  Runs of sqrt(n) items put their outputs
    together first, so each output is copied about sqrt(n) times, not n times."""
    def append(joined):
        return lambda acc, x: _let(step(acc["state"], x), lambda s: F.struct(s["state"].alias("state"), F.concat(acc["out"], joined(s["out"])).alias("out")))

    none, runs = F.array().cast(kind), F.array().cast(f"array<struct<o:{kind}>>")

    def inner(acc, run):
        part = F.aggregate(run, F.struct(acc["state"].alias("state"), none.alias("out")), append(lambda o: o))
        return _let(part, lambda p: F.struct(p["state"].alias("state"), F.concat(acc["out"], F.array(F.struct(p["out"].alias("o")))).alias("out")))

    def whole(xs):
        size = F.ceil(F.sqrt(F.size(xs))).cast("int")
        cut = F.transform(F.sequence(F.lit(0), F.ceil(F.size(xs) / size).cast("int") - 1), lambda i: F.slice(xs, i * size + 1, size))
        folded = F.aggregate(cut, F.struct(zero.alias("state"), runs.alias("out")), inner)
        return F.when(F.size(xs) > 0, F.flatten(F.transform(folded["out"], lambda r: r["o"]))).otherwise(none)

    return _let(items, whole)


def _matches(text: Column, pattern: str, group: int, least: int) -> Column:
    """array<struct<start, end, found>> of the matches whose group has ``least`` characters."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    between = F.split(text, pattern, -1)
    # Java's split leaves the groups out; an empty leading piece stays as every match has a width
    steps = F.zip_with(between, found, lambda b, x: F.struct(F.length(b).alias("gap"), x.alias("found")))
    if group != 1:
        inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        steps = F.zip_with(steps, inner, lambda s, i: F.struct(s["gap"].alias("gap"), s["found"].alias("found"), (F.length(i) >= least).alias("fits")))
    else:
        steps = F.transform(steps, lambda s: F.struct(s["gap"].alias("gap"), s["found"].alias("found"), (F.length(s["found"]) >= least).alias("fits")))

    def step(at, s):
        start = at + s["gap"]
        end = start + F.coalesce(F.length(s["found"]), F.lit(0))
        hit = F.struct(start.alias("start"), end.alias("end"), s["found"].alias("found"))
        return F.struct(end.alias("state"), F.when(s["fits"], F.array(hit)).otherwise(F.array().cast(PIECE)).alias("out"))

    return F.when(F.size(found) > 0, _scan(steps, F.lit(0), step, PIECE)).otherwise(F.array().cast(PIECE))


def _allowed(candidate: Column) -> Column:
    """What is left of a candidate between matches of the allow list, where a window fits in."""
    found = candidate["found"]
    parts = F.zip_with(F.split(found, CUT, -1), F.regexp_extract_all(found, F.lit(CUT), F.lit(1)), lambda p, c: F.struct(p.alias("part"), F.coalesce(F.length(c), F.lit(0)).alias("cut")))

    def step(at, s):
        end = at + F.length(s["part"])
        piece = F.struct(at.alias("start"), end.alias("end"), s["part"].alias("found"))
        return F.struct((end + s["cut"]).alias("state"), F.when(end - at >= WINDOW, F.array(piece)).otherwise(F.array().cast(PIECE)).alias("out"))

    return _scan(parts, candidate["start"], step, PIECE)


def _uncovered(pieces: Column, base: Column) -> Column:
    """Parts of the pieces outside all base spans, where a window fits in: one
    sweep over both in order of their starts.  struct<piece, start, end>."""
    kind = "array<struct<piece:int,start:int,end:int>>"
    spans = F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(-1).alias("piece"), b["end"].alias("end")))
    events = F.transform(pieces, lambda p, i: F.struct(p["start"].alias("start"), i.alias("piece"), p["end"].alias("end")))
    last = F.array(F.struct(F.lit(2**31 - 1).alias("start"), F.lit(-1).alias("piece"), F.lit(2**31 - 1).alias("end")))
    zero = F.struct(F.lit(-1).alias("piece"), F.lit(0).alias("at"), F.lit(0).alias("end"), F.lit(0).alias("covered"))

    def step(s, e):
        # what lies before this event of the piece under way
        stop = F.least(s["end"], e["start"])
        out = F.when((s["piece"] >= 0) & (stop - s["at"] >= WINDOW), F.array(F.struct(s["piece"].alias("piece"), s["at"].alias("start"), stop.alias("end")))).otherwise(F.array().cast(kind))
        fresh = e["piece"] >= 0
        covered = F.when(fresh, s["covered"]).otherwise(F.greatest(s["covered"], e["end"]))
        state = F.struct(
            F.when(fresh, e["piece"]).otherwise(s["piece"]).alias("piece"),
            F.when(fresh, F.greatest(e["start"], s["covered"])).otherwise(F.greatest(s["at"], e["end"])).alias("at"),
            F.when(fresh, e["end"]).otherwise(s["end"]).alias("end"),
            covered.alias("covered"),
        )
        return F.struct(state.alias("state"), out.alias("out"))

    return F.when(F.size(pieces) > 0, _scan(F.concat(F.array_sort(F.concat(spans, events)), last), zero, step, kind)).otherwise(F.array().cast(kind))


def _codes(found: Column, alphabet: str) -> Column:
    """Places of the characters in the alphabet."""
    table = [0] * 128
    for i, c in enumerate(alphabet):
        table[ord(c)] = i
    places = F.lit(table)
    return F.transform(F.filter(F.split(found, ""), lambda c: c != ""), lambda c: F.get(places, F.ascii(c)))


def _windows(codes: Column, size: int, least: Column) -> Column:
    """struct<first, last>: starts of the first and last window whose entropy
    reaches ``least``; -1 if none does."""
    each = 60 // BITS  # counters in a long
    weigh = F.lit([n * math.log2(n) if n else 0.0 for n in range(WINDOW + 2)])
    ones, shifts = F.lit([1 << BITS * (i % each) for i in range(size)]), F.lit([BITS * (i % each) for i in range(size)])
    most = F.lit(float(WINDOW)) * (F.lit(math.log2(WINDOW)) - least) + F.lit(1e-9)  # of the sum, for an entropy of ``least``
    longs, words = -(-size // each), F.lit([i // each for i in range(size)])
    zero = F.struct(F.array(*[F.lit(0).cast("long")] * longs).alias("counts"), F.lit(0.0).alias("total"), F.lit(0).alias("i"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))
    moves = F.zip_with(codes, F.concat(F.array_repeat(F.lit(-1), WINDOW), codes), lambda e, l: F.struct(e.alias("enters"), l.alias("leaves")))

    def put(counts, total, code, by: int):
        """(counters, sum) after one character more or less."""
        word = F.get(words, code)
        old = F.call_function("shiftright", F.get(counts, word), F.get(shifts, code)).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")
        changed = F.transform(counts, lambda n, k: F.when(k == word, n + by * F.get(ones, code)).otherwise(n))
        return _let(old, lambda n: F.struct(changed.alias("counts"), (total + F.get(weigh, n + by) - F.get(weigh, n)).alias("total")))

    def step(acc, m):
        entered = put(acc["counts"], acc["total"], m["enters"], 1)
        moved = _let(entered, lambda s: F.when(m["leaves"] >= 0, put(s["counts"], s["total"], m["leaves"], -1)).otherwise(s))

        def judged(s):
            hot = (acc["i"] >= WINDOW - 1) & (s["total"] <= most)
            start = acc["i"] - (WINDOW - 1)
            return F.struct(
                s["counts"].alias("counts"), s["total"].alias("total"), (acc["i"] + 1).alias("i"),
                F.when(hot & (acc["first"] < 0), start).otherwise(acc["first"]).alias("first"), F.when(hot, start).otherwise(acc["last"]).alias("last"),
            )

        return _let(moved, judged)

    # the shifted codes are longer by a window: nothing enters there
    return F.aggregate(F.filter(moves, lambda m: m["enters"].isNotNull()), zero, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def _hot(text: Column, base: Column, pattern: str, alphabet: str, least: float, plain: float) -> Column:
    """Spans of the hot windows of every piece."""
    low, high = alphabet.index("0"), alphabet.index("9")

    def judged(start, codes):
        bound = F.when(F.exists(codes, lambda c: (c >= low) & (c <= high)), F.lit(least)).otherwise(F.lit(plain))
        return F.struct(start.alias("start"), _windows(codes, len(alphabet), bound).alias("w"))

    def part(coded, x):
        return _let(F.get(coded, x["piece"]), lambda c: _let(F.slice(c["codes"], x["start"] - c["start"] + 1, x["end"] - x["start"]), lambda own: judged(x["start"], own)))

    def piecewise(pieces):
        coded = F.transform(pieces, lambda p: F.struct(p["start"].alias("start"), _codes(p["found"], alphabet).alias("codes")))
        return _let(coded, lambda cs: F.transform(_uncovered(pieces, base), lambda x: part(cs, x)))

    pieces = F.flatten(F.transform(_matches(text, pattern, 1, WINDOW), _allowed))
    hot = F.filter(_let(pieces, piecewise), lambda h: h["w"]["first"] >= 0)
    return F.transform(hot, lambda h: F.struct((h["start"] + h["w"]["first"]).alias("start"), (h["start"] + h["w"]["last"] + WINDOW).alias("end")))


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, spans: array<struct<start, rank, end, kind>> in order of start and kind."""
    out = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    for kind, pattern, group, least in KINDS:
        direct = DIRECT.get(kind)
        out = out.withColumn(kind, _matches(F.col("text"), direct or pattern, 1 if direct else group, 1 if direct else least))

    def spans(col, kind, rank):
        return F.transform(col, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    base = F.concat(*[spans(F.col(k), k, i) for i, (k, *_) in enumerate(KINDS)])
    out = out.withColumn("base", F.array_sort(base))
    for rank, (kind, *settings) in enumerate(ENTROPY, len(KINDS)):
        out = out.withColumn(kind, spans(_hot(F.col("text"), F.col("base"), *settings), kind, rank))
    every = F.array_sort(F.concat("base", *[F.col(k) for k, *_ in ENTROPY]))
    return out.select("doc_id", "base", every.alias("spans"))


def secret_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_<kind> of the base kinds, base_sha256, spans, n_entropy."""
    rows = secret_spans(docs, doc_id, text)

    def joined(col):
        return F.array_join(F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def counted(i):
        return F.size(F.filter("base", lambda s: s["rank"] == i)).cast("long")

    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[counted(i).alias(f"n_{k}") for i, (k, *_) in enumerate(KINDS)],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["rank"] >= len(KINDS))).cast("long").alias("n_entropy"),
    )
