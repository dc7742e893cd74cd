"""Fill-in-the-middle: cuts against a plain regex version, exact round trips."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidecast.llm import fill_middle as fm
from tidecast.llm import queries as Q

SF = "/root/testdata/sf0.001"


def brute(doc_id, text, unit="line", seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i: 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


TEXTS = ["", None, "\n", "one line", "a\nb\n", "a\n\n\nb", "é\nü漢字\n😀\n", "has <M> inside", "<", "<P\n>x\n<S", "<M\n<\n>\nM>",
         "line of some length\n" * 2000, "漢" * 5000 + "\n" + "x" * 9000, "\n" * 10000, "a" * 4096 + "\n" + "b" * 4095 + "\n"]


@pytest.mark.parametrize("unit", fm.UNITS)
def test_matches_regex_version(spark, unit):
    rows = [(i, t, "other") for i, t in enumerate(TEXTS * 6)] + [(None, "a\nb\nc"), (None, None), (3, "again\nand again\n"), (3, "again\nand again\n")]
    rows = [(*r, None)[:3] for r in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string")
    out = fm.fill_in_middle(docs, unit=unit).withColumn("back", fm.restored()).collect()
    key = lambda r: (r[0] is None, r[0] or 0, str(r))
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out), key=key)
    assert got == sorted(((i, *brute(i, t, unit)) for i, t, _ in rows), key=key)
    texts = {i: t or "" for i, t, _ in rows if i != 3 and i is not None}
    assert all(r.back == texts[r.doc_id] for r in out if r.doc_id in texts)
    assert {r.form for r in out} == {"plain", "psm", "spm"}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="a\né漢😀<>PSM", max_size=60), st.integers(0, 10**6), st.sampled_from(fm.UNITS))
def test_any_text(text, doc_id, unit):
    n, form, prefix, middle, out = fm.transform(np.frombuffer(text.encode(), np.uint8), doc_id, unit, 7, 100, 50)
    assert (n, form, prefix, middle, out.decode()) == brute(doc_id, text, unit)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3 * fm.BLOCK), max_size=6), st.integers(0, 5 * fm.BLOCK))
def test_tree_cuts_across_blocks(at, size):
    data = np.full(size, 0x61, np.uint8)
    data[[a for a in at if a < size]] = 0x0A
    ends = np.flatnonzero(fm.unit_ends(data, "line")) + 1
    tree = fm.BlockTree(data, "line")
    assert tree.units == len(ends)
    assert [tree.cut(k + 1) for k in range(len(ends))] == [(e, e) for e in ends]


def test_rate_and_empty_table(spark):
    docs = spark.createDataFrame([(i, "a\nb\nc\n") for i in range(300)], "doc_id long, text string")
    forms = [r.form for r in fm.fill_in_middle(docs, rate=40, spm=0).collect()]
    assert set(forms) == {"plain", "psm"} and 80 < forms.count("psm") < 160
    assert fm.fill_in_middle(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fm.fill_in_middle(docs, unit="word")


def test_query_round_trip(spark):
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = Q.op11_fill_middle(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, form, prefix, middle, out = brute(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256) == (n, form, prefix, middle, sha(out))
        assert r.restored_sha256 == sha(docs[r.doc_id])
