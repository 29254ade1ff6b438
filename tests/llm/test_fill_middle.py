import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluicework.llm import fill_middle as module
from sluicework.llm.fill_middle import fill_in_middle, restore, restored, reverse, token_ends, transformed
from tests.llm.helpers import DOCUMENT, documents

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
PIECES = st.text(alphabet="aé日𝄞<PSM> \t\n\x0b ", max_size=60)


def plain(doc_id, text):
    """One row by string functions."""
    text = text or ""
    tokens = TOKEN.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 50:
        return doc_id, len(tokens), "plain", None, None, text
    if h4 % 100 < 80:
        return doc_id, len(tokens), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(tokens), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=300, deadline=None)
@given(PIECES)
def test_scan_finds_the_ends_of_tokens(text):
    sizes = [len(t.encode()) for t in TOKEN.findall(text)]
    assert token_ends(text.encode()).tolist() == np.cumsum(sizes, dtype=int).tolist()


@settings(max_examples=300, deadline=None)
@given(PIECES, PIECES, PIECES, st.integers(1, 5))
def test_rotations_are_undone(prefix, middle, suffix, swap):
    whole = prefix + middle + suffix
    if any(mark in whole for mark in ("<P>", "<S>", "<M>")):
        return
    a, b = len(prefix.encode()), len((prefix + middle).encode())
    module.SWAP_BYTES, before = swap, module.SWAP_BYTES
    try:
        for form, expected in (("spm", f"<S>{suffix}<P>{prefix}<M>{middle}"), ("psm", f"<P>{prefix}<S>{suffix}<M>{middle}"), ("plain", whole)):
            output = transformed(whole.encode(), a, b, form)
            assert bytes(output) == expected.encode()
            assert restored(bytes(output), form) == whole.encode()
    finally:
        module.SWAP_BYTES = before


@pytest.mark.parametrize("size", [0, 1, 2, 7, 200_001])
def test_reverse(size):
    data = np.random.default_rng(size).integers(0, 256, size).astype(np.uint8)
    expected = data[::-1].copy()
    reverse(data)
    assert np.array_equal(data, expected)


def test_rows_equal_the_plain_version(spark):
    texts = ["", None, "one", "  two words ", "a <P> b c d", " x y z", "日本 語 text\n\n", "<S", "long words " * 60_000]
    rows = [(i, texts[i % len(texts)]) for i in range(120)] + [(7, "again and again"), (7, "again and again"), (None, "no id at all"), (-5, " minus five ")]
    df = documents(spark, rows).selectExpr("*", "1 AS n", "2 AS form", "3 AS output", "4 AS row")
    out = fill_in_middle(df)
    found = sorted(map(tuple, out.collect()), key=str)
    assert found == sorted((plain(i, t) for i, t in rows), key=str)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}
    back = sorted((tuple(r) for r in restore(out).collect()), key=str)
    assert back == sorted(((i, t or "") for i, t in rows), key=str)


def test_small_batches(spark, monkeypatch):
    monkeypatch.setattr(module, "BATCH_BYTES", 10)
    rows = [(i, f"text of number {i}") for i in range(30)]
    assert sorted(map(tuple, fill_in_middle(documents(spark, rows)).collect())) == sorted(plain(i, t) for i, t in rows)


def test_parameters(spark):
    rows = [(i, "a b c d e f") for i in range(50)]
    assert {r.form for r in fill_in_middle(documents(spark, rows), changed_percent=100, spm_percent=0).collect()} == {"psm"}


def test_empty_table(spark):
    out = fill_in_middle(spark.createDataFrame([], DOCUMENT))
    assert out.collect() == [] and restore(out).collect() == []
