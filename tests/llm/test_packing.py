import itertools

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sluicework.llm.packing import hilbert_index, pack_along_curve
from sluicework.llm.tokens import WordTokenizer
from tests.llm.helpers import DOCUMENT, documents

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
CACHED = WordTokenizer(PATH)


def ids(text):
    return PLAIN.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_words_give_the_ids_of_the_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in CACHED.encode(texts)] == [ids(t) for t in texts]


def test_cache_that_overflows(monkeypatch):
    monkeypatch.setattr("sluicework.llm.tokens.KNOWN_WORDS", 3)
    small = WordTokenizer(PATH)
    for text in ("a b c d e f", "g h, i a b", "z" * 200 + " a"):
        assert np.frombuffer(small.encode([text])[0], "<u4").tolist() == ids(text)


def test_words_over_segments(monkeypatch):
    """Segments end between words, and words longer than a segment stay whole."""
    monkeypatch.setattr("sluicework.llm.tokens.SEGMENT_BYTES", 16)
    texts = ["a b " * 20, "z" * 90 + " y", "", None, "é" * 50, "Straße, nicht! " * 9, " \t\n", "'s don't x's <|endoftext|> 12 3a"]
    for tokenizer in (WordTokenizer(PATH), WordTokenizer(PATH)):
        for _ in range(2):
            assert [np.frombuffer(b, "<u4").tolist() for b in tokenizer.encode(texts)] == [ids(t or "") for t in texts]


def test_words_whose_hashes_meet(monkeypatch):
    """A word whose first hash is another's is told apart by the second."""
    monkeypatch.setattr("sluicework.llm.tokens.mixed", lambda x: x % np.uint64(97))
    monkeypatch.setattr("sluicework.llm.tokens._VALUES", np.stack([np.ones(256, np.uint64), np.arange(256, dtype=np.uint64)]))
    monkeypatch.setattr("sluicework.llm.tokens._POWERS", np.stack([np.ones(40, np.uint64), 3 ** np.arange(40, dtype=np.uint64)]))
    own = WordTokenizer(PATH)
    for text in ("ab", "cd ab", "ef", "cd ef ab"):
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == ids(text)


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_visits_every_cell_by_single_steps(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    order = np.argsort(hilbert_index(cells, bits))
    assert sorted(hilbert_index(cells, bits)) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()


def _check(rows, pieces, capacity):
    by_document = {}
    for p in pieces:
        by_document.setdefault(p.doc_id, []).append(p)
    for doc_id, own in by_document.items():
        expected = sorted([ids(t or "") + [2] for i, t in rows if i == doc_id])
        found, at = [], []
        for p in sorted(own, key=lambda p: (p.start, p.sequence_id)):
            assert p.length * 4 == len(p.ids)
            at.append((p.start, np.frombuffer(p.ids, "<u4").tolist()))
        if len(expected) == 1:
            assert sum((x for _, x in at), []) == expected[0]
        else:
            assert sorted(sum((x for _, x in at), [])) == sorted(sum(expected, []))
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    assert sorted(sequences) == list(range(len(sequences)))
    for number, own in sequences.items():
        end = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == end
            end += p.length
        assert end == capacity or number == len(sequences) - 1


@pytest.mark.parametrize("ranges", [1, 7])
def test_pieces_hold_every_id_once(spark, monkeypatch, ranges):
    monkeypatch.setattr("sluicework.llm.packing.RANGE_TOKENS", 4000 // ranges)
    rows = [(i, f"text number {i} " * (i % 40)) for i in range(200)]
    rows += [(900, None), (901, ""), (902, "same"), (902, "same"), (None, "no id"), (903, "word " * 9000)]
    df = documents(spark, rows).selectExpr("*", "1 AS rank", "2 AS range", "3 AS start", "4 AS tie")
    _check(rows, pack_along_curve(df, PATH, 512).collect(), 512)


def test_equal_documents_are_neighbours(spark):
    texts = [f"{w} " * 30 for w in ("apple", "stone", "river")]
    rows = [(i, texts[i % 3]) for i in range(90)]
    pieces = sorted(pack_along_curve(documents(spark, rows), PATH, 4096).collect(), key=lambda p: (p.sequence_id, p.offset))
    kinds = [p.doc_id % 3 for p in pieces if p.start == 0]
    assert sum(a != b for a, b in itertools.pairwise(kinds)) == 2


def test_empty_table(spark):
    assert pack_along_curve(spark.createDataFrame([], DOCUMENT), PATH).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab.,é'1 ßİΣ́", max_size=30), max_size=6))
def test_marks_and_letters_give_the_ids_of_the_text(texts):
    assert [np.frombuffer(b, "<u4").tolist() for b in CACHED.encode(texts)] == [ids(t) for t in texts]
