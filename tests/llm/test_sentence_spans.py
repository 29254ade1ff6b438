import random
import re

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from sluicework.llm.sentence_spans import CUT_WINDOW, LAST_WORDS, MIN_SENTENCES, MIN_WORDS, WHOLE_WORDS, remove_repeated_spans, runs, sentences
from tests.llm.helpers import DOCUMENT, documents


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .!?\n,", max_size=400))
def test_sentences_make_up_the_text(text):
    assert "".join(sentences(text)) == text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a .!\n\u3000\u2028。！？」)是文カกｶ", max_size=80))
def test_sentences_make_up_texts_without_spaces(text):
    assert "".join(sentences(text)) == text


def plain_sentences(text):
    """The rule in plain words, for text with spaces: a sentence ends behind . ! or ?, marks that
    close, and white space, and at a line break. A word with no such stop in the WHOLE_WORDS
    words up to it and the LAST_WORDS from it on ends one too if its hash is the least of some CUT_WINDOW words in a row."""
    words = re.findall(r"\S+\s*", text)
    if not words:
        return [text] if text else []
    words[0] = text[: len(text) - sum(map(len, words))] + words[0]

    def value(word):
        x, top = xxhash.xxh3_64_intdigest(word.strip().lower()), (1 << 64) - 1
        for _ in range(2):
            x = ((x ^ (x >> 29)) * 0x9E3779B97F4A7C15) & top
        return x ^ (x >> 29)

    values = [value(w) for w in words]
    stops = [bool(re.search(r"[.!?]+[\"'”’)\]]*\s+$", w)) or w is words[-1] for w in words]
    pieces, piece = [], ""
    for i, word in enumerate(words):
        piece += word
        apart = not any(stops[max(0, i - WHOLE_WORDS + 1) : i + LAST_WORDS])
        windows = [values[k : k + CUT_WINDOW] for k in range(max(0, i - CUT_WINDOW + 1), i + 1) if k + CUT_WINDOW <= len(words)]
        if stops[i] or "\n" in word.lstrip() or apart and any(values[i] == min(w) for w in windows):
            pieces.append(piece)
            piece = ""
    return pieces


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["ab", "c", "dd.", "e!)", "f\n", "g", "hi", "j", "kl", "m", "no", "p", "q", "rs", "t"]), max_size=120))
def test_sentences_by_the_rule_in_plain_words(words):
    text = " ".join(f"{w}{i % 7}" if w.isalpha() else w for i, w in enumerate(words))
    assert sentences(text) == plain_sentences(text)


def plain(rows):
    """The same by looking at every run of any length as a tuple of words."""
    places, held = {}, []
    for doc_id, text in rows:
        pieces = [p.lower().split() for p in plain_sentences(text or "")]
        own = [
            (tuple(map(tuple, pieces[at:end])), at, end)
            for at in range(len(pieces))
            for end in range(at + MIN_SENTENCES, len(pieces) + 1)
            if sum(map(len, pieces[at:end])) >= MIN_WORDS
        ]
        held.append(own)
        for run, at, _ in own:
            places[run] = min(places.get(run, (doc_id, at)), (doc_id, at))
    result = {}
    for (doc_id, text), own in zip(rows, held, strict=True):
        gone = {k for run, at, end in own if places[run] != (doc_id, at) for k in range(at, end)}
        kept = None if text is None else "".join(p for k, p in enumerate(plain_sentences(text)) if k not in gone)
        result[doc_id] = kept, len(gone)
    return result


def _corpus():
    rng = random.Random(2)

    def prose(n):
        return " ".join(
            " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(2, 12))).capitalize() + "." for _ in range(n)
        )

    passages = [prose(8) for _ in range(3)]
    bare = " ".join(f"v{rng.randrange(5000)}" for _ in range(80))
    rows = [f"{prose(4)} {rng.choice(passages)} {prose(3)}" for _ in range(30)]
    rows += [f"{prose(2)} {bare} {prose(2)}" for _ in range(3)]
    rows += [prose(10)] * 3 + [passages[0] + " " + passages[0], "", None, "Short. Text."] + ["Short. Text."]
    return list(enumerate(rows))


def test_equals_plain_version(spark):
    rows = _corpus()
    found = {r.doc_id: (r.text, r.removed_sentences) for r in remove_repeated_spans(documents(spark, rows)).collect()}
    assert found == plain(rows)
    assert sum(n > 0 for _, n in found.values()) > 25


def test_passage_without_punctuation_goes(spark):
    rng = random.Random(3)
    bare = " ".join(f"v{rng.randrange(5000)}" for _ in range(90))
    rows = [(1, f"First one here. {bare} and so on."), (2, f"Another beginning {bare} with an end. Done.")]
    found = {r.doc_id: r.text for r in remove_repeated_spans(documents(spark, rows)).collect()}
    assert found[1] == rows[0][1]
    assert sum(w in found[2].split() for w in bare.split()) < 45


def test_null_ids_repeated_rows_and_other_columns(spark):
    text = "One two three four five six seven eight nine ten. Eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty."
    rows = [(7, text), (7, text), (None, text), (3, "before it. " + text)]
    df = documents(spark, rows).selectExpr("*", "1 AS run", "2 AS spans", "3 AS key_id", "4 AS removed_sentences", "5 AS first")
    found = remove_repeated_spans(df)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "run", "spans", "key_id", "first", "removed_sentences"]
    assert sorted(((r.doc_id, r.text, r.key_id) for r in found.collect()), key=str) == sorted(
        [(3, "before it. " + text, 3), (7, "", 3), (7, "", 3), (None, "", 3)], key=str
    )


def test_long_text_and_empty_table(spark):
    long = " ".join(f"Sentence number {i} of a text." for i in range(20_000))
    found = {r.doc_id: r.removed_sentences for r in remove_repeated_spans(documents(spark, [(1, long), (2, long)])).collect()}
    assert found == {1: 0, 2: 20_000}
    assert remove_repeated_spans(spark.createDataFrame([], DOCUMENT)).collect() == []


def test_run_depends_on_what_follows_only():
    tail = " ".join(f"Word{i} and more of it here." for i in range(9))
    a, b = runs("Start. " + tail), runs("Another start of it. And one. " + tail)
    assert set(a[0][1:].tolist()) <= set(b[0].tolist())


def test_passage_without_punctuation_goes_up_to_its_ends(spark):
    rng = random.Random(4)
    rows = []
    for i in range(0, 80, 2):
        bare = " ".join(f"v{rng.randrange(10**6)}" for _ in range(50))
        rows += [(i, f"{'a b c d e f ' * (i % 5)}{bare} and so on"), (i + 1, f"Another beginning {bare} with an end. Done.")]
    found = {r.doc_id: r.text for r in remove_repeated_spans(documents(spark, rows)).collect()}
    left = [sum(w[0] == "v" for w in found[i].split()) for i, _ in rows]
    assert set(left[::2]) == {50}
    assert max(left[1::2]) < 15 and sum(left[1::2]) < 40 * 10


def test_cut_does_not_depend_on_the_length_of_the_sentence():
    rng = random.Random(5)
    words = [f"v{rng.randrange(10**6)}" for _ in range(50)]
    short, long = sentences(" ".join(words)), sentences(" ".join(["a b c d"] * 20 + words))
    assert short[1:] == long[-len(short) + 1 :] and len(short) >= 5
    # Only the words before the end are left together.
    assert max(len(p.split()) for p in long[:-1]) <= CUT_WINDOW and len(long[-1].split()) < LAST_WORDS + CUT_WINDOW


def test_sentences_of_ordinary_length_are_whole():
    rng = random.Random(9)
    # The start of a text is no end of a sentence.
    made = ["Start. "] + [" ".join(f"v{rng.randrange(10**6)}" for _ in range(rng.randrange(1, WHOLE_WORDS + LAST_WORDS))) + ". " for _ in range(200)]
    assert sentences("".join(made)) == made


def test_equals_all_runs_where_passages_end_in_short_sentences(spark):
    rng = random.Random(6)

    def prose(*lengths):
        return " ".join(" ".join(f"w{rng.randrange(5000)}" for _ in range(n)) + "." for n in lengths)

    passages = [prose(30, 8, 8, 3), prose(5, 6, 4, 6, 3, 2, 1), prose(6, 6, 6, 6, 2, 2)]
    rows = [(i, f"{prose(5, 4)} {passages[i % 3]} {prose(6, 3)} {rng.choice(passages)}") for i in range(12)]
    found = {r.doc_id: (r.text, r.removed_sentences) for r in remove_repeated_spans(documents(spark, rows)).collect()}
    assert found == plain(rows)
    for i in range(3, 12):
        assert not set(passages[i % 3].split()[-3:]) & set(found[i][0].split())


def test_line_break_ends_a_sentence(spark):
    rng = random.Random(7)
    passage = " ".join(" ".join(f"w{rng.randrange(5000)}" for _ in range(n)) + "." for n in (5, 9, 14, 40))
    rows = [(1, f"Before it. {passage} And so on."), (2, f"A heading of a few words\n{passage}\n- an item\n"), (3, f"- item\n{passage}")]
    found = {r.doc_id: r.text for r in remove_repeated_spans(documents(spark, rows)).collect()}
    assert found == {1: rows[0][1], 2: "A heading of a few words\n- an item\n", 3: "- item\n"}
    assert sentences("One line\nanother line\n") == ["One line\n", "another line\n"]


def test_texts_without_spaces(spark):
    rng = random.Random(8)

    def prose(n):
        return "".join("".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(rng.randrange(5, 15))) + "。" for _ in range(n))

    passage, bare = prose(5), "".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(60))
    rows = [(1, prose(2) + passage + prose(2)), (2, prose(3) + passage + prose(1)), (3, prose(1) + bare), (4, prose(2) + bare)]
    found = {r.doc_id: r.text for r in remove_repeated_spans(documents(spark, rows)).collect()}
    assert found[1] == rows[0][1] and found[3] == rows[2][1]
    assert found[2] == rows[1][1].replace(passage, "")
    assert sum(c in found[4] for c in bare) < 15
