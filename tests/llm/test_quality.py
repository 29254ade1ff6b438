import math
import random
import re

import numpy as np
import pytest
import xxhash

from sluicework.llm.quality import _chosen, classify, features, fit, grades_of
from tests.llm.helpers import DOCUMENT, documents


def _corpus(n=1500):
    rng = random.Random(9)
    rows, ratings = [], []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 120))]
        grade = rng.choice([0, 1, 2, 2, 2])
        if grade == 0:
            words = [w + rng.choice(["***", "%%%"]) for w in words]
        if grade == 1:
            words.insert(rng.randrange(len(words)), rng.choice(["rude", "nasty"]))
        rows.append((i, " ".join(words)))
        ratings.append((i, grade))
    return rows, ratings


def test_held_out_accuracy(spark):
    rows, ratings = _corpus()
    known = spark.createDataFrame(ratings[:1200], "doc_id long, grade int")
    found = {r.doc_id: r for r in classify(documents(spark, rows), known).collect()}
    held = ratings[1200:]
    right = sum(found[i].keep == (grade == 2) for i, grade in held) / len(held)
    assert right > 0.9
    means = [np.mean([found[i].expected_grade for i, g in held if g == k]) for k in range(3)]
    assert means == sorted(means)
    assert all(0 <= r.tail <= 1 and 0 <= r.expected_grade <= 2 for r in found.values())


def test_thresholds_ascend(spark):
    rows, ratings = _corpus(200)
    model = fit(documents(spark, rows), spark.createDataFrame(ratings, "doc_id long, grade int"))
    assert (np.diff(model.thresholds) > 0).all()


def test_bound_of_rated_documents(spark):
    rows, ratings = _corpus(120)
    known = spark.createDataFrame(ratings, "doc_id long, grade int")
    whole, bounded = fit(documents(spark, rows), known), fit(documents(spark, rows), known, max_rated=30)
    assert not np.array_equal(whole.weights, bounded.weights)


@pytest.mark.parametrize("ratings", [[], [(1, 2)], [(1, None), (None, 0)]])
def test_without_two_grades_all_stay(spark, ratings):
    known = spark.createDataFrame(ratings, "doc_id long, grade int")
    df = documents(spark, [(1, "a b"), (2, None), (None, "")])
    assert all(r.keep for r in classify(df, known).collect())


def test_nulls_repeated_rows_other_columns_and_empty(spark):
    rows, ratings = _corpus(80)
    known = spark.createDataFrame([*ratings, (0, 2), (0, 0), (None, 1), (3, None)], "doc_id long, grade int")
    df = documents(spark, [*rows, (None, None), (5, rows[5][1]), (900, ""), (901, "w " * 10**5)])
    df = df.selectExpr("*", "1 AS keep", "2 AS grade", "3 AS row", "4 AS rated_id")
    found = classify(df, known)
    assert found.columns == [*DOCUMENT.replace(",", "").split()[::2], "grade", "row", "rated_id", "expected_grade", "tail", "keep"]
    assert found.count() == 84
    assert len({r.tail for r in found.filter("doc_id = 5").collect()}) == 1
    assert classify(spark.createDataFrame([], DOCUMENT), known).collect() == []


def test_grades(spark):
    labels = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 0), (None, None), (1, None)], "quality int, toxic int")
    found = [r.grade for r in grades_of(labels.selectExpr("1L AS doc_id", "*")).collect()]
    assert found == [0, 0, 1, 2, None, 2]


def test_features_of_nothing():
    assert [len(part) for part in features(None)] == [1, 1] == [len(part) for part in features(" \n")]


def test_rare_words_of_a_rare_grade(spark):
    rng = random.Random(11)
    rows, ratings = [], []
    for i in range(1800):
        grade = 1 if i % 10 == 0 else rng.choice([0, 2, 2])
        words = [f"w{rng.randrange(900)}" for _ in range(rng.randrange(40, 120))]
        if grade == 0:
            words = [w + "%%%" for w in words]
        if grade == 1:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), f"x{rng.randrange(60)}" + rng.choice(["", ",", ".", "!"]))
        rows.append((i, " ".join(words)))
        ratings.append((i, grade))
    known = spark.createDataFrame(ratings[:1200], "doc_id long, grade int")
    kept = {r.doc_id for r in classify(documents(spark, rows), known).filter("keep").collect()}
    shares = [np.mean([i in kept for i, g in ratings[1200:] if g == grade]) for grade in range(3)]
    assert shares[0] < 0.02 and shares[1] < 0.25 and shares[2] > 0.95


def test_rare_grades_are_taken_whole(spark):
    known = spark.createDataFrame([(i, 1 if i % 40 == 0 else 0 if i % 5 == 0 else 2) for i in range(2000)], "doc_id long, grade int")
    chosen, shares = _chosen(known, 330)
    found = [r.grade for r in chosen.collect()]
    assert [found.count(g) for g in range(3)] == [140, 50, 140]
    assert shares == {0: 350 / 140, 1: 1.0, 2: 1600 / 140}


def _named_place(name):
    return xxhash.xxh3_64_intdigest(name.encode()) % (1 << 18)


def plain_score(weights, text):
    """The sum of the weights of a text's features, feature by feature."""
    words = re.findall(rb"[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode())
    bare = [re.sub(rb"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$", b"", w) for w in words]
    distinct = {b or w for b, w in zip(bare, words, strict=True)}
    places = {xxhash.xxh3_64_intdigest(w) % (1 << 18) for w in distinct}
    places |= {xxhash.xxh3_64_intdigest(b"-" + b[:5]) % (1 << 18) for b in bare if len(b) > 5}
    score = sum(0.25 * weights[p] for p in places)
    data = text.encode()
    for byte in set(data):
        if byte < 128 and not ord("a") <= byte <= ord("z"):
            score += weights[_named_place(f"byte {byte}")] * math.sqrt(data.count(byte) / len(text))
    kept = [b or w for b, w in zip(bare, words, strict=True)]
    again = sum(a == b for a, b in zip(kept, kept[1:], strict=False)) / len(words)
    for name in (
        f"distinct {int(10 * len(distinct) / len(words))}", f"again {int(10 * again)}", f"length {len(words).bit_length()}",
        f"word length {min(32, sum(map(len, words)) // len(words))}",
    ):
        score += weights[_named_place(name)]
    return score


def test_scores_and_tails_by_plain_sums(spark):
    rows, ratings = _corpus(300)
    rows += [(9000, "One, one ONE! two-fold; \"quoted\" words; words words é 42"), (9001, "x")]
    df = documents(spark, rows)
    known = spark.createDataFrame(ratings, "doc_id long, grade int")
    model = fit(df, known)
    found = {r.doc_id: r for r in classify(df, known).collect()}
    for i, text in rows[::17] + rows[-2:]:
        score = plain_score(model.weights.astype(float), text)
        tails = [1 / (1 + math.exp(t - score)) for t in model.thresholds]
        assert abs(found[i].expected_grade - sum(tails)) < 1e-3 and abs(found[i].tail - tails[-1]) < 1e-3


def test_thresholds_are_the_likeliest(spark):
    """The plain likelihood of the ratings falls if a threshold is moved either way."""
    rows, ratings = _corpus(400)
    rng = random.Random(1)
    ratings = [(i, rng.randrange(3) if rng.random() < 0.3 else g) for i, g in ratings]
    df = documents(spark, rows)
    model = fit(df, spark.createDataFrame(ratings, "doc_id long, grade int"))
    scores = {i: plain_score(model.weights.astype(float), t) for i, t in rows}
    shares = {g: sum(h == g for _, h in ratings) for _, g in ratings}
    assert min(shares.values()) > 0

    def likelihood(thresholds):
        total = 0.0
        for i, grade in ratings:
            below = [0.0, *(1 / (1 + math.exp(scores[i] - t)) for t in thresholds), 1.0]
            total += math.log(max(below[grade + 1] - below[grade], 1e-12))
        return total / len(ratings)

    best = likelihood(model.thresholds)
    assert best > math.log(1 / 3)
    for k, move in ((0, -2.0), (0, 2.0), (1, -2.0), (1, 2.0)):
        moved = model.thresholds.copy()
        moved[k] += move
        assert likelihood(moved) < best
