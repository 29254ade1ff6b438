import random

import pytest

import corpus_pipeline
from sluicework.sources.scratch import scratch_dir
from tests.llm.helpers import documents, jaccard_components
from tests.llm.test_packing import _check
from tests.llm.test_poisson_mix import drawn
from tests.llm.test_sentence_spans import plain as without_repeats


@pytest.fixture(scope="module")
def folder(spark):
    """Prose, junk, copies, near copies and a shared passage, with labels."""
    rng = random.Random(8)

    def prose(n):
        return " ".join(" ".join(f"w{rng.randrange(4000)}" for _ in range(rng.randrange(4, 12))) + "." for _ in range(n))

    passage = prose(9)
    rows, labels = [], []
    for i in range(260):
        kind = rng.choice(["prose", "prose", "prose", "junk", "copy", "near", "passage"])
        text = prose(12)
        if kind == "junk":
            text = " ".join(w + "%%%" for w in text.split())
        elif kind == "passage":
            text = f"{prose(6)} {passage} {prose(6)}"
        elif kind in ("copy", "near") and i > 20:
            text = rows[rng.randrange(10)][1]
            if kind == "near":
                text = text + " one more word"
        rows.append((i, text))
        labels.append((i, int(not text.endswith("%%%")), 0))
    rows += [(500, ""), (501, None)]
    path = scratch_dir(spark)
    documents(spark, rows, {i: f"src{i % 4}" for i, _ in rows}).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, dict(rows)


def test_stages_by_their_plain_versions(spark, folder):
    path, texts = folder
    names = [name for name, _ in corpus_pipeline.STAGES]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = f"{scratch_dir(spark)}/{name}"
        stage(spark, docs, path).write.parquet(out)
        docs = spark.read.parquet(out)
        kept[name] = docs.collect()
        if name != names[-1]:
            assert docs.columns == list(corpus_pipeline.COLUMNS)

    clean = {r.doc_id for r in kept["quality"]}
    assert {i for i, t in texts.items() if t and not t.endswith("%%%")} <= clean
    assert not any(r.text and r.text.endswith("%%%") for r in kept["quality"])

    components = jaccard_components([(r.doc_id, r.text) for r in kept["quality"]])
    assert sorted(r.doc_id for r in kept["near_duplicates"]) == sorted({c for _, _, c in components})

    cleaned = without_repeats([(r.doc_id, r.text) for r in kept["near_duplicates"]])
    assert {r.doc_id: r.text for r in kept["repeated_passages"]} == {i: t for i, (t, _) in cleaned.items()}
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in kept["repeated_passages"])

    sizes = {}
    for r in kept["repeated_passages"]:
        sizes[r.source] = sizes.get(r.source, 0) + 1
    total = len(kept["repeated_passages"])
    expected = sorted(r.doc_id for r in kept["repeated_passages"] for _ in range(drawn(r.doc_id, total / len(sizes) / sizes[r.source])))
    assert sorted(r.doc_id for r in kept["mixing"]) == expected

    _check([(r.doc_id, r.text) for r in kept["mixing"]], kept["packing"], 4096)


def test_run_gives_the_rows_of_the_last_stage(spark, folder):
    found = corpus_pipeline.run(spark, folder[0])
    assert found.count() > 0 and found.columns[:3] == ["doc_id", "start", "length"]


def test_odd_rows_pass_through_all_stages(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names the stages use."""
    rng = random.Random(4)
    prose = [" ".join(" ".join(f"w{rng.randrange(3000)}" for _ in range(9)) + "." for _ in range(8)) for _ in range(30)]
    rows = list(enumerate(prose)) + [(3, prose[3]), (3, prose[3]), (None, "no id of any kind here."), (40, None), (41, ""), (42, " \n"), (43, "long words here. " * 40_000)]
    path = scratch_dir(spark)
    docs = documents(spark, rows, {i: None if i == 5 else f"s{(i or 0) % 3}" for i, _ in rows})
    docs = docs.selectExpr("*", "1 AS keep", "2 AS copy", "3 AS spans", "4 AS component", "5 AS text_key", "6 AS result", "7 AS tail")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    current, kept = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = f"{scratch_dir(spark)}/{name}"
        stage(spark, current, path).write.parquet(out)
        current = spark.read.parquet(out)
        kept[name] = current.collect()
    ids = [r.doc_id for r in kept["near_duplicates"]]
    assert len(ids) == len(set(ids)) and all(r.text is None or isinstance(r.text, str) for r in kept["repeated_passages"])
    _check([(r.doc_id, r.text) for r in kept["mixing"]], kept["packing"], 4096)


def test_empty_tables(spark):
    path = scratch_dir(spark)
    none = documents(spark, [])
    none.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []
