"""Merges, newest rows and flattening against plain Python on random rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluicework.operators.dedup import latest_per_key
from sluicework.operators.merge import change_feed, drop_preimages, merge_always, merge_insert, merge_newer
from sluicework.operators.nested import flatten

KIND = "id INT, inc INT, v STRING"
QUICK = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.integers(0, 6))
rows = st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(0, 3)), st.sampled_from("abc")), max_size=12)


def unique(found):
    """At most one row per key, any number without."""
    kept = {}
    for i, row in enumerate(found):
        kept[row[0] if row[0] is not None else ("none", i)] = row
    return list(kept.values())


def sorted_rows(found):
    return sorted(map(tuple, found), key=repr)


def merged(target, source, newer):
    by_key = {s[0]: s for s in source if s[0] is not None}
    stored = {t[0] for t in target if t[0] is not None}
    updated = [by_key[t[0]] if t[0] in by_key and newer(by_key[t[0]], t) else t for t in target]
    return updated + [s for s in source if s[0] not in stored]


@QUICK
@given(rows, rows.map(unique))
def test_merges(spark, target, source):
    t, s = spark.createDataFrame(target, KIND), spark.createDataFrame(source, KIND)

    def is_newer(new, old):
        return None not in (new[1], old[1]) and new[1] > old[1]

    for made, newer in (
        (merge_newer(t, s, "id", "inc"), is_newer),
        (merge_always(t, s, "id"), lambda new, old: True),
        (merge_insert(t, s, "id"), lambda new, old: False),
    ):
        assert sorted_rows(made.collect()) == sorted_rows(merged(target, source, newer))


@QUICK
@given(rows)
def test_latest(spark, found):
    newest = {}
    for key, inc, _ in found:
        if inc is not None:
            newest[key] = max(inc, newest.get(key, inc))
    expected = [r for r in found if r[1] is not None and newest[r[0]] == r[1]]
    df = spark.createDataFrame(found, KIND)
    assert sorted_rows(latest_per_key(df, "id", "inc").collect()) == sorted_rows(expected)
    one = latest_per_key(df, "id", "inc", ties="one").collect()
    assert sorted_rows({(r[0], r[1]) for r in one}) == sorted_rows(newest.items()) and len(one) == len(newest)


@QUICK
@given(rows.map(unique), rows.map(unique))
def test_changes_lead_from_before_to_after(spark, before, after):
    before = [r for r in before if r[0] is not None]
    after = [r for r in after if r[0] is not None]
    feed = change_feed(spark.createDataFrame(before, KIND), spark.createDataFrame(after, KIND), "id")
    state = {r[0]: r for r in before}
    for change in drop_preimages(feed).collect():
        if change["_change_type"] == "delete":
            del state[change["id"]]
        else:
            state[change["id"]] = tuple(change)[:3]
    assert sorted_rows(state.values()) == sorted_rows(after)


@QUICK
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.lists(st.integers(-9, 9), max_size=3)),
                          st.one_of(st.none(), st.lists(st.integers(-9, 9), max_size=3))), max_size=6))
def test_flatten_multiplies_arrays(spark, found):
    df = spark.createDataFrame(found, "id INT, a ARRAY<BIGINT>, b ARRAY<BIGINT>")
    nested = df.select("id", F.struct("a", F.struct("b").alias("deep")).alias("s"))
    found = [
        (i, x, y) for i, a, b in found for x in (a or [None]) for y in (b or [None])
    ]
    flat = flatten(nested)
    assert flat.columns == ["id", "s_a", "s_deep_b"]
    assert sorted_rows(flat.collect()) == sorted_rows(found)
