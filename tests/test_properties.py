"""Random tables and changesets against plain Python."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stillroom.operators import changes as ch

KEYS = st.one_of(st.none(), st.integers(0, 6))
TARGET = st.lists(st.tuples(KEYS, st.sampled_from(["x", "y", None]), st.one_of(st.none(), st.integers(-5, 5))), max_size=14)
CHANGES = st.lists(
    st.tuples(KEYS, st.sampled_from(["x", "y", None]), st.one_of(st.none(), st.integers(-5, 5))),
    max_size=8,
    unique_by=lambda r: (r[0], r[1]) if r[0] is not None and r[1] is not None else object(),
)
SCHEMA = "a int, b string, n int"
PAIRS = [["a", "a"], ["b", "b"]]
QUICK = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def same(df, expected):
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(expected, key=repr)


@QUICK
@given(TARGET, CHANGES)
def test_changes_agree_with_python(spark, target, changed):
    def key(row):
        return (row[0], row[1]) if row[0] is not None and row[1] is not None else None

    by_key = {key(c): c for c in changed if key(c) is not None}
    present = {key(t) for t in target} - {None}
    updated = [by_key.get(key(t), t) for t in target]
    added = [c for c in changed if key(c) not in present]
    t, c = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(changed, SCHEMA)
    same(ch.update_from(t, c, PAIRS), updated)
    same(ch.upsert(t, c, PAIRS), updated + added)
    same(ch.delete_matching(t, c.select("a", "b"), PAIRS), [r for r in target if key(r) not in by_key])
    assert ch.count_matching(t, c.select("a", "b"), PAIRS).first()["n"] == sum(key(r) in by_key for r in target)


@QUICK
@given(TARGET, st.sampled_from(["lt", "lte", "gt", "gte", "eq", "neq"]), st.integers(-5, 5))
def test_conditions_agree_with_python(spark, target, op, value):
    import operator

    name = {"lt": "lt", "lte": "le", "gt": "gt", "gte": "ge", "eq": "eq", "neq": "ne"}[op]
    condition = {"op": op, "target-col": "n", "const": {"type": "int", "v": value}}
    kept = [r for r in target if r[2] is None or not getattr(operator, name)(r[2], value)]
    same(ch.apply_change(spark.createDataFrame(target, SCHEMA), "delete", match_condition=condition), kept)
