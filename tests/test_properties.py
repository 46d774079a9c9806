"""Property rules: each kind passes and fails where it should, in one aggregate a table."""

import dataclasses

import pytest

from lendnet.operators import quality as Q


def report(tables, *rules):
    numbered = [dataclasses.replace(r, name=str(i)) for i, r in enumerate(rules)]
    return [r["failures"] for r in sorted(Q.dq_properties(tables, numbered).collect(), key=lambda r: int(r["name"]))]


def test_kinds_of_rules(spark):
    t = spark.createDataFrame([("a1", "b", 1.0, 0.25), ("a2", "a2", -3.0, 0.5), (None, "c", None, 0.25),
                               ("b1", None, float("nan"), 0.0)], "k string, o string, x double, s double")
    ref = spark.createDataFrame([("a1",), ("a1",), (None,), ("b1",)], "id string")
    tables = {"t": t, "ref": ref, "none": t.filter("false")}
    R = Q.Rule
    assert report(tables, R("t", "x", "bounds", (0, None)), R("t", "x", "bounds", (None, 0.5)),
                  R("t", "x", "bounds", (-5, 5))) == [2, 2, 1]                      # not a number is out of bounds
    assert report(tables, R("t", "k", "starts_with", ("a",)), R("t", "k", "differs", ("o",)),
                  R("t", "s", "equals", ("s < 0.5",)), R("t", "x", "equals", ("x > 0",))) == [1, 1, 1, 1]
    assert report(tables, R("t", "s", "sums_to", (1.0, 1e-12)), R("t", "s", "sums_to", (2.0, 0.5))) == [0, 1]
    assert report(tables, R("t", "k", "ratio", ("ref", 0.9, 1.1)), R("t", "k", "ratio", ("ref", 2, 3)),
                  R("t", "k", "ratio", ("none", 0, 9)), R("none", "k", "ratio", ("ref", 0, 9))) == [0, 1, 1, 0]
    assert report(tables, R("t", "k", "subset", ("ref", "id")), R("none", "k", "subset", ("ref", "id")),
                  R("t", "k", "subset", ("none", "k")), R("ref", "id", "unique")) == [1, 0, 3, 1]
    assert report(tables, R("none", "x", "bounds", (0, 1)), R("none", "s", "sums_to", (1.0, 0.1))) == [0, 1]
    with pytest.raises(ValueError):
        report(tables, R("t", "k", "other"))


def test_assertion_names_the_failing_rules(spark):
    t = {"t": spark.createDataFrame([(1,), (2,)], "x int")}
    Q.assert_properties(Q.dq_properties(t, [Q.Rule("t", "x", "bounds", (1, 2))]))
    with pytest.raises(AssertionError, match="t.x bounds low: 1"):
        Q.assert_properties(Q.dq_properties(t, [Q.Rule("t", "x", "bounds", (2, 3), "low"), Q.Rule("t", "x", "not_null")]))
