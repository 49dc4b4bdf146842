from fareline.operators.checks import (
    DEFAULT_SUITE,
    accepted_values,
    fare_within_tolerance,
    not_null,
    relationships,
    run_checks,
    unique,
)


def test_each_check_kind(spark):
    t = spark.createDataFrame(
        [(1, "a", 10.0, 10.0, False), (1, "b", 10.0, 11.0, False), (2, None, 10.0, 12.0, True), (None, "z", None, 1.0, False)],
        "k int, v string, actual double, expected double, qa_is_fare_mismatch boolean",
    )
    parent = spark.createDataFrame([(1,), (3,)], "k int")
    checks = [
        not_null("t", "k"),
        not_null("t", "v"),
        unique("t", "k"),
        accepted_values("t", "v", ["a", "b"]),
        relationships("t", "k", "p", "k"),
        fare_within_tolerance("t", "actual", "expected", 0.5),
        fare_within_tolerance("t", "actual", "expected", 0.5, exclude_flagged=False),
    ]
    got = [(r["check_name"], r["column_name"], r["failures"], r["passed"]) for r in run_checks({"t": t, "p": parent}, checks).collect()]
    assert sorted(got) == sorted([
        ("not_null", "k", 1, False),
        ("not_null", "v", 1, False),
        ("unique", "k", 1, False),  # value 1 twice (NULL ignored)
        ("accepted_values", "v", 1, False),  # 'z' (NULL passes)
        ("relationships", "k", 1, False),  # k=2 orphan, NULL passes
        ("fare_within_tolerance", "actual", 1, False),  # flagged row excluded
        ("fare_within_tolerance", "actual", 2, False),
    ])


def test_suite_matches_reference_size():
    kinds = [c.kind for c in DEFAULT_SUITE]
    assert len(kinds) == 53
    assert kinds.count("relationships") == 24 and kinds.count("unique") == 6
    assert kinds.count("not_null") == 20 and kinds.count("accepted_values") == 2
