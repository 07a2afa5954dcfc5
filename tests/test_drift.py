import numpy as np
import pytest

from vanewright.operators.drift import categorical_drift, numeric_drift, summarize, table_drift


def frame(spark, values, more=None):
    more = values if more is None else more
    return spark.createDataFrame([(None if v is None else float(v), None if w is None else float(w)) for v, w in zip(values, more)], "x double, y double")


def brute(ref, cur):
    ref, cur = (np.sort(np.array([v for v in side if v is not None])) for side in (ref, cur))
    points = np.unique(np.concatenate([ref, cur]))
    f = np.searchsorted(ref, points, side="right") / len(ref)
    g = np.searchsorted(cur, points, side="right") / len(cur)
    gap = np.abs(f - g)
    return gap.max(), (gap[:-1] * np.diff(points)).sum() / (np.std(ref) or 1.0)


@pytest.mark.parametrize("case", ["shifted", "same", "apart", "one hot value", "gaps"])
def test_numeric_drift_equals_brute_force(spark, case):
    rng = np.random.default_rng(5)
    ref, cur = {
        "shifted": (rng.normal(size=600), rng.normal(0.3, 1, 400)),
        "same": ([1, 2, 3], [1, 2, 3]),
        "apart": (rng.random(50), 10 + rng.random(60)),
        "one hot value": ([7.0] * 400 + list(rng.random(100)), [7.0] * 100 + list(rng.random(300))),
        "gaps": ([None, 1, 2, None, 5], [2, 2, None, 9]),
    }[case]
    rows = numeric_drift(frame(spark, ref, ref[::-1]), frame(spark, cur, cur[::-1]), ["x", "y"]).collect()
    ks, wasserstein = brute(ref, cur)
    assert sorted(r.column_name for r in rows) == ["x", "y"]
    for r in rows:
        assert (r.ks, r.wasserstein) == pytest.approx((ks, wasserstein), abs=1e-9)
        assert r.drifted == (wasserstein >= 0.1)


def test_categorical_drift(spark):
    def texts(values):
        return spark.createDataFrame([(v,) for v in values], "c string")

    same = categorical_drift(texts("aabb"), texts("ab"), ["c"]).first()
    apart = categorical_drift(texts("aa"), texts(["b", None]), ["c"]).first()
    assert (same.js, same.drifted) == (0.0, False)
    assert apart.js == pytest.approx(1.0) and apart.drifted


def test_table_drift_is_a_share(spark):
    one = spark.createDataFrame([("a", 0.5, True), ("b", 0.0, False)], "column_name string, ks double, drifted boolean")
    two = spark.createDataFrame([("c", 0.0, False)], "column_name string, js double, drifted boolean")
    assert tuple(table_drift(one).first()) == (2, 1, 0.5, True)
    row = table_drift(one, two).first()
    assert (row.columns, row.drifted_columns, row.drifted) == (3, 1, False)


@pytest.mark.parametrize("exact_rows", [3, 1000])
def test_summary(spark, exact_rows):
    values = [float(v) for v in np.random.default_rng(2).integers(0, 40, 200)] + [None] * 3
    rows = {r.column_name: r for r in summarize(frame(spark, values, [None] * 203), ["x", "y"], exact_rows=exact_rows).collect()}
    known = np.array(values[:200])
    x = rows["x"]
    assert (x.rows, x.nulls, x.distinct_values, x.low, x.high) == (203, 3, len(set(known)), known.min(), known.max())
    assert (x.mean, x.deviation) == pytest.approx((known.mean(), known.std()))
    assert [x.p25, x.p50, x.p75] == [np.quantile(known, p, method="inverted_cdf") for p in (0.25, 0.5, 0.75)]
    assert (rows["y"].nulls, rows["y"].distinct_values, rows["y"].p50) == (203, 0, None)
