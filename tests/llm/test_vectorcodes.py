"""Vector codes against a plain version without bounds."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from vanewright.llm import queries, vectorcodes

FOLDER = "/root/testdata/sf0.001"


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """{row: (code, error)} and the codebooks of rows (vec_id, vector), all of one length, measuring every distance."""
    ints = [[int(np.floor(np.float64(x) * 4096)) for x in v] for _, v in rows]
    width = len(ints[0]) // parts
    cut = np.array(ints, dtype=object).reshape(len(rows), parts, width)
    order = sorted((i for i, (vec_id, _) in enumerate(rows) if vec_id is not None), key=lambda i: (rows[i][0], list(rows[i][1])))
    books = [[cut[i, p] for i in order[:entries]] for p in range(parts)]
    for turn in range(rounds + 1):
        codes, errors = [], []
        for row in cut:
            far = [[int(((row[p] - e) ** 2).sum()) for e in books[p]] for p in range(parts)]
            codes.append([f.index(min(f)) for f in far])
            errors.append(sum(map(min, far)))
        if turn < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    own = [cut[i, p] for i in range(len(rows)) if codes[i][p] == e]
                    if own:
                        books[p][e] = sum(own) // len(own)
    return [(bytes(c).hex(), error) for c, error in zip(codes, errors)], books


def digest(books):
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def coded(df, **options):
    codes, books = vectorcodes.vector_codes(df, **options)
    return codes, books


def test_query_against_the_plain_version(spark):
    found = queries.op13_vector_codes(spark, FOLDER)
    assert dict(found.dtypes) == {
        "vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string",
    }
    rows = sorted(spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect(), key=lambda r: r.vec_id)
    expected, books = plain_codes([(r.vec_id, r.embedding) for r in rows])
    sums = defaultdict(int)
    for r, (_, error) in zip(rows, expected):
        sums[r.label] += error
    assert sorted(tuple(r) for r in found.collect()) == [
        (r.vec_id, code, error, sums[r.label], digest(books)) for r, (code, error) in zip(rows, expected)
    ]


@pytest.mark.parametrize("kind", ["grid", "groups", "few", "negative"])
def test_ties_groups_and_few_rows(spark, kind):
    rng = np.random.default_rng(4)
    vectors = {
        "grid": rng.integers(0, 3, (300, 16)) / 4096,  # many equal distances and repeated parts
        "groups": rng.normal(size=(1, 16)) + rng.integers(0, 5, (400, 1)) + 0.001 * rng.normal(size=(400, 16)),
        "few": rng.normal(size=(5, 16)),
        "negative": -np.abs(rng.normal(size=(300, 16))),
    }[kind]
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(vectors)), vectors)]
    df = spark.createDataFrame([(i, v, i % 3 or None) for i, v in rows], "vec_id long, embedding array<double>, label long")
    codes, books = vectorcodes.vector_codes(df.repartition(3), carry=["label"])
    expected, plain_books = plain_codes(rows)
    got = {r.vec_id: r for r in vectorcodes.with_label_errors(codes).collect()}
    assert {i: (got[i].code.hex(), got[i].error) for i, _ in rows} == {i: e for (i, _), e in zip(rows, expected)}
    assert books.sha256() == digest(plain_books)
    for label in (None, 1, 2):
        own = {r.label_error for r in got.values() if r.label == label}
        assert not own or own == {sum(r.error for r in got.values() if r.label == label)}


def test_bounds_spare_distances_and_keep_results():
    """After small moves most rows keep their entry without a second distance; results are those of measuring all."""
    rng = np.random.default_rng(6)
    rows = rng.integers(-3000, 3000, (5000, 8))
    book = rows[:16].copy()
    bounds, _ = vectorcodes.measured(rows, book, 4)
    for listed in (4, 3, 2):
        after = book + rng.integers(-20, 21, book.shape)
        moves = np.sqrt(((after - book) ** 2).sum(1)) * (1 + 1e-9)
        bounds, best, needed = vectorcodes.moved(rows, after, moves, bounds, listed)
        distances = vectorcodes.squared(rows, after)
        assert (best == distances.min(1)).all() and (bounds.near[:, 0] == distances.argmin(1)).all()
        roots = np.sqrt(distances.astype(float))
        for at in range(listed):
            assert (bounds.lower[:, at] <= np.take_along_axis(roots, bounds.near[:, at:at + 1].astype(int), 1)[:, 0]).all()
        others = roots.copy()
        np.put_along_axis(others, bounds.near.astype(int), np.inf, 1)
        assert (bounds.outer <= others.min(1)).all()
        assert (needed == 1).mean() > 0.7 and (needed > listed).mean() < 0.1
        book = after


def test_listed_entries_adapt():
    assert vectorcodes.next_listed([0, 990, 5, 5, 0, 100], 4, 16) == 2
    assert vectorcodes.next_listed([0, 500, 300, 200, 0, 0], 4, 16) == 3
    assert vectorcodes.next_listed([0, 0, 0, 0, 0, 50], 4, 16) == 4
    assert vectorcodes.next_listed([0, 9, 0], 1, 1) == 1


def test_large_components_are_exact():
    rng = np.random.default_rng(7)
    rows, entries = rng.integers(-2**26 + 1, 2**26, (50, 4)), rng.integers(-2**26 + 1, 2**26, (16, 4))
    plain = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, e)) for e in entries] for r in rows]
    assert vectorcodes.squared(rows, entries).tolist() == plain
    packed = vectorcodes._packed(np.array([[1, -2], [2**15, 0], [-2**26, 5]]))
    assert [len(b) for b in packed] == [4, 8, 8]
    assert vectorcodes._unpacked(packed, 2).tolist() == [[1, -2], [2**15, 0], [-2**26, 5]]


def test_odd_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=10).tolist()) for i in range(40)]  # parts of one or two components
    odd = [
        (50, None), (51, []), (52, [float("nan")] * 10), (53, [float("inf")] + [0.0] * 9), (54, [None] + [0.0] * 9),
        (55, [1.0, 2.0]), (56, [1e300] + [0.0] * 9), (None, rows[3][1]), (3, rows[3][1]),
    ]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows + odd], "vec_id long, embedding array<double>, own string, sums string")
    codes, books = vectorcodes.vector_codes(df, carry=["own", "sums"])
    found = codes.collect()
    assert codes.columns == ["vec_id", "own", "sums", "code", "error"] and len(found) == 45
    assert sorted(r.vec_id for r in found if r.code is None) == [51, 55, 56]
    same = {(r.code, r.error) for r in found if r.vec_id in (None, 3)}
    assert len(same) == 1 and [len(e) for e in books.entries] == [16] * 8
    for nothing in (df.limit(0), df.where("vec_id IS NULL")):
        codes, books = vectorcodes.vector_codes(nothing, carry=["own"])
        assert books.entries == [] and all(r.code is None for r in codes.collect()) and codes.count() == nothing.count()
