"""Periodic runs against a plain search of all periods."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from vanewright.llm import periodic, queries

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=24, times=3):
    """Every longest stretch of every period, as (start, length, period), but those of a smaller period."""
    found = {}
    for q in range(1, len(words) // times + 1):
        start = 0
        while start + q < len(words):
            end = start
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end - start + q >= max(least, times * q):
                found.setdefault((start, end - start + q), q)
            start = end + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_row(doc_id, text):
    """The contract of op11 word by word."""
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def found_runs(words):
    (runs, _), = periodic.look_at([" ".join(words).encode()])
    return [tuple(r) for r in runs.tolist()]


def square_texts(rng, alphabet):
    """A text with nested and overlapping repeats over a small alphabet."""
    words = []
    while len(words) < 150:
        phrase = [str(rng.integers(alphabet)) for _ in range(rng.integers(1, 30))]
        for _ in range(rng.integers(0, 3)):
            phrase = phrase * int(rng.integers(1, 5)) + [str(rng.integers(alphabet)) for _ in range(rng.integers(0, 3))]
        words += phrase[:400]
    return words


@pytest.mark.parametrize("alphabet", [1, 2, 3, 40])
def test_runs_against_all_periods(alphabet):
    rng = np.random.default_rng(alphabet)
    for _ in range(60):
        words = square_texts(rng, alphabet)
        assert found_runs(words) == plain_runs(words)


@pytest.mark.parametrize("least, times", [(24, 3), (10, 3), (5, 4), (60, 5)])
def test_other_bounds(least, times):
    rng = np.random.default_rng(5)
    for _ in range(20):
        words = square_texts(rng, 2)
        (runs, _), = periodic.look_at([" ".join(words).encode()], least, times)
        assert [tuple(r) for r in runs.tolist()] == plain_runs(words, least, times)


def test_bands_cover_all_periods_by_seeds_that_runs_guarantee():
    before = 0
    for _, (low, high, seed) in zip(range(30), periodic.bands()):
        assert low == before + 1 and all(seed <= max(24 - q, 2 * q) and 3 * q <= 2 * seed + 3 for q in range(low, min(high, low + 99) + 1))
        before = high


def test_long_phrases_that_repeat_within_themselves():
    """A period that holds its own stretches twice, and one word repeated a hundred thousand times."""
    u = [f"u{i}" for i in range(300)]
    phrase = u + ["x"] + u + ["y"] + u + ["z"]
    assert found_runs(phrase * 4) == [(0, 4 * len(phrase), len(phrase))]
    assert found_runs(["a"] * 100_000) == [(0, 100_000, 1)]
    assert found_runs([str(i) for i in range(20_000)] * 3) == [(0, 60_000, 20_000)]


def test_texts_looked_at_together_stay_apart(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(square_texts(rng, 2)).encode() for _ in range(20)] + [b"", b"a", b" \n"] + [b"a " * 12] * 3
    together = periodic.look_at(texts)
    for text, (runs, collapsed) in zip(texts, together):
        (alone, its), = periodic.look_at([text])
        assert alone.tolist() == runs.tolist() and its == collapsed
    monkeypatch.setattr(periodic, "TOGETHER", 100)
    assert [t for portion in periodic._portions(texts) for t in portion] == texts


def test_query_against_the_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    found = queries.op11_periodic_runs(spark, FOLDER)
    assert dict(found.dtypes) == {
        "doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
        "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string",
    }
    short = [r for r in docs if len((r.text or "").split()) < 1500]
    rows = {r.doc_id: tuple(r) for r in found.collect()}
    assert len(rows) == len(docs) and len(short) > len(docs) // 2
    assert all(rows[r.doc_id] == plain_row(r.doc_id, r.text) for r in short)
    assert sum(rows[r.doc_id][1] > 0 for r in docs) >= len(docs) / 20


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumnRenamed("measures", "periodic")
    found = periodic.with_runs(periodic.with_planted_repeats(docs))
    assert found.columns == [*docs.columns, "periodic_"]
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id != 10 and zlib.crc32(str(r.doc_id).encode()) % 10:
            assert r.periodic_.collapsed == " ".join(WORD.findall(r.text or "")) and r.periodic_.runs == []
            assert r.periodic_.strongest is None
    long = next(r for r in rows if r.doc_id == 10)
    assert long.periodic_.strongest == (0, 3000, 1) and long.periodic_.collapsed == "word end"
    assert periodic.with_runs(no_docs).count() == 0


def test_planted_repeats(spark):
    texts = [(i, " ".join(f"w{j}" for j in range(i % 7 * 40))) for i in range(200)] + [(None, "a b"), (1004, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for r in periodic.with_planted_repeats(docs).collect():
        words = dict(texts)[r.doc_id].split()
        h = zlib.crc32(str(r.doc_id).encode())
        if r.doc_id is None or h % 10 or not words:
            assert r.text.split() == words
        else:
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            assert r.text.split() == [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
