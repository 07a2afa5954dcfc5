"""Document fingerprints by winnowing.

Rolling hashes of all k-grams of code points; in each window of consecutive hashes the smallest is chosen, the
rightmost of equal ones, and its position is kept. Texts that share ``window + k - 1`` code points in a row share a
fingerprint entry there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewright.llm.common import bounded_batches, by_value, objects

by_value(__name__)

GRAM, WINDOW = 8, 8
#: Hashes have 40 bits: below them, 24 bits of a key tell positions within a block apart.
_POSITION_BITS = 24
_BLOCK = 1 << 22
_BASE = 0x9E3779B97F4A7C15


def _windowed(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` values in a row, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:len(values) - step], values[step:])
        done += step
    return values


def gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """40-bit hashes of all ``gram`` code points in a row; a shorter text is one gram."""
    values = codes.astype(np.uint64) + np.uint64(1)
    gram = max(1, min(gram, len(values)))
    done = 1
    while done < gram:  # a hash of 2n code points is made of two hashes of n
        step = min(done, gram - done)
        power = np.uint64(pow(_BASE, step, 1 << 64))
        values = values[:len(values) - step] * power + values[step:] if step == done else _stretch(values, codes, done, step)
        done += step
    values ^= values >> np.uint64(31)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    return values >> np.uint64(24)


def _stretch(values: np.ndarray, codes: np.ndarray, done: int, step: int) -> np.ndarray:
    """Hashes of ``done`` code points lengthened by ``step`` single ones."""
    for at in range(step):
        more = codes[done + at:].astype(np.uint64) + np.uint64(1)
        values = values[:len(more)] * np.uint64(_BASE) + more
    return values


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) that winnowing chooses from a text; an empty text has none."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(codes):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = gram_hashes(codes, gram)
    found, places = [], []
    window = min(window, len(hashes))
    for start in range(0, len(hashes) - window + 1, _BLOCK):
        block = hashes[start:start + _BLOCK + window - 1]
        later = np.arange(len(block) - 1, -1, -1, dtype=np.uint64)  # of equal hashes, the rightmost has the least
        chosen = _windowed(block << np.uint64(_POSITION_BITS) | later, window)
        chosen = chosen[np.r_[True, chosen[1:] != chosen[:-1]]]
        at = start + len(block) - 1 - (chosen & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
        found.append(chosen >> np.uint64(_POSITION_BITS))
        places.append(at)
    hashes, positions = np.concatenate(found), np.concatenate(places)
    new = np.r_[True, positions[1:] != positions[:-1]]
    return hashes[new], positions[new]


def digest(print_: tuple[np.ndarray, np.ndarray]) -> str:
    """A fingerprint as a short text: equal for equal entries at equal positions."""
    return hashlib.blake2b(print_[0].tobytes() + print_[1].tobytes(), digest_size=16).hexdigest()


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Jaccard likeness of two sets of hashes (sorted, distinct); of two empty ones, 1."""
    if not len(one) and not len(other):
        return 1.0
    both = np.concatenate([one, other])
    both.sort(kind="stable")
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared / (len(both) - shared)


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(doc_id, hashes, positions) of every document (doc_id, text); a null or empty text has empty lists. A task
    works on what it reads; other columns are not read, repeated rows repeat, an empty table gives no rows."""

    @F.pandas_udf("hashes array<long>, positions array<long>")
    def chosen(text: pd.Series) -> pd.DataFrame:
        found = [winnow(t or "", gram, window) for t in text]
        return pd.DataFrame({
            "hashes": objects(h.astype(np.int64) for h, _ in found), "positions": objects(p for _, p in found),
        })

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", chosen("text").alias("found")).select("doc_id", "found.*")


def _ranges(ids: DataFrame, parts: int) -> tuple[list[int], dict[int, int]]:
    """Borders that cut the ids into ``parts`` alike, and the largest id of each part that has rows: at most
    ``parts`` numbers each."""
    borders = ids.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 100 * parts)).first()[0]
    borders = sorted(set(borders or []))
    part = _part_of(borders)
    return borders, dict(ids.groupBy(part("doc_id").alias("part")).agg(F.max("doc_id")).collect())


def _part_of(borders: list[int]):
    @F.pandas_udf("int")
    def part(doc_id: pd.Series) -> pd.Series:
        known = doc_id.notna().to_numpy()
        at = np.searchsorted(np.array(borders, np.int64), doc_id.fillna(0).astype(np.int64).to_numpy(), "right")
        return pd.Series(np.where(known, at, 0).astype(np.int32))

    return part


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """The documents (doc_id, text) dealt out by falling doc_id, so that each task sees every document's next one.

    Rows: (part, copy, doc_id, text), sorted in each task by (copy, falling doc_id, text). The first row of a part is
    added to the part before as ``copy``: the next of its last row; the first of all follows the last of all. Texts
    are shuffled once. A null doc_id comes last; rows of one doc_id follow each other by text.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    borders, largest = _ranges(docs.select("doc_id"), parts)
    order = sorted(largest, reverse=True)
    before = {part: order[i - 1] for i, part in enumerate(order)}  # the first part follows the last one

    part = _part_of(borders)

    @F.pandas_udf("array<int>")
    def copies(doc_id: pd.Series, own: pd.Series) -> pd.Series:
        return objects(
            [before[p]] if (None if pd.isna(i) else int(i)) == largest[p] else [] for i, p in zip(doc_id, own)
        )

    keyed = docs.withColumn("part", part("doc_id"))
    own = F.array(F.struct(F.col("part").alias("part"), F.lit(0).alias("copy")))
    more = F.transform(copies("doc_id", "part"), lambda p: F.struct(p.alias("part"), F.lit(1).alias("copy")))
    dealt = keyed.select("doc_id", "text", F.explode(F.concat(own, more)).alias("to")).select("to.*", "doc_id", "text")
    return dealt.repartitionById(parts, F.col("part")).sortWithinPartitions(
        "part", "copy", F.col("doc_id").desc_nulls_last(), "text"
    )


def edited_text(text: str, following: str) -> str:
    """``text`` whose last half (rounded down) is replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


EDITS_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edit_likeness(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, parts: int | None = None) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document: ``EDITS_SCHEMA``.

    The next document is the one with the next smaller doc_id, after the smallest the largest; a single document is
    its own next. A null text counts as empty; two empty fingerprints are alike (1.0), an empty and another are not
    (0.0). Rows that share a doc_id follow each other by text. Whole texts count, however long; a text alone must fit in a
    task. Other columns are not read. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)

    def looked_at(text: str) -> tuple:
        found = winnow(text, gram, window)
        return text, found, np.unique(found[0])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Every own row with the row after it, part by part."""
        held = None
        for batch in batches:
            for part, copy, doc_id, text in zip(*(batch.column(c) for c in ("part", "copy", "doc_id", "text"))):
                row = (part.as_py(), copy.as_py(), doc_id.as_py(), looked_at(text.as_py()))
                if held and held[0] == row[0] and not held[1]:
                    yield held[2], held[3], row[3]
                held = row

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            names = [part.split()[0] for part in EDITS_SCHEMA.split(", ")]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
            out.clear()
            return batch

        for doc_id, (text, found, hashes), (following, _, next_hashes) in rows(batches):
            edited = edited_text(text, following)
            its = winnow(edited, gram, window)
            out.append((
                doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), digest(found), digest(its),
                likeness(hashes, np.unique(its[0])), likeness(hashes, next_hashes),
            ))
            if len(out) >= 5000:
                yield made()
        yield made()

    return with_next(docs, parts).mapInArrow(task, EDITS_SCHEMA)
