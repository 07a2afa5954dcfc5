"""Vector codes by codebooks of parts, assigned with adaptive distance bounds.

Vectors become integers and are cut into parts; each part position has a codebook, which starts as that part of the
first vectors and moves to the means of what is assigned to it, round by round. A round need not measure every distance:
each part keeps the b entries that were nearest to it, a lower bound of its distance to each, and one outer bound below
its distance to all others. After a round, a bound falls by what its entry moved, the outer bound by the largest move.
Where the exact distance to the assigned entry is below all bounds, the entry stays; where it is below the outer bound,
the listed entries are measured in integers; only what is left is measured against the whole codebook. b starts at a
quarter of the codebook and falls, down to an eighth, to what the parts needed.

Bounds are rounded down and moves up, so rounding never decides: whatever the bounds leave open is compared in integers.
The parts and their bounds are written to shared storage once a round, and the table of the round before is then removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanewright.llm.common import bounded_batches, by_value
from vanewright.session import removed, scratch_folder

by_value(__name__)

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components this large or larger, times ``SCALE``, have squared distances that might not fit in 64 bits.
LARGEST = 1 << 26
#: Rounding of bounds: moves and distances are lengthened by this share before they are compared.
_MORE = 1 + 1e-9


@dataclass
class Codebooks:
    """Integer entries of each part position: ``entries[part]`` has a row an entry."""

    entries: list[np.ndarray]

    def sha256(self) -> str:
        """Of all components in decimal, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(x) for e in self.entries for x in e.ravel().tolist()).encode()).hexdigest()


def cut(length: int, parts: int) -> list[slice]:
    """``parts`` consecutive parts, as equal as the length allows."""
    borders = np.linspace(0, length, parts + 1).astype(int).tolist()
    return [slice(a, b) for a, b in zip(borders, borders[1:])]


def squared(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to all entries."""
    if not rows.shape[1]:
        return np.zeros((len(rows), len(entries)), np.int64)
    largest = max(int(np.abs(rows).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * rows.shape[1] * largest**2 < 1 << 53:  # sums of integers below 2^53 are exact in doubles, in any order
        x, c = rows.astype(np.float64), entries.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    out = np.empty((len(rows), len(entries)), np.int64)
    for at, entry in enumerate(entries):
        out[:, at] = ((rows - entry) ** 2).sum(1)
    return out


def _below(distances: np.ndarray) -> np.ndarray:
    """Bounds in single precision that are surely not above the roots or bounds given."""
    return np.nextafter(distances.astype(np.float32), np.float32(-np.inf))


@dataclass
class Bounds:
    """Of one part position: the listed entries of each row (the assigned one first), their lower bounds, and the outer
    bound below the distances to all others."""

    near: np.ndarray
    lower: np.ndarray
    outer: np.ndarray


def measured(rows: np.ndarray, entries: np.ndarray, listed: int) -> tuple[Bounds, np.ndarray]:
    """Bounds, and squared distances to the nearest entry, by measuring against the whole codebook."""
    distances = squared(rows, entries)
    order = np.argsort(distances, axis=1, kind="stable")  # of equal distances, the lower entry comes first
    ranked = np.take_along_axis(distances, order, 1)
    roots = _below(np.sqrt(ranked.astype(np.float64)))
    outer = roots[:, listed] if listed < len(entries) else np.full(len(rows), np.inf, np.float32)
    return Bounds(order[:, :listed].astype(np.uint8), roots[:, :listed], outer), ranked[:, 0]


def moved(rows: np.ndarray, entries: np.ndarray, moves: np.ndarray, old: Bounds, listed: int) -> tuple[Bounds, np.ndarray, np.ndarray]:
    """(bounds, squared distances to the nearest entry, listed bounds each row needed) after the entries moved.

    A row that needed its whole codebook measured has one more than the listed entries.
    """
    lower = old.lower.astype(np.float64) - moves[old.near] * _MORE
    outer = old.outer.astype(np.float64) - moves.max() * _MORE
    outer = np.minimum(outer, lower[:, listed:].min(1, initial=np.inf))  # entries that are listed no longer
    near, lower = old.near[:, :listed].copy(), lower[:, :listed]
    best = ((rows - entries[near[:, 0]]) ** 2).sum(1)
    reach = np.sqrt(best.astype(np.float64)) * _MORE
    lower[:, 0] = reach / _MORE**2
    needed = 1 + (lower[:, 1:] <= reach[:, None]).sum(1)
    whole = outer <= reach
    some = (needed > 1) & ~whole
    new = Bounds(near, _below(lower), _below(outer))
    if some.any():
        own = near[some]
        distances = np.stack([((rows[some] - entries[own[:, at]]) ** 2).sum(1) for at in range(own.shape[1])], 1)
        order = np.lexsort([own, distances])  # of equal distances, the lower entry comes first
        ranked = np.take_along_axis(distances, order, 1)
        new.near[some], best[some] = np.take_along_axis(own, order, 1), ranked[:, 0]
        new.lower[some] = _below(np.sqrt(ranked.astype(np.float64)))
    if whole.any():
        all_, best[whole] = measured(rows[whole], entries, listed)
        new.near[whole], new.lower[whole], new.outer[whole] = all_.near, all_.lower, all_.outer
    return new, best, np.where(whole, listed + 1, needed)


def next_listed(counts: Sequence[int], listed: int, entries: int) -> int:
    """Entries to list from now on: what was enough for 99 of 100 parts that their list settled, but between an eighth
    and a quarter of the codebook. ``counts[n]`` parts needed n listed bounds."""
    settled = np.cumsum([float(n) for n in counts[:listed + 1]])
    needed = int(np.searchsorted(settled, 0.99 * settled[-1])) if settled[-1] else listed
    return max(1, min(listed, max(needed, entries // 8)))


# whole numbers in and out of tables

def _packed(ints: np.ndarray) -> list[bytes]:
    """Rows as bytes, of two bytes a number where that is enough."""
    small = (np.abs(ints) < 1 << 15).all(1)
    short, long = ints.astype("<i2"), ints.astype("<i4")
    return [(short if s else long)[at].tobytes() for at, s in enumerate(small)]


def _unpacked(blobs: list[bytes], length: int) -> np.ndarray:
    sizes = np.array([len(b) for b in blobs])
    out = np.zeros((len(blobs), length), np.int64)
    for width in (2, 4):
        rows = np.flatnonzero(sizes == width * length)
        if length and len(rows):
            out[rows] = np.frombuffer(b"".join(blobs[i] for i in rows), f"<i{width}").reshape(len(rows), length)
    return out


def _integers(vectors: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(integers of the rows that get a code, their numbers): rows of another length or with too large numbers do not."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == length)
    flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), length)
    with np.errstate(over="ignore"):
        scaled = np.floor(flat * SCALE)
    fits = (np.abs(scaled) < LARGEST).all(1)
    return scaled[fits].astype(np.int64), rows[fits]


def _state_schema(own: T.DataType) -> T.StructType:
    kinds = {
        "own": own, "ints": T.BinaryType(), "near": T.BinaryType(), "lower": T.BinaryType(), "outer": T.BinaryType(),
        "code": T.BinaryType(), "error": T.LongType(), "sums": T.ArrayType(T.LongType()),
    }
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def _spread(values: list, rows: np.ndarray, size: int) -> list:
    out = [None] * size
    for at, value in zip(rows.tolist(), values):
        out[at] = value
    return out


def _assigning(codebooks: list[np.ndarray], moves: list[np.ndarray] | None, kept: int, listed: int, length: int):
    """The task of a round: new bounds and codes of each row, then one row of sums for the next codebooks.

    ``sums`` holds the summed components by part, entry and position, then the assigned rows by part and entry, then how
    many parts needed so many listed bounds. ``kept`` entries are listed in the table read, ``listed`` in the one written.
    """
    slices, parts, entries = cut(length, len(codebooks)), len(codebooks), len(codebooks[0])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(c.shape, np.int64) for c in codebooks]
        counts = np.zeros((parts, entries), np.int64)
        needs = np.zeros(entries + 2, np.int64)
        own_type = None
        names = ["own", "ints", "near", "lower", "outer", "code", "error", "sums"]
        for batch in batches:
            own = batch.column("own")
            own_type, size = own.type, batch.num_rows
            if moves is None:
                ints, rows = _integers(batch.column("embedding"), length)
            else:
                blobs = batch.column("ints").to_pylist()
                rows = np.array([at for at, b in enumerate(blobs) if b is not None], np.int64)
                ints = _unpacked([blobs[at] for at in rows], length)
                near, lower, outer = (
                    np.frombuffer(b"".join(b for b in batch.column(name).to_pylist() if b is not None), kind).reshape(shape)
                    for name, kind, shape in (
                        ("near", np.uint8, (-1, parts, kept)), ("lower", "<f4", (-1, parts, kept)), ("outer", "<f4", (-1, parts))
                    )
                )
            bounds, error = [], np.zeros(len(rows), np.int64)
            for part, (where, book) in enumerate(zip(slices, codebooks)):
                own_part = ints[:, where]
                if moves is None:
                    new, best = measured(own_part, book, listed)
                    needed = np.full(len(rows), listed + 1)
                else:
                    old = Bounds(near[:, part], lower[:, part], outer[:, part])
                    new, best, needed = moved(own_part, book, moves[part], old, listed)
                bounds.append(new)
                error += best
                needs += np.bincount(needed, minlength=len(needs))[:len(needs)]
                chosen = new.near[:, 0]
                counts[part] += np.bincount(chosen, minlength=entries)
                # sums of one batch are exact in doubles: far fewer than 2^27 rows of numbers below 2^26
                sums[part] += ((chosen[:, None] == np.arange(entries)).astype(np.float64).T @ own_part).astype(np.int64)
            columns = {
                "ints": _packed(ints),
                "near": [b.tobytes() for b in np.stack([b.near for b in bounds], 1)],
                "lower": [b.tobytes() for b in np.stack([b.lower for b in bounds], 1).astype("<f4")],
                "outer": [b.tobytes() for b in np.stack([b.outer for b in bounds], 1).astype("<f4")],
                "code": [b.tobytes() for b in np.stack([b.near[:, 0] for b in bounds], 1)],
                "error": error.tolist(),
            }
            arrays = [pa.array(_spread(v, rows, size), pa.int64() if n == "error" else pa.binary()) for n, v in columns.items()]
            yield pa.RecordBatch.from_arrays([own, *arrays, pa.nulls(size, pa.list_(pa.int64()))], names=names)
        if own_type is not None:
            numbers = np.concatenate([*(s.ravel() for s in sums), counts.ravel(), needs]).tolist()
            yield pa.RecordBatch.from_arrays([
                pa.nulls(1, own_type), *(pa.nulls(1, pa.binary()) for _ in range(5)), pa.nulls(1, pa.int64()),
                pa.array([numbers], pa.list_(pa.int64())),
            ], names=names)

    return task


def _totals(table: DataFrame) -> list[int]:
    """The rows of sums added up across tasks, number by number: as many as a codebook has."""
    one = F.posexplode("sums").alias("at", "number")
    added = table.where("sums IS NOT NULL").select(one).groupBy("at").agg(F.sum(F.col("number").cast("decimal(38,0)")))
    return [int(total) for _, total in sorted(added.collect())]


def _first(kept: DataFrame, entries: int) -> list[list[float]]:
    """The vectors of the smallest ids (of rows of one id, the smallest vectors): ``entries`` rows at most."""
    rows = kept.where("vec_id IS NOT NULL").orderBy("vec_id", "embedding").limit(entries)
    return [r[0] for r in rows.select("embedding").collect()]


def vector_codes(
    vectors: DataFrame, carry: Sequence[str] = (), parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """(codes, codebooks): for each kept row of ``vectors`` (vec_id, embedding) its vec_id, the columns named by
    ``carry``, ``code`` (one byte a part) and ``error`` (the squared distances to its entries, added up).

    Rows whose vector is null or holds null or non-finite components are dropped. Components become
    floor(4096 * component). A codebook starts as the parts of the ``entries`` smallest vec_ids (fewer if there are
    fewer; rows without id are coded, but start no entry; rows of one id are ordered by vector), and in each of
    ``rounds`` rounds moves to the floor of the mean of its parts; an entry without parts stays. Equal distances go to
    the lower entry. Vectors of another length than the first one's, or with a component of 16,384 or more, have no
    code and no error and move nothing. Where the length is not a multiple of ``parts``, parts differ by one component.
    Repeated rows are coded each; an empty table, or one without any id, has no codes. Other columns are not read.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    sound = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    kept = vectors.where(F.col("embedding").isNotNull()).withColumn("embedding", F.col("embedding").cast("array<double>"))
    kept = kept.where(sound)
    first = _first(kept, entries)
    length = len(first[0]) if first else 0
    start, _ = _integers(pa.array([v for v in first if len(v) == length], pa.list_(pa.float64())), length)
    own = F.struct("vec_id", *carry)
    if not len(start):
        nothing = [F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error")]
        return kept.select("vec_id", *carry, *nothing), Codebooks([])
    slices = cut(length, parts)
    books = [start[:, where] for where in slices]
    listed = kept_lists = max(1, len(start) // 4)
    moves, table, path = None, kept.select(own.alias("own"), "embedding"), None
    schema = _state_schema(table.schema["own"].dataType)
    for turn in range(rounds + 1):
        task = _assigning(books, moves, kept_lists, listed, length)
        new_path = scratch_folder(spark, "vector-codes")
        source = table if moves is None else table.where("sums IS NULL").select("own", "ints", "near", "lower", "outer")
        source.mapInArrow(task, schema).write.parquet(new_path)
        table = spark.read.schema(schema).parquet(new_path)
        if path:
            removed(spark, path)
        path, kept_lists = new_path, listed
        if turn == rounds:
            break
        totals = _totals(table)
        books, moves, listed = _moved_books(books, totals, listed)
    return table.where("sums IS NULL").select("own.*", "code", "error"), Codebooks(books)


def _moved_books(books: list[np.ndarray], totals: list[int], listed: int) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """(codebooks moved to the floors of their means, lengths of the moves rounded up, entries to list)."""
    parts, entries = len(books), len(books[0])
    at = sum(b.size for b in books)
    counts = np.array(totals[at:at + parts * entries], dtype=object).reshape(parts, entries)
    needs = totals[at + parts * entries:]
    new, moves, place = [], [], 0
    for part, book in enumerate(books):
        width = book.shape[1]
        after = book.copy()
        for entry in range(entries):
            own = totals[place + entry * width:place + (entry + 1) * width]
            if counts[part, entry]:
                after[entry] = [total // counts[part, entry] for total in own]
        place += book.size
        new.append(after)
        moves.append(np.sqrt(((after - book) ** 2).sum(1).astype(np.float64)) * _MORE)
    return new, moves, next_listed(needs, listed, entries)


def with_label_errors(codes: DataFrame, label: str = "label") -> DataFrame:
    """``codes`` with ``label_error``: the errors of all rows of an equal label added up, nulls together. Labels are added
    up in the tasks before they are shuffled; a hot label is one row of the small side."""
    totals = codes.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(totals, F.col(label).eqNullSafe(F.col("_label"))).drop("_label")
