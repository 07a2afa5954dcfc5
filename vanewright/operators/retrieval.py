"""Corpus of maintenance reports and nearest-neighbour search over it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from vanewright.functions.columns import columns_named
from vanewright.functions.text import decimals_in, joined_values
from vanewright.operators.bounded import join_small, rows_if_small
from vanewright.operators.topk import Nearest, as_matrix
from vanewright.session import written

# A block of queries is held by every task: 2,048 vectors of 1,024 doubles are 16 MB.
QUERY_BLOCK = 2_048
CORPUS_BLOCK = 50_000


def report_corpus(
    training: DataFrame, report: str, metadata: Sequence[str], ids: Sequence[str], text_of=None
) -> DataFrame:
    """Rows that have a report: the ``std_`` readings, sorted by name, as vector and as text, with the metadata.

    ``report_id`` is made from the row's own key, so it does not change from run to run: the ids, then a hash of all
    that the corpus has of the row, so that several reports of one unit and hour stay apart. Rows alike in all of it
    are one report. ``text_of`` turns a reading into text (a plain cast by default).
    """
    readings = columns_named(training, prefix="std_")
    as_text = text_of or (lambda c: c.cast("string"))
    # Each part is written with its length, and a missing one as nothing at all: no two rows read alike.
    own = [F.col(c).cast("string") for c in dict.fromkeys([*ids, *metadata, report])]
    own.append(joined_values([as_text(F.col(c)) for c in readings]))
    whole = F.concat_ws(";", *[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in own])
    key = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in ids])
    return training.filter(F.col(report).isNotNull()).select(
        F.concat(key, F.lit("#"), F.left(F.md5(whole), F.lit(16))).alias("report_id"),
        joined_values([as_text(F.col(c)) for c in readings]).alias("content"),
        F.array(*[F.col(c).cast("double") for c in readings]).alias("vector"),
        *metadata,
        report,
    ).dropDuplicates(["report_id"])


def parse_readings(requests: DataFrame, text: str, width: int | None = None) -> DataFrame:
    """Vector of the decimals in a request text, with ``status`` invalid (and a null vector) where there are none, or
    not ``width`` of them."""
    found = decimals_in(F.col(text)).cast("array<double>")
    right = F.size(found) > 0 if width is None else F.size(found) == width
    valid = F.coalesce(right, F.lit(False))
    return requests.withColumns({
        "vector": F.when(valid, found),
        "status": F.when(valid, "ok").otherwise("invalid"),
    })


def is_whole(vector: str) -> Column:
    """Whether a vector is there and has no missing value."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x))


def _points(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(key, F.col(vector).cast("array<double>").alias("v")).filter(is_whole("v"))


def nearest(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 5,
    corpus_id: str = "report_id",
    query_id: str = "query_id",
    vector: str = "vector",
    query_block: int = QUERY_BLOCK,
    corpus_block: int = CORPUS_BLOCK,
) -> DataFrame:
    """The k corpus rows nearest to each query by squared Euclidean distance; ties go to the smaller id. Exact.

    Up to ``query_block`` queries travel with the tasks: each task keeps k rows per query of its part of the corpus,
    and only those are shuffled. More queries are cut into blocks, and so is the corpus; a task then sees one block of
    each and again passes on k rows per query. Missing vectors, and vectors with a missing value, take no part.
    """
    vectors, asked = _points(corpus, corpus_id, vector), _points(queries, query_id, vector)
    schema = StructType([
        asked.schema[query_id], vectors.schema[corpus_id], StructField("distance", DoubleType())
    ])
    block = rows_if_small(asked, query_block)
    if block is not None:
        partial = _nearest_to_block(vectors, block, k, corpus_id, query_id, schema)
    else:
        partial = _nearest_by_blocks(vectors, asked, k, corpus_id, query_id, schema, query_block, corpus_block)
    return best_of(partial, k, query_id, corpus_id)


def best_of(found: DataFrame, k: int, query_id: str, corpus_id: str) -> DataFrame:
    """The k nearest of the rows found for each query, ranked; ties go to the smaller id."""
    order = Window.partitionBy(query_id).orderBy("distance", corpus_id)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _nearest_to_block(vectors, block, k, corpus_id, query_id, schema) -> DataFrame:
    query_ids = [r[query_id] for r in block]
    points = np.array([r["v"] for r in block], dtype=np.float64)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = Nearest(query_ids, points, k)
        for pdf in batches:
            if len(pdf):
                best.see(pdf[corpus_id].to_numpy(dtype=object), as_matrix(pdf["v"]))
        yield best.frame(query_id, corpus_id)

    return vectors.mapInPandas(scan, schema)


def _blocked(df: DataFrame, key: str, name: str, blocks: int) -> DataFrame:
    return df.withColumn(name, F.pmod(F.xxhash64(key), F.lit(blocks)))


def _nearest_by_blocks(vectors, asked, k, corpus_id, query_id, schema, query_block, corpus_block) -> DataFrame:
    query_blocks = -(-asked.count() // query_block)
    corpus_blocks = max(-(-vectors.count() // corpus_block), 1)
    left = _blocked(vectors, corpus_id, "cb", corpus_blocks).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)).cast("array<bigint>")))
    right = _blocked(asked, query_id, "qb", query_blocks).withColumn(
        "cb", F.explode(F.sequence(F.lit(0), F.lit(corpus_blocks - 1)).cast("array<bigint>")))

    def compare(part: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(part) or not len(asking):
            return pd.DataFrame({query_id: [], corpus_id: [], "distance": []})
        best = Nearest(asking[query_id], as_matrix(asking["v"]), k)
        best.see(part[corpus_id].to_numpy(dtype=object), as_matrix(part["v"]))
        return best.frame(query_id, corpus_id)

    return left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInPandas(compare, schema)


def similar_reports(
    corpus: DataFrame, requests: DataFrame, text: str, k: int = 5, query_id: str = "query_id",
    search: Callable[[DataFrame, int], DataFrame] | None = None,
) -> DataFrame:
    """The k reports most like the readings in each request text, with their content and metadata.

    ``search`` looks for the k nearest of the parsed readings in a stored index of the corpus; without it the corpus is
    compared as a whole. Requests without as many numbers as a report has readings come back as one row with ``status`` invalid. The k found rows per request are
    broadcast (while they pass the size check) to pick up their details, so the report texts are not shuffled.
    """
    first = corpus.where(F.col("vector").isNotNull()).select(F.size("vector")).first()
    parsed = written(parse_readings(requests, text, first and first[0]).select(query_id, "vector", "status"), "requests")
    near = search(parsed, k) if search else nearest(corpus, parsed, k, "report_id", query_id)
    found = written(near, "nearest-reports")
    details = join_small(corpus.drop("vector"), found, ["report_id"])
    return parsed.drop("vector").join(details, query_id, "left")
