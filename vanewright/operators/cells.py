"""A stored corpus cut into cells, so that a search reads only the cells that can hold a nearest neighbour.

The search is exact. Unlike a hashing or graph index it loses no neighbour: by the triangle inequality no row of a
cell is nearer to a query than the query's distance to the cell's centre less the cell's radius.
"""

from __future__ import annotations

import json
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from vanewright.operators.bounded import rows_if_small
from vanewright.operators.retrieval import best_of, is_whole
from vanewright.operators.topk import Nearest, as_matrix, found_centres, nearest_centre
from vanewright.session import written
from vanewright.sources import files

_ROUNDING = 1e-9
#: Centres are found on so many bytes of vectors at most. They decide how well searches are pruned, not what they find.
SAMPLE_BYTES = 32 << 20
#: Rows of a cell, and (query, cell) pairs, that one task compares at a time.
ROWS_BLOCK, QUERIES_BLOCK = 50_000, 4_096
#: Bytes of queries that travel with the tasks; more are dealt out by cell.
TRAVELLING_BYTES = 16 << 20


class VectorCells:
    """``{root}/rows/batch=B/cell=N`` holds rows, ``{root}/cells/batch=B`` names all cells after a batch: centre, radius,
    row count and the folders of the rows of each.

    ``add`` puts new rows into the cells of their nearest centres; a cell that grows beyond ``cell_rows`` is split by
    centres of its own rows, and one spread over too many folders is written together. Nothing else is written again, and
    a batch that comes again is left alone. One writer at a time.
    """

    def __init__(
        self, spark: SparkSession, root: str, corpus_id: str = "report_id", vector: str = "vector",
        cell_rows: int = 200_000, cell_folders: int = 32,
    ):
        self.spark, self.root, self.corpus_id, self.vector = spark, root.rstrip("/"), corpus_id, vector
        self.cell_rows, self.cell_folders = cell_rows, cell_folders

    # growing

    def build(self, corpus: DataFrame, cells: int = 256) -> None:
        """Start with ``corpus`` as the first batch."""
        self.add(corpus, 0, cells)

    def add(self, rows: DataFrame, batch_id: int, cells: int = 16, known_apart: bool = True) -> None:
        """Add a batch of rows; the first one finds ``cells`` centres. Vectors that are missing or incomplete stay out.

        Batches come in order. With ``known_apart`` false, rows whose id is stored already are left out: equal ids must
        have equal vectors, so only the cells that the batch touches are looked at.
        """
        last, stored = self._latest()
        if last is not None and batch_id <= last:
            return
        whole = rows.withColumn(self.vector, F.col(self.vector).cast("array<double>")).filter(is_whole(self.vector))
        if not stored:
            found = found_centres(self._sample(whole), cells)
            stored = [
                {"cell": i, "centre": c.tolist(), "radius": 0.0, "n_rows": 0, "folders": [], "splits": True}
                for i, c in enumerate(found)
            ]
        if not stored:  # no row with a vector yet
            return
        fresh = self._assigned(whole, {None: stored})
        if not known_apart:
            fresh = written(fresh.dropDuplicates([self.corpus_id]), "cell-batch")
            touched = {r[0] for r in fresh.select("cell").distinct().collect()}
            present = self._rows([c for c in stored if c["cell"] in touched])
            if present is not None:
                fresh = fresh.join(present.select(self.corpus_id), self.corpus_id, "left_anti").select(*fresh.columns)
        cells_by_id = {c["cell"]: c for c in stored}
        self._store(fresh, f"{batch_id}", cells_by_id)
        turn = 0
        while self._split(cells_by_id, f"{batch_id}-{turn}"):
            turn += 1
        files.write_text(self.spark, f"{self.root}/cells/batch={batch_id}", json.dumps(list(cells_by_id.values())))
        older = files.numbers(self.spark, f"{self.root}/cells", "batch=")[:-2]  # a search may still use the last one
        files.remove(self.spark, [f"{self.root}/cells/batch={b}" for b in older])

    def follow(self, stream: DataFrame, checkpoint: str, drain: bool = True) -> StreamingQuery:
        """Add a stream's rows batch by batch; rows that come again (equal ids) count once."""
        writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
            lambda batch, batch_id: self.add(batch, batch_id, known_apart=False)
        )
        return (writer.trigger(availableNow=True) if drain else writer).start()

    def _latest(self) -> tuple[int | None, list[dict]]:
        """(last batch, the cells after it)."""
        batches = files.numbers(self.spark, f"{self.root}/cells", "batch=")
        if not batches:
            return None, []
        return batches[-1], json.loads(files.read_text(self.spark, f"{self.root}/cells/batch={batches[-1]}"))

    def _sample(self, rows: DataFrame) -> np.ndarray:
        """A sample of vectors, by the hash of their ids, of ``SAMPLE_BYTES`` at most."""
        first = rows.select(self.vector).first()
        if first is None:
            return np.empty((0, 0))
        most = max(1, min(20_000, SAMPLE_BYTES // (8 * max(1, len(first[0])))))
        chosen = rows.orderBy(F.xxhash64(self.corpus_id)).limit(most).select(self.vector).collect()
        return np.array([r[0] for r in chosen if len(r[0]) == len(first[0])])

    def _centres_within(self, cells: list[dict]) -> dict[int, list[np.ndarray]]:
        """New centres for each of ``cells``, of a sample of its rows as ``_sample`` takes it. All cells at once: their
        number grows with the corpus, so they must not be a job each."""
        if not cells:
            return {}
        vector, rows = self.vector, self._rows(cells)
        width = max(1, len(cells[0]["centre"]))
        most = max(1, min(20_000, SAMPLE_BYTES // (8 * width)))
        pieces = {c["cell"]: min(64, 1 + -(-c["n_rows"] // self.cell_rows)) for c in cells}
        # The rows of least hash are twice the sample or so: no task gets a whole large cell.
        limits = self.spark.createDataFrame(
            [(c["cell"], min((1 << 63) - 1, (1 << 65) * most // c["n_rows"] - (1 << 63))) for c in cells],
            "cell bigint, most_hash bigint",
        )
        place = F.xxhash64(self.corpus_id)
        some = rows.join(F.broadcast(limits), "cell").where(place <= F.col("most_hash"))
        ranked = some.withColumn("_rank", F.row_number().over(Window.partitionBy("cell").orderBy(place)))

        def find(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
            points = np.array([p for p in own[vector] if len(p) == width], np.float64)
            found = found_centres(points, pieces[key[0]]) if len(points) else []
            return pd.DataFrame({"cell": [key[0]] * len(found), "centre": [c.tolist() for c in found]})

        sample = ranked.where(F.col("_rank") <= most).select("cell", vector)
        found = defaultdict(list)
        for row in sample.groupBy("cell").applyInPandas(find, "cell bigint, centre array<double>").collect():
            found[row["cell"]].append(np.array(row["centre"]))
        return found

    def _assigned(self, rows: DataFrame, choices: dict[int | None, list[dict]]) -> DataFrame:
        """``rows`` with ``cell`` and ``centre_distance``: the nearest of the choices that their cell has (``None``: rows
        that are in no cell yet)."""
        vector, of_all = self.vector, None in choices
        known = {
            cell: (np.array([c["centre"] for c in own]), np.array([c["cell"] for c in own])) for cell, own in choices.items()
        }

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                groups = [(None, pdf)] if of_all else pdf.groupby("cell", sort=False)
                for cell, own in groups:
                    if len(own):
                        centres, names = known[cell]
                        points = as_matrix(own[vector])
                        near = nearest_centre(points, centres)
                        gap = points - centres[near]
                        # columns come in the order of the schema: the distance, then the cell
                        yield own.drop(columns="cell", errors="ignore").assign(
                            centre_distance=np.sqrt((gap ** 2).sum(axis=1)), cell=names[near].astype("int64")
                        )

        fields = [f for f in rows.schema.fields if f.name not in ("cell", "centre_distance")]
        schema = StructType([*fields, StructField("centre_distance", DoubleType()), StructField("cell", LongType())])
        columns = [f.name for f in fields]
        return rows.select(*columns, *([] if of_all else ["cell"])).mapInPandas(assign, schema)

    def _store(self, rows: DataFrame, batch: str, cells: dict[int, dict]) -> None:
        """Write rows into their cells' folders and note them in ``cells``; a large cell becomes several files."""
        folder = f"{self.root}/rows/batch={batch}"
        rows.hint("rebalance", "cell").write.partitionBy("cell").mode("overwrite").parquet(folder)
        if not any(n.startswith("cell=") for n in files.names(self.spark, folder)):
            return  # not a single row
        sizes = self.spark.read.parquet(folder).groupBy("cell").agg(
            F.count("*").alias("n_rows"), F.max("centre_distance").alias("radius")
        )
        for row in sizes.collect():  # one row per cell
            cell = cells[row["cell"]]
            cell["n_rows"] += row["n_rows"]
            cell["radius"] = max(cell["radius"], row["radius"])
            cell["folders"].append(f"rows/batch={batch}/cell={row['cell']}")

    def _split(self, cells: dict[int, dict], batch: str) -> bool:
        """Split the cells that are too large, and write those of too many folders together; False if there are none."""
        choices, following = {}, 1 + max(cells)
        large = [c for c in cells.values() if c["n_rows"] > self.cell_rows and c["splits"] and c["radius"] > 0]
        centres = self._centres_within(large)
        for cell in [c for c in cells.values() if len(c["folders"]) > self.cell_folders or c["cell"] in centres]:
            own = centres.get(cell["cell"], [np.array(cell["centre"])])
            choices[cell["cell"]] = [
                {"cell": following + i, "centre": c.tolist(), "radius": 0.0, "n_rows": 0, "folders": [], "splits": len(own) > 1}
                for i, c in enumerate(own)
            ]
            following += len(own)
        if not choices:
            return False
        rows = self._assigned(self._rows([cells[c] for c in choices]), choices)
        children = {c["cell"]: c for own in choices.values() for c in own}
        self._store(rows, batch, children)
        for parent, own in choices.items():
            before = cells.pop(parent)
            for child in own:
                if child["n_rows"]:
                    # rows that no centre tells apart stay together
                    child["splits"] = before["splits"] and (len(own) > 1) and child["n_rows"] < before["n_rows"]
                    cells[child["cell"]] = child
        return True

    def _rows(self, cells: list[dict]) -> DataFrame | None:
        paths = [f"{self.root}/{folder}" for cell in cells for folder in cell["folders"]]
        if not paths:
            return None
        rows = self.spark.read.option("basePath", f"{self.root}/rows").parquet(*paths)
        return rows.drop("batch").withColumn("cell", F.col("cell").cast("long"))

    def rows(self) -> DataFrame:
        """All rows, with the cell each lies in."""
        found = self._rows(self._latest()[1])
        if found is None:
            raise FileNotFoundError(f"no rows in {self.root}")
        return found

    # searching

    def search(self, queries: DataFrame, k: int = 5, query_id: str = "query_id") -> DataFrame:
        """The same result as ``nearest`` over all rows. Query ids must be unique.

        The first round compares each query with the nearest cells that surely hold k rows: its k-th distance bounds
        what can still matter. The second compares it with the other cells within that bound. Each query meets its own
        cells alone, and cells that no query needs are not read.
        """
        asked = queries.select(query_id, F.col(self.vector).cast("array<double>").alias("v")).filter(is_whole("v"))
        cells = [c for c in self._latest()[1] if c["n_rows"]]
        schema = StructType([
            asked.schema[query_id],
            self._rows(cells).schema[self.corpus_id] if cells else StructField(self.corpus_id, LongType()),
            StructField("distance", DoubleType()),
        ])
        if not cells:
            return best_of(self.spark.createDataFrame([], schema), k, query_id, self.corpus_id)
        first = written(self._compared(_chosen(asked, query_id, cells, k), cells, k, query_id, schema), "nearest-first")
        reach = first.groupBy(query_id).agg(
            F.when(F.count("*") >= k, F.sort_array(F.collect_list("distance"))[k - 1]).alias("reach")
        )
        bounded = asked.join(reach, query_id, "left")
        second = self._compared(_chosen(bounded, query_id, cells, k), cells, k, query_id, schema)
        return best_of(first.unionByName(second), k, query_id, self.corpus_id)

    def _compared(self, pairs: DataFrame, cells: list[dict], k: int, query_id: str, schema: StructType) -> DataFrame:
        """The k nearest rows of each (query, cell) pair, at least those that are among the query's k nearest."""
        few = rows_if_small(pairs, TRAVELLING_BYTES // (8 * max(1, len(cells[0]["centre"]))))
        if few is None:
            pairs = written(pairs, "query-cells")
            asked = {r["cell"]: r["n"] for r in pairs.groupBy("cell").agg(F.count("*").alias("n")).collect()}
        else:
            asked = Counter(r["cell"] for r in few)
        wanted = [c for c in cells if c["cell"] in asked]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        rows = self._rows(wanted).select(F.col(self.corpus_id), F.col(self.vector).alias("v"), "cell")
        corpus_id = self.corpus_id
        if few is not None:
            rows_by_cell = defaultdict(list)
            for row in few:
                rows_by_cell[row["cell"]].append(row)
            by_cell = {
                cell: ([r[query_id] for r in own], np.array([r["v"] for r in own], np.float64))
                for cell, own in rows_by_cell.items()
            }

            def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                best: dict[int, Nearest] = {}
                for pdf in batches:
                    for cell, own in pdf.groupby("cell", sort=False):
                        if cell not in best:
                            best[cell] = Nearest(*by_cell[cell], k)
                        best[cell].see(own[corpus_id].to_numpy(dtype=object), as_matrix(own["v"]))
                for found in best.values():
                    yield found.frame(query_id, corpus_id)

            return rows.mapInPandas(scan, schema)
        parts = self.spark.createDataFrame(
            [(c["cell"], -(-c["n_rows"] // ROWS_BLOCK), -(-asked[c["cell"]] // QUERIES_BLOCK)) for c in wanted],
            "cell bigint, row_parts bigint, query_parts bigint",
        )

        def each(number: str):
            return F.explode(F.sequence(F.lit(0).cast("long"), F.col(number) - 1))

        row_part = F.pmod(F.xxhash64(corpus_id), F.col("row_parts"))
        query_part = F.pmod(F.xxhash64(query_id), F.col("query_parts"))
        left = rows.join(F.broadcast(parts), "cell").select(
            corpus_id, "v", "cell", row_part.alias("rp"), each("query_parts").alias("qp")
        )
        right = pairs.join(F.broadcast(parts), "cell").select(
            query_id, "v", "cell", each("row_parts").alias("rp"), query_part.alias("qp")
        )

        def compare(part: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
            best = Nearest(asking[query_id].tolist(), as_matrix(asking["v"]), k)
            if len(part) and len(asking):
                best.see(part[corpus_id].to_numpy(dtype=object), as_matrix(part["v"]))
            return best.frame(query_id, corpus_id)

        keys = ["cell", "rp", "qp"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, schema)


def _chosen(asked: DataFrame, query_id: str, cells: list[dict], k: int) -> DataFrame:
    """(query, vector, cell) of the cells to compare: without a column ``reach`` the nearest that hold k rows, with it
    the others that may hold a row within that squared distance (null: all others)."""
    centres, names = np.array([c["centre"] for c in cells]), np.array([c["cell"] for c in cells])
    radius, counts = np.array([c["radius"] for c in cells]), np.array([c["n_rows"] for c in cells])
    second = "reach" in asked.columns

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            owners, chosen = [], []
            for at, point in enumerate(pdf["v"]):
                distance = np.sqrt(((centres - np.asarray(point, np.float64)) ** 2).sum(axis=1))
                order = distance.argsort(kind="stable")
                first = order[:1 + int(np.searchsorted(counts[order].cumsum(), k))]
                if second:
                    reach = pdf["reach"].iloc[at]
                    reach = np.inf if pd.isna(reach) else np.sqrt(reach)
                    near = ~(distance - radius > reach * (1 + _ROUNDING) + _ROUNDING * (1 + distance))
                    near[first] = False
                    first = np.flatnonzero(near)
                owners += [at] * len(first)
                chosen += first.tolist()
            yield pdf[[query_id, "v"]].iloc[owners].assign(cell=names[chosen].astype("int64"))

    schema = StructType([asked.schema[query_id], asked.schema["v"], StructField("cell", LongType())])
    return asked.mapInPandas(choose, schema)
