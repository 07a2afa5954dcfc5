"""Near-duplicate embeddings by a robust-pruned flat graph.

Equal vectors are one node. Nodes go to the shards of their nearest centres, more than one each, so that shards overlap.
Every shard's block builds a graph whose neighbour lists are pruned as in DiskANN: a neighbour is left out if a kept one
is much nearer to it. The lists of a node from all its shards are united. Then each block is searched: greedily from
its medoid towards the query, and from there as far as members lie within range. Dense groups keep their edges to
themselves: a query whose beam fills with members in range is compared with its whole block by one matrix product. Every
pair found is verified by its cosine in double precision. Pairs are counted where they are found, in one shard each, and never written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.common import bounded_batches, by_value, objects
from vanewright.llm.components import connected_components
from vanewright.session import written

by_value(__name__)

#: Cosine from which vectors link.
SIMILAR = 0.95
#: Centres are taken from so many vectors, the sample's bound; about so many nodes a shard; shards of a node; nodes of
#: a block at most about.
SAMPLE, SHARD, OVERLAP, BLOCK = 4096, 1000, 3, 4096
#: Candidates and kept neighbours of a node, and how much nearer a kept neighbour must be to shadow another.
CANDIDATES, DEGREE, ALPHA = 48, 20, 1.2
#: Nodes that the greedy search keeps in sight.
BEAM = 12
#: Rows of a block that are compared with all its members at a time.
_ROWS = 512


def as_units(vectors: pd.Series) -> tuple[np.ndarray, list[np.ndarray]]:
    """(usable, unit vectors of the usable ones in double precision). Null, zero, empty and non-finite vectors are not
    usable."""
    rows = []
    usable = np.zeros(len(vectors), bool)
    for i, vector in enumerate(vectors):
        if vector is None:
            continue
        values = np.array([np.nan if v is None else v for v in vector], np.float64)
        top = np.abs(values).max() if len(values) and np.isfinite(values).all() else 0.0
        if top > 0:
            values = values / top  # so that squares neither overflow nor vanish
            usable[i] = True
            rows.append(values / np.sqrt(values @ values))
    return usable, rows


def nodes_of(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, usable, s1, s2, unit) of every row; equal unit vectors have equal signatures."""

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for frame in frames:
            usable, rows = as_units(frame["vector"])
            units, marks = [None] * len(frame), np.zeros((len(frame), 2), np.int64)
            for at, row in zip(np.flatnonzero(usable), rows):
                units[at] = (row + 0.0).tobytes()  # no negative zeros
                mark = xxhash.xxh3_128_intdigest(units[at])
                marks[at] = np.array([mark >> 64, mark & (1 << 64) - 1], np.uint64).view(np.int64)
            yield pd.DataFrame({"vec_id": frame["vec_id"], "usable": usable & frame["vec_id"].notna().to_numpy(),
                                "s1": marks[:, 0], "s2": marks[:, 1], "unit": objects(units)})

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    return rows.mapInPandas(task, "vec_id long, usable boolean, s1 long, s2 long, unit binary")


def chosen_centres(nodes: DataFrame, total: int, sample: int = SAMPLE, shard: int = SHARD) -> dict[int, np.ndarray]:
    """By vector length, centres from a sample of nodes by hash, no two alike: a large group of near vectors has one centre, not many."""
    rows = nodes.orderBy(F.xxhash64("s1", "s2"), "s1", "s2").limit(sample).select("unit").collect()
    units = [np.frombuffer(r["unit"], np.float64) for r in rows]
    wanted = max(1, -(-total // shard))
    centres: list[np.ndarray] = []
    for unit in units:
        same = [c for c in centres if len(c) == len(unit)]
        if same and (np.stack(same) @ unit).max() >= 0.8:
            continue
        centres.append(unit)
        if len(centres) >= wanted:
            break
    widths = {len(c) for c in centres}
    return {w: np.stack([c for c in centres if len(c) == w]) for w in widths}


def robust_prune(to_own: np.ndarray, among: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Which candidates the nodes keep: (nodes, candidates), candidates in falling nearness. ``to_own`` has their cosines
    to the node, ``among`` the cosines of the candidates of each node. A candidate goes when a kept neighbour is
    ``alpha`` times nearer to it than the node is. All nodes are pruned step by step together."""
    kept, left = np.zeros(to_own.shape, bool), np.ones(to_own.shape, bool)
    rows = np.arange(len(to_own))
    for _ in range(min(degree, to_own.shape[1])):
        best = left.argmax(axis=1)  # the nearest that is left
        some = left[rows, best]
        kept[rows[some], best[some]] = True
        left[rows, best] = False
        left &= alpha * (1.0 - among[rows, best]) > 1.0 - to_own
        if not left.any():
            break
    return kept


def build_graph(units: np.ndarray) -> list[list[int]]:
    """Pruned neighbour lists, made two-way, of one block."""
    count = min(CANDIDATES, len(units) - 1)
    if count < 1:
        return [[] for _ in units]
    one, other = [], []
    for start in range(0, len(units), _ROWS):
        own = np.arange(start, min(start + _ROWS, len(units)))
        near = units[own] @ units.T
        near[own - start, own] = -2.0
        top = np.argpartition(-near, count - 1, axis=1)[:, :count]
        to_own = np.take_along_axis(near, top, 1)
        order = np.argsort(-to_own, axis=1, kind="stable")
        top, to_own = np.take_along_axis(top, order, 1), np.take_along_axis(to_own, order, 1)
        candidates = units[top]
        at, which = np.nonzero(robust_prune(to_own, candidates @ candidates.transpose(0, 2, 1)))
        one.append(own[at])
        other.append(top[at, which])
    one, other = np.concatenate(one), np.concatenate(other)
    pairs = np.unique(np.concatenate([one * len(units) + other, other * len(units) + one]))
    return [part.tolist() for part in np.split(pairs % len(units), np.searchsorted(pairs, np.arange(1, len(units)) * len(units)))]


class Block:
    """Members of one block with their united neighbour lists, ready to be searched."""

    def __init__(self, units: np.ndarray, lists: list[np.ndarray]):
        self.units = units
        degree = max((len(n) for n in lists), default=0)
        self.lists = np.full((len(units), max(1, degree)), -1, np.int64)
        for at, found in enumerate(lists):
            self.lists[at, :len(found)] = found
        self.medoid = int((units @ units.mean(axis=0)).argmax()) if len(units) else 0

    def search(self, query: np.ndarray, similar: float, known: np.ndarray) -> np.ndarray:
        """The members within range of a query that the graph leads to: greedily from the medoid and from the query's
        own ``known`` neighbours, then outwards."""
        seen = np.zeros(len(self.units), bool)
        beam = np.unique(np.append(known, self.medoid))
        seen[beam] = True
        values = self.units[beam] @ query
        expanded = np.zeros(len(self.units), bool)
        while True:
            open_ = beam[~expanded[beam]]
            if not len(open_):
                break
            expanded[open_] = True
            more = self.lists[open_].ravel()
            more = np.unique(more[more >= 0])
            more = more[~seen[more]]
            seen[more] = True
            beam = np.concatenate([beam, more])
            values = np.concatenate([values, self.units[more] @ query])
            order = np.argsort(-values, kind="stable")[:BEAM]
            beam, values = beam[order], values[order]
        found = beam[values >= similar]
        edge = found
        inside = np.zeros(len(self.units), bool)
        inside[found] = True
        looked = np.zeros(len(self.units), bool)
        while len(edge):
            more = self.lists[edge].ravel()
            more = np.unique(more[more >= 0])
            more = more[~inside[more] & ~looked[more]]
            looked[more] = True
            edge = more[self.units[more] @ query >= similar]
            inside[edge] = True
        return np.flatnonzero(inside)

    def search_all(self, queries: np.ndarray, similar: float, known: list[np.ndarray]) -> list[np.ndarray]:
        """The members within range of each query. A full beam says nothing about groups that no edge in range leads
        to: its query is compared with all members, as a block is small enough for that."""
        near = [self.search(query, similar, own) for query, own in zip(queries, known)]
        full = [at for at, found in enumerate(near) if len(found) >= BEAM]
        for start in range(0, len(full), _ROWS):
            some = full[start:start + _ROWS]
            for at, values in zip(some, queries[some] @ self.units.T):
                near[at] = np.union1d(near[at], np.flatnonzero(values >= similar))
        return near


def _stacked(column: pd.Series) -> np.ndarray:
    return np.stack([np.frombuffer(u, np.float64) for u in column])


def united_lists(placed: DataFrame) -> DataFrame:
    """(id, neighbours) of the nodes: the pruned lists of all their blocks together."""

    def built(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        ids = group["id"].to_numpy()
        lists = build_graph(_stacked(group["unit"]))
        return pd.DataFrame({"id": ids, "neighbours": objects(ids[found] for found in lists)})

    lists = placed.groupBy("width", "shard", "block").applyInPandas(built, "id long, neighbours array<long>")
    return lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))


def place(nodes: DataFrame, centres: dict[int, np.ndarray], overlap: int = OVERLAP) -> DataFrame:
    """``nodes`` (id, unit, copies) once for each of their shards: (width, shards, shard) added."""

    @F.pandas_udf("width int, shards array<int>")
    def nearest(unit: pd.Series) -> pd.DataFrame:
        widths, shards = [], []
        for value in unit:
            row = np.frombuffer(value, np.float64)
            known = centres.get(len(row))
            widths.append(len(row))
            near = np.zeros(1) if known is None else known @ row
            shards.append(np.sort(np.argsort(-near, kind="stable")[:overlap]).astype(np.int32))
        return pd.DataFrame({"width": np.array(widths, np.int32), "shards": objects(shards)})

    return nodes.withColumn("at", nearest("unit")).select("*", "at.*").drop("at").withColumn(
        "shard", F.explode("shards")
    )


def _links(searched: DataFrame, similar: float) -> DataFrame:
    """(id, links, root) from every task (shard, two of its blocks): how many vectors a node links with in pairs that
    belong to this task, and one member of its own component there."""

    def task(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["shard"].iloc[0])
        low, high = int(group["low"].iloc[0]), int(group["high"].iloc[0])
        group = group.sort_values("id").reset_index(drop=True)
        ids, copies = group["id"].to_numpy(), group["copies"].to_numpy()
        units, blocks = _stacked(group["unit"]), group["block"].to_numpy()
        members = np.flatnonzero(blocks == high)
        queries = np.flatnonzero(blocks == low)
        place_of = {i: at for at, i in enumerate(ids[members])}
        lists = [
            np.array([place_of[n] for n in neighbours if n in place_of], np.int64) for neighbours in group["neighbours"]
        ]
        block = Block(units[members], [lists[m] for m in members])
        shards = [tuple(s) for s in group["shards"]]
        # A pair that shares several shards belongs to the first of them.
        owned = {s: {t: min(set(s) & set(t)) == shard for t in set(shards)} for s in set(shards)}
        kinds = {s: k for k, s in enumerate(owned)}
        kind = np.array([kinds[s] for s in shards], np.int64)
        mine = np.array([[owned[s][t] for t in owned] for s in owned], bool)
        links = np.zeros(len(ids), np.int64)
        parent = np.arange(len(ids))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for q, found in zip(queries, block.search_all(units[queries], similar, [lists[q] for q in queries])):
            found = members[found]
            found = found[found != q]
            if not len(found):
                continue
            own = found[mine[kind[q], kind[found]]]
            links[q] += copies[own].sum()
            if low != high:
                np.add.at(links, own, copies[q])
            top = root(q)
            for other in {root(x) for x in np.unique(parent[found])}:
                parent[max(other, top)] = min(other, top)
                top = min(other, top)
        roots = np.array([root(x) for x in range(len(ids))])
        some = (links > 0) | (roots != np.arange(len(ids)))
        return pd.DataFrame({"id": ids[some], "links": links[some], "root": ids[roots[some]]})

    return searched.groupBy("width", "shard", "low", "high").applyInPandas(task, "id long, links long, root long")


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", similar: float = SIMILAR,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row per row: how many other vectors were found with at least this
    cosine, the smallest vec_id reachable by links, and whether it is the row's own.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and so do rows without
    vec_id, whose component is null. Vectors of different lengths do not link. Repeated rows count as vectors of their
    own and link with each other; of rows of one vec_id with different vectors, the links are counted together. An empty table gives no rows; other columns are not read.
    """
    bounded_batches(vectors.sparkSession)
    rows = written(nodes_of(vectors, id_col, vector_col), "vectors")
    classes = written(
        rows.where("usable").groupBy("s1", "s2").agg(
            F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("unit").alias("unit")
        ), "vector-classes",
    )
    total = classes.count()
    centres = chosen_centres(classes, total)
    placed = place(classes.select("id", "copies", "unit", "s1"), centres)
    sizes = placed.groupBy("width", "shard").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = written(
        placed.join(written(sizes, "shard-sizes"), ["width", "shard"])
        .withColumn("block", F.pmod(F.xxhash64("s1"), F.col("blocks")).cast("int")), "placed-vectors",
    )
    lists = united_lists(placed.select("width", "shard", "block", "id", "unit"))
    members = written(placed.join(lists, "id"), "graph")
    # A block meets every block of its shard once, and itself.
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least(F.col("block"), other).alias("low"), F.greatest(F.col("block"), other).alias("high")),
    )
    searched = members.withColumn("task", F.explode(pairs)).select("*", "task.low", "task.high").drop("task")
    found = written(_links(searched, similar), "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    components = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = classes.select("s1", "s2", "id", "copies").join(links, "id", "left").join(
        components.withColumnRenamed("node", "id"), "id", "left"
    )
    named = written(named.select(
        "s1", "s2", F.lit(True).alias("usable"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "id").alias("component"),
    ), "named-vectors")
    out = rows.select("vec_id", "usable", "s1", "s2").join(named, ["usable", "s1", "s2"], "left")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def audit_recall(
    vectors: DataFrame, found: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    similar: float = SIMILAR, every: int = 50,
) -> float:
    """The share of the links of rows whose id is divisible by ``every`` that ``found`` counts, by brute force in
    blocks: each task holds all those queries against the rows it reads."""
    rows = nodes_of(vectors, id_col, vector_col).where("usable")
    width = rows.groupBy(F.octet_length("unit").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if not width:
        return 1.0
    rows = rows.where(F.octet_length("unit") == width["width"])  # vectors of the usual length
    queries = rows.where(F.col("vec_id") % every == 0).select("vec_id", "unit").toPandas()
    if not len(queries):
        return 1.0
    ids, units = queries["vec_id"].to_numpy(), _stacked(queries["unit"])

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(len(ids), np.int64)
        for frame in frames:
            if len(frame):
                counts += (units @ _stacked(frame["unit"]).T >= similar).sum(axis=1)
        yield pd.DataFrame({"vec_id": ids, "n": counts})

    true = rows.select("vec_id", "unit").mapInPandas(counted, "vec_id long, n long").groupBy("vec_id").agg(
        (F.sum("n") - 1).alias("n")
    )
    sums = true.join(found.select("vec_id", "n_links"), "vec_id").agg(F.sum("n_links"), F.sum("n")).first()
    return float(sums[0]) / float(sums[1]) if sums[1] else 1.0
