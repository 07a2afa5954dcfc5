"""Near-duplicate documents by word shingles: an exact Jaccard join with several global token orders.

A document's set is its distinct shingles. Equal sets are one class. Under any global order of the tokens, two sets
that are similar enough share a token among the first few of each; so they must share one under every order, and only
pairs that pass all orders are verified. Each order puts frequent tokens last and the rest by a hash of its own.

Groups of near copies are not expanded into pairs. In each list of sets that share a prefix token, all are first
compared with one of them, the one with the fewest rare tokens before it; what that links is one component. Then only
sets of different components in one list are still compared, which leaves no link out: links inside a component
change nothing.

Every class carries a parity sketch. Each bit in which two sketches differ stands for a token of its own that one of
the sets lacks, so pairs whose sketches differ in more bits than similar sets may differ in tokens go first, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vanewright.llm.common import bounded_batches, by_value, process_cache
from vanewright.llm.components import connected_components
from vanewright.session import forget, written

by_value(__name__)

#: Words of a shingle; two documents link when 100 * shared >= SIMILAR * united.
WORDS, SIMILAR = 5, 80
#: Tokens counted at a time for frequency, and how often one must come up there to be noted as frequent. The list of
#: frequent ones that travels to the tasks is bounded. It shapes the orders, never the result.
COUNT_AT, NOTED, FREQUENT = 2_000_000, 2, 400_000
#: Lists of tokens of at least this power of frequency are split in so many.
SPLIT, SALT = 8, 32
#: Bits of the fixed-size filter for sets that have candidates. False positives cost time only.
FILTER_BITS = 25
#: Bytes of a text that are hashed at a time.
SEGMENT = 1 << 18
#: Longs of a set's parity sketch.
SKETCH = 4
_SKETCH = [f"k{i}" for i in range(SKETCH)]
_SPACES = [bytes([c]) for c in b" \t\n\x0b\x0c\r"]
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ values >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ values >> np.uint64(33)


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and their inverses, modulo 2**64."""
    cache = process_cache("shingle-powers")
    if len(cache.get("up", ())) < size:
        base = 0x9DDFEA08EB382D69
        for name, factor in (("up", base), ("down", pow(base, -1, 1 << 64))):
            row = np.full(size, factor, np.uint64)
            row[0] = 1
            cache[name] = np.multiply.accumulate(row)
    return cache["up"], cache["down"]


def _word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word: a polynomial of its bytes, from one running sum over the whole text."""
    found = []
    at = 0
    while at < len(text):
        cut = at + SEGMENT
        if cut < len(text):  # a segment ends where a word does
            cut = max(text.rfind(space, at, cut) for space in _SPACES) + 1
            if not cut:
                cut = min((p for p in (text.find(space, at) for space in _SPACES) if p >= 0), default=len(text) - 1) + 1
        part = np.frombuffer(text[at:cut], np.uint8)
        at = cut
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = ~_IS_SPACE[part]
        change = np.diff(inside)
        starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        up, down = _powers(max(SEGMENT + 1, len(part)))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=sums[1:])
        lengths = (ends - starts).astype(np.uint64)
        found.append(_mixed((sums[ends] - sums[starts]) * down[starts] + lengths * np.uint64(0xC2B2AE3D27D4EB4F)))
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def shingle_set(text: str, words: int) -> np.ndarray:
    """The sorted distinct 64-bit tokens of a text: one per ``words`` words in a row, or one for all of fewer words."""
    hashes = _word_hashes(text.encode("utf-8", "surrogatepass").lower())  # bytes: ASCII letters only
    if not len(hashes):
        return hashes
    count = min(words, len(hashes))
    rolled = hashes[:len(hashes) - count + 1].copy()
    for i in range(1, count):
        rolled *= np.uint64(0xD6E8FEB86659FD93)
        rolled += hashes[i:len(hashes) - count + 1 + i]
    rolled = _mixed(rolled + np.uint64(count))
    rolled.sort()
    new = np.empty(len(rolled), bool)
    new[0] = True
    np.not_equal(rolled[1:], rolled[:-1], out=new[1:])
    return rolled[new]


def signature(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed longs."""
    import xxhash

    value = xxhash.xxh3_128_intdigest(tokens.tobytes())
    high, low = value >> 64, value & (1 << 64) - 1
    return high - (1 << 64) * (high >> 63), low - (1 << 64) * (low >> 63)


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """``SKETCH`` longs whose bits are the parities of how many tokens fall on each: two sets differ in at least as many
    tokens as their sketches in bits."""
    bits = np.bincount((tokens % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<i8")


def prefix_length(size: int, similar: int) -> int:
    """So many first tokens of a set cannot all miss a similar enough one."""
    return size - -(-similar * size // 100) + 1 if size else 0


@dataclass
class Frequent:
    """Frequent tokens, sorted, with the power of two of how often they come up, from 1 on."""

    tokens: np.ndarray
    powers: np.ndarray

    def of(self, tokens: np.ndarray) -> np.ndarray:
        """The powers of tokens; 0 for those that are not frequent."""
        if not len(self.tokens):
            return np.zeros(len(tokens), np.uint64)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.powers[at], np.uint64(0))


def ordered_prefix(tokens: np.ndarray, powers: np.ndarray, order: int, length: int) -> np.ndarray:
    """The first tokens under one global order: by their power of frequency, then by the order's hash."""
    keys = tokens * np.uint64(_ORDERS[order]) >> np.uint64(6) | powers << np.uint64(58)
    return tokens[np.argsort(keys, kind="stable")[:length]]


def _docs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str]]:
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield doc_id, text.as_py() or ""


def _batch(names: list[str], columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def survey(docs: DataFrame, words: int) -> DataFrame:
    """One pass over all texts, written to shared storage. Rows of two kinds: (doc_id, n, s1, s2, k0, ...) for every document,
    the size, signature and parity sketch of its set, and (token, often) for every token that comes up ``NOTED`` times in any two
    million tokens of different sets that a task reads in a row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "s1", "s2", "token", "often", *_SKETCH]
        held: list[np.ndarray] = []
        seen: set[tuple[int, int]] = set()
        size = 0

        def noted() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held or [np.empty(0, np.uint64)]), return_counts=True)
            often = counts >= NOTED
            nothing = pa.nulls(int(often.sum()), pa.int64())
            return pa.RecordBatch.from_arrays(
                [nothing] * 4 + [pa.array(tokens[often].view(np.int64)), pa.array(counts[often].astype(np.int64))]
                + [nothing] * SKETCH, names=names,
            )

        for batch in batches:
            sets = [shingle_set(t.as_py() or "", words) for t in batch.column(1)]
            marks = [signature(s) for s in sets]
            both = np.array(marks, np.int64).reshape(-1, 2)
            sketches = np.array([parity_sketch(s) for s in sets], np.int64).reshape(-1, SKETCH)
            nothing = pa.nulls(len(sets), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(both[:, 0]),
                 pa.array(both[:, 1]), nothing, nothing, *[pa.array(sketches[:, i]) for i in range(SKETCH)]],
                names=names,
            )
            for mark, tokens in zip(marks, sets):
                if mark in seen:  # copies do not make a token frequent
                    continue
                seen.add(mark)
                held.append(tokens)
                size += len(tokens)
                if size >= COUNT_AT:
                    yield noted()
                    held, size = [], 0
                    seen.clear()
        yield noted()

    schema = ", ".join(f"{c} long" for c in ["doc_id", "n", "s1", "s2", "token", "often", *_SKETCH])
    return written(_docs(docs).mapInArrow(task, schema), "shingle-survey")


def frequent_tokens(surveyed: DataFrame) -> Frequent:
    """The tokens noted most often over all documents, at most ``FREQUENT``."""
    counts = surveyed.where(F.col("token").isNotNull()).groupBy("token").agg(F.sum("often").alias("often"))
    kept = counts.orderBy(F.desc("often"), "token").limit(FREQUENT).toPandas()
    tokens = kept["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    powers = np.log2(np.maximum(kept["often"].to_numpy(np.float64), 2.0)).astype(np.uint64)
    return Frequent(tokens[order], powers[order])


def _postings(docs: DataFrame, words: int, similar: int, frequent: Frequent) -> DataFrame:
    """(token, salt, s1, n, at): the prefix of every class under the first order, once a task. Half of the signature
    is enough to find candidates."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["token", "salt", "s1", "n", "at"]
        seen: set[tuple[int, int]] = set()
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            lengths = [len(h[0]) for h in held]
            tokens = np.concatenate([h[0] for h in held] or [np.empty(0, np.uint64)])
            salts = np.repeat(np.array([1 + h[1][0] % SALT for h in held], np.int32), lengths)
            salts[frequent.of(tokens) < SPLIT] = 0
            nodes = np.repeat(np.array([h[1][0] for h in held], np.int64), lengths)
            n = np.repeat(np.array([h[2] for h in held], np.int32), lengths)
            places = np.concatenate([np.arange(k, dtype=np.int32) for k in lengths] or [np.empty(0, np.int32)])
            return _batch(names, [tokens.view(np.int64), salts.astype(np.int32), nodes, n.astype(np.int32), places])

        for doc_id, text in _rows(batches):
            tokens = shingle_set(text, words)
            mark = signature(tokens)
            if doc_id is None or not len(tokens) or mark in seen:
                continue
            if len(seen) >= 1_000_000:
                seen.clear()
            seen.add(mark)
            prefix = ordered_prefix(tokens, frequent.of(tokens), 0, prefix_length(len(tokens), similar))
            held.append((prefix, mark, len(tokens)))
            size += len(prefix)
            if size >= 200_000:
                yield flush()
                held, size = [], 0
        yield flush()

    return _docs(docs).mapInArrow(listed, "token long, salt int, s1 long, n int, at int")


def _may_link(similar: int, n: Column, at: Column, m: Column, other_at: Column) -> Column:
    """Whether two sets can be similar whose first shared token stands at these places: nothing before is shared."""
    most = F.least(n - at, m - other_at)
    return most * 100 >= (n + m - most) * similar


def _may_differ(similar: int, n: Column, m: Column, sketches: list[tuple[Column, Column]]) -> Column:
    """Whether two sets can be similar whose sketches these are, long for long: each bit that differs stands for a token
    that one of them lacks."""
    differ = sum(F.bit_count(one.bitwiseXOR(other)) for one, other in sketches)
    return differ * (100 + similar) <= (n + m) * (100 - similar)


def _filter_bit(value: Column) -> Column:
    return F.pmod(value, F.lit(1 << FILTER_BITS))


def _candidate_filter(classes: DataFrame, name: str) -> np.ndarray:
    """A bitmap of fixed size over the signatures or ids of the classes."""
    bit = _filter_bit(F.col(name))
    words = classes.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod({name}, 64) as int))")).alias("bits")
    ).toPandas()
    bitmap = np.zeros(1 << FILTER_BITS - 6, np.int64)
    bitmap[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return bitmap.view(np.uint64)


def _candidate_sets(docs: DataFrame, words: int, similar: int, frequent: Frequent, pairs: DataFrame) -> DataFrame:
    """(t1, t2, tokens, second, third) of the classes of the pairs (a, b), and of a few others: signature, whole set at
    48 bits a token, and 32 bits of its prefix tokens under the other orders. Only the documents that classes are named
    after are cut into shingles."""
    bitmap = _candidate_filter(pairs.select(F.col("a").alias("id")).union(pairs.select("b")), "id")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["t1", "t2", "tokens", "second", "third"]
            )

        for doc_id, text in _rows(batches):
            if doc_id is None or not _in_filter(bitmap, doc_id):
                continue
            tokens = shingle_set(text, words)
            mark = signature(tokens)
            if mark in seen:
                continue
            if len(seen) >= 1_000_000:
                seen.clear()
            seen.add(mark)
            length, powers = prefix_length(len(tokens), similar), frequent.of(tokens)
            rows.append((*mark, packed(tokens), *(
                ordered_prefix(tokens, powers, k, length).astype(np.uint32).view(np.int32) for k in (1, 2)
            )))
            if len(rows) >= 1000:
                yield flush()
                rows = []
        yield flush()

    return written(_docs(docs).mapInArrow(
        made, "t1 long, t2 long, tokens binary, second array<int>, third array<int>"
    ), "candidate-sets")


def _in_filter(bitmap: np.ndarray, value: int) -> bool:
    bit = value % (1 << FILTER_BITS)
    return bool(int(bitmap[bit >> 6]) >> (bit & 63) & 1)


def packed(tokens: np.ndarray) -> bytes:
    """The upper 48 bits of each token: two tokens of one pair of sets agree in them by chance once in 10**14."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def shared_tokens(one: bytes, other: bytes) -> tuple[int, int]:
    """(shared, united) of two packed sets."""
    both = np.zeros(((len(one) + len(other)) // 6, 8), np.uint8)
    both[:, 2:] = np.frombuffer(one + other, np.uint8).reshape(-1, 6)
    tokens = both.reshape(-1).view("<u8")
    tokens.sort(kind="stable")
    shared = int(np.count_nonzero(tokens[1:] == tokens[:-1]))
    return shared, len(tokens) - shared


def _is(s1: str, s2: str, t1: str, t2: str) -> Column:
    return (F.col(s1) == F.col(t1)) & (F.col(s2) == F.col(t2))


def _verified(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs of classes (a1, a2, b1, b2, a, b) that share prefix tokens under the other orders too, and are
    similar: (a, b)."""
    prefixes = written(sets.select("t1", "t2", "second", "third").dropDuplicates(["t1", "t2"]), "other-prefixes")

    def beside(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
        side = right.select(*[F.col(c).alias(f"{name}_{c}") for c in right.columns])
        return left.join(side, _is(f"{name}1", f"{name}2", f"{name}_t1", f"{name}_t2"))

    both = beside(beside(pairs, prefixes, "a"), prefixes, "b")
    overlap = F.arrays_overlap("a_second", "b_second") & F.arrays_overlap("a_third", "b_third")
    passed = written(both.where(overlap).select(*pairs.columns), "candidate-pairs")

    ends = passed.select(F.col("a1").alias("s1")).union(passed.select("b1"))
    bitmap = _candidate_filter(ends, "s1")  # of fixed size: only sets that are needed are shuffled

    @F.pandas_udf("boolean")
    def needed(signature: pd.Series) -> pd.Series:
        bits = signature.to_numpy(np.int64) % (1 << FILTER_BITS)
        return pd.Series(bitmap[bits >> 6] >> (bits & 63).astype(np.uint64) & np.uint64(1) == 1)

    @F.pandas_udf("boolean")
    def similar_enough(one: pd.Series, other: pd.Series) -> pd.Series:
        counts = [shared_tokens(a, b) for a, b in zip(one, other)]
        return pd.Series([100 * shared >= similar * united for shared, united in counts], dtype=bool)

    whole = sets.where(needed("t1")).select("t1", "t2", "tokens").dropDuplicates(["t1", "t2"])
    compared = beside(beside(passed, whole, "a"), whole, "b")
    found = written(compared.where(similar_enough("a_tokens", "b_tokens")).select("a", "b"), "similar-pairs")
    forget(passed, prefixes)
    return found


def posting_lists(docs: DataFrame, words: int, similar: int, frequent: Frequent) -> DataFrame:
    """(token, salt, s1, n, at, first, length) of the prefix tokens that a class shares with another of similar
    size, or that are frequent. ``first`` is the list's leader: it has the fewest tokens before the shared one."""
    one_list = Window.partitionBy("token", "salt")
    postings = _postings(docs, words, similar, frequent).repartition("token", "salt").dropDuplicates()
    shared = postings.withColumn("length", F.count("*").over(one_list)).where("length > 1 OR salt > 0")
    reach = int(1e6 * np.log(100 / similar)) + 2  # in millionths of a logarithm, rounded up
    size = (F.log("n") * 1e6).cast("long")
    sized = Window.partitionBy("token", "salt").orderBy(size).rangeBetween(-reach, reach)
    shared = shared.withColumn("sized", F.count("*").over(sized)).where("sized > 1 OR salt > 0")
    first = F.min(F.struct("at", "n", "s1")).over(one_list)
    return written(shared.select(
        "token", "salt", "s1", "n", "at", first.alias("first"), F.count("*").over(one_list).alias("length"),
    ), "posting-lists")


def _of_classes(pairs: DataFrame, classes: DataFrame, similar: int) -> DataFrame:
    """Distinct pairs of classes (a1, a2, b1, b2, a, b), a the smaller id, from pairs of half signatures (s1, f1). Left
    out are those whose sketches differ in more bits than two similar sets of their sizes in tokens."""
    distinct = pairs.where("s1 <> f1").select(
        F.least("s1", "f1").alias("s1"), F.greatest("s1", "f1").alias("f1")
    ).distinct()
    own = F.struct("id", "s1", "s2", "n", *_SKETCH)
    one = classes.select(own.alias("one"), F.col("s1").alias("c1"))
    other = classes.select(own.alias("other"), F.col("s1").alias("d1"))
    sketches = [(F.col(f"one.{c}"), F.col(f"other.{c}")) for c in _SKETCH]
    may = _may_differ(similar, F.col("one.n"), F.col("other.n"), sketches)
    named = distinct.join(one, F.col("s1") == F.col("c1")).join(
        other, (F.col("f1") == F.col("d1")) & (F.col("one.id") != F.col("other.id")) & may
    )
    low, high = F.least("one", "other"), F.greatest("one", "other")
    return named.select(
        low.s1.alias("a1"), low.s2.alias("a2"), high.s1.alias("b1"), high.s2.alias("b2"), low.id.alias("a"),
        high.id.alias("b"),
    )


def _star_pairs(lists: DataFrame, classes: DataFrame, similar: int) -> DataFrame:
    """Every class beside its list's leader, and the leaders of a split list beside the first of them."""
    f, top = F.col("first"), F.col("top")
    own = lists.where(_may_link(similar, F.col("n"), F.col("at"), f.n, f.at)).select("s1", f.s1.alias("f1"))
    split = lists.where("salt > 0").select("token", "first").distinct()
    tops = split.groupBy("token").agg(F.min("first").alias("top"))
    among = split.join(tops, "token").where(_may_link(similar, f.n, f.at, top.n, top.at)).select(
        f.s1.alias("s1"), top.s1.alias("f1")
    )
    return written(_of_classes(own.union(among), classes, similar), "star-pairs")


def _longer(lists: DataFrame) -> DataFrame:
    """Lists that may hold pairs beyond those with their leader."""
    return lists.where("length > 2 OR salt > 0")


def _mixed_lists(lists: DataFrame, classes: DataFrame, components: DataFrame) -> DataFrame:
    """(token, s1, n, at, component, k0, ..., main) of the lists with classes of several components; main is that of the
    leader, to which most of the list belongs."""
    linked = F.struct(F.lit(True).alias("linked"), F.col("component").alias("x"))
    alone = F.struct(F.lit(False).alias("linked"), F.col("s1").alias("x"))
    known = classes.join(components, F.col("id") == F.col("node"), "left").select(
        F.col("s1").alias("c1"), F.when(F.col("component").isNotNull(), linked).otherwise(alone).alias("component"),
        *_SKETCH,
    )
    placed = written(
        _longer(lists).select("token", "s1", "n", "at").join(known, F.col("s1") == F.col("c1")).drop("c1"),
        "placed-lists",
    )
    mixed = placed.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.min(F.struct("at", "n", "s1", "component")).alias("first"),
    ).where("low <> high").select("token", F.col("first.component").alias("main"))
    whole = written(placed.join(written(mixed, "mixed-lists"), "token"), "mixed-rows")
    forget(placed)
    return whole


def _mixed_pairs(whole: DataFrame, similar: int) -> DataFrame:
    """(s1, f1): pairs of different components in one list that may be similar by their places and sketches. One of them
    is not of the list's main component, so only such classes are set against the whole list, each two of them once a
    list."""
    others = whole.where(F.col("component") != F.col("main")).select(
        "token", F.col("s1").alias("f1"), F.col("n").alias("m"), F.col("at").alias("place"),
        F.col("component").alias("its"), *[F.col(c).alias(f"its_{c}") for c in _SKETCH],
    )
    once = (F.col("component") == F.col("main")) | (F.col("s1") < F.col("f1"))
    return others.join(whole, "token").where(
        (F.col("component") != F.col("its")) & once
        & _may_link(similar, F.col("n"), F.col("at"), F.col("m"), F.col("place"))
        & _may_differ(similar, F.col("n"), F.col("m"), [(F.col(c), F.col(f"its_{c}")) for c in _SKETCH])
    ).select("s1", "f1")


def similar_classes(docs: DataFrame, classes: DataFrame, words: int, similar: int, frequent: Frequent) -> DataFrame:
    """(node, component) over the classes (id, s1, s2, n, k0, ...) that are linked with another."""
    lists = posting_lists(docs, words, similar, frequent)
    star = _star_pairs(lists, classes, similar)
    sets = _candidate_sets(docs, words, similar, frequent, star)
    links = _verified(star, sets, similar)
    forget(sets)
    seen = star.select(*[F.col(c).alias(f"seen_{c}") for c in ("a1", "a2", "b1", "b2")])
    mixed = _mixed_lists(lists, classes, connected_components(links))
    rest = _of_classes(_mixed_pairs(mixed, similar), classes, similar)
    rest = rest.join(seen, _is("a1", "a2", "seen_a1", "seen_a2") & _is("b1", "b2", "seen_b1", "seen_b2"), "left_anti")
    rest = written(rest, "rest-pairs")
    forget(lists, star, mixed)
    sets = _candidate_sets(docs, words, similar, frequent, rest)
    more = _verified(rest, sets, similar)
    forget(rest, sets)
    return connected_components(links.union(more))


def near_duplicates(docs: DataFrame, words: int = WORDS, similar: int = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component_id) of documents (doc_id, text), a row per row: the size of its set of
    ``words``-word shingles, and the smallest doc_id reachable by links of ``similar`` percent Jaccard similarity.

    A-Z are lower-cased; words are runs without ASCII white space; a text of fewer words is one shingle. Null, empty
    and blank texts have an empty set and link with nothing. A row without doc_id links with nothing and has a null
    component. Rows of one doc_id are one document: the links of all
    its texts are its links. Whole texts count, however long.
    An empty table gives no rows; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    surveyed = survey(docs, words)
    signed = surveyed.where("s1 IS NOT NULL").select("doc_id", "n", "s1", "s2", *_SKETCH)
    classes = written(
        signed.where("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2").agg(
            F.min("doc_id").alias("id"), *[F.min(c).alias(c) for c in ("n", *_SKETCH)]
        ), "classes"
    )
    components = similar_classes(docs, classes, words, similar, frequent_tokens(surveyed))
    named = written(
        classes.join(components, F.col("id") == F.col("node"), "left")
        .select("s1", "s2", F.coalesce("component", "id").alias("component_id")), "named-classes"
    )
    return signed.join(named, ["s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
        .alias("component_id"),
    )
