"""SentencePiece encoding and decoding by a max-plus parallel scan.

A piece file gives every piece a score; the encoding of a text is its segmentation with the highest summed score, and
a character that no piece covers is written in byte pieces. The best segmentation is a product of max-plus matrices,
so giant texts need no single task: they are cut into chunks, each chunk yields the matrix of best scores from every
state at its left border to every state at its right one, the matrices are multiplied pair by pair up a tree, the state
at each border is found down the same tree, and then every chunk is traced back on its own. A state is how far a piece
reaches over the border.
"""

from __future__ import annotations

import hashlib
import re
import zlib
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.common import bounded_batches, by_value, objects, process_cache
from vanewright.session import written

by_value(__name__)

#: Characters from which a text is cut into chunks, and characters of a chunk.
GIANT = 1 << 16
#: Matrices that a task multiplies into one.
FAN = 64
#: The mark that piece files write for a space.
SPACE = "\u2581"
#: Words looked up that a process keeps, in each of two generations: the older one is dropped when the newer is full,
#: so that frequent words stay and those met once go.
_CACHE_WORDS = 300_000
NEVER = -np.inf


class Pieces:
    """The pieces of a model file with their scores."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.bytes = [0] * 256
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i)):
                self.ids[piece] = i
        scores = np.array([self.model.get_score(i) for i in range(self.model.get_piece_size())])
        usable = [scores[i] for i in self.ids.values() if scores[i] > -1e8]
        self.lowest = float(min(usable, default=0.0)) - 10.0  # what a character without a piece costs
        # File scores are whole numbers and often tie: a thousandth by the piece's own checksum makes the best unique.
        # Runs of spaces are listed without a score of their own; they count as the least likely pieces.
        self.scores = {
            p: max(float(scores[i]), self.lowest + 5.0) - 1e-3 * zlib.crc32(p.encode()) / (1 << 32) for p, i in self.ids.items()
        }
        self.plain = [b""] * self.model.get_piece_size()
        for piece, i in self.ids.items():
            self.plain[i] = piece.replace(SPACE, " ").encode()
        for value, i in enumerate(self.bytes):
            self.plain[i] = bytes([value])
        self.longest = max(map(len, self.ids), default=1)
        self.letters = {p for p in self.ids if len(p) == 1}
        self.matcher = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            self.matcher.add_word(piece, (len(piece), score))
        self.matcher.make_automaton()
        self.words: dict[str, tuple[bytes, float]] = {}
        self.older: dict[str, tuple[bytes, float]] = {}

    def steps(self, text: str, end: int) -> list[tuple[int, float]]:
        """(start, score) of every piece of ``text`` that ends at ``end``."""
        out = []
        for start in range(max(0, end - self.longest), end):
            score = self.scores.get(text[start:end])
            if score is not None:
                out.append((start, score))
        if not out or out[-1][0] != end - 1:
            out.append((end - 1, self.lowest))
        return out

    def best(self, text: str) -> tuple[list[int], float]:
        """The borders of the best segmentation and its score; of equally good ones, the longest last piece."""
        # All pieces in the text are matched at once, by rising end and falling length.
        value, came = [NEVER] * (len(text) + 1), [0] * (len(text) + 1)
        value[0] = 0.0
        if self.letters.issuperset(text):
            for last, (length, score) in self.matcher.iter(text):
                end = last + 1
                total = value[end - length] + score
                if total > value[end]:
                    value[end], came[end] = total, end - length
        else:
            foreign = [end for end, c in enumerate(text, 1) if c not in self.letters]  # ends that need byte pieces
            foreign.append(len(text) + 1)
            lowest, due = self.lowest, 0
            matches = [(last + 1, length, score) for last, (length, score) in self.matcher.iter(text)]
            for end, length, score in [*matches, (len(text) + 1, 0, 0.0)]:
                while foreign[due] < end:  # no more pieces end there
                    at = foreign[due]
                    if value[at - 1] + lowest > value[at]:
                        value[at], came[at] = value[at - 1] + lowest, at - 1
                    due += 1
                if length:
                    total = value[end - length] + score
                    if total > value[end]:
                        value[end], came[end] = total, end - length
        borders = [len(text)]
        while borders[-1]:
            borders.append(came[borders[-1]])
        return borders[::-1], value[-1]

    def ids_of(self, text: str, borders: list[int]) -> list[int]:
        out: list[int] = []
        for start, end in zip(borders, borders[1:]):
            known = self.ids.get(text[start:end])
            out.extend([known] if known is not None else [self.bytes[b] for b in text[start:end].encode("utf-8", "surrogatepass")])
        return out

    def transfer(self, chunk: str, after: str) -> np.ndarray:
        """The max-plus matrix of a chunk: from how many characters of it the piece before has covered (row) to how
        many characters of the text ``after`` it the last piece covers (column)."""
        size = self.longest
        reach = chunk + after[:size - 1]
        matrix = np.full((size, size), NEVER)
        value = np.full((size, len(reach) + 1), NEVER)
        for state in range(min(size, len(reach) + 1)):
            value[state, state] = 0.0
        # A piece that covers the whole chunk passes straight through: its states lie beyond the chunk's end.
        for end in range(1, len(reach) + 1):
            for start, score in self.steps(reach, end):
                if start < len(chunk):
                    np.maximum(value[:, end], value[:, start] + score, out=value[:, end])
        columns = value[:, len(chunk):len(chunk) + size]
        matrix[:, :columns.shape[1]] = columns
        return matrix

    def trace(self, chunk: str, after: str, enter: int, leave: int) -> list[int]:
        """The borders of the pieces that begin in the chunk, for known states at its ends."""
        reach = chunk + after[:self.longest - 1]
        end_at = len(chunk) + leave
        value, came = [NEVER] * (len(reach) + 1), [-1] * (len(reach) + 1)
        if enter <= len(reach):
            value[enter] = 0.0
        for end in range(enter + 1, end_at + 1):
            for start, score in self.steps(reach, end):
                if enter <= start < len(chunk) and value[start] + score > value[end]:
                    value[end], came[end] = value[start] + score, start
        borders = [end_at]
        while borders[-1] > enter:
            borders.append(came[borders[-1]])
        return borders[::-1]

    def encode(self, text: str) -> tuple[bytes, float]:
        """(ids as little-endian unsigned 32-bit numbers, score) of a text in memory.

        No piece has a space mark behind other characters, so a text is the sum of its words, each with the marks
        before it; each distinct word is segmented once.
        """
        marked = SPACE + text.replace(" ", SPACE)
        parts, total, known = [], 0.0, self.words
        words = marked.split(SPACE)[1:]
        if SPACE * 2 in marked or marked[-1] == SPACE:
            words = [run[1:] for run in re.findall(f"{SPACE}+[^{SPACE}]*", marked)]
        for word in words:
            found = known.get(word)
            if found is None:
                if len(known) >= _CACHE_WORDS:
                    self.older, self.words = known, {}
                    known = self.words
                found = self.older.get(word)
                if found is None:
                    own = SPACE + word
                    borders, score = self.best(own)
                    found = (np.array(self.ids_of(own, borders), "<u4").tobytes(), score)
                known[word] = found
            parts.append(found[0])
            total += found[1]
        return b"".join(parts), total


    def decode(self, ids: bytes) -> str:
        """The text of packed ids: the mark before the first word is dropped, byte pieces are put together."""
        found = b"".join(map(self.plain.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return found.decode("utf-8", "replace")[1:]


def max_plus(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The product of two max-plus matrices."""
    return (one[:, :, None] + other[None, :, :]).max(axis=1)


def pieces_of(path: str) -> Pieces:
    cache = process_cache("pieces")
    if path not in cache:
        cache[path] = Pieces(path)
    return cache[path]


def product_tree(matrices: list[np.ndarray]) -> list[list[np.ndarray]]:
    """The matrices, the products of neighbouring pairs, the products of those, up to the product of all."""
    levels = [matrices]
    while len(levels[-1]) > 1:
        below = levels[-1]
        pairs = [below[i:i + 2] for i in range(0, len(below), 2)]
        levels.append([max_plus(*pair) if len(pair) == 2 else pair[0] for pair in pairs])
    return levels


def border_states(levels: list[list[np.ndarray]], enter: int, leave: int) -> list[int]:
    """The states at the borders of the matrices on the best path, for known states at both ends: down the tree, a
    product's two ends give the state between its two factors."""
    states = [enter, leave]
    for level in levels[-2::-1]:
        finer = states[:1]
        for i, (start, end) in enumerate(zip(states, states[1:])):
            if 2 * i + 1 < len(level):
                finer.append(int((level[2 * i][start] + level[2 * i + 1][:, end]).argmax()))
            finer.append(end)
        states = finer
    return states


def _states(matrices: DataFrame, size: int) -> DataFrame:
    """(doc_id, text_hash, chunk, enter, leave, score) of chunks with their matrices: the states of the best path.

    A scan in rounds, as products are associative: up, each group multiplies at most ``FAN`` neighbouring matrices
    of a text into one; down, each group turns the states at its ends into those between its members. However long a
    text is, no task holds more than ``FAN`` of its matrices at once.
    """
    key = ["doc_id", "text_hash", "over"]

    def square(group: pd.DataFrame) -> list[np.ndarray]:
        return [np.asarray(m, np.float64).reshape(size, size) for m in group["matrix"]]

    def product(group: pd.DataFrame) -> pd.DataFrame:
        whole = product_tree(square(group.sort_values("chunk")))[-1][0]
        return group[key].head(1).rename(columns={"over": "chunk"}).assign(matrix=[whole.ravel()])

    def opened(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        states = border_states(product_tree(square(group)), int(group["enter"].iloc[0]), int(group["leave"].iloc[0]))
        return group[["doc_id", "text_hash", "chunk", "score"]].assign(enter=states[:-1], leave=states[1:])

    over = F.floor(F.col("chunk") / FAN).cast("int")
    levels, last = [matrices], matrices.agg(F.max("chunk")).first()[0] or 0
    while last:
        last //= FAN
        grouped = levels[-1].withColumn("over", over).groupBy(*key)
        levels.append(written(
            grouped.applyInPandas(product, "doc_id long, text_hash string, chunk int, matrix array<double>"), "products"
        ))
    states = levels[-1].select(
        "doc_id", "text_hash", "chunk", F.get("matrix", F.lit(0)).alias("score"),
        F.lit(0).alias("enter"), F.lit(0).alias("leave"),
    )
    for level in levels[-2::-1]:
        known = states.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash", "chunk": "_over"})
        members = level.withColumn("over", over).join(
            known, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash"))
            & (F.col("_over") == F.col("over")),
        )
        states = members.select(*key, "chunk", "matrix", "score", "enter", "leave").groupBy(*key).applyInPandas(
            opened, "doc_id long, text_hash string, chunk int, score double, enter int, leave int"
        )
    return states


def _cut(docs: DataFrame, chunk: int, longest: int) -> DataFrame:
    """(doc_id, text_hash, chunk, text, after) of every chunk of the marked texts."""
    marked = F.concat(F.lit(SPACE), F.translate("text", " ", SPACE))
    count = F.ceil(F.length("marked") / chunk).cast("int")
    numbered = docs.select("doc_id", F.md5("text").alias("text_hash"), marked.alias("marked")).distinct()
    numbered = numbered.select("*", F.explode(F.sequence(F.lit(0), count - 1)).alias("chunk"))
    at = F.col("chunk") * chunk
    return numbered.select(
        "doc_id", "text_hash", "chunk", F.substring(F.col("marked"), at + 1, F.lit(chunk)).alias("text"),
        F.substring(F.col("marked"), at + 1 + chunk, F.lit(longest - 1)).alias("after"),
    )


def _encode_giants(docs: DataFrame, model: str, chunk: int) -> DataFrame:
    """(doc_id, text_hash, ids, score) of giant texts, each once."""
    longest = pieces_of(model).longest
    tasks = 4 * docs.sparkSession.sparkContext.defaultParallelism  # chunks are small to read and long to work on
    chunks = written(_cut(docs, chunk, longest).repartition(tasks, "doc_id", "text_hash", "chunk"), "text-chunks")

    @F.pandas_udf("array<double>")
    def transfer(text: pd.Series, after: pd.Series) -> pd.Series:
        pieces = pieces_of(model)
        return objects(pieces.transfer(t, a).ravel() for t, a in zip(text, after))

    matrices = chunks.select("doc_id", "text_hash", "chunk", transfer("text", "after").alias("matrix"))
    states = _states(written(matrices, "matrices"), longest)

    @F.pandas_udf("binary")
    def traced(text: pd.Series, after: pd.Series, enter: pd.Series, leave: pd.Series) -> pd.Series:
        pieces = pieces_of(model)
        out = []
        for t, a, start, end in zip(text, after, enter, leave):
            borders = pieces.trace(t, a, start, end)
            out.append(np.array(pieces.ids_of(t + a, borders), "<u4").tobytes())
        return objects(out)

    both = chunks.withColumnRenamed("doc_id", "_id").join(
        states.withColumnsRenamed({"text_hash": "_hash", "chunk": "_chunk"}),
        F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("text_hash") == F.col("_hash"))
        & (F.col("chunk") == F.col("_chunk")),
    )
    parts = both.select("doc_id", "text_hash", "chunk", "score", traced("text", "after", "enter", "leave").alias("ids"))
    joined = F.expr("listagg(ids, X'') WITHIN GROUP (ORDER BY chunk)")
    return parts.groupBy("doc_id", "text_hash").agg(joined.alias("ids"), F.max("score").alias("score"))


def _digested(pieces: Pieces, ids: bytes, score: float) -> tuple[int, int, float, str]:
    text = pieces.decode(ids)
    return len(ids) // 4, zlib.crc32(ids), score, hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def encode(
    docs: DataFrame, model: str, giant: int = GIANT, chunk: int = GIANT, digests: bool = False
) -> DataFrame:
    """(doc_id, ids, score) of documents (doc_id, text), a row per row; ids are packed as little-endian unsigned
    32-bit numbers. With ``digests``, (doc_id, n_ids, ids_crc32, score, decoded_sha256) instead: the ids are decoded
    again where they are made, and only digests leave the tasks.

    ``model`` is a piece file of ``sentencepiece`` without its own normalisation; a space mark comes before the text.
    Texts of ``giant`` characters and more go chunk by chunk through the scan, with the same score; where several
    orders of the same pieces are equally good, it may take another one. A null or empty
    text is the mark alone. A null doc_id stays null; repeated rows repeat; an empty table gives no rows; other
    columns are not read.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    large = F.length("text") >= giant

    @F.pandas_udf("ids binary, score double")
    def encoded(column: pd.Series) -> pd.DataFrame:
        pieces = pieces_of(model)
        found = [pieces.encode(t) for t in column]
        return pd.DataFrame({"ids": objects(f[0] for f in found), "score": [f[1] for f in found]})

    def table(rows: list[tuple]) -> pd.DataFrame:
        columns = list(zip(*rows)) or [[]] * 4
        return pd.DataFrame({
            "n_ids": np.array(columns[0], np.int64), "ids_crc32": np.array(columns[1], np.int64),
            "score": np.array(columns[2], np.float64), "decoded_sha256": objects(columns[3]),
        })

    kinds = "n_ids long, ids_crc32 long, score double, decoded_sha256 string"

    @F.pandas_udf(kinds)
    def small_digests(column: pd.Series) -> pd.DataFrame:
        pieces = pieces_of(model)
        return table([_digested(pieces, *pieces.encode(t)) for t in column])

    @F.pandas_udf(kinds)
    def giant_digests(ids: pd.Series, score: pd.Series) -> pd.DataFrame:
        pieces = pieces_of(model)
        return table([_digested(pieces, bytes(i), s) for i, s in zip(ids, score)])

    of_small = small_digests if digests else encoded
    small = docs.where(~large).select("doc_id", of_small("text").alias("e")).select("doc_id", "e.*")
    giants = docs.where(large)
    scanned = _encode_giants(giants, model, chunk).withColumnRenamed("doc_id", "_id")
    back = giants.select("doc_id", F.md5("text").alias("_hash")).join(
        scanned, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash"))
    )
    if digests:
        back = back.select("doc_id", giant_digests("ids", "score").alias("e")).select("doc_id", "e.*")
        return small.unionByName(back)
    return small.unionByName(back.select("doc_id", "ids", "score"))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids): exactly the encoded text, but that a space mark written in a text itself
    comes back as a space. Null ids give a null text."""
    bounded_batches(encoded.sparkSession)

    @F.pandas_udf("string")
    def decoded(ids: pd.Series) -> pd.Series:
        pieces = pieces_of(model)
        return objects(None if i is None else pieces.decode(bytes(i)) for i in ids)

    return encoded.select("doc_id", decoded("ids").alias("text"))
