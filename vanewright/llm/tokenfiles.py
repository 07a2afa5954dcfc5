"""Token ids in binary files of directly addressable codes.

Ids are split into chunks of 8 bits, lowest first. Level 0 holds the lowest chunk of every id, and a bitmap says which
ids go on; level 1 holds the next chunk of those alone, with a bitmap of its own, and so on. A rank directory counts
the set bits before every 512th, so the place of an id's next chunk is one number of the directory plus the bits of at
most one part of the bitmap: any token is read by a few bytes a level, and nothing else is decoded.

A file, all numbers little-endian::

    magic (8 bytes), tokens, documents, levels (8 bytes each), chunks of each of the four levels (8 bytes each)
    doc_id of each document (8 bytes), whether it has one (1 byte)
    token at which each document begins, then the number of tokens (8 bytes each)
    each level: rank directory (8 bytes a part), bitmap (1 bit a chunk, lowest bit first), chunks (1 byte each)

Documents lie in ascending doc_id: texts are range-partitioned, each task writes the files of its range, and the
manifest, a Parquet table beside them, names every file with its place in the order. A file that is not in the manifest
is what a lost or repeated task left behind.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vanewright.llm.common import bounded_batches, by_value, process_cache, unused

by_value(__name__)

MAGIC = b"DACTOKN1"
#: Bits of a chunk, and chunks between two numbers of a rank directory.
CHUNK, PART = 8, 512
LEVELS = 4
_HEAD = "<8s3Q4Q"
#: A task begins another file when one has so many ids; a document is never cut.
FILE_TOKENS = 1 << 22
#: A word cache is emptied at this many entries: it bounds the memory of a worker and changes no result.
CACHE_WORDS = 500_000
#: Ids read from a file at a time (a longer document is read whole).
READ_TOKENS = 1 << 20

MANIFEST = "file string, part int, number int, documents bigint, tokens bigint, bytes bigint"


# the file format

def rank_directory(bits: np.ndarray) -> np.ndarray:
    """How many bits are set before every ``PART``th, the end included where it is one."""
    before = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
    return before[::PART]


def coded(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(chunks, continuation bits) of each level of a row of unsigned 32-bit ids."""
    levels, rest = [], ids.astype(np.uint32)
    while len(levels) < LEVELS and (len(rest) or not levels):
        more = rest >> np.uint32(CHUNK)
        levels.append((rest.astype(np.uint8), more > 0))
        rest = more[more > 0]
    return levels


def file_bytes(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """A whole file of documents with so many ids each."""
    levels = coded(ids)
    sizes = [len(chunks) for chunks, _ in levels] + [0] * (LEVELS - len(levels))
    parts = [
        struct.pack(_HEAD, MAGIC, len(ids), len(doc_ids), len(levels), *sizes),
        np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
        np.array([i is not None for i in doc_ids], np.uint8).tobytes(),
        np.concatenate([[0], np.cumsum(np.array(lengths, np.int64))]).astype("<i8").tobytes(),
    ]
    for chunks, bits in levels:
        parts += [
            rank_directory(bits).astype("<i8").tobytes(),
            np.packbits(bits, bitorder="little").tobytes(),
            chunks.tobytes(),
        ]
    return b"".join(parts)


class TokenFile:
    """A file open for reading (anything with ``seek`` and ``read``): tokens by number, documents by number."""

    def __init__(self, source):
        self.source = source
        magic, self.tokens, self.documents, levels, *sizes = struct.unpack(_HEAD, self._at(0, struct.calcsize(_HEAD)))
        if magic != MAGIC:
            raise ValueError("not a file of directly addressable tokens")
        at = struct.calcsize(_HEAD) + 9 * self.documents
        self._starts = at
        at += 8 * (self.documents + 1)
        self.levels = []  # (chunks, place of the directory, of the bitmap, of the chunks)
        for size in sizes[:levels]:
            directory = 8 * (size // PART + 1)
            bitmap = -(-size // 8)
            self.levels.append((size, at, at + directory, at + directory + bitmap))
            at += directory + bitmap + size

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        return self.source.read(size)

    def _bits(self, level: int, first: int, last: int) -> np.ndarray:
        """Continuation bits of the chunks from ``first`` up to ``last`` (without it)."""
        low, high = first // 8, -(-last // 8)
        packed = np.frombuffer(self._at(self.levels[level][2] + low, high - low), np.uint8)
        return np.unpackbits(packed, bitorder="little")[first - 8 * low:last - 8 * low]

    def rank(self, level: int, chunk: int) -> int:
        """How many chunks before ``chunk`` go on."""
        part = chunk // PART
        counted = int.from_bytes(self._at(self.levels[level][1] + 8 * part, 8), "little")
        return counted + int(self._bits(level, part * PART, chunk).sum()) if chunk % PART else counted

    def token(self, number: int) -> int:
        """One id, read by a few bytes a level."""
        if not 0 <= number < self.tokens:
            raise IndexError(f"no token {number} of {self.tokens}")
        value = 0
        for level, (_, _, _, chunks) in enumerate(self.levels):
            value |= self._at(chunks + number, 1)[0] << CHUNK * level
            if not self._bits(level, number, number + 1)[0]:
                break
            number = self.rank(level, number)
        return value

    def slice(self, first: int, last: int) -> np.ndarray:
        """The ids from ``first`` up to ``last`` (without it), level by level."""
        out = np.zeros(max(0, last - first), np.uint32)
        owners = np.arange(len(out))
        for level, (_, _, _, chunks) in enumerate(self.levels):
            if not len(owners):
                break
            out[owners] |= np.frombuffer(self._at(chunks + first, last - first), np.uint8).astype(np.uint32) << np.uint32(
                CHUNK * level
            )
            bits = self._bits(level, first, last).astype(bool)
            first, owners = self.rank(level, first) if bits.any() else 0, owners[bits]
            last = first + len(owners)
        return out

    def table(self, first: int, last: int) -> tuple[list[int | None], np.ndarray]:
        """(doc_ids, starts and end) of the documents from ``first`` up to ``last`` (without it)."""
        ids = np.frombuffer(self._at(struct.calcsize(_HEAD) + 8 * first, 8 * (last - first)), "<i8").tolist()
        known = self._at(struct.calcsize(_HEAD) + 8 * self.documents + first, last - first)
        starts = np.frombuffer(self._at(self._starts + 8 * first, 8 * (last - first + 1)), "<i8")
        return [i if k else None for i, k in zip(ids, known)], starts


# encoding

#: Fixed value: how files of words with word ends cut a lower-cased text before merging.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters that every Unicode version lower-cases and composes alike: only words of these are merged by ranks.
_COMMON = frozenset(map(chr, [*range(0x21, 0x7F), *range(0xC0, 0x130), *range(0x132, 0x149), *range(0x14A, 0x17F)]))


class WordEndEncoder:
    """Encode texts with a file of ``tokenizers``, each distinct word (between white space) once.

    For a file that normalises characters alone, cuts at white space and merges within words, a text is the sum of its
    words. Texts with the string of an added token, and other files, go through the library whole. Words of common
    letters are merged by ``tiktoken`` where the file's ids rise with the order of its merges: the end of a word is a
    byte that UTF-8 does not use, and the ids are the same.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        state = json.loads(self.tokenizer.to_str())
        self.by_word = self._cuts_at_white_space(state)
        self.ranks = self._ranked(state) if self.by_word else None
        self.cut = regex.compile(WORD_PATTERN).findall
        self.pieces, self.words = _Words(self._piece), _Words(self._word)

    @staticmethod
    def _cuts_at_white_space(state: dict) -> bool:
        parts = (state["normalizer"] or {}).get("normalizers") or []
        cuts = (state["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        return (
            all(p["type"] in ("NFC", "Lowercase") or (p["type"] == "Replace" and p["pattern"] == {"Regex": "\\s+"}) for p in parts)
            and {"NFC", "Lowercase"} <= {p["type"] for p in parts}
            and [c.get("type") for c in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["pattern"] == {"Regex": WORD_PATTERN}
            and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"]
            and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
            and not state["post_processor"]
        )

    @staticmethod
    def _ranked(state: dict):
        import tiktoken

        model = state["model"]
        end, vocab = model.get("end_of_word_suffix"), model["vocab"]
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        order = [vocab.get(m.replace(" ", "", 1), -1) for m in merges]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        special = {t["content"] for t in state["added_tokens"]}
        words = {w: i for w, i in vocab.items() if w not in special}
        if not end or any(a >= b for a, b in zip([511, *order], order)) or model.get("ignore_merges") or (
            any(words.get(letter, 256) > 255 or not 255 < words.get(letter + end, 0) < 512 for letter in letters)
        ):
            return None
        ranks = {}
        for word, i in words.items():
            stem = word[:-len(end)] if word.endswith(end) else word
            ranks[bytes(letters[c] for c in stem) + (b"\xff" if stem != word else b"")] = i
        return tiktoken.Encoding("file", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if not self.ranks or not _COMMON.issuperset(text):
            return self._library(text)
        return b"".join(map(self.pieces.__getitem__, self.cut(unicodedata.normalize("NFC", text).lower())))

    def _piece(self, piece: str) -> bytes:
        return np.array(self.ranks._encode_single_piece(piece.encode() + b"\xff"), "<u4").tobytes()

    def encode(self, text: bytes) -> bytes:
        """The ids of a text (UTF-8), packed as little-endian unsigned 32-bit numbers."""
        if not self.by_word or any(token in text for token in self.added):
            return self._library(text.decode())
        return b"".join(map(self.words.__getitem__, text.split()))


class _Words(dict):
    """Packed ids by word or piece, filled as asked for."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        ids = self[word] = self.encode(word)
        return ids


def encoder(path: str) -> WordEndEncoder:
    cache = process_cache("word-end encoders")
    if path not in cache:
        cache[path] = WordEndEncoder(path)
    return cache[path]


# writing and reading on Spark

def _opened(path: str):
    """(file system, path on it) of a path or address."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end: int) -> DataFrame:
    """Write the ids of all documents (doc_id, text), each followed by ``end``, into files in ascending doc_id; returns
    the manifest, read back from ``folder``.

    A null doc_id comes first; rows of one doc_id follow each other by the hash of their text, so a doc_id that a
    third of all rows share is dealt to many tasks. A null or empty text is ``end`` alone. Texts are encoded whole,
    however long; a document lies in one file. Repeated rows are written as often; other columns are not read; an
    empty table gives a manifest without rows. Texts are shuffled once, and a task holds one file's ids at a time. A
    task that runs again writes files of other names; the manifest has those of the run that counted.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = folder.rstrip("/")
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(F.col("doc_id"), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id"), F.xxhash64("text"))
    )
    most = FILE_TOKENS

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer).encode, TaskContext.get().partitionId()
        last, number = struct.pack("<I", end), 0
        ids: list[bytes] = []
        doc_ids: list[int | None] = []
        held = 0

        def written() -> pa.RecordBatch:
            name = f"{folder}/part-{part:06d}-{number:05d}-{uuid4().hex}.tokens"
            system, path = _opened(name)
            lengths = [len(i) // 4 for i in ids]
            content = file_bytes(doc_ids, lengths, np.frombuffer(b"".join(ids), "<u4"))
            system.create_dir(path.rsplit("/", 1)[0])
            with system.open_output_stream(path) as out:
                out.write(content)
            row = [name, part, number, len(ids), sum(lengths), len(content)]
            ids.clear()
            doc_ids.clear()
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = [field.split()[0] for field in MANIFEST.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                own = encode(text) + last
                if ids and held + len(own) // 4 > most:
                    yield written()
                    number, held = number + 1, 0
                ids.append(own)
                doc_ids.append(doc_id)
                held += len(own) // 4
        if ids:
            yield written()

    ordered.mapInArrow(task, MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """``MANIFEST`` of a folder with ``start``: the tokens of all files before. The files of a task are added up in
    that task's group; across tasks, one number a task is."""
    files = spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/manifest")
    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = files.groupBy("part").agg(F.sum("tokens").alias("own")).select(
        F.col("part").alias("_part"), F.coalesce(F.sum("own").over(by_part), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return files.join(before, files["part"] == before["_part"]).withColumn(
        "start", F.col("_before") + F.coalesce(F.sum("tokens").over(within), F.lit(0))
    ).drop("_part", "_before")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of a folder: ``start`` counts the ids of all documents before
    it, ``ids`` are little-endian unsigned 32-bit numbers. A task reads the files it is given, a part of one at a time."""
    files = manifest(spark, folder).select("file", "start")
    count, most = spark.read.parquet(f"{folder.rstrip('/')}/manifest").count(), READ_TOKENS

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                system, path = _opened(name)
                with system.open_input_file(path) as source:
                    yield from _documents(TokenFile(source), before, most)

    bounded_batches(spark)
    # a number of tasks by the number of files: the few bytes of a manifest must not become one task
    parts = max(1, min(count, spark.sparkContext.defaultParallelism + count // 4))
    return files.repartition(parts).mapInArrow(task, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def _documents(file: TokenFile, before: int, most: int) -> Iterator[pa.RecordBatch]:
    for block in range(0, file.documents, 4096):
        doc_ids, starts = file.table(block, min(block + 4096, file.documents))
        at = 0
        while at < len(doc_ids):
            until = max(at + 1, int(np.searchsorted(starts, starts[at] + most, "right")) - 1)
            ids = file.slice(int(starts[at]), int(starts[until])).astype("<u4")
            cuts = starts[at:until + 1] - starts[at]
            yield pa.RecordBatch.from_arrays([
                pa.array(doc_ids[at:until], pa.int64()),
                pa.array(before + starts[at:until], pa.int64()),
                pa.array(np.diff(cuts), pa.int64()),
                pa.array([ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            ], names=["doc_id", "start", "n_tokens", "ids"])
            at = until


#: Tokens between two keys that positions and files are joined by.
_KEY = 1 << 21


def tokens_at(positions: DataFrame, folder: str) -> DataFrame:
    """``positions`` (position, and any other columns) with ``token``: the id at that place of the whole folder.

    Positions and files meet by an equal join of coarse places; each file is opened once, and each token read by a few
    bytes. A null position, or one outside the folder, has no token. Repeated positions repeat.
    """
    spark = positions.sparkSession
    own, start, end, key, token = (unused(positions, name) for name in ("_file", "_start", "_end", "_key", "token"))
    files = manifest(spark, folder).where("tokens > 0").select(
        F.col("file").alias(own), F.col("start").alias(start), (F.col("start") + F.col("tokens")).alias(end)
    )
    files = files.withColumn(key, F.explode(F.sequence(F.floor(F.col(start) / _KEY), F.floor((F.col(end) - 1) / _KEY))))
    place = F.col("position")
    found = positions.join(
        files, (F.floor(place / _KEY) == F.col(key)) & (place >= F.col(start)) & (place < F.col(end)), "left"
    ).drop(key, end)
    columns = positions.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source, file = None, None, None
        for batch in batches:
            tokens = []
            for number, its, before in zip(*(batch.column(c).to_pylist() for c in ("position", own, start))):
                if its is None:
                    tokens.append(None)
                    continue
                if its != name:
                    if source:
                        source.close()
                    system, path = _opened(its)
                    name, source = its, system.open_input_file(path)
                    file = TokenFile(source)
                tokens.append(file.token(number - before))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(tokens, pa.int64())], names=[*columns, token]
            )
        if source:
            source.close()

    bounded_batches(spark)
    schema = found.select(*columns, F.lit(0).cast("long").alias(token)).schema
    for field in schema:
        field.nullable = True
    dealt = found.repartition(F.col(own), F.floor(place / _KEY)).sortWithinPartitions(own, "position")
    return dealt.mapInArrow(task, schema)
