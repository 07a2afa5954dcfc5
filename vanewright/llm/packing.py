"""Packing tokenised documents into windows of one capacity with little padding.

Full windows are cut off each document first. What is left of it is cut into short pieces, and the pieces of a block of
documents are divided by Karmarkar-Karp multiway differencing: every partial partition is a tuple of window sums, and
the two with the widest spread are merged, the largest sum of one on the smallest of the other, so that opposing
imbalances cancel. The windows come out nearly equal; when one exceeds the capacity, the block is divided again into
one window more.

A task packs what it reads: no shuffle, no state beyond one block of piece lengths. Windows never cross tasks.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.common import by_value, process_cache

by_value(__name__)

#: A word cache is emptied at this many entries: it bounds the memory of a worker and changes no result.
CACHE_WORDS = 700_000
#: Fixed value: how byte-level BPE files cut a text before merging.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Where the pre-tokenizer would see a text otherwise than word by word: white space three deep, or two at the end.
_UNEVEN = re.compile(r"\s\s(?:\s|\Z)")
_OTHER_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _plain(text: str) -> bool:
    """Surely without white space two deep before the end: a quick look that spares most texts the search."""
    return not (
        "  " in text or " \n" in text or "\n " in text or "\n\n" in text or _OTHER_SPACE.search(text)
        or text[-1:] in (" ", "\n")
    )


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level BPE files write for each byte: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordCachedEncoder:
    """Encode texts with a byte-level BPE file of ``tokenizers``, each distinct word only once.

    The pre-tokenizer always ends a token before a space or line break that follows the text of a word, so a text is
    the sum of its words. Texts with deeper white space, or with the string of an added token, go through the library
    whole, which gives that string the token's id. Where the file's ids rise with
    the order of its merges, ``tiktoken`` merges the words by the same ranks, some ten times as fast; the ids are the
    same.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranks = self._ranked()
        self.words = Words(self.word)

    def _ranked(self):
        import tiktoken

        state = json.loads(self.tokenizer.to_str())
        split = state["pre_tokenizer"] or {}
        merges = [m if isinstance(m, str) else " ".join(m) for m in state["model"].get("merges", [])]
        vocab, letters = state["model"].get("vocab", {}), _byte_letters()
        order = [vocab.get(m.replace(" ", "", 1)) for m in merges]
        known = {split.get("type"), *(p.get("type") for p in split.get("pretokenizers", []))} == {"ByteLevel"}
        if not known or split.get("add_prefix_space") or not split.get("use_regex", True) or state["normalizer"] or (
            not order or None in order or any(a >= b for a, b in zip(order, order[1:]))
        ):
            return None
        special = {t["content"] for t in state["added_tokens"]}
        ranks = {bytes(letters[c] for c in word): i for word, i in vocab.items() if word not in special}
        return tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _whole(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, dtype="<u4").tobytes()

    def word(self, text: str) -> bytes:
        return np.array(self.ranks.encode_ordinary(text), dtype="<u4").tobytes() if self.ranks else self._whole(text)

    def encode(self, text: str) -> bytes:
        """The ids of ``text``, packed as little-endian unsigned 32-bit numbers."""
        if (not _plain(text) and _UNEVEN.search(text)) or any(token in text for token in self.added):
            return self._whole(text)
        first, *words = text.replace("\n", " \n").split(" ")
        return (self.word(first) if first else b"") + b"".join(map(self.words.__getitem__, words))


class Words(dict):
    """The packed ids of words by their text, without the space before them. A word that begins a line has its break."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        ids = self[word] = self.encode(word if word[:1] == "\n" else " " + word)
        return ids


def encoder(path: str) -> WordCachedEncoder:
    cache = process_cache("encoders")
    if path not in cache:
        cache[path] = WordCachedEncoder(path)
    return cache[path]


def divide(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: the numbers of the items in each of ``windows`` nearly equal parts."""
    if windows == 1:
        return [list(range(len(sizes)))]
    # A partial partition has its sums in falling order; ``parts`` names the node of the merge tree behind each sum.
    children: list[tuple[int, int]] = []
    heap = []
    for item, size in enumerate(sizes):
        sums, parts = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
        sums[0], parts[0] = size, item
        heap.append((-size, item, sums, parts))
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, sums, parts = heapq.heappop(heap)
        _, _, others, their = heapq.heappop(heap)
        others, their = others[::-1], their[::-1]
        merged = sums + others
        nodes = np.where(parts < 0, their, parts)
        for at in np.flatnonzero((parts >= 0) & (their >= 0)):
            nodes[at] = len(sizes) + len(children)
            children.append((int(parts[at]), int(their[at])))
        order = np.argsort(-merged, kind="stable")
        merged, nodes = merged[order], nodes[order]
        heapq.heappush(heap, (int(merged[-1] - merged[0]), count, merged, nodes))
        count += 1
    result = []
    for node in heap[0][3]:
        stack, items = [int(node)] if node >= 0 else [], []
        while stack:
            top = stack.pop()
            if top < len(sizes):
                items.append(top)
            else:
                stack.extend(children[top - len(sizes)])
        result.append(sorted(items))
    return result


def windows_for(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items divided into as few windows as differencing fits; the count rises while one exceeds the capacity."""
    count = max(1, -(-sum(sizes) // capacity))
    while True:
        parts = divide(sizes, count)
        if max(sum(sizes[i] for i in part) for part in parts) <= capacity:
            return [part for part in parts if part]
        count += 1 + count // 200


SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class Packer:
    """Packs the documents of one task. ``capacity`` tokens a window, ``piece`` tokens a piece of a rest at most,
    ``block`` pieces are divided at a time."""

    def __init__(self, task: int, capacity: int, piece: int, block: int, with_ids: bool):
        self.capacity, self.piece, self.block, self.with_ids = capacity, piece, block, with_ids
        self.next = task << 33
        self.waiting: list[tuple] = []
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, at = len(ids) // 4, 0
        while at < total:
            length = min(self.capacity if total - at >= self.capacity else self.piece, total - at)
            own = ids[4 * at:4 * (at + length)]
            row = (doc_id, at, length, zlib.crc32(own), total, own if self.with_ids else None)
            if length == self.capacity:
                self._put(row, 0)
                self.next += 1
            else:
                self.waiting.append(row)
            at += length
        if len(self.waiting) >= self.block:
            self.close()

    def _put(self, row: tuple, offset: int) -> None:
        self.rows.append((*row[:5], self.next, offset, row[5]))

    def close(self) -> None:
        """Divide the pieces that wait."""
        if self.waiting:
            for part in windows_for([row[2] for row in self.waiting], self.capacity):
                offset = 0
                for item in part:
                    self._put(self.waiting[item], offset)
                    offset += self.waiting[item][2]
                self.next += 1
            self.waiting = []

    def batch(self) -> pa.RecordBatch:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        columns = list(zip(*self.rows)) or [[]] * 8
        arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
        if self.with_ids:
            names.append("ids")
            arrays.append(pa.array(columns[7], pa.binary()))
        self.rows = []
        return pa.RecordBatch.from_arrays(arrays, names=names)


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, piece: int = 256, block: int = 768, end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of the documents (doc_id, text) with their place in a window: columns as in ``SCHEMA``.

    Each id of a document (its text's ids, then ``end_id``) lies in exactly one piece. With ``with_ids``, the column
    ``ids`` has a piece's ids as little-endian unsigned 32-bit numbers. A null or empty text is its end id alone; a
    null doc_id stays null; texts are encoded whole, and a long one fills windows by itself; repeated rows are packed once each; an empty table gives no rows; other columns are not
    read. Windows are numbered by task and count within it.
    """
    end = int(end_id).to_bytes(4, "little")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        packer = Packer(context.partitionId() if context else 0, capacity, piece, block, with_ids)
        words = encoder(tokenizer)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc_id, words.encode(text.as_py() or "") + end)
                if len(packer.rows) >= 20_000:
                    yield packer.batch()
        packer.close()
        yield packer.batch()

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return columns.mapInArrow(task, SCHEMA + (", ids binary" if with_ids else ""))
