"""Lines that several documents share are kept in one of them only.

Texts are cut into lines once. Every task sorts its lines' 128-bit hashes by hash and document, largest first, and
streams the first few documents of each hash on; a line that a third of all documents hold thus leaves a task as a few
rows. Met again, sorted the same way, the first document of a hash is its holder, and whether there is a last of those
few tells whether enough documents share it. What comes back to the documents is no text but the runs of lines to keep:
a run-length compressed bitmap per document that loses lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vanewright.llm.common import unused
from vanewright.session import written

#: The white space stripped from a line's ends, and the letters that are lower-cased.
LINE_SPACE = "\t\n\x0b\x0c\r "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def bare_line(line: Column) -> Column:
    """A line without white space at its ends. Few lines have any, and looking is much cheaper than cutting."""
    ends = F.lit(False)
    for space in LINE_SPACE:
        ends = ends | F.startswith(line, F.lit(space)) | F.endswith(line, F.lit(space))
    return F.when(ends, F.btrim(line, F.lit(LINE_SPACE))).otherwise(line)


def line_key(bare: Column) -> Column:
    """What makes bare lines equal: A-Z in lower case. ``lower`` does that, and is much faster than ``translate``, where
    no other letter has a lower case to take."""
    pure = (F.length(bare) == F.octet_length(bare)) | ~F.rlike(bare, F.lit(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"))
    return F.when(pure, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def line_occurrences(docs: DataFrame, min_chars: int = 20) -> DataFrame:
    """(doc_id, text_hash, n_lines, position, hash) of every line long enough to count, of documents (doc_id, text).

    Written to shared storage: texts are cut into lines once, and what follows reads only hashes. ``text_hash`` tells
    rows of one doc_id with different texts apart.
    """
    text = F.coalesce("text", F.lit(""))
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    # Selected before the explosion: beside it, they would be worked out once a line.
    whole = docs.where(F.col("doc_id").isNotNull()).select(
        "doc_id", F.unhex(F.md5("text")).alias("text_hash"), n_lines.alias("n_lines"), "text"
    )
    lines = whole.select(
        "doc_id", "text_hash", "n_lines", F.posexplode(lines_of(F.col("text"))).alias("position", "line")
    )
    bare = bare_line(F.col("line"))
    hashed = lines.where(F.length(bare) >= min_chars).withColumn("hash", F.unhex(F.md5(line_key(bare))))
    return written(hashed.drop("line"), "lines")


def shared_lines(occurrences: DataFrame, min_docs: int = 3) -> DataFrame:
    """(hash, holder) of every line found in at least ``min_docs`` documents; ``holder`` is the largest doc_id with
    it. Rows of one doc_id are one document."""
    # A bound on the rank becomes a group limit on both sides of the shuffle: only ``min_docs`` documents of a hash
    # leave a task, however common the line is, and the aggregation finds its rows where the rank left them.
    largest_first = Window.partitionBy("hash").orderBy(F.col("doc_id").desc())
    first = occurrences.select("hash", "doc_id", F.dense_rank().over(largest_first).alias("place"))
    found = (
        first.where(F.col("place") <= min_docs)
        .groupBy("hash").agg(F.max("place").alias("n_docs"), F.max("doc_id").alias("holder"))
    )
    return written(found.where(F.col("n_docs") >= min_docs).select("hash", "holder"), "shared-lines")


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, text_hash, n_lines, n_dropped, kept_runs) of the documents that lose lines.

    ``kept_runs`` lists the runs of lines to keep as (first, length), in order. A document keeps all lines of which it
    is the holder.
    """
    lines = line_occurrences(docs, min_chars)
    lost = lines.join(shared_lines(lines, min_docs), "hash").where(F.col("doc_id") != F.col("holder"))
    dropped = lost.groupBy("doc_id", "text_hash", "n_lines").agg(
        F.sort_array(F.collect_set("position")).alias("dropped")
    )
    borders = F.concat(F.array(F.lit(-1)), F.col("dropped"), F.array(F.col("n_lines")))
    gaps = F.transform(
        F.sequence(F.lit(1), F.size("borders") - 1),
        lambda i: F.struct(
            (F.get("borders", i - 1) + 1).alias("first"),
            (F.get("borders", i) - F.get("borders", i - 1) - 1).alias("length"),
        ),
    )
    return dropped.select(
        "doc_id", "text_hash", "n_lines", F.size("dropped").alias("n_dropped"), borders.alias("borders")
    ).select("doc_id", "text_hash", "n_lines", "n_dropped", F.filter(gaps, lambda run: run.length > 0).alias("kept_runs"))


def without_shared_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with the lines that other documents keep taken out of ``text``; n_lines and n_dropped are added.

    All other columns stay, whatever their names; new columns that clash get a trailing underscore. A null text without
    shared lines stays null. Rows without doc_id keep all lines. Repeated rows lose the same lines. A document that
    loses all its lines has an empty text. Empty tables give empty tables.
    """
    n_lines, n_dropped = unused(docs, "n_lines"), unused(docs, "n_dropped")
    bitmaps = keep_bitmaps(docs.select("doc_id", "text"), min_chars, min_docs).select(
        F.struct("doc_id", "text_hash").alias("_of"), F.struct("n_dropped", "kept_runs").alias("_bitmap")
    )
    own, at, bitmap = unused(docs, "own"), unused(docs, "at"), unused(docs, "bitmap")
    bitmaps = bitmaps.select(
        F.col("_of.doc_id").alias(own), F.col("_of.text_hash").alias(at), F.col("_bitmap").alias(bitmap)
    )
    keyed = docs.join(
        bitmaps, (docs["doc_id"] == bitmaps[own]) & (F.unhex(F.md5(docs["text"])) == bitmaps[at]), "left"
    )
    lines, whole = lines_of(F.col("text")), F.coalesce("text", F.lit(""))
    kept = F.flatten(F.transform(F.col(f"{bitmap}.kept_runs"), lambda run: F.slice(lines, run.first + 1, run.length)))
    text = F.when(F.col(bitmap).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return keyed.select(
        *[(text if c == "text" else F.col(c)).alias(c) for c in docs.columns],
        (F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("long").alias(n_lines),
        F.coalesce(F.col(f"{bitmap}.n_dropped"), F.lit(0)).cast("long").alias(n_dropped),
    )
