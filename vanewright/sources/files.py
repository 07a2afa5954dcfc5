"""Names, claims and small texts in shared storage, through the file system that Spark itself uses for a path."""

from __future__ import annotations

import os
from collections.abc import Iterable
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; none if there is no such folder."""
    place, system = _located(spark, folder)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """The numbers behind ``prefix`` in a folder's names, sorted."""
    return sorted(int(n[len(prefix):]) for n in names(spark, folder) if n.startswith(prefix) and n[len(prefix):].isdigit())


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already. Of several callers one alone gets True."""
    place, system = _located(spark, path)
    system.mkdirs(place.getParent())
    if system.getScheme() == "file":  # the local file system of Hadoop looks first and creates then
        try:
            os.close(os.open(unquote(urlparse(place.toUri().toString()).path), os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return False
        return True
    try:
        system.create(place, False).close()
    except Exception as e:  # whatever the file system throws: what counts is whether the file was there
        if system.exists(place):
            return False
        raise e
    return True


def claim_next(spark: SparkSession, folder: str, prefix: str, after: int = -1) -> int:
    """Claim the next free number above ``after`` and all claimed before."""
    number = 1 + max([after, *numbers(spark, folder, prefix)])
    while not claim(spark, f"{folder}/{prefix}{number}"):
        number += 1
    return number


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text: whole or not at all, by writing beside it and renaming."""
    place, system = _located(spark, path)
    beside, _ = _located(spark, f"{path.rsplit('/', 1)[0]}/_{place.getName()}.part")
    out = system.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not system.rename(beside, place) and not system.exists(place):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text as a whole; None if there is none."""
    place, system = _located(spark, path)
    if not system.exists(place):
        return None
    source = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove files and folders that are there."""
    for path in paths:
        place, system = _located(spark, path)
        system.delete(place, True)
