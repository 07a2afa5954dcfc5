"""Quality by compression.

Two zstandard dictionaries are built from good and from bad labelled text. A text is compressed with both, in chunks so
that the dictionaries count throughout; the difference of the sizes, divided by their sum, and how far each shrinks
the text become a calibrated score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.common import bounded_batches, by_value, label_sample, process_cache, unused
from vanewright.llm.toxicity import fit_logistic, logistic
from vanewright.session import written

by_value(__name__)

#: A fit reads so many labelled documents, and so many chunks of each label for the dictionaries: the sample's bounds.
FIT_ROWS, FIT_CHUNKS = 12_000, 3000
#: Characters of a chunk, bytes of a dictionary, level of compression.
CHUNK, DICTIONARY, LEVEL = 2048, 65_536, 3


def chunks(text: str) -> list[bytes]:
    return [text[at:at + CHUNK].encode("utf-8", "surrogatepass") for at in range(0, len(text), CHUNK)]


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    calibration: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0, 0.0)
    key: str = field(default_factory=lambda: uuid4().hex)

    def compressors(self):
        import zstandard

        cache = process_cache(f"quality-{self.key}")
        if not cache:
            for name, content in (("good", self.good), ("bad", self.bad)):
                # Sizes only: frames without checksum, size or dictionary id add the same few bytes to both.
                given = zstandard.ZstdCompressionDict(content) if content else None
                cache[name] = zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=given, write_checksum=False, write_content_size=False, write_dict_id=False
                )
        return cache["good"], cache["bad"]

    def measures(self, text: str) -> tuple[float, float, float, float]:
        """(difference, shrinkage, worst chunk's difference, shrinkage of the chunk that shrinks most)."""
        good, bad = self.compressors()
        parts = chunks(text)
        if not parts:
            return 0.0, 0.0, 0.0, 0.0
        sizes = np.array([(len(p), len(good.compress(p)), len(bad.compress(p))) for p in parts], np.float64)
        by_chunk = (sizes[:, 2] - sizes[:, 1]) / (sizes[:, 1] + sizes[:, 2])
        shrunk = np.log((sizes[:, 1] + 8) / (sizes[:, 0] + 8))
        whole = sizes.sum(axis=0)
        return (
            float((whole[2] - whole[1]) / (whole[1] + whole[2])), float(np.log((whole[1] + 8) / (whole[0] + 8))),
            float(by_chunk.min()), float(shrunk.min()),
        )

    def scores(self, measures: np.ndarray) -> np.ndarray:
        return logistic(measures, np.array(self.calibration))


def _dictionary(samples: list[bytes]) -> bytes:
    import zstandard

    if sum(map(len, samples)) < 4096 or len(samples) < 8:
        return b"".join(samples)[-DICTIONARY:]  # too little to train on: the text itself, as raw content
    try:
        return zstandard.train_dictionary(min(DICTIONARY, sum(map(len, samples)) // 4), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, most: int = FIT_CHUNKS) -> QualityModel:
    """Learn from documents (doc_id, text) and labels (doc_id, quality) outside the held-out part.

    At most ``rows`` labelled documents are read. Half of them give the dictionaries, at most ``most`` chunks of each
    label by the hash of the chunk; the other half calibrates. Without labels of both kinds the score is constant.
    """
    bounded_batches(docs.sparkSession)
    sample = written(label_sample(docs, labels, "quality", rows), "quality-sample")
    part = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(2))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"chunk": pd.Series([c for t in frame["text"] for c in chunks(t or "")], dtype=object)})

    trained = []
    for label in (1, 0):
        found = (
            sample.where((part == 0) & (F.col("label") == label)).select("text").mapInPandas(cut, "chunk binary")
            .orderBy(F.xxhash64("chunk"), "chunk").limit(most).collect()
        )
        trained.append(_dictionary([bytes(r["chunk"]) for r in found]))
    model = QualityModel(*trained)
    points = with_quality(sample.where(part == 1), model).select("quality.*", "label").toPandas()
    labels_seen = points["label"].to_numpy(np.float64)
    if len(set(labels_seen)) == 2:
        features = points[["difference", "shrinkage", "worst", "tightest"]].to_numpy()
        model.calibration = tuple(fit_logistic(features, labels_seen, 0.01).tolist())
    else:
        share = labels_seen.mean() if len(labels_seen) else 0.5
        model.calibration = (float(np.log((share + 1e-3) / (1 - share + 1e-3))), 0.0, 0.0, 0.0, 0.0)
    return model


def with_quality(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """``docs`` with one more column, a struct (difference, shrinkage, worst, tightest, score) named ``quality``.

    A null text counts as empty, for which all measures are 0. Whole texts are compressed, however long. Repeated
    rows repeat, an empty table gives no rows. Equal texts get equal results; other columns stay as they are, and a clashing name gets a trailing underscore.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("difference double, shrinkage double, worst double, tightest double, score double")
    def judged(column: pd.Series) -> pd.DataFrame:
        table = np.array([model.measures(t or "") for t in column], np.float64).reshape(-1, 4)
        out = pd.DataFrame(table, columns=["difference", "shrinkage", "worst", "tightest"])
        return out.assign(score=model.scores(table))

    return docs.withColumn(unused(docs, "quality"), judged(F.col(text)))
