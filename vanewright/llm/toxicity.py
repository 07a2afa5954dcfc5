"""Toxicity by a weighted lexicon.

Texts are folded first: letters that look like Latin ones become those, digits and signs that stand for letters too.
A learned lexicon of word beginnings, each with its log-odds, is matched by Aho-Corasick; matches inside an exception
phrase do not count. The summed weight and the weight per word go into a calibrated score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.common import bounded_batches, by_value, label_sample, objects, process_cache, unused
from vanewright.session import written

by_value(__name__)

#: The lexicon and the calibration are fitted on so many labelled documents: the sample's bound.
FIT_ROWS = 12_000
#: The lexicon holds so many entries at most, each found in five toxic documents and this share of them at least,
#: with such log-odds.
LEXICON, LEAST_DOCS, LEAST_SHARE, LEAST_WEIGHT = 2000, 5, 0.01, 2.0
_SHORTEST, _LONGEST = 4, 10

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = dict(zip(
    "абвгеёзийкмнорстухьѕіјԁԛԝһҽɡɑαβγεηικνορτυχωℓ",
    "abbreeзuukмhopctyxbsijdqwhegaabyenikvoptuxwl",
))
#: Digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "€": "e", "|": " "}
#: Phrases in which a word of the lexicon means no harm.
EXCEPTIONS = ("clown fish", "trash can", "trash bin", "class clown", "circus clown", "pond scum")


def _folding() -> np.ndarray:
    table = np.full(1 << 16, 32, np.uint32)
    for code in range(1 << 16):
        wide = code - 0xFEE0 if 0xFF01 <= code <= 0xFF5E else code  # full-width forms
        letter = chr(wide).lower() if len(chr(wide).lower()) == 1 else chr(wide)
        letter = HOMOGLYPHS.get(letter, SUBSTITUTES.get(letter, letter))
        table[code] = ord(letter) if letter.isalpha() else 32
    return table


def folded(text: str) -> str:
    """A text in folded lower-case letters, between single-space borders; whatever is no letter is a space."""
    cache = process_cache("folding")
    if "table" not in cache:
        cache["table"] = _folding()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    flat = cache["table"][np.minimum(codes, 0xFFFF)].astype("<u4").tobytes().decode("utf-32-le")
    return f" {flat} "


def beginnings(text: str) -> set[str]:
    """The words of a folded text and their beginnings."""
    words = set(text.split())
    found = {w for w in words if len(w) <= _LONGEST}
    for length in range(_SHORTEST, _LONGEST + 1):
        found.update(w[:length] for w in words if len(w) > length)
    return found


@dataclass
class ToxicityModel:
    """Word beginnings with weights, exception phrases, and the calibration of the two sums."""

    lexicon: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    calibration: tuple[float, ...] = (-4.0, 1.0, 0.0)
    key: str = field(default_factory=lambda: uuid4().hex)

    def automaton(self):
        import ahocorasick

        cache = process_cache(f"toxicity-{self.key}")
        if "automaton" not in cache:
            machine = ahocorasick.Automaton()
            for word, weight in self.lexicon.items():
                machine.add_word(" " + word, (len(word) + 1, weight))
            for phrase in self.exceptions:
                machine.add_word(f" {phrase} ", (len(phrase) + 2, None))
            machine.make_automaton()
            cache["automaton"] = machine
        return cache["automaton"]

    def matches(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) in the folded text, one per word, none inside an exception phrase."""
        if not self.lexicon:
            return []
        found: dict[int, tuple[int, float]] = {}
        safe: list[tuple[int, int]] = []
        for end, (length, weight) in self.automaton().iter(text):
            start = end - length + 1
            if weight is None:
                safe.append((start, end))
            elif start not in found or found[start][1] < weight:
                found[start] = (end, weight)
        return [(s, e, w) for s, (e, w) in found.items() if not any(a <= s and e <= b for a, b in safe)]

    def measures(self, flat: str) -> tuple[float, float, list[str]]:
        """Of a folded text: the summed weight, that weight per 100 words, and the matched words, each counted once."""
        words: dict[str, float] = {}
        for start, end, weight in self.matches(flat):
            words[flat[start + 1:flat.index(" ", end)]] = weight
        total = sum(words.values())
        return total, 100.0 * total / max(1, len(flat.split())) if total else 0.0, list(words)

    def scores(self, measures: np.ndarray) -> np.ndarray:
        return logistic(np.log1p(measures), np.array(self.calibration))


def logistic(features: np.ndarray, coefficients: np.ndarray) -> np.ndarray:
    if not len(features):
        return np.zeros(0)
    z = coefficients[0] + features @ coefficients[1:]
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method with a small ridge; constant labels give a constant score near them."""
    x = np.column_stack([np.ones(len(features)), features])
    at = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ at, -30, 30)))
        gradient = x.T @ (p - labels) + ridge * np.r_[0.01, np.ones(x.shape[1] - 1)] * at
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.diag(np.r_[0.01, np.ones(x.shape[1] - 1)])
        step = np.linalg.solve(curve, gradient)
        at -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return at


def chosen_lexicon(rows: Iterable[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Entries with the strongest evidence first; one word beginning stands for all that it begins or is begun by."""
    scored = []
    for word, t, c in rows:
        weight = float(np.log((t + 0.5) / (toxic + 1)) - np.log((c + 1.0) / (clean + 1)))
        if t >= max(LEAST_DOCS, LEAST_SHARE * toxic) and weight >= LEAST_WEIGHT:
            scored.append((-t * weight, -len(word), word, weight))
    lexicon: dict[str, float] = {}
    begun: set[str] = set()
    for _, _, word, weight in sorted(scored):
        if word in begun or any(word[:n] in lexicon for n in range(1, len(word))):
            continue
        lexicon[word] = weight
        begun.update(word[:n] for n in range(1, len(word)))
        if len(lexicon) == LEXICON:
            break
    return lexicon


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> ToxicityModel:
    """Learn from documents (doc_id, text) and labels (doc_id, toxic) outside the held-out part.

    At most ``rows`` labelled documents are read. Two thirds give the lexicon: Spark counts the word beginnings of
    toxic ones, then those that are frequent there in clean ones. The rest calibrates the score. Without labels of
    both kinds the lexicon is empty and the score a constant.
    """
    bounded_batches(docs.sparkSession)
    sample = written(label_sample(docs, labels, "toxic", rows), "toxicity-sample")
    part = F.pmod(F.xxhash64("text", F.lit(3)), F.lit(3))
    lexical, rest = sample.where(part > 0), sample.where(part == 0)

    def counter(label: int, only: set[str] | None):
        def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            counts: Counter = Counter()
            for frame in frames:
                for text in frame["text"]:
                    found = beginnings(folded(text or ""))
                    counts.update(found if only is None else found & only)
            yield pd.DataFrame({"word": objects(counts), "n": np.array(list(counts.values()), np.int64)})

        rows = lexical.where(F.col("label") == label).select("text").mapInPandas(task, "word string, n long")
        return rows.groupBy("word").agg(F.sum("n").alias("n"))

    sizes = {r["label"]: r["n"] for r in lexical.groupBy("label").agg(F.count("*").alias("n")).collect()}
    frequent = (
        counter(1, None).where(F.col("n") >= LEAST_DOCS).orderBy(F.desc("n"), "word").limit(20 * LEXICON).collect()
    )
    toxic = {r["word"]: r["n"] for r in frequent}
    clean = {r["word"]: r["n"] for r in counter(0, set(toxic)).collect()} if toxic else {}
    model = ToxicityModel(chosen_lexicon(
        ((w, n, clean.get(w, 0)) for w, n in toxic.items()), sizes.get(1, 0), sizes.get(0, 0)
    ))
    measured = with_measures(rest.select("text", "label"), model)
    points = measured.select("measures.total", "measures.rate", "label").toPandas()
    if points["label"].nunique() == 2:
        model.calibration = tuple(fit_logistic(np.log1p(points[["total", "rate"]].to_numpy()), points["label"].to_numpy()))
    else:
        share = sizes.get(1, 0) / max(1, sum(sizes.values()))
        model.calibration = (float(np.log((share + 1e-3) / (1 - share + 1e-3))), 0.0, 0.0)
    return model


def with_measures(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with one more column, a struct (total, rate, score, matched) named ``measures``.

    ``matched`` lists the matched words in folded form. A null text counts as empty: nothing is matched and
    the score is the one of an empty text. Whole texts are matched, however long. Repeated rows repeat, an empty table gives
    no rows. Equal texts get equal results; other columns stay as they are, and a
    clashing name gets a trailing underscore.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("total double, rate double, score double, matched array<string>")
    def measured(column: pd.Series) -> pd.DataFrame:
        found = [model.measures(folded(value or "")) for value in column]
        table = np.array([f[:2] for f in found], np.float64).reshape(-1, 2)
        return pd.DataFrame({
            "total": table[:, 0], "rate": table[:, 1], "score": model.scores(table), "matched": objects(f[2] for f in found),
        })

    return docs.withColumn(unused(docs, "measures"), measured(F.col(text)))
