"""Language of whole texts and of their spans.

Every word is scored in each language it can belong to: the script of its first letter narrows the candidates, then a
word the model knows counts by its own frequency and any other by its letter triples. Viterbi over the words, with a
penalty for each switch, labels the spans of mixed text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vanewright.llm.common import bounded_batches, by_value, held_out, objects, process_cache, unused
from vanewright.session import written

by_value(__name__)

#: What a switch of language costs, in nats.
SWITCH = 12.0
#: A model is fitted on so many labelled documents, and keeps so many words a language.
FIT_ROWS, FIT_WORDS = 12_000, 20_000
UNKNOWN = "und"
_TRIPLES = 1 << 15
_BARRED = -20.0
_CACHE_WORDS = 300_000
#: Characters of texts that are scored at a time.
_AT_A_TIME = 1_000_000

#: The first code points of Unicode's script blocks, and which script begins there.
SCRIPT_STARTS = {
    0x0000: "latin", 0x0370: "greek", 0x0400: "cyrillic", 0x0530: "armenian", 0x0590: "hebrew", 0x0600: "arabic",
    0x0900: "devanagari", 0x0980: "bengali", 0x0A00: "gurmukhi", 0x0A80: "gujarati", 0x0B00: "other",
    0x0B80: "tamil", 0x0C00: "telugu", 0x0C80: "kannada", 0x0D00: "malayalam", 0x0D80: "sinhala", 0x0E00: "thai",
    0x0E80: "lao", 0x0F00: "tibetan", 0x1000: "burmese", 0x10A0: "georgian", 0x1100: "hangul", 0x1200: "ethiopic",
    0x13A0: "other", 0x1780: "khmer", 0x1800: "mongolian", 0x18B0: "other", 0x1E00: "latin", 0x1F00: "greek",
    0x2000: "other", 0x2C60: "latin", 0x2C80: "other", 0x3040: "kana", 0x3100: "other", 0x3400: "han",
    0xA000: "other", 0xAC00: "hangul", 0xD7B0: "other", 0xF900: "han", 0xFB00: "latin", 0xFB13: "armenian",
    0xFB1D: "hebrew", 0xFB50: "arabic", 0xFE00: "other", 0xFE70: "arabic", 0xFF00: "latin", 0xFF66: "kana",
    0xFFA0: "hangul", 0x10000: "other", 0x20000: "han", 0x30000: "han",
}
SCRIPTS = sorted(set(SCRIPT_STARTS.values()))


def _letters_table() -> np.ndarray:
    """For each code point of the basic plane the lower-case letter, or a space for what is no letter."""
    table = np.full(1 << 16, ord(" "), np.uint32)
    for code in range(1 << 16):
        letter = chr(code)
        if letter.isalpha() or 0x300 <= code < 0x370:
            lower = letter.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def words_of(text: str) -> list[str]:
    """The words of a text: runs of letters, lower-cased."""
    cache = process_cache("letters")
    if "table" not in cache:
        cache["table"] = _letters_table()
        cache["table"].setflags(write=False)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letters = cache["table"][np.minimum(codes, (1 << 16) - 1)]
    beyond = np.flatnonzero(codes >= 1 << 16)
    for code in np.unique(codes[beyond]).tolist():
        letter = chr(code)
        letters[beyond[codes[beyond] == code]] = ord(letter.lower()) if letter.isalpha() else ord(" ")
    return letters.astype("<u4").tobytes().decode("utf-32-le").split()


@dataclass
class LanguageModel:
    """Word and letter-triple scores by language, and the scripts each language is written in."""

    languages: list[str]
    words: dict[str, np.ndarray]
    triples: np.ndarray
    by_script: np.ndarray
    switch: float = SWITCH
    key: str = field(default_factory=lambda: uuid4().hex)

    def _triple_scores(self, words: list[str]) -> np.ndarray:
        """Sums of triple scores by word, each word between spaces."""
        codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        mixed = (codes[:-2] * np.uint64(1_000_003) + codes[1:-1]) * np.uint64(1_000_003) + codes[2:]
        at = (mixed ^ mixed >> np.uint64(15)) % np.uint64(_TRIPLES)
        values = self.triples[at.astype(np.int64)]
        values[codes[1:-1] == 32] = 0.0  # a space in the middle belongs to no word
        lengths = np.array([len(w) for w in words])
        starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        return np.add.reduceat(values, starts, axis=0)

    def score(self, words: list[str]) -> np.ndarray:
        """A row of scores per word."""
        if not words:
            return np.zeros((0, len(self.languages)))
        scores = self._triple_scores(words)
        known = [i for i, w in enumerate(words) if w in self.words]
        if known:
            scores[known] = np.stack([self.words[words[i]] for i in known])
        starts = np.array(sorted(SCRIPT_STARTS))
        scripts = np.array([SCRIPTS.index(SCRIPT_STARTS[s]) for s in starts.tolist()])
        first = np.array([ord(w[0]) for w in words])
        allowed = self.by_script[scripts[np.searchsorted(starts, first, "right") - 1]]
        none = ~allowed.any(axis=1)
        scores = scores - scores.max(axis=1, keepdims=True)
        scores = np.where(allowed, np.maximum(scores, _BARRED), _BARRED)
        scores[none] = 0.0
        return scores


def triple_slots(word: str) -> list[int]:
    """The places in the table of a word's letter triples."""
    codes = [32, *map(ord, word), 32]
    out = []
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        mixed = ((a * 1_000_003 + b) * 1_000_003 + c) & (1 << 64) - 1
        out.append((mixed ^ mixed >> 15) % _TRIPLES)
    return out


def fit_languages(docs: DataFrame, rows: int = FIT_ROWS, words: int = FIT_WORDS, switch: float = SWITCH) -> LanguageModel:
    """Learn from documents (doc_id, text, lang) with a language, outside the held-out part.

    At most ``rows`` of them, those with the smallest hash of the id: the sample's bound. Words are counted by Spark;
    the driver gets the ``words`` most frequent of each language, and one row per language and letter triple.
    """
    chosen = (
        docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    sample = docs.where(F.col("lang").isNotNull()).join(F.broadcast(chosen.distinct()), "doc_id").select("lang", "text")

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"]):
                for word, n in Counter(words_of(text or "")).items():
                    counts[lang, word] += n
        keys = list(counts)
        yield pd.DataFrame({"lang": objects(k[0] for k in keys), "word": objects(k[1] for k in keys),
                            "n": np.array(list(counts.values()), np.int64)})

    bounded_batches(docs.sparkSession)
    counts = sample.mapInPandas(counted, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n")
    )
    counts = written(counts, "language-words")
    slots = F.pandas_udf(lambda column: pd.Series([triple_slots(w) for w in column]), "array<int>")
    triples = counts.select("lang", "n", F.explode(slots("word")).alias("slot")).groupBy("lang", "slot").agg(
        F.sum("n").alias("n")
    ).collect()
    starts = sorted(SCRIPT_STARTS)
    first = F.ascii("word")
    script = F.lit(SCRIPTS.index("other"))
    for start in starts:
        script = F.when(first >= start, F.lit(SCRIPTS.index(SCRIPT_STARTS[start]))).otherwise(script)
    scripts = counts.groupBy("lang", script.alias("script")).agg(F.sum("n").alias("n")).collect()
    frequent = counts.withColumn(
        "place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    ).where((F.col("place") <= words) & (F.col("n") >= 3)).select("word").distinct()
    top = counts.join(frequent, "word").select("lang", "word", "n").collect()

    languages = sorted({r["lang"] for r in scripts})
    place = {lang: i for i, lang in enumerate(languages)}
    table = np.full((_TRIPLES, len(languages)), 0.5)
    for r in triples:
        table[r["slot"], place[r["lang"]]] += r["n"]
    log_triples = np.log(table / table.sum(axis=0)) if languages else table
    log_triples = log_triples - log_triples.max(axis=1, keepdims=True) if languages else table
    by_script = np.zeros((len(SCRIPTS), len(languages)))
    for r in scripts:
        by_script[r["script"], place[r["lang"]]] += r["n"]
    totals = np.maximum(by_script.sum(axis=0), 1.0)
    seen: dict[str, np.ndarray] = {}
    for r in top:
        seen.setdefault(r["word"], np.full(len(languages), 0.5))[place[r["lang"]]] += r["n"]
    logs = {w: np.log(n / totals) for w, n in seen.items()}
    return LanguageModel(languages, logs, log_triples, by_script >= 0.01 * totals, switch)


def viterbi(scores: np.ndarray, switch: float) -> np.ndarray:
    """The best state of each row when every change of state costs ``switch``; ties go to staying, then to the first."""
    rows, states = scores.shape
    best = scores[0].tolist()
    came: list[list[int]] = []
    for row in scores[1:].tolist():
        top = max(range(states), key=best.__getitem__)
        limit = best[top] - switch
        back = [s if best[s] >= limit else top for s in range(states)]
        best = [max(b, limit) + r for b, r in zip(best, row)]
        came.append(back)
    state = max(range(states), key=best.__getitem__)
    path = np.empty(rows, np.int64)
    path[rows - 1] = state
    for at in range(rows - 2, -1, -1):
        state = came[at][state]
        path[at] = state
    return path


def _unmixed(scores: np.ndarray, starts: np.ndarray, best: np.ndarray, counts: np.ndarray, switch: float) -> np.ndarray:
    """Texts for which no run of words gains more than one switch by another language: one language is the best path."""
    safe = np.ones(len(starts), bool)
    owner = np.repeat(np.arange(len(starts)), counts)
    main = scores[np.arange(len(scores)), best[owner]]
    for state in range(scores.shape[1]):
        gain = scores[:, state] - main
        total = np.cumsum(gain)
        before = total - gain
        low = before - owner * (np.abs(gain).sum() + 1.0)  # each text's sums lie below those of all before it
        low = np.minimum.accumulate(low) + owner * (np.abs(gain).sum() + 1.0)
        safe &= np.maximum.reduceat(total - low, starts) < switch - 1e-6
    return safe


def _odds(margin):
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -30.0, 30.0)))


def label_texts(texts: list[str], model: LanguageModel) -> list[tuple[str, float, list[tuple[str, int, int]], float]]:
    """(language, score, spans, sure) of each text; a span is (language, first word, words). ``sure`` is the share of
    letters in surely labelled spans: each span counts by the odds of its language over the others within it."""
    if not model.languages:
        return [(UNKNOWN, 0.0, [], 0.0)] * len(texts)
    cache = process_cache(f"languages-{model.key}")
    if not cache or len(cache["at"]) > _CACHE_WORDS:
        cache.update(at={}, scores=np.empty((0, len(model.languages)), np.float32))
    at: dict[str, int] = cache["at"]
    split = [words_of(t) for t in texts]
    flat = [w for words in split for w in words]
    new = list(dict.fromkeys(w for w in flat if w not in at))
    if new:
        at.update(zip(new, range(len(at), len(at) + len(new))))
        cache["scores"] = np.concatenate([cache["scores"], model.score(new).astype(np.float32)])
    result: list = [(UNKNOWN, 0.0, [], 0.0)] * len(texts)
    worded = [i for i, words in enumerate(split) if words]
    if not worded:
        return result
    scores = cache["scores"][np.fromiter(map(at.__getitem__, flat), np.int64, len(flat))].astype(np.float64)
    letters = np.fromiter(map(len, flat), np.int64, len(flat))
    counts = np.array([len(split[i]) for i in worded])
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    totals = np.add.reduceat(scores, starts, axis=0)
    best = totals.argmax(axis=1)
    plain = _unmixed(scores, starts, best, counts, model.switch)
    for k, i in enumerate(worded):
        rows = slice(starts[k], starts[k] + counts[k])
        if plain[k]:
            main, share, spans, known = int(best[k]), 1.0, [(model.languages[best[k]], 0, int(counts[k]))], None
        else:
            path = viterbi(scores[rows], model.switch)
            weight = np.bincount(path, weights=letters[rows], minlength=len(model.languages))
            main = int(weight.argmax())
            share = float(weight[main] / weight.sum())
            borders = [0, *(np.flatnonzero(path[1:] != path[:-1]) + 1).tolist(), len(path)]
            spans = [(model.languages[path[a]], a, b - a) for a, b in zip(borders, borders[1:])]
            own = path[borders[:-1]]
            sums, at_own = np.add.reduceat(scores[rows], borders[:-1], axis=0), np.arange(len(own))
            of_own = sums[at_own, own]
            sums[at_own, own] = -np.inf
            span_letters = np.add.reduceat(letters[rows], borders[:-1])
            margins = of_own - sums.max(axis=1) if sums.shape[1] > 1 else np.full(len(own), 30.0)
            known = float((span_letters * _odds(margins)).sum() / span_letters.sum())
        others = np.delete(totals[k], main)
        margin = float(totals[k, main] - others.max()) if len(others) else 30.0
        sure = float(_odds(margin))
        score = share * (sure if share == 1.0 else max(sure, 0.5))
        result[i] = (model.languages[main], score, spans, sure if known is None else known)
    return result


def with_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with one more column, a struct (lang_pred, score, spans, sure) named ``language``.

    ``spans`` lists (lang, first word, words) over the text's words, runs of letters. ``lang_pred`` has the most
    letters, and score is its share of them times the odds over the runner-up; ``sure`` is the share of letters in spans
    that surely are in their language, whichever it is, so a text of several languages may be as sure as one of one. A null text and one without letters
    are ``und`` with score 0 and no spans, and so is every text if the model has no language. Whole texts count, however long; repeated rows repeat, an empty table gives no
    rows. Equal texts get equal
    results; all other columns stay as they are, and a clashing name gets a trailing underscore.
    """
    bounded_batches(docs.sparkSession)
    kind = "lang_pred string, score double, spans array<struct<lang:string,first:int,words:int>>, sure double"

    @F.pandas_udf(kind)
    def labelled(column: pd.Series) -> pd.DataFrame:
        found, part, size = [], [], 0
        for value in column:
            part.append(value or "")
            size += len(part[-1])
            if size >= _AT_A_TIME:
                found += label_texts(part, model)
                part, size = [], 0
        found += label_texts(part, model)
        return pd.DataFrame({
            "lang_pred": objects(f[0] for f in found), "score": [f[1] for f in found],
            "spans": objects([{"lang": a, "first": b, "words": c} for a, b, c in f[2]] for f in found),
            "sure": [f[3] for f in found],
        })

    return docs.withColumn(unused(docs, "language"), labelled(F.col(text)))
