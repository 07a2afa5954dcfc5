"""The operators on texts against plain versions of themselves, on awkward rows."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import TEXTS
from vanewright.llm import jaccard, langid, linededup, packing, quality, sentencepiece, toxicity, winnowing

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ASCII_SPACE = "\t\n\x0b\x0c\r "


def ascii_lower(text):
    return text.encode().lower().decode()


# packing

def test_words_encode_as_whole_texts():
    words = packing.WordCachedEncoder(BPE)
    random.seed(1)
    texts = ["", " ", "   a", "a \n b", "a\n\n\nb ", "don't  stop\n'll", "<|endoftext|> x", "a   b"]
    texts += ["".join(random.choice("ab \n\t.'1 é") for _ in range(random.randint(0, 12))) for _ in range(1500)]
    for text in texts:
        ids = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.encode(text), "<u4").tolist() == ids, text


def test_added_tokens_in_texts_encode_as_by_the_library():
    words, library = packing.WordCachedEncoder(BPE), Tokenizer.from_file(BPE)
    for text in ["<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b\nc", "  <|endoftext|>\n\nx", "<|endoftext"]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.encode(text), "<u4").tolist() == ids and (50256 in ids) == ("|>" in text), text


def test_every_id_lies_in_one_gapless_piece(odd_docs):
    rows = packing.pack(odd_docs, BPE, capacity=64, piece=16, block=8, with_ids=True).collect()
    words = packing.WordCachedEncoder(BPE)
    documents = defaultdict(list)
    windows = defaultdict(list)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        documents[r.doc_id, r.doc_tokens].append((r.start, bytes(r.ids)))
        windows[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in TEXTS:
        ids = words.encode(text or "") + bytes(4)
        own = sorted(documents[doc_id, len(ids) // 4])
        copies = TEXTS.count((doc_id, text))
        assert Counter(own) == Counter({piece: copies for piece in set(own)})
        assert b"".join(part for _, part in sorted(set(own))) == ids
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64


def test_differencing_is_even_and_fits():
    random.seed(2)
    sizes = [random.randint(1, 255) for _ in range(700)]
    parts = packing.windows_for(sizes, 1024)
    assert sorted(i for part in parts for i in part) == list(range(700))
    sums = [sum(sizes[i] for i in part) for part in parts]
    assert max(sums) <= 1024 and max(sums) - min(sums) <= 8
    assert len(parts) <= -(-sum(sizes) // 1024) + 1


# line dedup

def plain_line_dedup(rows):
    def key(line):
        return ascii_lower(line.strip(ASCII_SPACE))

    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= 20:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or len(holders[key(x)]) < 3 or max(holders[key(x)]) == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_line_dedup(odd_docs):
    found = linededup.without_shared_lines(odd_docs)
    assert found.columns == [*odd_docs.columns, "n_lines_", "n_dropped"]
    rows = found.collect()
    assert sorted(((r.doc_id, r.n_lines_, r.n_dropped, r.text or "") for r in rows), key=repr) == plain_line_dedup(TEXTS)
    assert {r.n_lines for r in rows} == {"kept"} and sum(r.text is None for r in rows) == 1


def test_line_dedup_runs_no_python(odd_docs):
    plan = linededup.without_shared_lines(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# winnowing

def test_winnowing_chooses_the_rightmost_least():
    random.seed(3)
    for _ in range(300):
        text = "".join(random.choice("abé") for _ in range(random.randint(0, 50)))
        gram, window = random.choice([3, 5, 8]), random.choice([1, 4, 7])
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        grams = [int(winnowing.gram_hashes(codes[i:i + min(gram, len(codes))], gram)[0])
                 for i in range(len(codes) - min(gram, len(codes)) + 1)] if text else []
        size, chosen = min(window, len(grams)), []
        for i in range(len(grams) - size + 1 if grams else 0):
            least = min(grams[i:i + size])
            at = max(j for j in range(i, i + size) if grams[j] == least)
            if not chosen or chosen[-1][1] != at:
                chosen.append((least, at))
        hashes, positions = winnowing.winnow(text, gram, window)
        assert list(zip(hashes.tolist(), positions.tolist())) == chosen


def test_each_document_meets_its_next(odd_docs):
    rows = winnowing.edit_likeness(odd_docs, parts=3).collect()
    order = sorted(((i, t or "") for i, t in TEXTS), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    expected = Counter()
    for at, (doc_id, text) in enumerate(order):
        edited = winnowing.edited_text(text, order[(at + 1) % len(order)][1])
        expected[doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == expected
    same = {r.fingerprint for r in rows if r.doc_id == 9}
    assert len(same) == 1 and all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in rows)


# near duplicates

def plain_near_duplicates(rows, words, similar):
    def shingles(text):
        w = (text or "").encode().lower().split()
        if len(w) < words:
            return frozenset([tuple(w)] if w else [])
        return frozenset(tuple(w[i:i + words]) for i in range(len(w) - words + 1))

    sets = [(i, shingles(t)) for i, t in rows]
    group = {i: {i} for i, _ in rows if i is not None}
    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if a is not None and b is not None and x and y and 100 * len(x & y) >= similar * len(x | y):
            both = group[a] | group[b]
            for i in both:
                group[i] = both
    return Counter((i, len(s), min(group[i]) if i is not None else None) for i, s in sets)


@pytest.mark.parametrize("words, similar", [(5, 80), (4, 85), (2, 50)])
def test_near_duplicates(spark, odd_docs, words, similar):
    rows = jaccard.near_duplicates(odd_docs, words, similar).collect()
    assert Counter(tuple(r) for r in rows) == plain_near_duplicates(TEXTS, words, similar)


def test_chains_and_large_groups_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "COUNT_AT", 3000)
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [random.choice(vocabulary) for _ in range(60)]
    rows = [(i, " ".join(random.choices(vocabulary, k=random.randint(3, 60)))) for i in range(60)]
    passage = " ".join(random.choices(vocabulary, k=20))
    rows += [(100 + i, " ".join(random.choices(vocabulary, k=40)) + " " + passage) for i in range(40)]
    for i in range(120):
        words = list(base)
        for _ in range(random.randint(0, 4)):
            words[random.randrange(60)] = random.choice(vocabulary)
        rows.append((300 - i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for similar in (60, 80):
        found = jaccard.near_duplicates(docs, 3, similar).collect()
        assert Counter(tuple(r) for r in found) == plain_near_duplicates(rows, 3, similar)


def test_pairs_with_sketches_too_far_apart_are_left_out(spark):
    """Classes that share a passage but cannot be similar meet no sets; similar ones all do."""
    random.seed(6)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [random.choice(vocabulary) for _ in range(60)]
    texts = [" ".join(base[:30] + random.choices(vocabulary, k=30)) for _ in range(20)]
    for i in range(20):
        words = list(base)
        words[3 * i] = "other"
        texts.append(" ".join(words))
    sets = [jaccard.shingle_set(text, 4) for text in texts]
    rows = [(i, len(s), *jaccard.signature(s), *jaccard.parity_sketch(s).tolist()) for i, s in enumerate(sets)]
    classes = spark.createDataFrame(rows, "id long, n long, s1 long, s2 long, k0 long, k1 long, k2 long, k3 long")
    pairs = classes.select("s1").crossJoin(classes.select(F.col("s1").alias("f1")))
    kept = {(r.a, r.b) for r in jaccard._of_classes(pairs, classes, 85).collect()}
    shared = {(i, j): len(set(sets[i].tolist()) & set(sets[j].tolist())) for j in range(40) for i in range(j)}
    links = {(i, j) for (i, j), n in shared.items() if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n)}
    assert links and links <= kept
    assert not any(i < 20 for i, _ in kept)


def test_only_sets_of_pairs_that_may_be_similar_are_written(spark, monkeypatch):
    """Documents that overlap with their neighbours stand in lists of many, yet cannot be similar: their sets stay where
    they are."""
    long = [f"p{i}" for i in range(460)]
    rows = [(i, " ".join(long[10 * i:10 * i + 60])) for i in range(40)]
    base = [f"b{i}" for i in range(60)]
    rows += [(100 + i, " ".join(base + [f"e{i}"])) for i in range(10)]
    n_sets, written = [], jaccard.written

    def counted(df, purpose):
        table = written(df, purpose)
        if purpose == "candidate-sets":
            n_sets.append(table.count())
        return table

    monkeypatch.setattr(jaccard, "written", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = jaccard.near_duplicates(docs, 4, 85).collect()
    assert Counter(tuple(r) for r in found) == plain_near_duplicates(rows, 4, 85)
    assert n_sets[0] == 10 and max(n_sets[1:], default=0) == 0


def test_lists_of_several_components_give_only_pairs_that_may_be_similar(spark):
    """A list's classes meet those of other components once, and only where places and sketches allow a link."""
    random.seed(8)
    base = [f"b{i}" for i in range(60)]
    texts = [" ".join(base[:30] + [f"d{i}x{k}" for k in range(30)]) for i in range(30)]
    texts += [" ".join([*base, f"e{i}"]) for i in range(6)]
    sets = [jaccard.shingle_set(text, 4) for text in texts]
    marks = [jaccard.signature(s) for s in sets]
    sketches = [f"k{i}" for i in range(jaccard.SKETCH)]
    classes = spark.createDataFrame(
        [(i, len(s), *m, *jaccard.parity_sketch(s).tolist()) for i, (s, m) in enumerate(zip(sets, marks))],
        "id long, n long, s1 long, s2 long, " + ", ".join(f"{k} long" for k in sketches),
    )
    lists = classes.selectExpr("1L AS token", "0 AS salt", "s1", "int(n) AS n", "int(id > 29) AS at", "36L AS length")
    components = spark.createDataFrame([(30, 30), (31, 30)], "node long, component long")
    mixed = jaccard._mixed_lists(lists, classes, components)
    pairs = [frozenset(r) for r in jaccard._mixed_pairs(mixed, 85).collect()]
    near = [m[0] for m in marks[30:]]
    wanted = {frozenset((one, other)) for i, one in enumerate(near) for other in near[:i]} - {frozenset(near[:2])}
    assert Counter(pairs) == Counter(wanted)


# SentencePiece

def test_scan_finds_the_best_segmentation():
    pieces = sentencepiece.Pieces(PIECES)
    random.seed(5)
    for _ in range(60):
        text = "".join(random.choice("abe th日é") for _ in range(random.randint(0, 12)))
        marked = sentencepiece.SPACE + text.replace(" ", sentencepiece.SPACE)

        def best(end):
            return 0.0 if end == 0 else max(best(s) + v for s, v in pieces.steps(marked, end))

        ids, score = pieces.encode(text)
        assert abs(score - best(len(marked))) < 1e-6 and pieces.decode(ids) == text
        for size in (1, 3, 7):
            parts = [marked[i:i + size] for i in range(0, len(marked), size)]
            after = [marked[i + size:i + size + pieces.longest - 1] for i in range(0, len(marked), size)]
            matrices = [pieces.transfer(p, a) for p, a in zip(parts, after)]
            tree = sentencepiece.product_tree(matrices)
            states = sentencepiece.border_states(tree, 0, 0)
            product = matrices[0]
            for matrix in matrices[1:]:
                product = sentencepiece.max_plus(product, matrix)
            assert abs(tree[-1][0][0, 0] - score) < 1e-6 and abs(product[0, 0] - score) < 1e-6
            assert len(states) == len(parts) + 1 and states[0] == states[-1] == 0
            scanned = [i for p, a, x, y in zip(parts, after, states, states[1:])
                       for i in pieces.ids_of(p + a, pieces.trace(p, a, x, y))]
            assert sorted(scanned) == sorted(np.frombuffer(ids, "<u4").tolist()) or abs(
                sum(map(pieces.scores.get, map(pieces.model.id_to_piece, scanned), itertools.repeat(0))) - score) < 1


def test_scan_in_rounds_gives_the_score_of_one_pass(spark, monkeypatch):
    monkeypatch.setattr(sentencepiece, "FAN", 3)  # so that 30 and more chunks of a text take several rounds
    pieces = sentencepiece.Pieces(PIECES)
    random.seed(15)
    texts = ["".join(random.choice("abe thè日é\n") for _ in range(n)) for n in (200, 199, 7, 61)]
    rows = [(1, texts[0]), (1, texts[1]), (None, texts[0]), (2, texts[2]), (3, texts[3]), (3, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sentencepiece.encode(docs, PIECES, giant=1, chunk=6).collect()
    assert len(found) == len(rows)
    told = {(r.doc_id, pieces.decode(bytes(r.ids))): r.score for r in found}
    assert set(told) == set(rows)
    for (_, text), score in told.items():
        assert abs(score - pieces.encode(text)[1]) < 1e-6
    for r in found:
        names = [pieces.model.id_to_piece(i) for i in np.frombuffer(r.ids, "<u4").tolist()]
        own = sum(pieces.scores[n] for n in names if n in pieces.scores)
        left = [n for n in names if n not in pieces.scores]  # characters without a piece, in bytes
        own += pieces.lowest * sum(not 0x80 <= int(n[3:5], 16) < 0xC0 for n in left)
        assert abs(own - r.score) < 1e-6


def test_round_trip_by_words_and_by_chunks(odd_docs):
    for giant in (1 << 16, 10):
        encoded = sentencepiece.encode(odd_docs, PIECES, giant=giant, chunk=25)
        assert Counter(tuple(r) for r in sentencepiece.decode(encoded, PIECES).collect()) == Counter(
            (i, t or "") for i, t in TEXTS
        )
    library = sentencepiece.Pieces(PIECES).model
    for r in encoded.collect():
        if r.doc_id == 1:
            assert library.decode(np.frombuffer(r.ids, "<u4").tolist()) == TEXTS[0][1]


# learned operators

def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int, quality int")


@pytest.fixture(scope="module")
def corpus(spark):
    random.seed(6)
    words = {"en": "the of and house river walking morning".split(), "de": "der und ist haus fluss morgen schnell".split(),
             "ru": "и дом река утро быстро человек".split()}
    rows = []
    for i in range(400):
        lang = random.choice(list(words))
        text = [random.choice(words[lang]) for _ in range(random.randint(10, 40))]
        toxic, good = int(i % 4 == 0), int(i % 5 != 0)
        if toxic:
            text[3:3] = [random.choice(["idiot", "1D1OT", "іdiоt", "moron"])] * 2
        if not good:
            text = [w for w in text for _ in range(12)]
        rows.append((i, " ".join(text), lang, toxic, good))
    return labelled(spark, rows)


def test_languages_of_texts_and_spans(spark, corpus, odd_docs, no_docs):
    model = langid.fit_languages(corpus)
    assert model.languages == ["de", "en", "ru"]
    found = langid.with_language(corpus, model)
    assert found.where(F.col("language.lang_pred") == F.col("lang")).count() >= 399
    mixed = langid.label_texts(["the house and the river " * 4 + "и дом река утро " * 9, "!? 12", ""], model)
    assert [s[0] for s in mixed[0][2]] == ["en", "ru"] and mixed[0][0] == "ru"
    assert mixed[1][:2] == mixed[2][:2] == ("und", 0.0)
    odd = langid.with_language(odd_docs, model).collect()
    assert len(odd) == len(TEXTS) and all(r.language == "kept" for r in odd)
    assert {r.doc_id for r in odd if r.language_.lang_pred == "und"} == {3, 4, 5, 12}
    nothing = langid.fit_languages(no_docs.withColumn("lang", F.lit("en")))
    assert langid.label_texts(["a b"], nothing) == [("und", 0.0, [], 0.0)]


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(1)
    for _ in range(200):
        rows, states = rng.integers(1, 6), rng.integers(1, 4)
        scores = rng.normal(size=(rows, states)) * 2

        def value(path):
            return sum(scores[i, s] for i, s in enumerate(path)) - 1.5 * sum(a != b for a, b in zip(path, path[1:]))

        best = max(value(p) for p in itertools.product(range(states), repeat=int(rows)))
        assert abs(value(langid.viterbi(scores, 1.5)) - best) < 1e-9
        main = np.array([scores.sum(axis=0).argmax()])
        if langid._unmixed(scores, np.array([0]), main, np.array([rows]), 1.5)[0]:
            assert abs(value([int(main[0])] * int(rows)) - best) < 1e-9


def test_toxicity_folds_and_spares_exceptions(spark, corpus, odd_docs, no_docs):
    model = toxicity.fit_toxicity(corpus, corpus.select("doc_id", "toxic"))
    found = toxicity.with_measures(corpus, model).select("toxic", "measures.score").toPandas()
    assert (found.score >= 0.3).eq(found.toxic == 1).mean() > 0.99
    assert any("idiot".startswith(w) for w in model.lexicon)
    lexicon = toxicity.ToxicityModel({"clown": 5.0, "idiot": 4.0})
    assert lexicon.measures(toxicity.folded("what a Cl0wn, ＣＬＯＷＮ"))[2] == ["clown"]
    assert lexicon.measures(toxicity.folded("a clown fish"))[0] == 0.0
    assert lexicon.measures(toxicity.folded("unidiotic"))[0] == 0.0
    odd = toxicity.with_measures(odd_docs, model).collect()
    assert len(odd) == len(TEXTS) and all(r.measures == 7 and 0 <= r.measures_.score <= 1 for r in odd)
    nothing = toxicity.fit_toxicity(no_docs, corpus.select("doc_id", "toxic").limit(0))
    assert nothing.lexicon == {} and toxicity.with_measures(no_docs, nothing).count() == 0


def test_quality_by_compression(corpus, odd_docs, no_docs):
    model = quality.fit_quality(corpus, corpus.select("doc_id", "quality"))
    found = quality.with_quality(corpus, model).select(F.col("quality").alias("label"), "quality_.score").toPandas()
    assert (found.score >= 0.5).eq(found.label == 1).mean() > 0.95
    odd = quality.with_quality(odd_docs, model).collect()
    assert len(odd) == len(TEXTS) and all(r.quality == 8 and 0 <= r.quality_.score <= 1 for r in odd)
    nothing = quality.fit_quality(no_docs, corpus.select("doc_id", "quality").limit(0))
    assert quality.with_quality(no_docs, nothing).count() == 0


def test_empty_tables(no_docs):
    assert packing.pack(no_docs, BPE).count() == 0
    assert linededup.without_shared_lines(no_docs).count() == 0
    assert winnowing.edit_likeness(no_docs, parts=2).count() == 0
    assert jaccard.near_duplicates(no_docs).count() == 0
    assert sentencepiece.encode(no_docs, PIECES).count() == 0


def test_words_are_cut_alike_beside_other_planes():
    """Combining marks belong to their words, whatever else a text holds."""
    plain = "cafe\u0301 … E\u0302 x1y"
    assert langid.words_of(plain) == ["cafe\u0301", "e\u0302", "x", "y"]
    assert langid.words_of(plain + " \U0001F600") == langid.words_of(plain)
    assert langid.words_of("\U0001F600ab\U00020000c \U00010400") == ["ab\U00020000c", "\U00010428"]
    assert langid.words_of("") == langid.words_of("\U0001F600") == []


def test_texts_of_three_languages_are_sure(spark):
    own = {"en": "the house and the river with", "fr": "la maison et le fleuve avec", "de": "das haus und der fluss mit"}
    rows = [(i, f"{own[lang]} " * 20, lang) for i, lang in enumerate(list(own) * 12)]
    model = langid.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    mixed = " ".join(f"{own[lang]} " * n for lang, n in (("en", 38), ("fr", 32), ("de", 30)))
    (lang, score, spans, sure), = langid.label_texts([mixed], model)
    assert lang in own and {s[0] for s in spans} == set(own) and score < 0.5 < 0.95 < sure
    (_, score, _, sure), = langid.label_texts([own["fr"] * 9], model)
    assert score == sure > 0.95
