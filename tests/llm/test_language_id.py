import random
import resource
import zlib
from collections import Counter

import numpy as np
import pytest
from support import ROWS, documents, empty

from millrace.llm import language_id as lid

REAL = lid.counts
STEMS = {"en": "the ing and that with tion", "de": "der ung und sch mit keit", "fr": "le ment que aux des tion", "es": "el cion que los ado para"}


def corpus(n=400, seed=0):
    rng, out = random.Random(seed), []
    for i in range(n):
        lang = sorted(STEMS)[i % 4]
        out.append((i, " ".join("".join(rng.choices(STEMS[lang].split(), k=rng.randint(1, 3))) for _ in range(rng.randint(2, 60))), lang, None, None))
    return out


def test_held_out_accuracy(spark):
    rows = corpus()
    langs = {r[0]: r[2] for r in rows}
    docs = documents(spark, rows + [(1000, None, "en", None, None), (1001, "12 !? 3", "en", None, None), (1002, "", None, None, None)])
    out = {r.doc_id: r for r in lid.language_id(docs).collect()}
    held = [r for r in out.values() if r.held_out and r.doc_id < 1000]
    assert 40 < len(held) < 160 and np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.95
    assert all((out[i].lang_pred, out[i].score) == ("und", 0.0) for i in (1000, 1001, 1002))
    assert all(0 <= r.score <= 1 for r in out.values())


def test_held_out_labels_are_not_learned(spark):
    docs = documents(spark, corpus())
    odd = docs.withColumn("lang", lid.F.when(lid.held_out(), "zz").otherwise(docs.lang))
    assert lid.learn(odd).langs == ["de", "en", "es", "fr"]


def test_odd_rows(spark):
    out = lid.language_id(documents(spark)).collect()
    assert sorted([r.doc_id for r in out], key=str) == sorted([r[0] for r in ROWS], key=str)
    assert {r.lang_pred for r in out if r.doc_id in (1, 2, 3)} == {"und"}
    assert lid.language_id(empty(spark)).count() == 0
    assert {r.lang_pred for r in lid.language_id(documents(spark, [(1, "words", None, None, None)])).collect()} == {"und"}


def plain_grams(text):
    """Slots by the definition, n-gram by n-gram, one text at a time."""
    fold = lambda c: (c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " "
    padded = [fold(c) for c in f" {text}  "]
    out = Counter()
    for start in range(len(text) + 1):
        h = 0
        for k in range(3):
            h = ((h ^ ord(padded[start + k])) * 0x01000193 + 0x9E3779B9) % 2**32
            if any(c != " " for c in padded[start : start + k + 1]):
                out[((h ^ h >> 15) * 0x2C1B3C6D % 2**32) >> 16 & lid.SLOTS - 1] += 1
    return out


ODD = ["", None, "a", "  ", "Ünïcödé 日本語 😀 x", "aB1", "12 !?", "der Fluß\tund\nİstanbul", "abc " * 300, "x"]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100, 1 << 17])
def test_blocks_of_any_size_count_each_ngram_once(size):
    found = [Counter() for _ in ODD]
    for block in lid.blocks(ODD, size):
        for row, slot, n in zip(*(c.tolist() for c in lid.sparse(*block)), strict=True):
            found[row][slot] += n
    assert found == [plain_grams(t) if t else Counter() for t in ODD]


@pytest.mark.parametrize("cells", [1, 5, 1 << 22])
def test_scores_against_plain_naive_bayes(monkeypatch, cells):
    monkeypatch.setattr(lid, "CELLS", cells)
    monkeypatch.setattr(lid, "BLOCK", 64)
    rng = np.random.default_rng(0)
    model = lid.Model(["a", "b", "c"], rng.normal(size=(lid.SLOTS, 3)).astype(np.float32))
    sums, ns = model.sums(ODD)
    for t, s, n in zip(ODD, sums, ns, strict=True):
        grams = plain_grams(t or "") if t else Counter()
        assert n == sum(grams.values()) and np.allclose(s, sum((k * model.logp[g].astype(float) for g, k in grams.items()), np.zeros(3)), atol=1e-3)
    assert model.score([]) == ([], [])


def test_learned_model_against_plain_counts(spark):
    rows = corpus(60)
    model, wanted = lid.learn(documents(spark, rows)), {}
    for doc, text, lang, *_ in rows:
        if zlib.crc32(str(doc).encode()) % 4 != 2:
            wanted.setdefault(lang, Counter()).update(plain_grams(text))
    assert model.langs == sorted(wanted)
    for i, lang in enumerate(model.langs):
        n = np.full(lid.SLOTS, 0.5)
        for slot, k in wanted[lang].items():
            n[slot] += k
        assert np.allclose(model.logp[:, i], np.log(n / n.sum()), atol=1e-4)


def test_many_languages_in_bounded_memory():
    logp = np.zeros((lid.SLOTS, 1000), np.float32)
    logp[:, 7] = 1
    text = "".join(chr(97 + i * i % 26) + " " * (i % 5 == 0) for i in range(2_000_000))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert lid.Model([f"l{i:03}" for i in range(1000)], logp).score([text])[0] == ["l007"]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 700_000  # kB, with the matrix of 262 MB


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(lid, "MOST_LANGUAGES", 3)
    with pytest.raises(ValueError):
        lid.learn(documents(spark, corpus(40)))


def test_learns_from_whole_texts(spark):
    late = documents(spark, [(i, "a " * 30_000 + ("zork " if i % 2 else "blim ") * 50, "xx" if i % 2 else "yy", None, None) for i in range(20)])
    model = lid.learn(late)
    assert model.score(["zork", "blim"])[0] == ["xx", "yy"]


def test_filter_keeps_columns(spark):
    docs = documents(spark, corpus(80) + [(500, "123", "en", None, None), (501, None, "en", None, None)])
    out = lid.identified(docs)
    assert out.schema == docs.schema and {r.doc_id for r in out.collect()} == set(range(80))


def test_language_without_letters_is_not_learned(spark):
    docs = documents(spark, corpus() + [(2000 + i, None if i % 2 else "12 3", "zz", None, None) for i in range(20)])
    assert lid.learn(docs).langs == ["de", "en", "es", "fr"]


def test_a_repeated_row_neither_fills_nor_thins_the_sample(spark, monkeypatch):
    monkeypatch.setattr(lid, "SAMPLE_ROWS", 80)
    rows, seen = corpus(200), []
    monkeypatch.setattr(lid, "counts", lambda docs: seen.append(sorted((r.lang, r.text) for r in docs.collect())) or REAL(docs))
    for docs in (rows, rows + [next(r for r in rows if r[2] == "en")] * 20_000):
        lid.learn(documents(spark, docs, clashing=False))
    assert seen[0] == seen[1] and {x: sum(lang == x for lang, _ in seen[0]) for x in STEMS} == dict.fromkeys(STEMS, 20)


def test_matrix_of_parts(spark):
    found = spark.createDataFrame([("a", 0, 3), ("b", 0, 1), ("b", 1023, 7), ("a", 1024, 2), ("a", lid.SLOTS - 1, 5)], "lang string, slot int, n long")
    out = lid.matrix(found, ["a", "b"])
    assert out.sum() == 18 and (out[0, 0], out[0, 1], out[1023, 1], out[1024, 0], out[-1, 0]) == (3, 1, 7, 2, 5)
