import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from support import LONG, ROWS, documents, empty
from tokenizers import Tokenizer

from millrace.llm import fertility as f
from millrace.llm import queries
from millrace.llm import vocabularies as v

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def plain_counts(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from("ab \n\t\x0b#|é\x1c\xa0"), max_size=120))
def test_base_counts(text):
    assert f.base_counts(text) == plain_counts(text)


def test_script():
    assert [f.script(t) for t in ("", "12 !", "abc", "привет мир", "日本 abc 漢字", "αβγ")] == ["none", "none", "latin", "cyrillic", "han", "greek"]


def test_odd_rows(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    words = Tokenizer.from_file(WORDS)
    out = f.quality_rules(documents(spark), {"piece": PIECES, "word": WORDS}).collect()
    wanted = {d: t or "" for d, t, *_ in ROWS if d is not None}
    assert len(out) == len(ROWS)
    for r in out:
        assert not (r.base_failed and r.kept)
        if r.doc_id is None:
            continue
        text = wanted[r.doc_id]
        n, *rest = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        ids = library.encode(text)
        if r.doc_id not in (8, 9):
            assert (n, *rest) == plain_counts(text)
        assert r.base_failed == (n < 50 or 100 * r.n_repeat_words > 50 * n)
        if ids:
            other = words.encode(text, add_special_tokens=False).ids
            assert r.word_tokens == len(other) and r.word_byte_share == 0 and np.isclose(r.word_chars_per_token, len(text) / len(other) if other else 0)
            times = np.array(list(Counter(ids).values()))
            entropy = np.log2(len(ids)) - (times * np.log2(times)).sum() / len(ids)
            assert np.isclose(r.piece_chars_per_token, len(text) / len(ids)) and np.isclose(r.piece_byte_share, np.mean([library.is_byte(i) for i in ids]))
            assert np.isclose(r.piece_token_entropy, entropy / np.log2(max(2, len(ids))))
    assert f.quality_rules(empty(spark), {"piece": PIECES}).count() == 0
    assert f.quality_rules(documents(spark).drop("lang"), {"piece": PIECES}).count() == len(ROWS)


def test_long_text_counts():
    text = LONG[:30_000]
    assert f.base_counts(text) == plain_counts(text)


def test_bands_reject_what_stands_out(spark):
    words = "the river runs past a quiet mill where grain ground for bread and every morning miller opens gate wide".split()
    rng = np.random.default_rng(0)
    prose = [" ".join(rng.choice(words, 120)) for _ in range(300)]
    junk = ["".join(rng.choice(list("#$%qzxjk0123456789"), 900)).replace("q", " ") for _ in range(10)]
    rows = [(i, t, "en" if i % 2 else None, None, None) for i, t in enumerate(prose + junk)]
    out = {r.doc_id: r for r in f.quality_rules(documents(spark, rows), {"piece": PIECES}).collect()}
    assert sum(out[i].kept for i in range(300) if not out[i].base_failed) >= 0.98 * sum(not out[i].base_failed for i in range(300))
    assert not any(out[i].kept for i in range(300, 310))


def test_bands_match_exact_quartiles(spark):
    rng = np.random.default_rng(1)
    values = np.round(rng.normal(2.5, 0.3, 400) / f.GRID) * f.GRID
    df = spark.createDataFrame([("en", False, float(v)) for v in values], "key string, base_failed boolean, m double")
    band = next(r for r in f.bands(df, ["m"]).collect() if r.key == "en")
    ordered = np.sort(values)
    assert np.isclose(band.q1, ordered[99]) and np.isclose(band.q3, ordered[299])


def test_copies_do_not_set_the_bands(spark):
    rng = np.random.default_rng(2)
    common = "the river runs past a quiet mill where grain is ground for bread and every morning".split()
    rare = "sedimentary hydrology thermodynamic crystallography phenomenological".split()
    prose = [" ".join(rng.choice(common + rare[: i % 6], 120)) for i in range(320)]
    junk = ["".join(rng.choice(list("#$%qzxjk0123456789"), 1800)).replace("q", " ") for _ in range(6)]
    langs = ["en"] * 120 + ["fr"] * 200 + ["en"] * 6
    for same in (3, 320):  # a third of all rows, over half of its language
        texts = prose + junk + [(prose + junk)[same]] * 163
        rows = [(i, t, lang, None, None) for i, (t, lang) in enumerate(zip(texts, langs + ["en"] * 163, strict=True))]
        out = {r.doc_id: r for r in f.quality_rules(documents(spark, rows), {"piece": PIECES}).collect()}
        assert len(out) == len(rows) and not any(out[i].base_failed for i in (3, *range(320, 326)))
        passed = [out[i] for i in range(320) if not out[i].base_failed]
        assert len(passed) > 250 and sum(r.kept for r in passed) >= 0.98 * len(passed)
        assert not any(out[i].kept for i in range(320, 326))
        assert all(out[i].outside == out[same].outside for i in range(326, 489))


def test_few_rows_have_bands_of_their_own(spark):
    rng = np.random.default_rng(3)
    words = "the river runs past a quiet mill where grain is ground for bread and every morning".split()
    prose = [(" ".join(rng.choice(words, 160)), "en") for _ in range(200)]
    for signs, lang in (("กขคงจชซญณดตถทธนบปผพฟภมยรลวสหอ", "th"), ("的一是不了人我在有他这为之大来以个中上们", "zh")):
        prose += [(" ".join("".join(rng.choice(list(signs), 5)) for _ in range(140)), lang) for _ in range(12)]
    few = " ".join(rng.choice("el perro come pan y la casa tiene un gato negro con ojos verdes".split(), 160))
    prose += [(few + f" {i}", "es") for i in range(20)]
    junk = [("".join(rng.choice(list("#$%qzxjk0123456789"), 1800)).replace("q", " "), "es")]
    out = {r.doc_id: r for r in f.quality_rules(documents(spark, [(i, t, g, None, None) for i, (t, g) in enumerate(prose + junk)]), {"piece": PIECES}).collect()}
    passed = [r for r in out.values() if not r.base_failed and r.doc_id < len(prose)]
    assert len(passed) > 215 and not out[len(prose)].base_failed and not out[len(prose)].kept
    assert sum(r.kept for r in passed if r.doc_id >= 200) >= 0.9 * sum(r.doc_id >= 200 for r in passed)


def test_query_measures_with_both_vocabularies(spark):
    columns = queries.op4_quality_rules(spark, "/root/testdata/sf0.001").columns
    assert {f"{v}_{m}" for v in ("piece", "word") for m in (*f.MEASURES, "tokens")} <= set(columns)


def plain_measures(text, encode, is_byte):
    ids = encode(text)
    if not ids:
        return 0.0, 0.0, 0.0, 0
    entropy = -sum(n / len(ids) * math.log2(n / len(ids)) for n in Counter(ids).values())
    return len(text) / len(ids), sum(map(is_byte, ids)) / len(ids), entropy / math.log2(max(2, len(ids))), len(ids)


def plain_verdicts(rows):
    """band, outside and kept of (doc_id, text, lang) rows, with the libraries on whole texts and lists for bands."""
    library, words = sentencepiece.SentencePieceProcessor(model_file=PIECES), Tokenizer.from_file(WORDS)
    encoders = {"piece": (library.encode, library.is_byte), "word": (lambda t: words.encode(t, add_special_tokens=False).ids, lambda i: False)}
    measured, values = [], {}
    for doc, text, lang in rows:
        text = text or ""
        n, *_, repeated = plain_counts(text)
        failed = n < 50 or 100 * repeated > 50 * n
        key = lang if lang is not None else f"script:{f.script(text)}"
        found = {v: plain_measures(text, *e) for v, e in encoders.items()}
        measured.append((doc, key, failed, found))
        if not failed:
            for v in encoders:
                for name, x in zip(f.MEASURES, found[v], strict=False):
                    values.setdefault((key, f"{v}_{name}"), {})[text] = math.floor(x / f.GRID + 0.5)
    limits = {}
    for of, by_text in values.items():
        bins = sorted(by_text.values())
        q1, q3 = (bins[math.ceil(q * len(bins)) - 1] * f.GRID for q in (0.25, 0.75))
        limits[of] = q1, q3, max(f.FENCE * (q3 - q1), f.LEAST_WIDTH) * (1 + f.FEW / math.sqrt(len(bins)))
    out = {}
    for doc, key, failed, found in measured:
        outside = []
        for v in encoders:
            for name, x in zip(f.MEASURES, found[v], strict=False):
                if (key, f"{v}_{name}") in limits:
                    q1, q3, reach = limits[key, f"{v}_{name}"]
                    reach *= math.sqrt(max(1, f.STEADY_TOKENS / max(found[v][3], 1)))
                    if x < q1 - reach or x > q3 + reach:
                        outside.append(f"{v}_{name}")
        out[doc] = key, outside, not failed and not outside
    return out


def test_verdicts_against_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(v, "BLOCK", 5000)
    monkeypatch.setattr(v, "STEP", 300)
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()]
    rows += [(10_000 + i, t, lang) for i, (_, t, lang, *_) in enumerate(ROWS)] + [(20_000 + i, t, None) for i, (_, t, _) in enumerate(rows[:40])]
    rows += [(30_000, "  two  spaces " + rows[0][1], "en"), (30_001, "▁ " + rows[1][1], "en"), (30_002, rows[2][1].replace(" ", "\u3000"), "en"), (30_003, rows[3][1].replace(" ", "\n"), "en")]
    docs = documents(spark, [(*r, None, None) for r in rows])
    out = {r.doc_id: (r.band, r.outside, r.kept) for r in f.quality_rules(docs, {"piece": PIECES, "word": WORDS}).collect()}
    assert out == plain_verdicts(rows) and sum(bool(o) for _, o, _ in out.values()) > 5


def test_a_full_table_starts_anew(monkeypatch):
    texts = ["a b c d", "the mill grinds", "", "x" * 100 + " y", "  a  b ", "the mill grinds", "日本 語 z"]
    whole = f.measures(v.Vocabularies(PIECES, WORDS), texts)
    for size in (0, 1, 3, 10):
        monkeypatch.setattr(v, "CACHE", size)
        table = v.Vocabularies(PIECES, WORDS)
        found = [np.hstack(x) for x in zip(*(f.measures(table, [t]) for t in texts), strict=True)]
        assert all((a == b).all() for a, b in zip(found, whole, strict=True)) and len(table.number) <= size


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    from millrace.llm import piece_bpe

    spec = sentencepiece_model_pb2.ModelProto.FromString(sentencepiece.SentencePieceProcessor(model_file=PIECES).serialized_model_proto())
    piece_bpe._refuse_others(sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString()))
    spec.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError, match="white space"):
        piece_bpe._refuse_others(sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString()))
