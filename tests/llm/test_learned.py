"""Toxicity and quality: held-out accuracy on made documents, and odd rows."""
import math
import random
import zlib

import numpy as np
import pytest
import zstandard
from support import ROWS, documents, empty

from millrace.llm import quality as q
from millrace.llm import tables
from millrace.llm import toxicity as t

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
INSULTS = "zonkbrain muckface gritnoggin".split()


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def corpus(n=600, seed=0):
    rng, docs, labels = random.Random(seed), [], []
    for i in range(n):
        words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(30, 150))]
        toxic, low = int(rng.random() < 0.2), int(rng.random() < 0.25)
        for _ in range(4 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        if low:
            words = [w + rng.choice(["###", "$$$", "%%%"]) for w in words]
        docs.append((i, " ".join(words), rng.choice(["en", "de"]), f"src{rng.randrange(5)}", None))
        labels.append((i, 1 - low, toxic))
    return docs, labels


def labels_of(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(spark):
    docs, labels = corpus()
    truth = {d: x for d, _, x in labels}
    out = t.toxicity(documents(spark, docs), labels_of(spark, labels + [(5, None, None), (None, 1, 1), (10_000, 1, 1)])).collect()
    mine = [r for r in out if r.held_out]
    assert {r.doc_id for r in mine} == {d for d in truth if held(d)} and len(out) == len(docs)
    caught = [r.predicted for r in mine if truth[r.doc_id]]
    clean = [r.predicted for r in mine if not truth[r.doc_id]]
    assert np.mean(caught) > 0.85 and np.mean(clean) < 0.05
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)


def test_toxicity_odd_rows(spark):
    docs, labels = corpus(200)
    known = labels_of(spark, labels)
    out = t.toxicity(documents(spark, docs + [(d if d is None else d + 5000, *r) for d, *r in ROWS]), known).collect()
    assert len(out) == len(docs) + len(ROWS) and all(r.score is not None for r in out)
    assert t.toxicity(empty(spark), known).count() == 0
    assert {r.score for r in t.toxicity(documents(spark), labels_of(spark, [])).collect()} == {0.0}


def test_windows_cover_the_text():
    text = "One two THREE\tfour\n" * 30 + "x" * 5000
    joined = b"".join(w.removesuffix(t.TAIL) for w in t.windows(text, 8))
    assert joined.split() == text.lower().encode().split() or b"".join(joined.split()) == b"".join(text.lower().encode().split())
    assert t.windows("", 5) == [] == t.windows(" \n", 5)


def test_quality(spark):
    docs, labels = corpus()
    truth = {d: x for d, x, _ in labels}
    out = q.quality(documents(spark, docs), labels_of(spark, labels)).collect()
    mine = [r for r in out if r.held_out]
    assert len(out) == len(docs) and np.mean([r.kept == bool(truth[r.doc_id]) for r in mine]) > 0.95
    assert np.mean([r.kept for r in mine if truth[r.doc_id]]) > 0.97


def test_quality_odd_rows(spark):
    docs, labels = corpus(200)
    known = labels_of(spark, labels)
    out = q.quality(documents(spark, docs + [(d if d is None else d + 5000, *r) for d, *r in ROWS]), known).collect()
    assert len(out) == len(docs) + len(ROWS) and all(0 <= r.score <= 1 for r in out)
    assert q.quality(empty(spark), known).count() == 0
    unlabelled = q.quality(documents(spark).drop("lang", "source"), labels_of(spark, [])).collect()
    assert {r.score for r in unlabelled} == {0.5} and all(r.kept for r in unlabelled)


class Rows:
    """A pool in memory, row by row."""

    def __init__(self, pool):
        self.pool = pool

    def surest(self, models, want, error, taken):
        out = []
        for view, (w, slope) in enumerate(models):
            odds = [max(-30, min(30, float(np.dot(r, w[:-1]) + w[-1]))) for r in self.pool[view]]
            p = [1 / (1 + math.exp(-max(-30, min(30, o * slope[0] + slope[1])))) for o in odds]
            for label, n in want.items():
                wrong = sorted((1 - x if label else x, i) for i, x in enumerate(p) if i not in taken)
                out += [(view, label, e, i, i) for e, i in wrong[:n] if e <= error[label]]
        return out


def plain_co_train(x, y, pool, rest, rest_y):
    """The exchange row by row, with the operator's fit of one logistic model."""
    share = lambda rows, w: [1 / (1 + math.exp(-max(-30, min(30, float(np.dot(r, w[:-1]) + w[-1]))))) for r in rows]
    odds = lambda rows, w: [max(-30, min(30, float(np.dot(r, w[:-1]) + w[-1]))) for r in rows]

    def calibrated(rows, view, w):
        line = q._fit(np.array(odds(rest[view], w))[:, None], rest_y)
        return share([[o] for o in odds(rows, w)], line)

    def loss(view, w):
        return sum(-math.log(p if label else 1 - p) for p, label in zip(calibrated(rest[view], view, w), rest_y, strict=True)) / len(rest_y)

    own = [(list(v), list(y)) for v in x]
    w = [q._fit(np.array(a), np.array(b)) for a, b in own]
    free, good = set(range(len(pool[0]))), sum(y) / len(y)
    for _ in range(q.ROUNDS):
        offers = []
        for view in (0, 1):
            p, chosen = calibrated(pool[view], view, w[view]), []
            for label, share_of in ((1, good), (0, 1 - good)):
                wrong = {i: 1 - p[i] if label else p[i] for i in free}
                best = sorted(free, key=lambda i: (wrong[i], i))[: round(q.EACH_ROUND * share_of)]
                chosen += [(i, label) for i in best if wrong[i] <= min(q.UNSURE, (1 - share_of) / 5)]
            offers.append(chosen)
        for view, chosen in ((1, offers[0]), (0, offers[1])):
            chosen = [(i, label) for i, label in chosen if i in free]
            if chosen:
                more = own[view][0] + [pool[view][i] for i, _ in chosen], own[view][1] + [float(label) for _, label in chosen]
                after = q._fit(np.array(more[0]), np.array(more[1]))
                if loss(view, after) <= loss(view, w[view]):
                    own[view], w[view] = more, after
                    free -= {i for i, _ in chosen}
    return w


def two_views(n, seed, noise=0.6):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n).astype(float)
    return y, tuple(np.column_stack([y * 2 - 1 + rng.normal(0, noise, n), rng.normal(size=n)]) for _ in range(2))


def exchange(monkeypatch, y, views, few, rest, pool):
    part = lambda at: tuple(v[at] for v in views)
    monkeypatch.setattr(q, "unpacked", lambda found: tuple(v[pool][list(found)] for v in views))
    monkeypatch.setattr(q, "EACH_ROUND", max(1, len(pool) // 10))
    return part(few), y[few], Rows(part(pool)), part(rest), y[rest]


def test_co_training_against_a_plain_version(monkeypatch):
    y, views = two_views(300, 1)
    args = exchange(monkeypatch, y, views, np.arange(12), np.arange(12, 52), np.arange(52, 300))
    (w, taken), wanted = q.co_train(*args), plain_co_train(*args[:2], args[2].pool, *args[3:])
    assert sum(taken) > 0 and all(np.allclose(a, b, atol=1e-6) for a, b in zip(w, wanted, strict=True))


def test_co_training_gives_the_other_view_labels(monkeypatch):
    """With a few labelled rows of each class, rounds on the pool teach both views."""
    y, views = two_views(1600, 0)
    few = np.concatenate([np.flatnonzero(y[:100] == 0)[:4], np.flatnonzero(y[:100] == 1)[:4]])
    w, taken = q.co_train(*exchange(monkeypatch, y, views, few, np.arange(100, 200), np.arange(200, 1000)))
    assert min(taken) > 50
    for v in (0, 1):
        alone = q._fit(views[v][few], y[few])
        right = [np.mean((q._odds(views[v][1000:], x) > 0) == y[1000:]) for x in (alone, w[v])]
        assert right[1] > 0.9 and right[1] >= right[0]


def test_a_view_that_knows_nothing_gives_no_labels(monkeypatch):
    y, views = two_views(1200, 3)
    noise = np.random.default_rng(5).normal(size=(1200, 2))
    w, taken = q.co_train(*exchange(monkeypatch, y, (views[0], noise), np.arange(60), np.arange(60, 200), np.arange(200, 1200)))
    assert taken[0] == 0 and np.mean((q._odds(views[0][200:], w[0]) > 0) == y[200:]) > 0.9


def test_the_surest_of_all_tasks(spark):
    """Copies are one, labelled documents none, and ties go to the smaller code, however rows are dealt."""
    docs = [(i, "word " * (i % 40) + "#" * (i % 7), "en", f"src{i % 3}", None) for i in range(300)]
    found = tables.stash(q.views(q._read(documents(spark, docs * 2).repartition(7))), "test")
    known = spark.createDataFrame([(i,) for i in range(0, 300, 3)], "doc_id long")
    rng = np.random.default_rng(0)
    models = [(rng.normal(size=n + 1), np.array([0.3, 0.0])) for n in (q.TEXT_SIZE, q.META_SIZE)]
    want, error, rows = {0: 9, 1: 14}, {0: 0.6, 1: 0.7}, {}
    for r in found.where("doc_id % 3 <> 0").selectExpr("xxhash64(view) code", "view").collect():
        rows[r.code] = bytes(r.view)
    taken = set(sorted(rows)[:20])
    wanted = []
    for view, (w, slope) in enumerate(models):
        p = {c: float(q._share(q._calibrated(q.unpacked([b])[view], w, slope))[0]) for c, b in rows.items() if c not in taken}
        for label, n in want.items():
            best = sorted((round(1 - x if label else x, 6), c) for c, x in p.items())
            wanted += [(view, label, e) for e, _ in [b for b in best if b[0] <= error[label]][:n]]
    got = q.Pool(found, known).surest(models, want, error, taken)
    assert [(v, label, round(e, 6)) for v, label, e, *_ in got] == wanted and all(rows[c] == b and c not in taken for *_, c, b in got)


def plain_fit(x, y, ridge=0.1):
    """Ridge logistic regression by damped Newton steps in long form, to convergence."""
    x = np.column_stack([np.asarray(x, np.longdouble), np.ones(len(x))])
    keep, w = np.append(np.full(x.shape[1] - 1, ridge), 1e-6), np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-(x @ w)))
        slope, bend = np.asarray(x.T @ (y - p) - keep * w, float), np.asarray((x * (p * (1 - p))[:, None]).T @ x, float) + np.diag(keep)
        step = np.linalg.lstsq(bend, slope, rcond=None)[0]
        w = w + step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-9:
            break
    return w


def test_quality_against_a_plain_version(spark, monkeypatch):
    """Views, samples, exchange, calibration, combination and verdicts of the whole query, with a fit of its own."""
    monkeypatch.setattr(q, "EACH_ROUND", 30)
    docs, labels = corpus(500, 7)
    rng = random.Random(2)
    labels = [x for x in labels if rng.random() < 0.5]
    docs += [(d if d is None else d + 5000, *r) for d, *r in ROWS]
    views = [np.concatenate((q.text_view(x or ""), q.meta_view(s, lang, x or ""))).astype("<f2").astype(float) for _, x, lang, s, _ in docs]
    x = [np.array([v[: q.TEXT_SIZE] for v in views]), np.array([v[q.TEXT_SIZE :] for v in views])]
    truth, at = {d: y for d, y, _ in labels}, {r[0]: i for i, r in enumerate(docs)}
    mine = sorted(d for d in truth if not held(d))
    fit, rest = ([d for d in mine if (zlib.crc32(f"fold {d}".encode()) % 4 == 0) == k] for k in (False, True))
    rows = lambda ids, v: x[v][[at[d] for d in ids]]
    y, rest_y = (np.array([truth[d] for d in ids], float) for ids in (fit, rest))
    one = {}
    for i, (d, *_) in enumerate(docs):
        if d not in truth:
            one.setdefault(np.concatenate((x[0][i], x[1][i])).tobytes(), i)
    pool = sorted(one.values())
    got = q.quality(documents(spark, docs), labels_of(spark, labels)).collect()
    monkeypatch.setattr(q, "_fit", lambda a, b, **_: plain_fit(a, b))
    w = plain_co_train([rows(fit, v) for v in (0, 1)], y, [x[v][pool] for v in (0, 1)], [rows(rest, v) for v in (0, 1)], rest_y)
    odds = lambda a, w: np.clip(a @ w[:-1] + w[-1], -30, 30)
    lines = [plain_fit(odds(rows(rest, v), w[v])[:, None], rest_y) for v in (0, 1)]
    calibrated = [odds(odds(x[v], w[v])[:, None], lines[v]) for v in (0, 1)]
    both = plain_fit(np.column_stack([c[[at[d] for d in rest]] for c in calibrated]), rest_y)
    scores = 1 / (1 + np.exp(-odds(np.column_stack(calibrated), both)))
    found = sorted((str(d), round(s, 2)) for d, s in ((r.doc_id, r.score) for r in got))
    wanted = sorted((str(r[0]), round(float(s), 2)) for r, s in zip(docs, scores, strict=True))
    assert [d for d, _ in found] == [d for d, _ in wanted] and np.allclose([s for _, s in found], [s for _, s in wanted], atol=0.02) and all(r.kept == (r.score >= 0.5) for r in got)


def test_toxicity_learns_from_whole_texts(spark):
    texts = {i: "plain words " * 2500 + f"the mark {i}" for i in range(40)}
    rows = [(i, x, "en", None, None) for i, x in texts.items()]
    marked = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, label int")
    found = tables.sample(documents(spark, rows).select("doc_id", "text"), marked, {0: 100, 1: 100}).collect()
    assert {(r.doc_id, r.text, r.label) for r in found} == {(i, x, i % 2) for i, x in texts.items()}


def marked_docs(spark, rows):
    return documents(spark, [(d, x, None, None, None) for d, x in rows], clashing=False).select("doc_id", "text")


def test_samples_are_bounded_by_row(spark):
    """One labelled id 6,000 times, with the same text and with others, fills no more than its share."""
    rows = [(7, "the same again")] * 3000 + [(7, f"other text {i}") for i in range(3000)] + [(100 + i, f"text {i}") for i in range(300)]
    marked = spark.createDataFrame([(7, 1)] + [(100 + i, i % 2) for i in range(300)], "doc_id long, label int")
    found = tables.sample(marked_docs(spark, rows), marked, {1: 500, 0: 100}).collect()
    assert sum(r.label == 1 for r in found) == 500 and sum(r.label == 0 for r in found) == 100
    assert len({(r.doc_id, r.text) for r in found}) == len(found)
    few = tables.sample(marked_docs(spark, rows), marked, {1: 500, 0: 100}, longest=1000).collect()
    sizes = {x: sum(len(r.text) for r in few if r.label == x) for x in (0, 1)}
    assert 900 < sizes[1] <= 1000 and sum(r.label == 0 for r in few) == 100 and sizes[0] <= 1000


def test_a_repeated_row_changes_no_sample(spark):
    rows = [(i, f"text {i}") for i in range(400)]
    marked = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, label int")
    once = tables.sample(marked_docs(spark, rows), marked, {1: 50, 0: 70}).collect()
    often = tables.sample(marked_docs(spark, rows + [rows[3]] * 40_000).repartition(7), marked, {1: 50, 0: 70}).collect()
    assert sorted(once) == sorted(often) and [sum(r.label == x for r in often) for x in (0, 1)] == [70, 50]


@pytest.mark.parametrize("size,longest", [(48_000, 2 << 20), (300_000, 1 << 17)])
def test_both_classes_at_any_size_of_texts(spark, size, longest):
    """Bytes are counted for each class, and a few rows are taken whatever their size."""
    docs = spark.range(0, 200, 1, 6).selectExpr("id as doc_id", f"concat(id, repeat('x', {size})) as text")
    marked = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, label int")
    found = tables.sample(docs, marked, {1: 1500, 0: 3000}, longest).selectExpr("label", "octet_length(text) n").collect()
    for label in (0, 1):
        n = sum(r.label == label for r in found)
        assert n == tables.LEAST_ROWS if size > longest else longest // 50_000 <= n <= longest // 48_000


def test_a_sample_where_most_labelled_documents_are_missing(spark):
    marked = spark.createDataFrame([(i, 1) for i in range(4000)], "doc_id long, label int")
    found = tables.sample(marked_docs(spark, [(i, f"text {i}") for i in range(60)]), marked, {1: 40}).collect()
    assert len(found) == 40


def plain_score(model, text):
    """Word by word with compressors of its own, as the definition has it."""
    toxic, ordinary, w, cut = model.parts
    lengths = []
    for word in text.lower().encode().split():
        whole = b" " + word + b" "
        for part in [whole] if len(whole) <= t.LONGEST else [whole[j : j + t.LONGEST] for j in range(0, len(whole), t.LONGEST)]:
            sizes = []
            for content in (ordinary, toxic):
                how = zstandard.ZstdCompressionParameters(window_log=17, chain_log=14, hash_log=14, search_log=6, min_match=3, target_length=16, strategy=zstandard.STRATEGY_BTLAZY2, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
                dictionary = zstandard.ZstdCompressionDict(content + t.TAIL, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                sizes.append(len(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=how).compress(part + t.TAIL)))
            lengths.append(sizes[0] - sizes[1])
    x = [0.0] * (len(w) - 1)
    if lengths:
        top, above = sorted(lengths, reverse=True), [sum(d >= a for d in lengths) for a in t.AT]
        x = [top[0], sum(top[:3]) / len(top[:3]), sum(max(d, 0) for d in lengths) / len(lengths), math.log(len(lengths))]
        x += [math.log1p(n) for n in above] + [20 * n / (len(lengths) + 5) for n in above]
    odds = sum(a * b for a, b in zip(x, w, strict=False)) + w[-1] + math.log(t.CUT / (1 - t.CUT)) - cut
    return 1 / (1 + math.exp(-max(-30, min(30, odds))))


@pytest.mark.parametrize("known", [0, 50, 400_000])
def test_toxicity_against_plain_scores(spark, monkeypatch, known):
    """The table of words changes nothing, whether it is full or not."""
    monkeypatch.setattr(t, "KNOWN_WORDS", known)
    docs, labels = corpus(150)
    docs += [(d if d is None else d + 5000, *(x[:30_000] if isinstance(x, str) else x for x in r)) for d, *r in ROWS]
    frame, known = documents(spark, docs), labels_of(spark, labels)
    model = t.learn(frame, known)
    assert all(len(d) <= size for d, size in zip(model.parts[:2], (t.TOXIC_BYTES, t.ORDINARY_BYTES), strict=True)) and len(model.parts[1]) > 100
    found = sorted(((str(r.doc_id), round(r.score, 6)) for r in t.score(frame, model).collect()))
    assert found == sorted((str(d), round(plain_score(model, x or ""), 6)) for d, x, *_ in docs)


def test_the_toxic_dictionary_holds_what_marks_toxic_text():
    """Chosen windows are stretches of toxic documents; the separate compressors tell words that ordinary text lacks."""
    docs, labels = corpus(400, 5)
    toxic, ordinary = ([x for (_, x, *_), (_, _, label) in zip(docs, labels, strict=True) if label == want] for want in (1, 0))
    dictionaries = t.train_dictionaries(toxic, ordinary)
    assert sum(w.encode() in dictionaries[0] for w in INSULTS) >= 2 and not any(w.encode() in dictionaries[1] for w in INSULTS)
    distance = t.Distance(*dictionaries)
    mean = lambda words: np.mean([distance.of(w) for x in words for w in t.windows(x, 1)])
    assert mean(INSULTS) > mean(ordinary[:20]) + 2


def test_toxicity_does_not_learn_held_out_labels(spark):
    docs, labels = corpus(200)
    other = [(d, q_, 1 - x if held(d) else x) for d, q_, x in labels]
    scores = [sorted((r.doc_id, r.score) for r in t.toxicity(documents(spark, docs), labels_of(spark, x)).collect()) for x in (labels, other)]
    assert scores[0] == scores[1]


def test_dictionaries_of_very_few_texts():
    toxic, ordinary = t.train_dictionaries(["you idiot here"] * 2, ["plain words"])
    assert len(toxic) <= t.TOXIC_BYTES and len(ordinary) <= t.ORDINARY_BYTES
    assert t.train_dictionaries([], []) == (b"", b"") and t.train_dictionaries(["", " "], [""]) == (b"", b"")


@pytest.mark.parametrize("n", [2, 3, 5])
def test_toxicity_of_very_few_labels(spark, n):
    ids = [i for i in range(100) if not held(i)][: 2 * n]
    docs = documents(spark, [(i, "you idiot word" if i % 2 else "plain word", "en", None, None) for i in range(100)])
    out = t.toxicity(docs, labels_of(spark, [(i, 1, at % 2) for at, i in enumerate(ids)])).collect()
    assert len(out) == 100 and all(0 <= r.score <= 1 for r in out)


def test_toxicity_with_all_rows_in_one_fold(spark, monkeypatch):
    monkeypatch.setattr(t, "FOLDS", 1)
    docs, labels = corpus(40)
    assert {r.score for r in t.toxicity(documents(spark, docs), labels_of(spark, labels)).collect()} == {0.0}
