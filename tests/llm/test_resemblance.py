"""Similar texts against all pairs by Jaccard, hot buckets, odd rows."""
import random
from itertools import combinations

import pytest
from support import documents

from millrace.llm import resemblance as r
from millrace.llm import simhash, tables


def plain_shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split(" ")
    words = [w for w in words if w]
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(x, y):
    return len(x & y) / len(x | y) if x and y else 0.0


def roots(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return [find(i) for i in range(n)]


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        i = rng.randrange(len(out))
        if rng.random() < 0.5:
            out[i] = f"new{rng.randrange(10**6)}"
        else:
            out.insert(i, f"in{rng.randrange(10**6)}")
    return out


def corpus(rng, families, size, edits, words=250):
    texts = []
    for _ in range(families):
        base = [f"w{rng.randrange(900)}" for _ in range(words)]
        texts += [" ".join(edited(rng, base, rng.randint(*edits))) for _ in range(size)]
    return texts


def found(spark, texts):
    docs, place = tables.located(documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]).repartition(5))
    out = r.similar(docs, place, docs.select(r.F.col("doc_id").alias("of"), r.F.col(place).alias("place")))
    return [(x.low, x.high) for x in out.collect()]


@pytest.mark.parametrize("chunk", [8, 2048])
def test_links_against_all_pairs(spark, monkeypatch, chunk):
    """No stranger is linked; of the pairs at 0.8 or more nearly all are in one component."""
    monkeypatch.setattr(r, "CHUNK", chunk)
    rng = random.Random(chunk)
    texts = corpus(rng, 25, 4, (0, 9)) + corpus(rng, 1, 40, (1, 3)) + ["", None, " ", "one two", "one  TWO", "x"] + corpus(rng, 30, 1, (0, 0), 40)
    sets = [plain_shingles(t) for t in texts]
    pairs = found(spark, texts)
    assert all(a < b and jaccard(sets[a], sets[b]) >= 0.8 for a, b in pairs)
    wanted = [(a, b) for a, b in combinations(range(len(texts)), 2) if jaccard(sets[a], sets[b]) >= 0.8]
    root = roots(len(texts), pairs)
    joined = sum(root[a] == root[b] for a, b in wanted)
    assert len(wanted) > 400 and joined >= 0.95 * len(wanted), (joined, len(wanted))


def test_a_hot_group_gives_far_fewer_rows_than_pairs(spark):
    """Of one group of near copies, most pairs of which are about as similar as is asked for: 4 times the texts gave 6.3 times the rows."""
    texts, n = corpus(random.Random(1), 1, 600, (1, 2), 120), []
    for size in (150, 600):
        docs = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts[:size])], clashing=False)
        pairs = r.candidates(r.signatures(docs.select(r.F.col("doc_id").alias("of"), "text"))).collect()
        assert len(set(roots(size, [(p.a, p.b) for p in pairs]))) == 1
        n.append(len(pairs))
    assert n[1] < 8 * n[0] and n[1] < 0.1 * 600 * 599 / 2, n


@pytest.mark.parametrize("chunk", [60, 2048])
def test_a_hot_group_around_the_threshold_loses_no_link(spark, monkeypatch, chunk):
    """Components of a large group with 1 to 8 edits a text are those of all similar pairs that share a band, from few rows."""
    monkeypatch.setattr(r, "CHUNK", chunk)
    texts = corpus(random.Random(6), 1, 400, (1, 8), 150)
    sets, bands = [plain_shingles(t) for t in texts], [r.signature(r.shingles(t)).reshape(r.BANDS, r.ROWS) for t in texts]
    wanted = [(a, b) for a, b in combinations(range(len(texts)), 2) if jaccard(sets[a], sets[b]) >= 0.8 and (bands[a] == bands[b]).all(axis=1).any()]
    pairs = found(spark, texts)
    assert all(jaccard(sets[a], sets[b]) >= 0.8 for a, b in pairs)
    assert roots(len(texts), pairs) == roots(len(texts), wanted)
    assert len(wanted) > 3000 and len(pairs) < 3 * len(texts), (len(wanted), len(pairs))


def test_an_id_with_many_similar_texts(spark, monkeypatch):
    """Each text of an id is met with its own set, so 60 of them are 60 rows, and a neighbour of any is linked to the id."""
    rng = random.Random(9)
    base = [[f"w{rng.randrange(900)}" for _ in range(200)] for _ in range(60)]
    rows = [(7, " ".join(w), None, None, None) for w in base] + [(100 + i, " ".join(edited(rng, w, 1)), None, None, None) for i, w in enumerate(base)]
    docs, place = tables.located(documents(spark, rows).repartition(5))
    met, whole = [], r.meeting
    monkeypatch.setattr(r, "meeting", lambda rows, held, **more: met.append(rows.join(held, ["of", "at"]).count() - rows.count()) or whole(rows, held, **more))
    pairs = r.similar(docs, place, docs.select(r.F.col("doc_id").alias("of"), r.F.col(place).alias("place"))).collect()
    assert met == [0]
    assert {(p.low, p.high) for p in pairs} == {(7, 100 + i) for i in range(60)}


def test_a_bucket_of_leaders_is_met_by_pairs_of_lots(spark, monkeypatch):
    """Where nobody is sure of a leader, leaders don't get fewer; pairs of lots end it, and find the same pairs."""
    texts = corpus(random.Random(4), 2, 60, (1, 2), 100)
    docs = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)], clashing=False).select(r.F.col("doc_id").alias("of"), "text")
    rows = r.signatures(docs)
    whole = {tuple(x) for x in r.candidates(rows, sure=1.1).collect()}
    monkeypatch.setattr(r, "CHUNK", 5)
    assert {tuple(x) for x in r.candidates(rows, sure=1.1).collect()} == whole and len(whole) > 300


def test_near_dedup_with_a_similarity(spark):
    rng = random.Random(8)
    texts = corpus(rng, 6, 5, (0, 2)) + corpus(rng, 20, 1, (0, 0))
    rows = [(i, t, "en", None, None) for i, t in enumerate(texts)] + [(None, texts[0], "en", None, None), (500, texts[0], "en", None, None), (501, None, None, None, None), (502, "", None, None, None)]
    docs = documents(spark, rows)
    out = simhash.one_of_each(docs, similarity=0.8)
    assert out.columns == docs.columns
    assert sorted((x.doc_id for x in out.collect()), key=str) == sorted([*range(0, 30, 5), *range(30, 50), None, 501], key=str)
    assert simhash.one_of_each(documents(spark, []), similarity=0.8).count() == 0
