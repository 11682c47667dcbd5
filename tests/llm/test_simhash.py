import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from support import LONG, ROWS, documents, empty

from millrace.llm import simhash as s


def plain_fingerprint(text, width=4):
    """Bit by bit, as the definition has it."""
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, distance=4):
    fps = [(d, plain_fingerprint(t)) for d, t, *_ in rows]
    ids = sorted({d for d, _ in fps if d is not None})
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    known = [(d, f) for d, f in fps if d is not None]
    for i, (a, x) in enumerate(known):
        for b, y in known[i + 1 :]:
            if (x ^ y).bit_count() <= distance:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted([(d, f"{f:016x}", find(d) if d is not None else None) for d, f in fps], key=str)


def rows_of(df):
    return sorted([(r.doc_id, r.fingerprint, r.component_id) for r in df.collect()], key=str)


def test_fingerprint():
    for text in [None, "", " \n", "one", "A b C", "a b c d", "a b c d e", "a b c d a b c d a b", "É A b ☃ d e", "x " * 500]:
        assert s.fingerprint(text) == plain_fingerprint(text), text
    assert s.fingerprint(LONG[:100_000]) == plain_fingerprint(LONG[:100_000])
    assert s.fingerprint("") == 0


def test_odd_rows(spark):
    assert rows_of(s.near_dedup(documents(spark))) == brute(ROWS)
    assert s.near_dedup(empty(spark)).count() == 0


def near_copies(n, seed=0):
    rng = random.Random(seed)
    rows, base = [], [f"w{rng.randrange(3000)}" for _ in range(60)]
    for i in range(n):
        words = list(base) if i % 3 else [f"w{rng.randrange(3000)}" for _ in range(30)]
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
        rows.append((1000 - i, " ".join(words), None, None, None))
    return rows + [(2000, None, None, None, None), (2001, "", None, None, None)]


@pytest.mark.parametrize("chunk", [2048, 16])
def test_near_copies_match_all_pairs(spark, monkeypatch, chunk):
    """Also with buckets cut into many chunks."""
    monkeypatch.setattr(s, "CHUNK", chunk)
    rows = near_copies(400)
    assert rows_of(s.near_dedup(documents(spark, rows))) == brute(rows)


def hot_fingerprints(n, seed=5):
    """n different fingerprints that share the first 13 bits, so that one bucket holds them all; some in close groups."""
    rng = np.random.default_rng(seed)
    top = np.uint64(0x5A5) << np.uint64(51)
    base = rng.integers(0, 1 << 51, n // 2, np.uint64)
    near = rng.choice(base, n - n // 2) ^ (np.uint64(1) << rng.integers(0, 51, n - n // 2, np.uint64)) ^ (np.uint64(1) << rng.integers(0, 51, n - n // 2, np.uint64))
    return np.unique(np.concatenate([base, near]) | top)


@pytest.mark.parametrize("chunk", [16, 2048])
def test_a_hot_bucket_matches_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(s, "CHUNK", chunk)
    fp = hot_fingerprints(6000 if chunk == 2048 else 1200)
    n = len(fp)
    near = [np.flatnonzero(np.bitwise_count(fp[i] ^ fp[i + 1 :]) <= 4) + i + 1 for i in range(n)]
    wanted = s._roots(n, np.repeat(np.arange(n), [len(b) for b in near]), np.concatenate(near))
    reps = s.stash(spark.createDataFrame([(int(x.astype(np.int64)), i) for i, x in enumerate(fp)], "fp long, rep long"), "test")
    found = {r.id: r.component for r in s.components(s.links(reps, n)).collect()}
    assert [found.get(i, i) for i in range(n)] == wanted.tolist()


def test_a_hot_bucket_gives_rows_in_proportion(spark, monkeypatch):
    """Rows sent to verification grow with the bucket, not with its square."""
    sent, monkey = [], monkeypatch
    for n in (4000, 16_000):
        fp = hot_fingerprints(n, 8)
        reps = s.stash(spark.createDataFrame([(int(x.astype(np.int64)), i) for i, x in enumerate(fp)], "fp long, rep long"), "test")
        monkey.setattr(s, "spanning", lambda key, fp, rep, distance: (np.full(1, len(key)), np.full(1, -1 - hash(tuple(key[:3])) % 1_000_000_007)))
        sent.append(sum(r.low for r in s.links(reps, len(fp)).collect()) / len(fp))
    assert sent[1] < 1.5 * sent[0]


def test_hot_fingerprints_need_no_shuffle_of_their_rows(spark):
    rows = [(i, "the same words again and again", None, None, None) for i in range(4000)] + [(5000 + i, f"a{i} b{i} c{i} d{i} e{i}", None, None, None) for i in range(1500)] + [(None, "the same words again and again", None, None, None)] * 500
    found = Counter(r.component_id for r in s.near_dedup(documents(spark, rows, clashing=False)).collect())
    assert found[0] == 4000 and found[None] == 500 and len(found) == 1502


def test_a_doc_id_with_two_texts(spark):
    rows = [(5, "a b c d e f g", None, None, None), (5, "totally other words stand here now", None, None, None), (3, "a b c d e f g", None, None, None), (9, "totally other words stand here now", None, None, None)]
    assert {r.component_id for r in s.near_dedup(documents(spark, rows)).collect()} == {3}


@pytest.mark.parametrize("blocks", [5, 6, 7, 8])
def test_some_key_is_shared(blocks):
    rng = random.Random(blocks)
    keys = s.block_keys(blocks, 4)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), 4):
            y ^= 1 << b
        assert any(x & k == y & k for k in keys)


def test_more_blocks_give_the_same_links():
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 63, 20, np.uint64)
    fp = np.unique(np.concatenate([centre ^ (np.uint64(1) << rng.integers(0, 64, 20, np.uint64)) for _ in range(12)]))
    rep = np.arange(len(fp))
    a, b = np.nonzero(np.triu(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4, 1))
    wanted = s._roots(len(fp), a, b)
    for blocks in (5, 7):
        low, high = zip(*(s.spanning((fp & np.uint64(k)).view(np.int64), fp, rep, 4) for k in s.block_keys(blocks, 4)), strict=True)
        assert (s._roots(len(fp), np.concatenate(low), np.concatenate(high)) == wanted).all()


def test_components_of_a_long_chain(spark):
    n = 60
    order = random.Random(1).sample(range(n), n)
    pairs = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(100, 101), (102, 101)], "low long, high long")
    found = {r.id: r.component for r in s.components(pairs).collect()}
    assert found == {**{i: 0 for i in range(1, n)}, 101: 100, 102: 100}


def test_blocks_grow_with_the_count():
    assert s.blocks_for(10**5, 4) == 5 and s.blocks_for(10**9, 4) > 5


def test_filter(spark):
    docs = documents(spark, [(1, "a b c d e f", None, None, None), (2, "A b c d e f", None, None, None), (None, "a b c d e f", None, None, None), (7, "q", None, None, None)])
    out = s.one_of_each(docs)
    assert out.columns == docs.columns and sorted([r.doc_id for r in out.collect()], key=str) == [1, 7, None]
