import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from support import ROWS, documents, empty
from tokenizers import Tokenizer

from millrace.llm import packing as p

WORDS = public_tokenizers.path("word_bpe_49k.json")


def plain_best_fit(lengths, window):
    left, where = [], []
    for n in sorted(lengths, reverse=True):
        fits = [(c, i) for i, c in enumerate(left) if c >= n]
        if fits:
            left[min(fits)[1]] -= n
        else:
            left.append(window - n)
    return sorted(left)


def test_best_fit_decreasing():
    rng = random.Random(2)
    for window in (1, 7, 64, 4096):
        for n in (0, 1, 5, 200):
            lengths = [rng.randint(1, window) for _ in range(n)]
            where, offset, opened = p.best_fit_decreasing(lengths, window)
            used = defaultdict(list)
            for w, o, k in zip(where, offset, lengths, strict=True):
                used[w].append((o, k))
            assert len(used) == opened
            for parts in used.values():
                at = 0
                for o, k in sorted(parts):
                    assert o == at
                    at += k
                assert at <= window
            assert sorted(window - sum(k for _, k in parts) for parts in used.values()) == plain_best_fit(lengths, window)


def check(out, rows, window):
    library = Tokenizer.from_file(WORDS)
    ids = defaultdict(list)
    for d, t, *_ in rows:
        ids[d].append(library.encode(t or "", add_special_tokens=False).ids + [2])
    assert sum(r.length for r in out) == sum(len(i) for copies in ids.values() for i in copies)
    by_sequence = defaultdict(list)
    for r in out:
        assert 0 < r.length <= window
        assert any(r.doc_tokens == len(i) and r.ids_crc32 == zlib.crc32(np.array(i[r.start : r.start + r.length], "<u4").tobytes()) for i in ids[r.doc_id])
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return by_sequence


def test_odd_rows(spark):
    check(p.pack_documents(documents(spark), WORDS).collect(), ROWS, 4096)
    check(p.pack_documents(documents(spark), WORDS, window=16).collect(), ROWS, 16)
    assert p.pack_documents(empty(spark), WORDS).count() == 0


def test_many_groups_keep_padding_small(spark, monkeypatch):
    rows = [(i, " ".join(["river"] * (1 + i * 7919 % 400)), None, None, None) for i in range(3000)]
    monkeypatch.setattr(p, "GROUP_PIECES", 500)
    found = check(p.pack_documents(documents(spark, rows), WORDS, window=512).collect(), rows, 512)
    assert len({s >> 32 for s in found}) > 3
    used = sum(n for parts in found.values() for _, n in parts)
    assert used > 0.97 * 512 * len(found)


def test_with_ids(spark):
    out = p.pack_documents(documents(spark, ROWS[:5]), WORDS, with_ids=True).collect()
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in out)


@pytest.mark.parametrize("doc_id", [None, 7])
def test_equal_ids_make_no_hot_group(spark, doc_id):
    n = 30_000
    cut = spark.range(n).select(p.F.lit(doc_id).cast("long").alias("doc_id"), p.F.lit(0).cast("long").alias("start"), (1 + p.F.col("id") % 9).alias("length"))
    out = p.pack(p.stash(p.numbered(cut.repartition(6)), "test"), n, 64)
    groups = Counter(r.sequence_id >> 32 for r in out.select("sequence_id").collect())
    assert sum(groups.values()) == n and len(groups) == 15 and max(groups.values()) < 1.3 * p.GROUP_PIECES
