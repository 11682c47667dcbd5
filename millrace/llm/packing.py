"""Packing documents into training sequences by best-fit decreasing.

1. `pieces`: each whole text becomes ids and an end id, cut into full windows and a remainder: a piece only ever is a
   cut one if its document is overlong. Rows carry positions and a checksum, not ids.
2. Pieces are dealt to groups by a hash of the row number they were written with: no source, document, repeated or null
   doc_id makes a hot group. A group has a bounded number of pieces, whatever the input's size.
3. In a group, pieces go in by falling length. A segment tree over remaining capacities finds the tightest open window
   that holds the piece; without one a new window opens.

Groups are independent, so a lost executor costs its groups only, and each group leaves about one window part empty.
"""
import zlib
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import numbered, slices, stash
from millrace.llm.word_bpe import word_bpe

WINDOW = 4096
END_ID = 2
GROUP_PIECES = 2000

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of each piece, and its ids on request. A null text is as empty."""

    def run(batches):
        bpe, end = word_bpe(tokenizer_path), np.array([end_id], "<u4").tobytes()
        for batch in slices(batches):
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = bpe.encode(text) + end
                total = len(raw) // 4
                for start in range(0, total, window):
                    part = raw[4 * start : 4 * (start + window)]
                    row = (doc, start, len(part) // 4, zlib.crc32(part), total)
                    out.append((*row, np.frombuffer(part, "<u4").tolist()) if with_ids else row)
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(kinds)]) if out else pa.RecordBatch.from_arrays([pa.array([], k) for k in kinds], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(kinds)])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, _PIECES + ", ids array<long>" * with_ids)


class Capacities:
    """Segment tree over remaining capacities 0..window: a leaf says how many open windows have that capacity left."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: dict[int, list[int]] = {}

    def _add(self, capacity: int, n: int) -> None:
        at = capacity + self.leaves
        while at:
            self.count[at] += n
            at >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.windows.setdefault(capacity, []).append(window)
        self._add(capacity, 1)

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Takes out a window with the least capacity of at least `length`: (capacity, window)."""
        at, count = length + self.leaves, self.count
        while not count[at]:
            while at & 1:  # a right child: nothing further right under this parent
                at >>= 1
            if not at:
                return None
            at += 1  # the sibling to the right
            if not at & (at - 1):
                return None
        while at < self.leaves:
            at *= 2
            if not count[at]:
                at += 1
        self._add(at - self.leaves, -1)
        return at - self.leaves, self.windows[at - self.leaves].pop()


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> tuple[list[int], list[int], int]:
    """(window, offset) of each length, in the order given, and the number of windows. Equal lengths keep their order."""
    where, offset, opened, tree = [0] * len(lengths), [0] * len(lengths), 0, Capacities(window)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.tightest(lengths[i])
        if found is None:
            found, opened = (window, opened), opened + 1
        left, where[i] = found
        offset[i] = window - left
        if left > lengths[i]:
            tree.put(left - lengths[i], where[i])
    return where, offset, opened


def pack(cut: DataFrame, n: int, window: int = WINDOW) -> DataFrame:
    """`cut` (n stashed pieces with their numbers, row) with sequence_id and offset in the place of row."""
    groups = max(1, ceil(n / GROUP_PIECES))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.drop("row").schema)

    def place(rows: pa.Table) -> pa.Table:
        group = rows["g"][0].as_py()
        rows = rows.drop(["g"]).sort_by([("length", "descending"), ("row", "ascending")]).drop(["row"])
        where, offset, _ = best_fit_decreasing(rows["length"].to_pylist(), window)
        return rows.append_column("sequence_id", pa.array(np.array(where, np.int64) + (group << 32))).append_column("offset", pa.array(offset, pa.int64()))

    dealt = cut.withColumn("g", F.pmod(F.xxhash64("row"), F.lit(groups)))
    return dealt.groupBy("g").applyInArrow(place, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is its end id alone; a very long one is cut into full windows and a rest, read as a whole. Rows
    that repeat a doc_id are packed once each, and a null doc_id is kept. Ties: pieces of equal length go in the order of
    their rows. An empty table gives no piece. Other columns of docs, whatever their names, are not looked at. A window's
    padding comes after its pieces.
    """
    cut = stash(numbered(pieces(docs, tokenizer_path, window, end_id, with_ids)), "pieces")
    return pack(cut, cut.count(), window)
