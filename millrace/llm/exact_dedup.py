"""Exact dedup by a minimal perfect hash over the distinct digests of a history.

1. A text's digest is SHA-256 of its UTF-8 bytes (null counts as empty), computed in the JVM.
2. `history` pre-aggregates documents to one row per distinct digest: the winner's locator (the largest doc_id) and
   the group's size. The partial aggregate runs before the shuffle, so a text that holds a third of all rows sends one
   row per task.
3. `build_slots` deals the digests into shards by their first bits (even, as SHA-256 is) and builds a minimal perfect
   hash for each: a pilot per bucket of about three digests sends the shard's n digests to the slots 0..n-1 without
   collision. A slot holds the full digest, the winner's locator and the size.
4. `look_up` sends each document to a lot of its shard, by a row number that was written with its digest. A shard has as
   many lots as its rows need, so copies of a hot text spread over many tasks whatever their ids, each with the shard's
   slots (bounded) beside a bounded number of rows. The document's slot is computed, and its 32 digest bytes are compared
   with those in the slot: equal is a member of the history.
5. Nonmembers, which any perfect hash sends to some slot too, fail that comparison. They are grouped among themselves in
   the same way, against the slots of their own digests.

Shards number at most MAX_SHARDS, so the table of lots that is broadcast has at most that many rows (some 20 MB). Beyond
MAX_SHARDS * SHARD_ROWS digests, half a billion, the slots of a shard grow in proportion to the digests: 200,000, some
10 MB, at fifty billion.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import located, stash, without_rows

MAX_SHARDS = 1 << 18
SHARD_ROWS = 2000  # digests a shard and rows a lot, while MAX_SHARDS allows it
BUCKET = 3  # mean digests a bucket
TRIES = 512  # pilots tried at once

_SLOTS = "shard int, n int, pilots binary, digests binary, winners binary, sizes binary"


def digests(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id and digest (binary) of each row, and row: the column named so, or a number. A null text counts as empty."""
    digest = F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    number = F.col(row) if row else F.monotonically_increasing_id()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest"), number.alias("row"))


def history(rows: DataFrame) -> DataFrame:
    """A row per distinct digest: winner (largest doc_id; null if all are null) and size."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("size"))


def _words(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), dtype="<u8").reshape(-1, 4)


def _places(low: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    """Slot of a digest word under a pilot: a 64-bit mix, then modulo the slots. Both arguments broadcast."""
    with np.errstate(over="ignore"):
        x = (low ^ (pilots.astype("u8") * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(n)).astype(np.int64)


def pilots_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pilots by bucket, slot by digest) for n distinct digests, n >= 1; a negative pilot -s-1 names slot s itself."""
    n = len(words)
    buckets = n // BUCKET + 1
    bucket = (words[:, 2] % np.uint64(buckets)).astype(np.int64)
    pilots, slots, taken = np.zeros(buckets, np.int64), np.empty(n, np.int64), np.zeros(n, bool)
    order = np.argsort(bucket, kind="stable")
    starts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    sizes = np.diff(starts)
    largest_first = np.argsort(-sizes, kind="stable")
    free = None
    for b in largest_first[: np.count_nonzero(sizes)]:
        own = order[starts[b] : starts[b + 1]]
        if len(own) == 1:  # all larger buckets are placed: the rest take what is free
            if free is None:
                free = iter(np.flatnonzero(~taken))
            s = next(free)
            pilots[b], slots[own[0]] = -s - 1, s
            continue
        first = 0
        while True:
            tried = np.arange(first, first + TRIES)
            at = np.sort(_places(words[own, 3][None, :], tried[:, None], n), axis=1)
            fits = ~taken[at].any(axis=1) & (np.diff(at, axis=1) > 0).all(axis=1)
            if fits.any():
                pilots[b] = p = first + int(np.argmax(fits))
                slots[own] = _places(words[own, 3], np.full(len(own), p), n)
                taken[slots[own]] = True
                break
            first += TRIES
    return pilots, slots


def slot_of(words: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    """The slot each digest would have, member or not."""
    p = pilots[(words[:, 2] % np.uint64(len(pilots))).astype(np.int64)]
    return np.where(p < 0, -p - 1, _places(words[:, 3], np.maximum(p, 0), n))


def _build(rows: pa.Table) -> pa.Table:
    raw = rows["digest"].to_pylist()
    words = _words(raw)
    pilots, slots = pilots_of(words)
    held = np.empty_like(words)
    held[slots] = words
    of = {name: np.empty(len(raw), np.int64) for name in ("winner", "size")}
    of["winner"][slots] = rows["winner"].fill_null(0).to_numpy()
    of["size"][slots] = np.where(rows["winner"].is_null().to_numpy(), -1, 1) * rows["size"].to_numpy()  # below zero: no id in the group
    return pa.table({
        "shard": pa.array([rows["shard"][0].as_py()], pa.int32()), "n": pa.array([len(raw)], pa.int32()), "pilots": [pilots.astype("<i8").tobytes()],
        "digests": [held.tobytes()], "winners": [of["winner"].tobytes()], "sizes": [of["size"].tobytes()],
    })


def _shard(shards: int):
    """The first 32 bits of the digest, scaled to the shards."""
    return F.shiftright(F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long") * shards, 32).cast("int")


def build_slots(past: DataFrame, n: int) -> tuple[DataFrame, int]:
    """(a row of slots for each shard, number of shards) for a history of n rows."""
    shards = int(min(MAX_SHARDS, n // SHARD_ROWS + 1))
    return past.withColumn("shard", _shard(shards)).groupBy("shard").applyInArrow(_build, _SLOTS), shards


def _find(rows: pa.Table, held: pa.Table) -> pa.Table:
    count = rows.num_rows
    winner, size, member = np.zeros(count, np.int64), np.zeros(count, np.int64), np.zeros(count, bool)
    if count and held.num_rows:
        one = {k: held[k][0].as_py() for k in ("n", "pilots", "digests", "winners", "sizes")}
        words = _words(rows["digest"].to_pylist())
        at = slot_of(words, np.frombuffer(one["pilots"], "<i8"), one["n"])
        member = (np.frombuffer(one["digests"], "<u8").reshape(-1, 4)[at] == words).all(axis=1)
        winner, size = np.frombuffer(one["winners"], "<i8")[at], np.frombuffer(one["sizes"], "<i8")[at]
    winner, size = pa.array(winner, mask=size < 0), np.abs(size)
    return pa.table({"row": rows["row"], "doc_id": rows["doc_id"], "digest": rows["digest"], "member": member, "winner": winner, "size": size})


def look_up(rows: DataFrame, slots: DataFrame, shards: int) -> DataFrame:
    """row, doc_id, digest, member, winner and size of each of the rows; the last two mean nothing where member is false."""
    dealt = rows.withColumn("shard", _shard(shards))
    per_lot = F.lit(SHARD_ROWS) if shards < MAX_SHARDS else F.greatest(F.lit(SHARD_ROWS), F.max("n_slots"))
    counted = dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows")).join(slots.select("shard", F.col("n").alias("n_slots")), "shard", "left")
    lots = counted.groupBy("shard").agg(F.ceil(F.max("n_rows") / per_lot).cast("int").alias("lots"))  # at most MAX_SHARDS rows
    lots = F.broadcast(lots)
    left = dealt.join(lots, "shard").withColumn("lot", F.pmod(F.xxhash64("row"), F.col("lots")).cast("int")).drop("lots")
    right = slots.join(lots, "shard").withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1))).drop("lots")
    return left.groupBy("shard", "lot").cogroup(right.groupBy("shard", "lot")).applyInArrow(_find, f"row {rows.schema['row'].dataType.simpleString()}, doc_id long, digest binary, member boolean, winner long, size long")


def _against(rows: DataFrame, past: DataFrame) -> DataFrame:
    """Numbered rows looked up in a stashed history, stashed."""
    slots, shards = build_slots(past, past.count())
    return stash(look_up(rows, stash(slots, "slots"), shards), "lookups")


def exact_dedup(docs: DataFrame, past: DataFrame | None = None, row: str | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest and row for every row of docs.

    `row` names a column that tells rows apart, to be returned under that name; without it rows are numbered.

    `past` is a history of digests as `history` makes it; without one the history is that of docs, so that every row is
    a member. Against an older history, the winner of a member's group is the older one, which isn't in docs, and
    group_size counts the older rows only.

    Null texts equal empty ones; texts of any length have one digest, so a very long text costs its own reading only.
    Ties: rows that repeat a doc_id are copies that share one verdict, and those of the winner are all kept. A null doc_id
    never wins over another; a group of null ids only has a null keep_id and kept is true, unless it is an older one. An
    empty table gives an empty result. Columns of docs other than doc_id and text, whatever their names, are not looked at.
    """
    rows = stash(digests(docs, row), "digests")
    found = _against(rows, stash(history(rows) if past is None else past, "history"))
    result = lambda df, kept: df.where("member").select("row", "doc_id", "digest", F.col("winner").alias("keep_id"), F.col("size").alias("group_size"), kept.alias("kept"))
    own = F.col("doc_id").eqNullSafe(F.col("winner"))
    if past is None:
        return result(found, own)
    others = found.where("not member").select("row", "doc_id", "digest")
    among = _against(others, stash(history(others), "history"))  # with the same split of hot texts
    return result(found, own & F.col("doc_id").isNotNull()).unionByName(result(among, own))


def first_copies(docs: DataFrame) -> DataFrame:
    """Rows of docs, columns as they are, less each row that is an exact copy of the winner of its group.

    Losers are dropped by their place in docs' files, so texts stay where they are, however many are dropped. Rows without a
    doc_id stay. Nulls, empty and long texts, ties and repeated rows are as in `exact_dedup`: rows that repeat the
    winner's doc_id and text all stay. An empty table gives an empty result; other columns are kept and not looked at.
    """
    docs, place = located(docs)
    losers = exact_dedup(docs, row=place).where("not kept and doc_id is not null").select(F.col("row").alias("place"))
    return without_rows(docs, place, losers)
