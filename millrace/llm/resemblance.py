"""Links between texts that share most of their shingles: an aid of near-dedup where fingerprints of few bits are too strict.

1. `signatures`: one pass over whole texts. A-Z is lower-cased, words are runs other than ASCII white space, a shingle is five
   words, its hash is XXH64. BANDS * ROWS minima of the hashes, each under a mix of its own, are the signature; a band is the
   hash of ROWS minima. Texts of a resemblance of 0.8 share one of ten bands of five with a chance of 0.98.
2. Texts meet in the bucket of a band, beside their shingle sets. Every pair of a bucket that others don't join yet is
   verified there, the best of each component first by a byte of each minimum, and a spanning forest of the pairs of a Jaccard
   similarity of at least 0.8 goes on: at most one row a text, however many pairs are similar, and no link is lost.
3. A bucket over CHUNK rows or LOT_BYTES of sets is dealt to lots, and each pair of lots meets in a task of its own. There a lot's
   own components come first, so that only links between components of two lots are added to those of the lots themselves. No
   pair is left out, and no task is unbounded.
"""
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import marked, slices, stash

WIDTH, SIMILARITY = 5, 0.8
BANDS, ROWS = 10, 5
SURE, LIKELY = 0.84, 0.68  # shares of the signature, where pairs aren't verified: of texts at 0.8 some 2 % agree in less than LIKELY
CHUNK = 2048  # rows of a bucket in a lot
LOT_BYTES = 16 << 20  # of shingle sets in a lot, about
GROUP_ROWS, GROUP_BYTES = 4096, 32 << 20  # rows and bytes of sets of all buckets in a task's group, about
PIECE = 4096  # hashes mixed at once

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = np.random.default_rng(1).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = np.random.default_rng(2).integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; of fewer words the whole sequence; empty without words."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    starts = np.concatenate(([0], ends[:-width])).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], 42) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)], np.uint64))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least hash under each mix."""
    out = np.full(len(_MIX), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), PIECE):
            x = (hashes[at : at + PIECE, None] ^ _SHIFT) * _MIX
            out = np.minimum(out, (x ^ (x >> np.uint64(32))).min(axis=0))
    return out


def _texts(docs: DataFrame, place: str, rows: DataFrame) -> DataFrame:
    """of (doc_id), text and at (which of an id's texts) of the rows of docs whose place is among `rows`."""
    docs = docs.select(F.col("doc_id").cast("long").alias("of"), F.col("text").cast("string").alias("text"), F.col(place).alias("place"))
    return marked(docs, "place", rows, "wanted").where("wanted").select("of", "text", F.xxhash64("place").alias("at"))


def signatures(texts: DataFrame) -> DataFrame:
    """of, at, key, bytes and size (bytes of the shingle set) for each band of each row (of, text, at if an id has many) with a word."""

    def run(batches):
        for batch in slices(batches, 200):
            ids, ats, keys, own, sizes = [], [], [], [], []
            for i, text, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = shingles(text)
                if len(found):
                    s = signature(found)
                    low = (s & np.uint64(255)).astype(np.uint8).tobytes()
                    for band in range(BANDS):
                        keys.append(xxhash.xxh64_intdigest(s[band * ROWS : (band + 1) * ROWS].tobytes(), band))
                    ids += [i] * BANDS
                    ats += [at] * BANDS
                    own += [low] * BANDS
                    sizes += [found.nbytes] * BANDS
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ats, pa.int64()), pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(own, pa.binary()), pa.array(sizes, pa.int64())], names=["of", "at", "key", "bytes", "size"])

    return texts.select("of", "text", "at" if "at" in texts.columns else F.lit(0).cast("long").alias("at")).mapInArrow(run, "of long, at long, key long, bytes binary, size long")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """of, at and held (the bytes of its sorted shingle hashes) of each row (of, text, at)."""

    def run(batches):
        for batch in slices(batches, 200):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(t).tobytes() for t in batch.column(1).to_pylist()], pa.binary()), batch.column(2)], names=["of", "held", "at"])

    return texts.select("of", "text", "at").mapInArrow(run, "of long, held binary, at long")


def joining(of: np.ndarray, own: np.ndarray, held: list[np.ndarray] | None = None, side: np.ndarray | None = None, sure: float = SURE, least: float = SIMILARITY) -> list[tuple[int, int]]:
    """Pairs that join what is similar among the rows of one lot, or among those of two lots, told apart by `side`.

    With shingle sets (`held`) these are links, a spanning forest of all pairs of a similarity of at least `least`. Without, pairs
    are judged by the signature: a forest of those that surely agree, and every likely pair of what this doesn't join. Of
    two lots only pairs of one with the other are given, and only if neither lot joins them by itself.
    """
    root, out = np.arange(len(of)), []
    if held is not None:
        sizes = np.array([len(h) for h in held])
        ids = np.split(np.unique(np.concatenate(held), return_inverse=True)[1].astype(np.int32), np.cumsum(sizes)[:-1])
        marks = np.zeros(sizes.sum(), bool)

    def alike(i: int, others: np.ndarray, agree: np.ndarray) -> np.ndarray:
        if held is None:
            return agree[others] >= sure
        marks[ids[i]] = True
        both = np.add.reduceat(marks[np.concatenate([ids[k] for k in others])], np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
        marks[ids[i]] = False
        return (both > 0) & (both >= least * (sizes[i] + sizes[others] - both))

    def apart(i: int, across: bool) -> tuple[np.ndarray, np.ndarray]:
        """Earlier rows that may be similar and are not joined with row i, those that agree most first; and how much all agree."""
        agree = (own[:i] == own[i]).mean(axis=1)
        may = agree >= LIKELY if held is None else least * np.maximum(sizes[:i], sizes[i]) <= np.minimum(sizes[:i], sizes[i])
        may &= root[:i] != root[i]
        if side is not None:
            may &= (side[:i] != side[i]) == across
        others = np.flatnonzero(may)
        return others[np.argsort(-agree[others], kind="stable")], agree

    each = lambda others: others[np.unique(root[others], return_index=True)[1]]  # the first of each component
    for across in (False,) if side is None else (False, True):
        for i in range(1, len(of)):
            others, agree = apart(i, across)
            for narrow in (True, False):
                others = others[root[others] != root[i]]
                if not len(others):
                    break
                tried = each(others) if narrow else others
                for k in each(tried[alike(i, tried, agree)]).tolist():
                    if across or side is None:
                        out.append((of[k], of[i]))
                    low, high = sorted((root[k], root[i]))
                    root[root == high] = low
    if held is None:
        out += [(of[k], of[i]) for i in range(1, len(of)) for k in apart(i, side is not None)[0].tolist()]
    return out


def _met(rows: pa.Table, sure: float, least: float) -> pa.Table:
    """Distinct pairs (a, b) of a group of lots."""
    key, lot, of = (rows[c].to_numpy() for c in ("key", "lot", "of"))
    own = np.frombuffer(b"".join(rows["bytes"].to_pylist()), np.uint8).reshape(-1, len(_MIX))
    side, pairs = rows["side"].to_numpy(), set()
    order = np.lexsort((of, lot, key))
    begins = np.flatnonzero(np.concatenate(([True], (np.diff(key[order]) != 0) | (np.diff(lot[order]) != 0)))) if len(order) else np.zeros(0, np.int64)
    for a, b in zip(begins, [*begins[1:], len(order)], strict=True):
        part = order[a:b]
        if b - a > 1:
            held = [np.frombuffer(h, np.uint64) for h in rows["held"].take(pa.array(part)).to_pylist()] if "held" in rows.column_names else None
            found = joining(of[part], own[part], held, side[part] if side[part[0]] >= 0 else None, sure, least)
            pairs |= {(min(p), max(p)) for p in found}  # bands of one group find the same
    pairs = sorted(pairs)
    return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})


def in_buckets(rows: DataFrame) -> DataFrame:
    """The rows of `signatures` that share a key with another, with the number of lots that their bucket is dealt to."""
    rows = stash(rows, "bands")
    counted = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).where("n > 1")
    lots = F.ceil(F.greatest(F.col("n") / CHUNK, F.col("bytes") / LOT_BYTES)).cast("int")
    return stash(rows.join(counted.select("key", lots.alias("lots")), "key"), "buckets")


def meeting(rows: DataFrame, held: DataFrame | None = None, sure: float = SURE, least: float = SIMILARITY) -> DataFrame:
    """Distinct (a, b), a < b, that `joining` gives of the rows of `in_buckets`, beside the sets `held` (of, at, held) if given."""
    total, size = rows.agg(F.sum("lots"), F.sum(F.col("size") * F.col("lots"))).first()
    if not total:
        return rows.select(F.col("of").alias("a"), F.col("of").alias("b")).limit(0)
    groups = -(-total // GROUP_ROWS) if held is None else max(-(-total // GROUP_ROWS), -(-size // GROUP_BYTES))
    own = F.pmod(F.xxhash64("of"), F.col("lots")).cast("long")
    meet = F.transform(F.sequence(F.lit(0), F.col("lots") - 1), lambda j: F.struct((F.least(own, j) * F.col("lots") + F.greatest(own, j)).alias("lot"), F.when(own == j, F.lit(-1)).otherwise((own > j).cast("int")).alias("side")))
    columns = ["key", "of", "bytes"] if held is None else ["key", "of", "bytes", "held"]
    dealt = (rows if held is None else rows.join(held, ["of", "at"])).select(*columns, F.explode(meet).alias("m")).select(*columns, "m.lot", "m.side")
    met = dealt.groupBy(F.pmod(F.xxhash64("key", "lot"), F.lit(groups))).applyInArrow(lambda rows: _met(rows, sure, least), "a long, b long")
    return met.where("a <> b").distinct()


def candidates(rows: DataFrame, sure: float = SURE) -> DataFrame:
    """Distinct (a, b), a < b, of the rows of `signatures`, judged by the signatures alone, for a caller who verifies them.

    A pair that surely agrees stands for others between the same texts' neighbours; `similar` verifies and needs no such guess.
    """
    return meeting(in_buckets(rows), sure=sure)


def similar(docs: DataFrame, place: str, rows: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """low and high of pairs of doc_ids whose texts are similar, enough to join all similar ones that share a band.

    `rows` has one doc_id (of) and place in docs for each text to be looked at. Texts without a word are similar to none.
    Texts in buckets are read again where they are, for their shingle sets.
    """
    rows = stash(rows.select("of", "place"), "looked-at")
    met = in_buckets(signatures(_texts(docs, place, rows.select("place"))))
    wanted = rows.join(met.select("of").distinct(), "of").select("place")
    held = stash(shingle_sets(_texts(docs, place, wanted)), "shingle-sets")
    return meeting(met, held, least=least).select(F.col("a").alias("low"), F.col("b").alias("high"))
