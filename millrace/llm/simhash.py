"""SimHash near-dedup: fingerprints, pigeonhole blocks, verified Hamming distance, components.

1. `fingerprints`: one pass over whole texts in Arrow batches. A-Z is lower-cased, words are runs other than ASCII white
   space, a feature is a shingle of `width` words (repeats count), its hash is XXH64 of the UTF-8 bytes. A fingerprint
   bit is 1 where over half the hashes have it.
2. Equal fingerprints collapse to one row (smallest doc_id) before anything is joined, so thousands of copies are one.
3. `links`: with fingerprints cut into b blocks, two that differ in at most d < b bits agree on some b - d blocks
   entirely. Each choice of b - d blocks is a key; rows meet in the bucket of a key, and there every pair's distance is
   verified. b grows with the count so that a bucket's mean stays small; any b gives the same links.
   Buckets are dealt to groups of bounded size. A bucket over CHUNK rows is split: its rows differ in the other bits
   only, so these are cut into blocks of their own, enough that a bucket of a finer key has about CHUNK / 16 rows, and
   rows meet there. The distance still leaves one choice of blocks alike, so no pair is lost, and a bucket of n rows gives
   some multiple of n rows, not of its square. What is over CHUNK even then is cut into chunks, and each pair of chunks
   is a lot of its own: no task holds more than two chunks, and no pair is left out.
   A lot gives a spanning forest of its links (at most one row a member), never all pairs.
4. `components`: large-star and small-star rounds over those links, each cut into the shared folder.
"""
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.resemblance import similar
from millrace.llm.tables import forget, located, slices, stash, without_rows

SEED = 42
BITS = 64
CHUNK = 2048  # rows of one bucket in one lot, half
GROUP_ROWS = 2048  # rows of all buckets in one group, about
BUCKET_MEAN = 256  # mean rows a bucket before more blocks are used
HOT = 1000  # a fingerprint of more than one in so many rows is joined by broadcast

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, width: int = 4) -> int:
    """Unsigned fingerprint of one text; zero without words, and for null."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-width])).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 4, place: str | None = None) -> DataFrame:
    """doc_id and fp (signed long with the fingerprint's bits) of every row, and place: the binary column named so, or null."""

    def run(batches):
        forget()
        for batch in slices(batches):
            found = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], "<u8").view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), batch.column(2)], names=["doc_id", "fp", "place"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (F.col(place) if place else F.lit(None).cast("binary")).alias("place"))
    return rows.mapInArrow(run, "doc_id long, fp long, place binary")


def block_keys(blocks: int, distance: int, within: int = (1 << BITS) - 1) -> list[int]:
    """A mask of the bits of `within` for each choice of blocks of them that a pair within the distance may share."""
    bits = [1 << b for b in range(BITS) if within >> b & 1]
    cuts = [round(len(bits) * i / blocks) for i in range(blocks + 1)]
    masks = [sum(bits[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(masks, blocks - distance)]


def blocks_for(n: int, distance: int, bits: int = BITS, mean: int = BUCKET_MEAN, most: int = 16) -> int:
    """Fewest blocks of the bits whose shortest key leaves `mean` of n rows in a bucket, within `most` blocks."""
    for blocks in range(distance + 1, most):
        if n <= mean << (bits // blocks * (blocks - distance)):
            return blocks
    return most


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each of 0..n-1 over the undirected pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while (new != (to := new[new])).any():
            new = to
        if (new == root).all():
            return root
        root = new


def spanning(key: np.ndarray, fp: np.ndarray, rep: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (root, member) that join whatever is within the distance under an equal key; one a member at most."""
    order = np.lexsort((rep, key))
    key, fp, rep = key[order], fp[order], rep[order]
    new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    longest = int(np.diff(np.append(starts, len(key))).max(initial=0))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    root = np.arange(len(key))
    live = np.arange(len(key))
    held = 0
    for step in range(1, longest):
        live = live[live + step < len(key)]
        live = live[key[live] == key[live + step]]
        near = live[np.bitwise_count(fp[live] ^ fp[live + step]) <= distance]
        near = near[root[near] != root[near + step]]
        left.append(near)
        right.append(near + step)
        held += len(near)
        if held > 4 * len(key):  # fold what is joined, so that links held stay in proportion to the members
            a, b = np.concatenate(left), np.concatenate(right)
            root = _roots(len(key), np.concatenate((a, np.arange(len(key)))), np.concatenate((b, root)))
            left, right, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    a, b = np.concatenate(left), np.concatenate(right)
    root = _roots(len(key), np.concatenate((a, np.arange(len(key)))), np.concatenate((b, root)))
    moved = np.flatnonzero(root != np.arange(len(key)))
    return rep[root[moved]], rep[moved]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _finer(keys: list[int], distance: int):
    """For a row of a bucket of n rows (t: its key's place in keys) the finer keys that it is sent to."""
    widths = range(distance + 1, distance + 4)
    wanted = F.lit(widths[-1])
    for blocks in reversed(widths[:-1]):
        least = min(BITS - k.bit_count() for k in keys) // blocks * (blocks - distance)
        wanted = F.when(F.col("n") <= (CHUNK // 16) << least, F.lit(blocks)).otherwise(wanted)
    masks = F.array(*(
        F.array(*(F.array(*(F.lit(_signed(m)).cast("long") for m in block_keys(blocks, distance, ~k & ((1 << BITS) - 1)))) for blocks in widths))
        for k in keys
    ))
    own = F.element_at(F.element_at(masks, F.col("t") + 1), wanted - distance)
    return F.transform(own, lambda m, i: F.xxhash64("key", i, m.bitwiseAND(F.col("fp"))))


def links(reps: DataFrame, n: int, distance: int = 4) -> DataFrame:
    """(low, high) ids of n distinct fingerprints (fp, rep), enough to join all those within the distance."""
    keys = block_keys(blocks_for(n, distance), distance)
    groups = max(1, ceil(n * len(keys) / GROUP_ROWS))
    tables = F.array(*(F.struct(F.lit(i).alias("t"), F.lit(_signed(m)).cast("long").bitwiseAND(F.col("fp")).alias("bits")) for i, m in enumerate(keys)))
    dealt = reps.select("fp", "rep", F.explode(tables).alias("k")).select("fp", "rep", F.col("k.t").alias("t"), F.xxhash64("k.t", "k.bits").alias("key"))
    over = lambda rows: rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CHUNK)
    large = stash(over(dealt), "large-buckets")
    small = dealt.join(large, "key", "left_anti").select("fp", "rep", "key", F.pmod(F.col("key"), F.lit(groups)).alias("g"), F.lit(True).alias("whole"))

    def verify(rows: pa.Table) -> pa.Table:
        own = [rows[c].to_numpy() for c in ("key", "fp", "rep")]
        low, high = spanning(own[0], own[1].view(np.uint64), own[2], distance)
        return pa.table({"low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64())})

    rows = small
    if held := large.agg(F.sum("n")).first()[0]:
        split = dealt.join(large, "key").select("fp", "rep", F.explode(_finer(keys, distance)).alias("key"))
        still = stash(over(split), "large-buckets")
        groups = max(1, ceil(held * len(keys) / GROUP_ROWS))
        finer = split.join(still, "key", "left_anti").select("fp", "rep", "key", (-1 - F.pmod(F.col("key"), F.lit(groups))).alias("g"), F.lit(True).alias("whole"))
        chunks = F.ceil(F.col("n") / CHUNK).cast("int")
        own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), chunks - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
        lots = split.join(still, "key").select("fp", "rep", "key", F.explode(pairs).alias("lot"))
        rows = small.unionByName(finer).unionByName(lots.select("fp", "rep", "key", F.xxhash64("key", "lot.i", "lot.j").alias("g"), F.lit(False).alias("whole")))
    return rows.groupBy("whole", "g").applyInArrow(verify, "low long, high long").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """id and component (smallest id reachable) of each id in `pairs` (low, high) that isn't its component itself.

    Large-star sends each larger neighbour of an id to the id's smallest neighbour, small-star does so with the smaller
    ones; rounds end when a round changes nothing, which is once all are stars. Minima are pre-aggregated, and the joins
    are plain inner joins of two shuffled sides, so a component that holds a third of all ids is split.
    """
    edges = stash(pairs.select(F.greatest("low", "high").alias("u"), F.least("low", "high").alias("v")).where("u <> v").distinct(), "links")
    seen = _mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = stash(both.join(least, F.col("u") == F.col("c")).where("v > c").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
        small = large.join(least, F.col("u") == F.col("c")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stash(small.unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct(), "links")
        if (now := _mark(edges)) == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def near_dedup(docs: DataFrame, width: int = 4, distance: int = 4, place: str | None = None, similarity: float | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, kept and place (the column named so, or null) for every row.

    With a similarity (and a place) texts whose five-word shingles have that Jaccard similarity are linked as well, if
    `resemblance` finds them; fingerprints are looked for in any case.

    Null and wordless texts have fingerprint zero and link with one another. Very long texts are read as a whole, one at
    a time. Ties: equal fingerprints are one before anything is joined. Rows that repeat a doc_id each have their own
    fingerprint; their links meet in that id. Rows without a doc_id keep their fingerprint but link with nothing:
    component_id is null and kept is true. kept is true for the smallest doc_id of a component. An empty table gives an
    empty result. Columns of docs other than doc_id and text, whatever their names, are not looked at.
    """
    rows = stash(fingerprints(docs, width, place), "fingerprints")
    known = rows.where("doc_id is not null").select("doc_id", "fp")
    reps = stash(rows.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.min_by("place", "doc_id").alias("place"), F.count(F.lit(1)).alias("n")), "representatives")
    own = reps.where("rep is not null").select("fp", "rep")
    n, total = own.count(), reps.agg(F.sum("n")).first()[0] or 0
    # a doc_id under several fingerprints joins them
    twice = known.distinct().join(known.groupBy("doc_id").agg(F.count_distinct("fp").alias("fps")).where("fps > 1"), "doc_id")
    same_id = twice.join(own, "fp").select(F.least("doc_id", "rep").alias("low"), F.greatest("doc_id", "rep").alias("high"))
    linked = links(own, n, distance).unionByName(same_id)
    if similarity is not None:
        linked = linked.unionByName(similar(docs, place, reps.where("rep is not null").select(F.col("rep").alias("of"), "place"), similarity))
    found = components(linked)
    placed = stash(reps.drop("place").join(found, reps.rep == found.id, "left").select(F.col("fp").alias("of"), "n", F.coalesce("component", "rep").alias("component_id")), "placed")
    # at most HOT fingerprints have that share of the rows; these rows are joined where they are, and no other key is hot
    hot = placed.where(F.col("n") * HOT >= total).drop("n")
    beside = rows.join(F.broadcast(hot.withColumn("hot", F.lit(True))), F.col("fp") == F.col("of"), "left").drop("of")
    cool = beside.where("hot is null").drop("hot", "component_id").join(placed.drop("n"), F.col("fp") == F.col("of")).drop("of")
    out = beside.where("hot").drop("hot").unionByName(cool).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"), "place"
    )
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, width: int = 4, distance: int = 4, similarity: float | None = None) -> DataFrame:
    """Rows of docs, columns as they are, less each row that has a smaller doc_id in its component, as `near_dedup` has them.

    Dropped rows go by their place in docs' files, so texts stay where they are, however many are dropped. Rows without a
    doc_id stay, and rows that repeat the smallest doc_id all stay. Nulls, empty and long texts and ties are as in
    `near_dedup`. An empty table gives an empty result; other columns are kept and not looked at.
    """
    docs, place = located(docs)
    dropped = near_dedup(docs, width, distance, place, similarity).where("not kept and doc_id is not null").select("place")
    return without_rows(docs, place, dropped)
