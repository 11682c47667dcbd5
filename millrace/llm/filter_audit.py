"""Filter interaction audit: which of five filters removes what, in every order of applying them.

1. Arrow-buffer scanning: the bytes of a batch's texts are looked up in a table of byte classes, and prefix sums of the
   classes, read at the texts' offsets, give code points, capitals and symbols. Words are the places where a byte other
   than white space follows white space or a text's start.
2. A word's hash is a difference of prefix sums of its bytes' codes times the powers of an odd number, put back to the
   power zero. Each document's hashes are sorted; words beside each other of equal hash are compared byte by byte, and a
   run in which they differ is counted by its bytes, so that the number of distinct words is exact.
3. A document becomes a mask of the filters it fails. Copies are found by SHA-256 digests: rows are pre-aggregated by
   digest, part and mask, so that a text that holds a third of all rows sends a few rows per task, and each group meets
   the smallest doc_id of its digest in a join that Spark can split.
4. Documents of a part reduce to 32 counts, one for each mask. Every order, step and Shapley sum is a product of these with
   a fixed matrix.
"""
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import stash

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 200, 50, 2, "#$%&*|"  # numbers 2 and 3 in hundredths
BLOCK = 1 << 20  # bytes scanned at once; texts are taken together up to it, a longer one goes block after block
LONG = 512  # bytes of a word from which it is compared by itself

_SPACE, _CAPITAL, _POINT, _SYMBOL = 1, 2, 4, 8
_MULTIPLIER = 0x9E3779B97F4A7C15  # any odd number
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _classes(symbols: str) -> np.ndarray:
    own = symbols.encode()
    return np.array([_SPACE * (b == 32 or 9 <= b <= 13) | _CAPITAL * (65 <= b <= 90) | _POINT * (b & 0xC0 != 0x80) | _SYMBOL * (b in own) for b in range(256)], np.uint8)


def _powers(base: int) -> np.ndarray:
    out = np.full(BLOCK + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)


class Scanner:
    """Counts of texts that lie end to end in a buffer."""

    def __init__(self, symbols: str = SYMBOLS):
        self.classes, self.codes = _classes(symbols), np.random.default_rng(0).integers(0, 1 << 64, 256, np.uint64)
        self.inverse = pow(_MULTIPLIER, -1, 1 << 64)
        self.up, self.down = _powers(_MULTIPLIER), _powers(self.inverse)

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(words, distinct words, capitals, code points, symbols) by text; text i is data[offsets[i]:offsets[i + 1]]."""
        out, at, n = np.zeros((len(offsets) - 1, 5), np.int64), 0, len(offsets) - 1
        while at < n:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK, "right")) - 1)
            to = min(to, at + (1 << 16), n)  # 16 bits of a sorted key have the text
            out[at:to] = self._group(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
            at = to
        return out

    def _group(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.zeros((len(offsets) - 1, 5), np.int64)
        found = [self._block(data, offsets, lo, out) for lo in range(0, len(data), BLOCK)]
        if found:
            starts, first = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            ends, last = (np.concatenate([f[k] for f in found]) for k in (2, 3))
            base = np.array([pow(self.inverse, lo, 1 << 64) for lo in range(0, len(data), BLOCK)], np.uint64)
            hashes = (last - first) * self.down[starts % BLOCK] * base[starts // BLOCK]
            cuts = np.searchsorted(starts, offsets)
            out[:, 0] = np.diff(cuts)
            out[:, 1] = self._distinct(data, starts, ends, hashes, np.repeat(np.arange(len(out), dtype=np.uint64), out[:, 0]), len(out))
        self.carry = np.uint64(0)
        return out

    carry = np.uint64(0)  # of the prefix sums, from block to block

    def _block(self, data: np.ndarray, offsets: np.ndarray, lo: int, out: np.ndarray):
        """Adds the block's classes to `out`; places where words start and end there, with the prefix sums of codes."""
        hi = min(lo + BLOCK, len(data))
        part = data[lo:hi]
        kinds = self.classes[part]
        at = np.clip(offsets, lo, hi) - lo
        for column, kind in ((2, _CAPITAL), (3, _POINT), (4, _SYMBOL)):
            out[:, column] += np.diff(np.concatenate(([0], np.cumsum(kinds & kind != 0, dtype=np.int32)))[at])
        cut = np.zeros(hi - lo + 1, bool)  # a text starts here
        cut[at[(offsets >= lo) & (offsets <= hi)]] = True
        word = np.ones(hi - lo + 2, bool)  # with the byte before the block and the one after it
        word[1:-1] = kinds & _SPACE == 0
        word[0] = lo > 0 and not self.classes[data[lo - 1]] & _SPACE
        word[-1] = hi < len(data) and not self.classes[data[hi]] & _SPACE
        starts = np.flatnonzero(word[1:-1] & (~word[:-2] | cut[:-1]))
        ends = np.flatnonzero(word[1:-1] & (~word[2:] | cut[1:])) + 1
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(self.codes[part] * self.up[: hi - lo], out=sums[1:])
        sums = sums * np.uint64(pow(_MULTIPLIER, lo, 1 << 64)) + self.carry
        self.carry = sums[-1]
        return starts + lo, sums[starts], ends + lo, sums[ends]

    def _distinct(self, data, starts, ends, hashes, text, n) -> np.ndarray:
        key = (text << np.uint64(48)) | ((hashes ^ (hashes >> np.uint64(31))) * _MIX >> np.uint64(16))
        order = np.argsort(key)
        key, starts, ends, text = key[order], starts[order], ends[order], text[order].astype(np.int64)
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        out = np.bincount(text[new], minlength=n)
        pairs = np.flatnonzero(~new)
        odd = pairs[~equal(data, starts[pairs - 1], ends[pairs - 1], starts[pairs], ends[pairs])]
        if len(odd):
            heads = np.flatnonzero(new)
            for i in np.unique(np.searchsorted(heads, odd, "right") - 1):
                run = range(heads[i], heads[i + 1] if i + 1 < len(heads) else len(key))
                out[text[heads[i]]] += len({data[starts[j] : ends[j]].tobytes() for j in run}) - 1
        return out


def equal(data: np.ndarray, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """For each pair whether data[a:a_end] and data[b:b_end] are the same bytes."""
    size = a_end - a
    same = size == b_end - b
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    live = np.flatnonzero(same & (size <= LONG))
    for k in range(0, LONG, 8):
        live = live[size[live] > k]
        if not len(live):
            break
        differ = (eights[a[live] + k] ^ eights[b[live] + k]) & _MASKS[np.minimum(size[live] - k, 8)]
        same[live[differ != 0]] = False
        live = live[differ == 0]
    for i in np.flatnonzero(same & (size > LONG)):
        same[i] = np.array_equal(data[a[i] : a_end[i]], data[b[i] : b_end[i]])
    return same


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow array of strings without nulls, as they lie in its buffers."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[at[0] : at[-1]], at - at[0]


def measures(docs: DataFrame, symbols: str = SYMBOLS) -> DataFrame:
    """doc_id, part, digest (SHA-256), words, distinct, capitals, points and symbols of every row; nulls count as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    part = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in docs.columns else F.lit("")
    names = ["words", "distinct", "capitals", "points", "symbols"]

    def run(batches):
        scanner = Scanner(symbols)
        for batch in batches:
            found = scanner.scan(*buffers(batch.column(3)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(found[:, k]) for k in range(5))], names=["doc_id", "part", "digest", *names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, digest binary, " + ", ".join(f"{n} long" for n in names))


def failures(measured: DataFrame) -> DataFrame:
    """doc_id, part, digest and mask: bit 0 for filter A to bit 3 for D. E needs other rows."""
    fails = [F.col("words") < LEAST_WORDS, 100 * F.col("distinct") < LEAST_DISTINCT * F.col("words"), 100 * F.col("capitals") > MOST_CAPITALS * F.col("points"), F.col("symbols") > 0]
    return measured.select("doc_id", "part", "digest", sum(f.cast("int") * (1 << k) for k, f in enumerate(fails)).alias("mask"))


def by_mask(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (E at bit 4), n, good and toxic: the documents of a part that fail just these filters."""
    known = labels.select(F.col("doc_id").cast("long").alias("of"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    known = known.where("of is not null and (good or toxic)").groupBy("of").agg(F.coalesce(F.max("good"), F.lit(False)).alias("good"), F.coalesce(F.max("toxic"), F.lit(False)).alias("toxic"))
    rows = failures(measures(docs)).groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(known, F.col("doc_id") == F.col("of"), "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # rows of a doc_id are one here, so the count at the smallest one is that of the first document
    groups = rows.groupBy("digest", "part", "mask", "good", "toxic", F.col("doc_id").isNull().alias("no_id")).agg(F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("at_first"))
    groups = stash(groups, "audit-groups")
    firsts = groups.where("not no_id").groupBy(F.col("digest").alias("of")).agg(F.min("first").alias("least"))
    placed = groups.join(firsts, F.col("digest") == F.col("of"), "left")
    stay = F.when(F.col("no_id"), F.col("n")).when(F.col("first") == F.col("least"), F.col("at_first")).otherwise(0)
    either = F.array(F.struct(F.col("mask").alias("mask"), stay.alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - stay).alias("n")))
    each = placed.select("part", "good", "toxic", F.explode(either).alias("x")).where("x.n > 0")
    count = lambda when: F.sum(F.when(when, F.col("x.n")).otherwise(0))
    return each.groupBy("part", F.col("x.mask").alias("mask")).agg(F.sum("x.n").alias("n"), count(F.col("good")).alias("good"), count(F.col("toxic")).alias("toxic"))


def _matrices() -> tuple[list[str], list[int], dict[str, np.ndarray]]:
    """Orders and steps of the 600 rows of a part, and what each takes of the 32 masks."""
    masks, orders, steps, of = np.arange(32), [], [], {k: [] for k in ("kept", "removed", "redundant", "unique_fails", "shapley")}
    failing = np.array([m.bit_count() for m in range(32)])
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            fails, gone = masks & bit != 0, masks & before != 0
            orders.append("".join(order))
            steps.append(step)
            # of a document's failing filters each comes first in as many of the 120 orders
            for name, take in (("kept", ~gone & ~fails), ("removed", fails & ~gone), ("redundant", fails & gone), ("unique_fails", masks == bit), ("shapley", fails * (120 // np.maximum(failing, 1)))):
                of[name].append(np.asarray(take, np.int64))
            before |= bit
    return orders, steps, {k: np.array(v) for k, v in of.items()}


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley.

    Each part (value of source) has 600 rows: 120 orders of the five filters, five steps each. Null texts count as empty
    ones, a null or missing source as the empty string. Very long texts are scanned block after block. Ties: of equal texts
    those with the smallest doc_id don't fail E, repeated rows of it neither; a row without a doc_id doesn't fail E and
    makes no other fail it. Repeated rows count each. A document is good (toxic) if any of its labels says so; null labels say
    nothing. An empty table gives an empty result, empty labels no loss. Columns other than doc_id, text and source,
    whatever their names, are not looked at.
    """
    orders, steps, matrices = _matrices()
    parts = by_mask(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                n = np.zeros((3, 32), np.int64)
                for m in batch.column(1)[at].as_py():
                    n[:, m["mask"]] = m["n"], m["good"], m["toxic"]
                of = {k: v @ n[0] for k, v in matrices.items()} | {"good_lost": matrices["removed"] @ n[1], "toxic_lost": matrices["removed"] @ n[2]}
                part = pa.array([batch.column(0)[at].as_py()] * len(steps), pa.string())
                yield pa.RecordBatch.from_arrays([part, pa.array(orders), pa.array(steps, pa.int32()), *(pa.array(of[k]) for k in names)], names=["part", "filter_order", "step", *names])

    return parts.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{k} long" for k in names))


def sql() -> str:
    """The same in DuckDB SQL, order by order."""
    fails = ["len(ws) < 200", "100 * len(list_distinct(ws)) < 50 * len(ws)", "100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t)", "regexp_matches(t, '[#$%&*|]')", "doc_id > min(doc_id) OVER (PARTITION BY t)"]
    letters = "(SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x)"
    hits = lambda letters: f"len(list_filter(string_split({letters}, ''), lambda x: x <> '' AND contains(f, x)))"
    return f"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM d),
        f AS (SELECT doc_id, part, {' || '.join(f"CASE WHEN {c} THEN '{x}' ELSE '' END" for x, c in zip(FILTERS, fails, strict=True))} AS f FROM w),
        l AS (SELECT doc_id AS of, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        g AS (SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f LEFT JOIN l ON doc_id = of GROUP BY part, f),
        o AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM {letters} a, {letters} b, {letters} c, {letters} d, {letters} e
              WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        s AS (SELECT part, o, step, substr(o, step, 1) AS own, f, n, good, toxic, contains(f, substr(o, step, 1)) AS fails,
                     {hits('substr(o, 1, step - 1)')} > 0 AS gone
              FROM g, o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
        r AS (SELECT part, o AS filter_order, step::INT AS step, own,
                     sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END)::BIGINT AS removed,
                     sum(CASE WHEN gone AND fails THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN f = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
                     sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
              FROM s GROUP BY part, o, step, own)
        SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r"""
