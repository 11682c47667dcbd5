"""Line dedup by levelled sorted runs of line hashes.

1. A line's key is the line without ASCII white space at its ends, A-Z lower-cased; its hash is 128 bits of BLAKE2b, as two
   longs. Keys under `least_length` code points are not looked at.
2. Documents come in batches. A batch's keys are pre-aggregated (documents that hold them, largest doc_id) and written in
   buckets, sorted by hash. There they are merged with the runs: joins of tables in equal buckets, so nothing is shuffled.
   Keys that no run holds are new; the batch's own run is made of these, so each key is in one run.
3. Runs have levels. FANOUT runs of a level are merged into one of the next, bucket by bucket, so a batch meets
   FANOUT - 1 runs a level at most, whatever the number of batches.
4. A key that a run did hold is a repeat. A key's count is that of its run and those of its repeats; keys in at least
   `least_documents` documents are common, and lose their lines but for the largest doc_id that holds them.
5. Each batch is merged with the common keys in the same way, which leaves those it holds. If they are few (COMMON), they go
   to the tasks that read the batch's texts, and texts stay where they are. If not, line places are joined with them, and only
   documents that lose a line are sent on; bitmaps of their places tell them apart.
"""
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.tables import file_group, located, marked, slices, stash, stash_sorted

FANOUT = 3
COMMON = 250_000  # common keys of a batch, of 32 bytes each, that are sent to every task
MOST_BUCKETS = 100_000
HASH = ["h1", "h2"]

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


def line_hashes(text: str, least_length: int) -> list[bytes | None]:
    """The hash of each line's key, null for one of under least_length code points."""
    out = []
    for line in text.encode().translate(_LOWER).split(b"\n"):
        key = line.strip(_SPACE)
        long = len(key) >= least_length and (key.isascii() or len(key.decode()) >= least_length)
        out.append(hashlib.blake2b(key, digest_size=16).digest() if long else None)
    return out


def _longs(hashes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _read(docs: DataFrame, place: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col(place).alias("place"))


def batch_keys(docs: DataFrame, least_length: int) -> DataFrame:
    """h1, h2, n (rows of docs that hold the key) and winner (largest doc_id of these)."""

    def run(batches):
        for batch in slices(batches):
            hashes, ids = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = {h for h in line_hashes(text, least_length) if h is not None}
                hashes += own
                ids += [doc] * len(own)
            h1, h2 = _longs(hashes)
            yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), pa.array(ids, pa.int64())], names=[*HASH, "doc_id"])

    held = docs.mapInArrow(run, "h1 long, h2 long, doc_id long")
    return held.groupBy(*HASH).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("winner"))


class LineRuns:
    """Runs of line keys in the shared folder, to which batches are added; tables h1, h2, n, winner in equal buckets."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = FANOUT):
        """`buckets` should give a bucket of a run some 100 MB at most; by default the session's shuffle partitions."""
        self.buckets = min(MOST_BUCKETS, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.fanout, self.levels, self.batches = fanout, [], []

    @property
    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _written(self, rows: DataFrame, label: str) -> DataFrame:
        return stash_sorted(rows, label, HASH, self.buckets)

    def add(self, keys: DataFrame) -> DataFrame:
        """Adds a batch's keys (h1, h2, n, winner), each once; gives the batch as written, with `new` where no run held the key."""
        held = F.lit(False)
        for i, run in enumerate(self.runs):
            keys = keys.join(run.select(*HASH, F.lit(True).alias(f"in{i}")), HASH, "left")
            held = held | F.coalesce(f"in{i}", F.lit(False))
        batch = self._written(keys.select(*HASH, "n", "winner", (~held).alias("new")), "batch")
        self.batches.append(batch)
        self._put(0, batch.where("new").drop("new"))
        return batch

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged, *rest = self.levels[level]
            for other in rest:  # no key is in two runs
                right = other.select(*HASH, F.col("n").alias("m"), F.col("winner").alias("last"))
                merged = merged.join(right, HASH, "full_outer").select(*HASH, F.coalesce("n", "m").alias("n"), F.coalesce("winner", "last").alias("winner"))
            self.levels[level] = []
            self._put(level + 1, self._written(merged, "run"))

    def common(self, least: int) -> DataFrame:
        """h1, h2 and winner of the keys that at least `least` documents hold."""
        repeats = None
        for batch in self.batches[1:]:  # the first one repeats nothing
            own = batch.where("not new").drop("new")
            repeats = own if repeats is None else repeats.unionByName(own)
        if repeats is not None:
            repeats = self._written(repeats.groupBy(*HASH).agg(F.sum("n").alias("more"), F.max("winner").alias("last")), "repeats")
        found = None
        for run in self.runs:
            if repeats is not None:
                run = run.join(repeats, HASH, "left").select(*HASH, (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"), F.greatest("winner", "last").alias("winner"))
            own = run.where(F.col("n") >= least).drop("n")
            found = own if found is None else found.unionByName(own)
        return self._written(found, "common")


_RESULT = "doc_id long, n_lines long, n_dropped long, text string"


def _result(ids, texts, drops) -> pa.RecordBatch:
    n, gone, kept = [], [], []
    for text, drop in zip(texts, drops, strict=True):
        lines = text.split("\n")
        n.append(len(lines))
        gone.append(len(drop))
        kept.append("\n".join(line for i, line in enumerate(lines) if i not in drop) if drop else text)
    return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_lines", "n_dropped", "text"])


def _beside(docs: DataFrame, common: DataFrame, least_length: int) -> DataFrame:
    """The result, with the batch's few common keys in every task."""
    winners = {h1.to_bytes(8, "little", signed=True) + h2.to_bytes(8, "little", signed=True): w for h1, h2, w in common.collect()}
    shared = docs.sparkSession.sparkContext.broadcast(winners)

    def run(batches):
        winners = shared.value
        for batch in slices(batches):
            texts, drops = batch.column(1).to_pylist(), []
            for doc, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                drops.append({i for i, h in enumerate(line_hashes(text, least_length)) if h in winners and winners[h] != doc})
            yield _result(batch.column(0), texts, drops)

    return docs.mapInArrow(run, _RESULT)


def _joined(docs: DataFrame, common: DataFrame, least_length: int) -> DataFrame:
    """The result, with places of lines joined with the batch's common keys. Only documents that lose a line are shuffled."""

    def lines(batches):
        for batch in slices(batches):
            hashes, ids, places, numbers = [], [], [], []
            for doc, text, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = [(h, i) for i, h in enumerate(line_hashes(text, least_length)) if h is not None]
                hashes += [h for h, _ in own]
                numbers += [i for _, i in own]
                ids += [doc] * len(own)
                places += [place] * len(own)
            yield pa.RecordBatch.from_arrays([*map(pa.array, _longs(hashes)), pa.array(ids, pa.int64()), pa.array(places, pa.binary()), pa.array(numbers, pa.int32())], names=[*HASH, "doc_id", "place", "line"])

    held = docs.mapInArrow(lines, "h1 long, h2 long, doc_id long, place binary, line int").join(common, HASH)
    lost = stash(held.where(~F.col("doc_id").eqNullSafe(F.col("winner"))).groupBy("place").agg(F.collect_list("line").alias("drop")), "lost-lines")
    docs = marked(docs, "place", lost.select("place"), "loses")
    none = F.array().cast("array<int>")
    loses = docs.where("loses").drop("loses").join(lost, "place").select("doc_id", "text", "drop")
    rows = docs.where("not loses").select("doc_id", "text", none.alias("drop")).unionByName(loses)

    def run(batches):
        for batch in slices(batches):
            yield _result(batch.column(0), batch.column(1).to_pylist(), map(set, batch.column(2).to_pylist()))

    return rows.mapInArrow(run, _RESULT)


def line_dedup(docs: DataFrame, least_length: int = 40, least_documents: int = 5, batches: int = 4) -> DataFrame:
    """doc_id, n_lines, n_dropped and text (what is left) of every row.

    docs' files are dealt to `batches`. Null texts count as empty ones, which have one empty line; of a text that loses all
    its lines the empty text is left. Very long texts and lines are read as a whole. Ties: rows that repeat a doc_id
    count as documents each, and if it is the largest one holding a line all of them keep it. A row without a doc_id counts as
    a document, but keeps a common line only where no row that holds it has one. An empty table gives an empty result.
    Columns of docs other than doc_id and text, whatever their names, are not looked at.
    """
    docs, place = located(docs.select("doc_id", "text"))
    group = file_group(docs, batches)
    runs, parts = LineRuns(docs.sparkSession), []
    for g in sorted(r.g for r in docs.select(group.alias("g")).distinct().collect()):
        own = _read(docs.where(group == g), place)
        parts.append((own, runs.add(batch_keys(own, least_length))))
    if not parts:
        return _read(docs, place).mapInArrow(lambda batches: iter(()), _RESULT)
    common, out = runs.common(least_documents), None
    for own, batch in parts:
        mine = stash(batch.join(common.withColumnRenamed("winner", "keeps"), HASH).where("keeps is not null").select(*HASH, F.col("keeps").alias("winner")), "batch-common")
        found = (_beside if mine.count() <= COMMON else _joined)(own, mine, least_length)
        out = found if out is None else out.unionByName(found)
    return out


def sql(least_length: int = 40, least_documents: int = 5) -> str:
    """The same in DuckDB SQL, with the digest of what is left."""
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
        WITH l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
        k AS (SELECT *, translate(trim(line, {space}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        c AS (SELECT key, max(doc_id) AS keeps FROM k WHERE length(key) >= {least_length} GROUP BY key HAVING count(DISTINCT doc_id) >= {least_documents}),
        d AS (SELECT doc_id, i, line, coalesce(doc_id <> keeps, false) AS gone FROM k LEFT JOIN c USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM d GROUP BY doc_id"""
