"""Reading the driver's tables, samples of labelled rows, and cutting lineage in the folder that all executors share."""
import re
import tempfile
import uuid
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HELD_OUT = 2  # documents whose crc32(doc_id as text) mod 4 is this take no part in learning
SLICE_ROWS = 500  # rows whose texts are unpacked at a time
BITMAPS = 8192  # of 4 KB each that may be sent to every executor at once
MOST_GROUPS = 1024  # of files, each with its bitmaps
OVERDRAWN, SPARE = 1.3, 60  # times the bound of a sample, and more, that is drawn by a hash before the bound is enforced by row
MOST_LABELS = 250_000  # labels of a few dozen bytes that are sent to every executor; more are joined as Spark chooses
LEAST_ROWS = 8  # of each label in a sample, whatever the size of their texts

_kept: list = []  # functions that empty what a worker keeps
_made: list[str] = []  # folders that stash() wrote and discard() has not deleted yet


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder if Spark runs in this one process, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='millrace-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def stash(df: DataFrame, label: str) -> DataFrame:
    """`df` written as a table in the shared folder and read back: a lost executor costs a reread, not the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def stash_sorted(df: DataFrame, label: str, keys: list[str], buckets: int) -> DataFrame:
    """`df` written in `buckets` by `keys`, each sorted by them, and read back: joins of such tables by these keys shuffle neither.

    The table is in the session's catalog, under a name of its own, with its files in the shared folder.
    """
    spark, name = df.sparkSession, f"millrace_{label}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    _made.append(path)
    return spark.table(name)


def stashed() -> list[str]:
    """The folders that stash() and stash_sorted() wrote so far and that are still there, in order."""
    return list(_made)


def discard(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Deletes stashed tables (all by default). Results that still read one must be written or collected before."""
    for path in stashed() if paths is None else paths:
        if (name := path.rpartition("/")[2]).startswith("millrace_"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        if path in _made:
            _made.remove(path)


def numbered(df: DataFrame) -> DataFrame:
    """`df` with a column `row` that differs by row, to deal rows by. Stash the result: the numbers are fixed by writing."""
    return df.withColumn("row", F.monotonically_increasing_id())


def forgettable(clear) -> None:
    """Names a function that empties what an operator keeps in a worker from task to task."""
    _kept.append(clear)


def forget() -> None:
    """Empties what other operators have kept in this worker; called where an operator begins a task that needs none of it."""
    for clear in _kept:
        clear()


def slices(batches, rows: int = SLICE_ROWS):
    """Arrow batches in slices of few rows. Spark bounds a batch's bytes; this bounds what is unpacked of it at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that df doesn't have."""
    while wanted.lower() in (c.lower() for c in df.columns):
        wanted += "_"
    return wanted


def located(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a column of each row's place, and that column's name: 16 bytes of its file's path, 8 of the row's number in it.

    The place of a row is the same whenever its file is read. docs must have rows that stem from one row of a Parquet file
    each, as a scan with filters and selections has; another frame is written to the shared folder first.
    """
    try:
        file = docs.metadataColumn("_metadata")
        docs.select(file["row_index"])
    except AnalysisException:
        docs = stash(docs, "documents")
        file = docs.metadataColumn("_metadata")
    name = free_name(docs, "place")
    return docs.withColumn(name, F.concat(F.unhex(F.md5(file["file_path"])), F.unhex(F.lpad(F.hex(file["row_index"]), 16, "0")))), name


def file_group(docs: DataFrame, groups: int):
    """The group of a row's file, by a hash of its path alone: where it is a condition, Spark leaves out the other files."""
    return _dealt(F.unhex(F.md5(docs.metadataColumn("_metadata")["file_path"])), groups)


def _dealt(file, groups: int):
    return F.pmod(F.xxhash64(file), F.lit(groups))


def bitmaps(rows: DataFrame) -> DataFrame:
    """file, bucket and bits: which rows of a file are among `rows` (place), 32,768 rows a bitmap of 4 KB."""
    number = F.conv(F.hex(F.substring("place", 17, 8)), 16, 10).cast("long") + 1  # these functions count from 1
    of = rows.select(F.substring("place", 1, 16).alias("file"), number.alias("number"))
    of = of.select("file", F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("bit"))
    return of.groupBy("file", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def marked(docs: DataFrame, place: str, rows: DataFrame, name: str) -> DataFrame:
    """docs with a boolean column `name`: whether the row's place is among `rows` (place). Texts stay where they are.

    Bitmaps go to the tasks that read their files. They are stashed and counted: where they are more than BITMAPS, files
    are dealt to as many groups as it takes for none to have more (than the largest file alone, if that is more), and each
    group is a scan of its own files, joined with its own bitmaps only.
    """
    held = stash(bitmaps(rows), "bitmaps")
    most = lambda by: held.groupBy(by).count().agg(F.max("count")).first()[0] or 0
    groups, bound = 1, max(BITMAPS, most(F.col("file")))
    while most(_dealt(F.col("file"), groups)) > bound and groups < MOST_GROUPS:
        groups *= 2
    file = F.substring(F.col(place), 1, 16)
    number = F.conv(F.hex(F.substring(F.col(place), 17, 8)), 16, 10).cast("long") + 1
    position = F.bitmap_bit_position(number)
    out = None
    for g in range(groups):
        own, bits = docs, held.select(F.col("file").alias(f"{place}f"), F.col("bucket").alias(f"{place}b"), F.col("bits").alias(f"{place}x"))
        if groups > 1:
            own = docs.where(file_group(docs, groups) == g)
            bits = bits.where(_dealt(F.col(f"{place}f"), groups) == g)
        own = own.join(F.broadcast(bits), (file == F.col(f"{place}f")) & (F.bitmap_bucket_number(number) == F.col(f"{place}b")), "left")
        byte = F.conv(F.hex(F.substring(F.col(f"{place}x"), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        own = own.withColumn(name, F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))).drop(f"{place}f", f"{place}b", f"{place}x")
        out = own if out is None else out.unionByName(own)
    return out


def without_rows(docs: DataFrame, place: str, rows: DataFrame) -> DataFrame:
    """docs, without the column `place`, less the rows whose place is among `rows` (place)."""
    name = free_name(docs, "marked")
    return marked(docs, place, rows, name).where(~F.col(name)).drop(name, place)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 4 == HELD_OUT


def share(*columns: str):
    """A hash of the columns as a number from 0 to below 1."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def overdrawn(bound: int, n: int) -> float:
    """The share of n rows, drawn by a hash, that leaves hardly ever fewer than `bound` of them."""
    return min(1.0, (OVERDRAWN * bound + SPARE) / max(1, n))


def _first(rows: list[tuple], bound: int, longest: int | None) -> list[tuple]:
    """Of rows (order, doc_id, code, bytes, ...) each once in order: the first `bound`, and of these those before `longest` bytes are full."""
    out, used = [], 0
    for row in sorted({row[:3]: row for row in rows}.values(), key=lambda row: (row[0], row[1] is not None, row[1] or 0, row[2]))[:bound]:
        used += row[3]
        if longest is not None and used > longest and len(out) >= LEAST_ROWS:
            break
        out.append(row)
    return out


def bottom(rows: DataFrame, bounds: dict, longest: int | None = None, content: str = "text") -> DataFrame:
    """A bounded sample of each label in one pass over rows (doc_id, text, label and more; `content` names another text).

    Of label x the bounds[x] rows with the least hashes are taken, rows that repeat a doc_id and text counting once.
    `longest` bounds the bytes of each label's texts: in that order, rows are taken until the next would go beyond, the
    first LEAST_ROWS whatever their size; no text is cut. Each task keeps no more than the bounds of what it reads,
    so neither a row repeated many times nor an id with many texts makes it hold more. The sample depends on the rows alone,
    not on how they are dealt.
    """
    names = [c for c in rows.columns if c not in ("doc_id", "label")]
    order, code, size = F.xxhash64("doc_id", content), F.xxhash64(F.lit(1), content, "doc_id"), F.octet_length(content).cast("long")
    coded = rows.where(F.col("label").isNotNull() & F.col(content).isNotNull()).select("label", order.alias("order"), "doc_id", code.alias("code"), size.alias("bytes"), *names)
    schema = coded.schema

    def run(batches):
        forget()
        held: dict = {}
        kinds = []
        for batch in slices(batches):
            kinds = batch.schema.types
            for label, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if label in bounds:
                    own, used = held.get(label, ([], 0))
                    own.append(tuple(row))
                    used += row[3]
                    if len(own) > 2 * bounds[label] + LEAST_ROWS or longest is not None and used > 2 * longest:
                        own = _first(own, bounds[label], longest)
                        used = sum(r[3] for r in own) if sum(r[3] for r in own) <= (longest or 1 << 62) else 0
                    held[label] = own, used
        for label, (own, _) in held.items():
            own = _first(own, bounds[label], longest)
            for at in range(0, len(own), SLICE_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*((label, *r) for r in own[at : at + SLICE_ROWS]), strict=True), kinds, strict=True)], names=schema.names)

    found = stash(coded.mapInArrow(run, schema), "sample")
    keys = found.select("label", "order", "doc_id", "code", "bytes").distinct()
    taken = []
    for label, bound in bounds.items():
        ordered = keys.where(F.col("label") == F.lit(label)).orderBy("order", F.col("doc_id").asc_nulls_first(), "code").limit(bound)
        taken += [(label, r[2]) for r in _first([tuple(r)[1:] for r in ordered.collect()], bound, longest)]
    chosen = rows.sparkSession.createDataFrame(taken, found.select("label", "code").schema) if taken else found.select("label", "code").limit(0)
    return found.join(F.broadcast(chosen), ["label", "code"]).dropDuplicates(["label", "code"]).select("doc_id", *names, "label")


def sample(docs: DataFrame, labels: DataFrame, bounds: dict[int, int], longest: int | None = None, content: str = "text") -> DataFrame:
    """Rows of docs (doc_id, text and more) with their label: `bottom` of each label, for distinct doc_id and label in `labels`.

    Labels are thinned by a hash of doc_id to some more than the bounds before they meet the texts, so that texts stay where
    they are. Should too few of their documents be in docs, all is done again with more labels.
    """
    n = {r.label: r.n for r in labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where(F.col("label").isin(list(bounds))).collect()}
    shares = {label: overdrawn(bound, n.get(label, 0)) for label, bound in bounds.items()}
    while True:
        few = labels.where(reduce(or_, ((F.col("label") == label) & (share("doc_id") < s) for label, s in shares.items()), F.lit(False)))
        least = sum(s * n.get(label, 0) for label, s in shares.items())
        found = bottom(docs.join(F.broadcast(few) if least <= MOST_LABELS else few, "doc_id"), bounds, longest, content)
        if all(s >= 1 for s in shares.values()):
            return found
        got = {r.label: (r.n, r.bytes) for r in found.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(content)).alias("bytes")).collect()}
        # of some 1.3 times the bound, the bound itself is found unless documents are missing, or texts fill the bytes
        short = [label for label, bound in bounds.items() if shares[label] < 1 and got.get(label, (0, 0))[0] < bound and (longest is None or got.get(label, (0, 0))[1] < longest / 2)]
        if not short:
            return found
        shares |= {label: min(1.0, 8 * shares[label]) for label in short}


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file; operators take any other path."""
    import public_tokenizers

    return public_tokenizers.path(name)
