"""Toxicity by compression distance: two zstandard dictionaries, window lengths compared, calibrated thresholds.

Learning, on a bounded sample of labelled rows, whole texts:
- The ordinary dictionary is trained by zstandard on windows of ordinary documents.
- The toxic dictionary is trained by zstandard on windows of toxic documents. Most of these are as ordinary as any other
  text, and a dictionary of all of them says nothing of a window, so windows are chosen, in rounds: first those that the
  ordinary dictionary compresses worst for their size; then those that a toxic dictionary, trained on what was chosen in
  the other half of the documents, shortens by more than all but a thousandth of ordinary windows. Stretches that stand in many
  toxic documents are found again from round to round, others are not. Windows get narrower.
- Ordinary windows that a round's toxic dictionary shortens are given to the ordinary trainer once more, several times.
- The two dictionaries are separate compressors. A window's distance is the difference of its two compressed lengths.
- A logistic model of a document's largest distances, their mean and the windows above fixed thresholds is fitted on the
  sample, each fold with dictionaries from the others; its threshold is the one with the best F1, put at 0.3.
Dictionaries are trained, and the sample's features made, in tasks; the driver sees dictionaries and features only.

Scoring: each whole text is cut into windows of one word, each compressed twice; a worker keeps the distances of words that it
has seen, in a bounded table. With wider windows the two compressors differ more by the ordinary words beside a marked one.
"""
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import held_out, sample, slices, stash

TOXIC_ROWS, ORDINARY_ROWS = 1500, 3000  # labelled rows learned from, at most
SAMPLE_BYTES = 32 << 20  # of the texts of either class, at most, but for the first few rows
WINDOW = 1  # words
LONGEST = 1024  # bytes of a window; longer ones are cut
KNOWN_WORDS = 400_000  # distances that a worker keeps, at most
ORDINARY_BYTES, TOXIC_BYTES = 32_768, 8_192  # sizes of the dictionaries, at most
SEGMENT, REPEAT = 16, 6  # of the trainer: bytes that it takes at once, and of what it counts
GIVEN, GIVEN_WORDS = 200_000, 5  # windows that the ordinary trainer gets, at most, evenly from whole texts, and their words
ROUNDS = (3, 3, 2, 2, 2)  # words of the windows that each round chooses from
WORST, USUAL = 0.97, 0.999  # shares of ordinary windows that a chosen one is beyond: by excess of length at first, by distance later
AGAINST = 800  # ordinary rows whose windows are compared with
HARD, TIMES = 2, 5  # distance from which an ordinary window is given to the ordinary trainer again, and how often
AT = (1, 2, 3, 5)  # differences in bytes above which windows are counted
CUT = 0.3
FOLDS = 3  # of the sample; each is calibrated on with dictionaries from the others
# Both dictionaries hold these bytes, and each window ends with them: else zstandard stores a short window as it is
# whenever it can't save a few bytes, and small differences are lost. A fixed value.
TAIL = bytes(range(128, 192))


def _words(text: str) -> list[bytes]:
    return text.lower().encode().split()


def windows(text: str, size: int) -> list[bytes]:
    """The whole text in windows of `size` words with spaces around them, each with the tail."""
    words, out = _words(text), []
    for i in range(0, len(words), size):
        w = b" " + b" ".join(words[i : i + size]) + b" "
        out += [w + TAIL] if len(w) <= LONGEST else [w[j : j + LONGEST] + TAIL for j in range(0, len(w), LONGEST)]
    return out


def _trained(samples: list[bytes], size: int) -> bytes:
    """A dictionary that zstandard trains on the samples; it refuses very few, so they are repeated. Empty if it gives none."""
    for _ in range(8 if samples else 0):
        try:
            return zstandard.train_dictionary(size, samples, k=SEGMENT, d=REPEAT).as_bytes()
        except zstandard.ZstdError:
            samples = samples * 3
    return b""


def _compressor(dictionary: bytes):
    how = zstandard.ZstdCompressionParameters(
        window_log=17, chain_log=14, hash_log=14, search_log=6, min_match=3, target_length=16, strategy=zstandard.STRATEGY_BTLAZY2,
        write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    content = zstandard.ZstdCompressionDict(dictionary + TAIL, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=how).compress


def _lengths(compress, found: list[bytes]) -> np.ndarray:
    return np.array([len(compress(w)) for w in found], np.int64)


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """The toxic and the ordinary dictionary."""
    cut = lambda texts, n: [windows(t, n) for t in texts]
    bare = lambda found: [w.removesuffix(TAIL) for w in found]
    plain = [w for own in cut(ordinary, GIVEN_WORDS) for w in own]
    plain = bare(plain[:: max(1, -(-len(plain) // GIVEN))])
    known, hard, chosen = _trained(plain, ORDINARY_BYTES), [], None
    for width in ROUNDS:
        shorter = _compressor(known)
        against = [w for own in cut(ordinary[:AGAINST], width) for w in own]
        found, lengths = cut(toxic, width), _lengths(shorter, against)
        if not against or not any(found):
            break
        own = [_lengths(shorter, ws) for ws in found]
        if chosen is None:
            rate = lengths.sum() / sum(map(len, against))
            least = np.quantile(lengths - rate * np.array(list(map(len, against))), WORST)
            chosen = [[w for w, n in zip(ws, ns, strict=True) if n - rate * len(w) > least] for ws, ns in zip(found, own, strict=True)]
        halves = [_compressor(_trained(bare(w for ws in chosen[h::2] for w in ws), TOXIC_BYTES)) for h in (0, 1)]
        usual = [lengths - _lengths(c, against) for c in halves]
        least = [max(1, np.quantile(d, USUAL)) for d in usual]
        chosen = []
        for i, (ws, ns) in enumerate(zip(found, own, strict=True)):
            other = 1 - i % 2
            chosen.append([w for w, d in zip(ws, ns - _lengths(halves[other], ws), strict=True) if d > least[other]])
        hard += bare(w for w, *d in zip(against, *usual, strict=True) if max(d) >= HARD)
        known = _trained(plain + hard * TIMES, ORDINARY_BYTES)
    return _trained(bare(w for ws in chosen or [] for w in ws), TOXIC_BYTES), known


class Distance:
    """Differences of compressed lengths: with the ordinary dictionary, less with the toxic one."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary, self.known = _compressor(toxic), _compressor(ordinary), {}

    def of(self, window: bytes) -> int:
        if (d := self.known.get(window)) is None:
            d = len(self.ordinary(window)) - len(self.toxic(window))
            if len(self.known) < KNOWN_WORDS and len(window) < LONGEST:
                self.known[window] = d
        return d

    def features(self, text: str | None) -> list[float]:
        found = windows(text or "", WINDOW)
        if not found:
            return [0.0] * (4 + 2 * len(AT))
        d = np.sort(np.fromiter(map(self.of, found), np.float64, len(found)))[::-1]
        above = [int((d >= t).sum()) for t in AT]
        return [d[0], d[:3].mean(), np.maximum(d, 0).mean(), np.log(len(d)), *np.log1p(above), *(20 * n / (len(d) + 5) for n in above)]


def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1.0) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the last one is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, keep = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, ridge), 1e-3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _calibrated(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Weights, the cut in their log-odds with the best F1, and that F1."""
    w = _fit(x, y)
    s = x @ w[:-1] + w[-1]
    order = np.argsort(-s, kind="stable")
    f1 = 2 * np.cumsum(y[order]) / (np.arange(1, len(y) + 1) + y.sum())
    last = np.append(s[order][1:] < s[order][:-1], True)  # a threshold can't part equal scores
    best = int(np.argmax(np.where(last, f1, -1)))
    below = s[order][best + 1] if best + 1 < len(s) else s[order][best] - 1
    return w, float(s[order][best] + below) / 2, float(f1[best])


def _logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


class Model:
    """Dictionaries, weights, and the shift that puts the best threshold at CUT."""

    def __init__(self, toxic: bytes, ordinary: bytes, weights: np.ndarray, cut: float):
        self.parts = (toxic, ordinary, weights, cut)

    def scorer(self):
        toxic, ordinary, w, cut = self.parts
        distance, shift = Distance(toxic, ordinary), _logit(CUT) - cut
        return lambda text: float(1 / (1 + np.exp(-np.clip(np.dot(distance.features(text), w[:-1]) + w[-1] + shift, -30, 30))))


def _train(rows: pa.Table) -> pa.Table:
    """The dictionaries of one job."""
    texts = {x: sorted(rows.filter(pa.compute.equal(rows["label"], x))["text"].to_pylist(), key=lambda t: zlib.crc32(t.encode())) for x in (0, 1)}
    toxic, ordinary = train_dictionaries(texts[1], texts[0])
    return pa.table({"job": pa.array([rows["job"][0].as_py()], pa.int32()), "toxic": pa.array([toxic], pa.binary()), "ordinary": pa.array([ordinary], pa.binary())})


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Model from a sample of labelled rows that are not held out, or None if either class has under FOLDS rows.

    A document labelled both ways counts as toxic. The sample's bounds are TOXIC_ROWS, ORDINARY_ROWS and SAMPLE_BYTES.
    """
    labelled = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic").cast("int") > 0).cast("int").alias("label"))
    labelled = labelled.where("doc_id is not null and label is not null").where(~held_out()).groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    drawn = sample(texts, labelled, {1: TOXIC_ROWS, 0: ORDINARY_ROWS}, SAMPLE_BYTES)
    rows = stash(drawn.withColumn("fold", F.pmod(F.xxhash64("text", "doc_id"), F.lit(FOLDS)).cast("int")).repartition(16), "toxicity-sample")
    n = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if min(n.get(0, 0), n.get(1, 0)) < FOLDS:
        return None
    # job k leaves out fold k; job FOLDS leaves out none
    jobs = F.explode(F.filter(F.array(*map(F.lit, range(FOLDS + 1))), lambda k: k != F.col("fold")))
    found = rows.select("text", "label", jobs.alias("job")).groupBy("job").applyInArrow(_train, "job int, toxic binary, ordinary binary").collect()
    dictionaries = {r.job: (bytes(r.toxic), bytes(r.ordinary)) for r in found}

    def run(batches):
        distances = {}
        for batch in slices(batches):
            out = []
            for text, label, fold in zip(*(batch.column(c).to_pylist() for c in ("text", "label", "fold")), strict=True):
                if fold in dictionaries:
                    if fold not in distances:
                        distances[fold] = Distance(*dictionaries[fold])
                    out.append((label, distances[fold].features(text)))
            columns = list(zip(*out, strict=True)) or [()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.list_(pa.float64())), strict=True)], names=["label", "x"])

    features = sorted((r.x, r.label) for r in rows.mapInArrow(run, "label int, x array<double>").collect())
    if not features:  # all rows in one fold
        return None
    w, cut, _ = _calibrated(np.array([x for x, _ in features]), np.array([y for _, y in features], np.float64))
    return Model(*dictionaries[FOLDS], w, cut)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every row; 0 without a model."""

    def run(batches):
        one = model.scorer() if model else lambda text: 0.0
        for batch in slices(batches):
            scores = pa.array([one(t) for t in batch.column(1).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs.

    Null, empty and wordless texts have no window; they get the score of one without differences. Very long texts are
    scored as a whole, window after window. If the labels lack either class every score is 0. Ties: equal texts have equal
    scores, and repeated rows give repeated results; a null doc_id is never held out. An empty table gives an empty
    result. Columns of docs other than doc_id and text, whatever their names, are not looked at.
    """
    found = score(docs, learn(docs, labels))
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
