"""Quality classifier by co-training of a text view and a metadata view.

Views:
- text: byte shares, transitions between kinds of characters, and repetition of words and lines, of the whole text;
- metadata: source, language, length and layout (lines, their lengths), nothing of what the text says.
Each view has a logistic model. In each round every unlabelled document of the corpus is scored by both models, calibrated
on labelled rows that neither learns from. Each model labels the documents that it is surest of, as many of either class as
the labelled rows' proportion asks for; tasks find their surest ones, and the surest of all tasks are taken. These join the
other model's rows if its loss on the calibration rows doesn't grow by them. At last each model is calibrated on those rows,
and a logistic model of the two calibrated log-odds combines them.

Texts are read once: a document's two views are 824 bytes of 16-bit floats, written to the shared folder. Rounds and scoring
read these. The fit takes a bounded sample of labelled rows, and a bounded number of pseudo-labels a round.
"""
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import free_name, held_out, located, marked, sample, slices, stash

LABELLED_ROWS = 6000  # of either class together, at most
ROUNDS = 4
UNSURE = 0.1  # greatest calibrated chance that a pseudo-label is wrong
EACH_ROUND = 400  # pseudo-labels that a view gives in a round, at most: the surest of the whole corpus
KEEP = 0.5
SOURCES, LANGS = 64, 16  # slots for hashed names

# Kinds of bytes: space, newline, digit, upper, lower, mark of a sentence, other ASCII, beyond ASCII.
_KIND = np.array([1 if b == 10 else 0 if b in b" \t\r\x0b\x0c" else 2 if 48 <= b < 58 else 3 if 65 <= b < 91 else 4 if 97 <= b < 123 else 5 if b in b".,;:!?'\"()-" else 6 if b < 128 else 7 for b in range(256)], np.int64)
TEXT_SIZE = 256 + 64 + 6
META_SIZE = SOURCES + LANGS + 6


def text_view(text: str) -> np.ndarray:
    """Features of what the text says; all zero for an empty text."""
    out = np.zeros(TEXT_SIZE, np.float32)
    raw = np.frombuffer(text.encode(), np.uint8)
    if not len(raw):
        return out
    out[:256] = np.sqrt(np.bincount(raw, minlength=256) / len(raw))
    kind = _KIND[raw]
    if len(raw) > 1:
        out[256:320] = np.sqrt(np.bincount(kind[:-1] * 8 + kind[1:], minlength=64) / (len(raw) - 1))
    words = text.split()
    if words:
        lines = [line for line in text.split("\n") if line.strip()]
        out[320:] = (
            len(set(words)) / len(words),
            sum(a == b for a, b in zip(words, words[1:], strict=False)) / len(words),
            min(sum(map(len, words)) / len(words), 40) / 10,
            1 - len(set(lines)) / max(1, len(lines)),
            sum(w.isupper() for w in words) / len(words),
            np.log1p(len(words)) / 10,
        )
    return out


def meta_view(source: str | None, lang: str | None, text: str) -> np.ndarray:
    """Features of where a page comes from and how it is laid out. Null names share a slot with the empty name."""
    out = np.zeros(META_SIZE, np.float32)
    out[zlib.crc32((source or "").encode()) % SOURCES] = 1
    out[SOURCES + zlib.crc32((lang or "").encode()) % LANGS] = 1
    lines = text.count("\n") + 1
    out[SOURCES + LANGS :] = (np.log1p(len(text)) / 10, np.log1p(lines) / 5, np.log1p(len(text) / lines) / 10, len(text) < 100, len(text) < 500, len(text) > 20_000)
    return out


def _read(docs: DataFrame) -> DataFrame:
    """doc_id, text, source and lang, null where docs lacks one of the last two."""
    other = [(F.col(c) if c in docs.columns else F.lit(None)).cast("string").alias(c) for c in ("source", "lang")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *other)


def views(rows: DataFrame) -> DataFrame:
    """doc_id and view (text view and metadata view, 16-bit floats as bytes) of rows from _read."""

    def run(batches):
        for batch in slices(batches):
            texts, sources, langs = ([x for x in batch.column(c).to_pylist()] for c in ("text", "source", "lang"))
            both = [np.concatenate((text_view(t or ""), meta_view(s, lang, t or ""))).astype("<f2").tobytes() for t, s, lang in zip(texts, sources, langs, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(both, pa.binary())], names=["doc_id", "view"])

    return rows.mapInArrow(run, "doc_id long, view binary")


def unpacked(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text views and metadata views, a row each."""
    both = np.frombuffer(b"".join(found), "<f2").reshape(-1, TEXT_SIZE + META_SIZE).astype(np.float32)
    return both[:, :TEXT_SIZE], both[:, TEXT_SIZE:]


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 25) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the last one is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    w, keep = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


def _share(odds):
    return 1 / (1 + np.exp(-odds))


def _calibrated(x: np.ndarray, w: np.ndarray, slope: np.ndarray) -> np.ndarray:
    """A view's log-odds, put right by its slope and shift."""
    return _odds(_odds(x, w)[:, None], slope)


def _loss(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """Mean log-loss of a view's model on calibration rows, once calibrated there."""
    odds = _calibrated(x, w, _fit(_odds(x, w)[:, None], y))
    return float(np.logaddexp(0, np.where(y > 0, -odds, odds)).mean())


def surest(found, models, want: dict[int, int], error: dict[int, float], taken: set[int]) -> list[tuple]:
    """(view, label, wrong, code, both views) of the rows that each view's calibrated model is surest of, want[label] of each label at most.

    found gives (codes, both views as bytes) of some rows at a time. wrong is the calibrated chance of error, at most
    error[label]. Rows of equal code are one; those in `taken` are left out. Ties go to the smaller code.
    """
    best: dict = {}
    for codes, both in found:
        parts, codes = unpacked(both), np.array(codes, np.int64)
        free = np.array([c not in taken for c in codes.tolist()], bool)
        for view, (w, slope) in enumerate(models):
            p = _share(_calibrated(parts[view], w, slope))
            for label, n in want.items():
                wrong = np.round(1 - p if label else p, 9)
                at = np.flatnonzero(free & (wrong <= error[label]))
                at = at[np.lexsort((codes[at], wrong[at]))]
                at = at[np.sort(np.unique(codes[at], return_index=True)[1])][:n]
                own = best.get((view, label), {}) | {int(codes[i]): (float(wrong[i]), both[i]) for i in at}
                best[view, label] = dict(sorted(own.items(), key=lambda x: (x[1][0], x[0]))[:n])
    return [(view, label, wrong, code, both) for (view, label), own in best.items() for code, (wrong, both) in own.items()]


class Pool:
    """The unlabelled rows of a table of views."""

    def __init__(self, found: DataFrame, known: DataFrame):
        """`found` is a stashed table of doc_id and view; `known` has the doc_ids that have a label."""
        rows, place = located(found)
        name = free_name(rows, "labelled")
        labelled = rows.select("doc_id", F.col(place).alias("place")).join(known.select("doc_id"), "doc_id").select("place")
        self.rows = marked(rows, place, labelled, name).where(~F.col(name)).select(F.xxhash64("view").alias("code"), "view")

    def surest(self, models, want, error, taken) -> list[tuple]:
        """`surest` of all rows: tasks find theirs, and of these the surest are taken."""

        def run(batches):
            found = surest(((b.column(0).to_pylist(), b.column(1).to_pylist()) for b in slices(batches)), models, want, error, taken)
            columns = list(zip(*found, strict=True)) or [()] * 5
            kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["view", "label", "wrong", "code", "both"])

        found = stash(self.rows.mapInArrow(run, "view int, label int, wrong double, code long, both binary"), "surest")
        out = []
        for view in range(len(models)):
            for label, n in want.items():
                own = found.where((F.col("view") == view) & (F.col("label") == label)).groupBy("code").agg(F.min("wrong").alias("wrong"), F.first("both").alias("both"))
                out += [(view, label, r.wrong, r.code, bytes(r.both)) for r in own.orderBy("wrong", "code").limit(n).collect()]
        return out


def co_train(x, y: np.ndarray, pool, rest, rest_y: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
    """Weights of the two views' models after ROUNDS exchanges of pseudo-labels, and the labels each view took over.

    x and rest hold both views' rows; pool.surest finds the rows of the corpus that views are surest of. In a round each
    view's model is calibrated on `rest`, and offers the other view the labels of up to EACH_ROUND rows, as many of either
    class as the labelled rows' proportion asks for. It is sure where its calibrated chance of error is at most UNSURE,
    and at most a fifth of that of always saying this label: a view that can't tell good from bad offers none. The other
    view takes them over if its loss on `rest` doesn't grow by them; else they stay in the pool.
    """
    own, count = [(v, y) for v in x], [0, 0]
    w = [_fit(*rows) for rows in own]
    loss = [_loss(rest[view], rest_y, w[view]) for view in (0, 1)]
    good, taken = float(y.mean()), set()
    want = {1: round(EACH_ROUND * good), 0: round(EACH_ROUND * (1 - good))}
    error = {1: min(UNSURE, (1 - good) / 5), 0: min(UNSURE, good / 5)}
    for _ in range(ROUNDS):
        found = pool.surest([(w[v], _fit(_odds(rest[v], w[v])[:, None], rest_y)) for v in (0, 1)], want, error, taken)
        moved = False
        for view in (1, 0):
            chosen = [(label, code, both) for by, label, _, code, both in found if by != view and code not in taken]
            if chosen:
                labels, codes, both = zip(*chosen, strict=True)
                more = np.vstack([own[view][0], unpacked(both)[view]]), np.append(own[view][1], labels)
                after = _fit(*more)
                if (now := _loss(rest[view], rest_y, after)) <= loss[view]:
                    own[view], w[view], loss[view] = more, after, now
                    count[view] += len(codes)
                    taken.update(codes)
                    moved = True
        if not moved:  # the next round would offer the same
            break
    return w, count


class Model:
    """Two views' weights, their calibrations (slope, shift) and the combination. parts is None if there is one class."""

    def __init__(self, x, y, pool, calibrate):
        self.parts = None
        fit, rest = ~calibrate, calibrate
        if len(set(y[fit])) < 2 or len(set(y[rest])) < 2:
            return
        w, _ = co_train((x[0][fit], x[1][fit]), y[fit], pool(), (x[0][rest], x[1][rest]), y[rest])
        slopes = [_fit(_odds(x[v][rest], w[v])[:, None], y[rest]) for v in (0, 1)]
        both = np.column_stack([_calibrated(x[v][rest], w[v], slopes[v]) for v in (0, 1)])
        self.parts = (w, slopes, _fit(both, y[rest]))

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(p_text, p_meta, score), each 0 to 1; a half everywhere without a model."""
        if self.parts is None:
            return (np.full(len(text), 0.5),) * 3
        w, slopes, combined = self.parts
        odds = [_calibrated(v, w[i], slopes[i]) for i, v in enumerate((text, meta))]
        return _share(odds[0]), _share(odds[1]), _share(_odds(np.column_stack(odds), combined))


def learn(found: DataFrame, labels: DataFrame) -> Model:
    """Model from a stashed table of views and labelled rows that are not held out; one labelled both ways is of low quality.

    At most LABELLED_ROWS labelled rows are taken, in the labels' proportion. Rows with any label get no pseudo-label.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality is not null")
    known = known.groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("label"))
    ours = known.where(~held_out())
    n = {r.label: r.n for r in ours.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    bounds = {label: max(1, LABELLED_ROWS * k // sum(n.values())) for label, k in n.items()}
    labelled = sample(found, ours, bounds, content="view").collect() if len(bounds) == 2 else []
    labelled = sorted(labelled, key=lambda r: (r.doc_id, bytes(r.view)))
    y = np.array([r.label for r in labelled], np.float64)
    return Model(unpacked([r.view for r in labelled]), y, lambda: Pool(found, known), np.array([zlib.crc32(f"fold {r.doc_id}".encode()) % 4 == 0 for r in labelled], bool))


def score(found: DataFrame, model: Model) -> DataFrame:
    """doc_id, p_text, p_meta and score of every row of a table of views."""

    def run(batches):
        for batch in slices(batches):
            scores = model.score(*unpacked(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, scores)], names=["doc_id", "p_text", "p_meta", "score"])

    return found.select("doc_id", "view").mapInArrow(run, "doc_id long, p_text double, p_meta double, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, p_text, p_meta, score and kept of every row.

    Null and empty texts have features of zero and are scored like others; very long ones are read as a whole, one at a
    time. Without labels of both classes every score is a half and all rows are kept. Null or missing source and lang
    share the slot of the empty name. Ties: a score of exactly KEEP is kept, and equal rows have equal scores. Repeated
    rows give repeated results; a null doc_id is never held out. An empty table gives an empty result. Columns other than
    doc_id, text, source and lang, whatever their names, are not looked at.
    """
    rows = stash(views(_read(docs)), "views")
    found = score(rows, learn(rows, labels))
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "p_text", "p_meta", "score", (F.col("score") >= KEEP).alias("kept"))
