"""Language ID by multinomial naive Bayes over hashed character n-grams.

Learning: a bounded sample of labelled rows, whole texts, is hashed on the executors into sparse counts (language, slot,
count), which are summed in the JVM and laid out as parts of a matrix in tasks; the driver puts these together. The model is
a matrix of log-probabilities, SLOTS by languages; MOST_LANGUAGES bounds the broadcast, more labels than that are an error.

Scoring: texts are laid end to end as code points, letters lower-cased and everything else a space, in blocks of bounded
size; a text that is longer than a block goes on in the next one, with as many characters more as its last n-grams need.
All n-grams of a block are hashed by array operations and counted into a sparse matrix (texts by slots, as rows of sorted
slots with their counts), which is multiplied with the model's in parts of bounded size.
"""
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import bottom, forget, free_name, held_out, overdrawn, share, slices

SLOTS = 1 << 16
ORDERS = (1, 2, 3)
SAMPLE_ROWS = 20_000  # labelled rows learned from, at most, shared by the languages
MOST_LANGUAGES = 1024  # labels that a model may have: a broadcast of 256 MB
BLOCK = 1 << 17  # code points hashed at once
CELLS = 1 << 22  # of the product of the two matrices, computed at once
STEADY = 60.0  # n-grams that count in full towards the score; longer texts are scored by their mean
PART = 1 << 10  # slots of the matrix that one task lays out
UNDETERMINED = "und"
KEEP = 0.5  # least score of a document that `identified` keeps


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """For each code point its lower case if it is a letter, a space otherwise."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if (char := chr(c)).isalpha():
            low = char.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def blocks(texts: list[str | None], size: int = 0):
    """Whole texts in blocks of at most `size` starts of n-grams, about: (rows, code points, starts) of each.

    A block is the code points of its parts one after another; rows has the text's index for each part and starts the
    number of its places where n-grams of that text start. A text starts at a space before it and ends before a space.
    """
    size, beyond = size or BLOCK, max(ORDERS) - 1
    rows, parts, starts, held = [], [], [], 0
    for i, text in enumerate(texts):
        padded = f" {text or ''}"
        for at in range(0, len(padded), size):
            n = min(size, len(padded) - at)
            rows.append(i)
            parts.append(padded[at : at + n + beyond].ljust(n + beyond))
            starts.append(n)
            held += n
            if held >= size or len(rows) >= SLOTS:
                yield rows, "".join(parts), starts
                rows, parts, starts, held = [], [], [], 0
    if rows:
        yield rows, "".join(parts), starts


def hashed(points: str) -> np.ndarray:
    """(order, place): the slots of the n-grams that start at each code point; -1 where one has no letter."""
    beyond = max(ORDERS) - 1
    folded = _folded()[np.frombuffer((points + " " * beyond).encode("utf-32-le", "surrogatepass"), "<u4")]
    n = len(folded) - beyond
    out = np.empty((len(ORDERS), n), np.int32)
    letters = folded != 32
    h, any_letter = np.zeros(n, np.uint32), np.zeros(n, bool)
    for k in range(max(ORDERS)):
        with np.errstate(over="ignore"):
            h = (h ^ folded[k : k + n]) * np.uint32(0x01000193) + np.uint32(0x9E3779B9)
            any_letter = any_letter | letters[k : k + n]
            if k + 1 in ORDERS:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                out[ORDERS.index(k + 1)] = np.where(any_letter, (mixed >> np.uint32(16)) & np.uint32(SLOTS - 1), -1)
    return out


def sparse(rows: list[int], points: str, starts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, count) of a block, sorted by row and slot, each pair once. Rows number at most SLOTS."""
    names, row = np.unique(np.array(rows, np.int64), return_inverse=True)
    beyond, slots = max(ORDERS) - 1, hashed(points)
    widths = np.array(starts, np.int64)
    row_of = np.repeat(row.astype(np.uint32), widths + beyond)
    ends = np.cumsum(widths + beyond)
    real = np.ones(len(row_of), bool)
    for k in range(1, beyond + 1):
        real[ends - k] = False
    row_of, slots = row_of[real], slots[:, real]
    keys = np.concatenate([(row_of[s >= 0] << np.uint32(16)) | s[s >= 0].astype(np.uint32) for s in slots])
    keys.sort()
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    keys, n = keys[first], np.diff(np.append(first, len(keys)))
    return names[keys >> np.uint32(16)], (keys & np.uint32(SLOTS - 1)).astype(np.int64), n


def counts(docs: DataFrame) -> DataFrame:
    """lang, slot, n over docs (text, lang), whole texts: what naive Bayes learns from."""

    def run(batches):
        forget()
        for batch in slices(batches):
            langs = batch.column(1).to_pylist()
            number = {lang: i for i, lang in enumerate(sorted(set(langs)))}
            names = pa.array(sorted(number), pa.string())
            for rows, points, starts in blocks(batch.column(0).to_pylist()):
                of, slot, n = sparse([number[langs[i]] for i in rows], points, starts)
                yield pa.RecordBatch.from_arrays([names.take(pa.array(of)), pa.array(slot.astype(np.int32)), pa.array(n.astype(np.int64))], names=["lang", "slot", "n"])

    return docs.select("text", "lang").mapInArrow(run, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))


class Model:
    """langs in order, and log-probabilities by slot and language."""

    def __init__(self, langs: list[str], logp: np.ndarray):
        self.langs, self.logp = langs, logp

    def sums(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihoods by text and language, and the n-grams of each text."""
        width = max(len(self.langs), 1)
        sums, ns = np.zeros((len(texts), width)), np.zeros(len(texts))
        for block in blocks(texts):
            row, slot, n = sparse(*block)
            ns += np.bincount(row, n, minlength=len(texts))
            for at in range(0, len(row) if self.langs else 0, max(1, CELLS // width)):
                part = slice(at, at + max(1, CELLS // width))
                cells = self.logp[slot[part]] * n[part, None].astype(np.float32)
                first = np.flatnonzero(np.concatenate(([True], np.diff(row[part]) > 0)))
                sums[row[part][first]] += np.add.reduceat(cells, first, axis=0, dtype=np.float64)
        return sums, ns

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        sums, ns = self.sums(texts)
        sums *= np.minimum(1.0, STEADY / np.maximum(ns, 1.0))[:, None]
        best = sums.argmax(axis=1)
        odds = np.exp(sums - sums.max(axis=1, keepdims=True))
        share = odds.max(axis=1) / odds.sum(axis=1)
        known = (ns > 0) & bool(self.langs)
        return [self.langs[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)], np.where(known, share, 0.0).tolist()


def matrix(found: DataFrame, langs: list[str]) -> np.ndarray:
    """Counts (lang, slot, n) as a matrix, slots by languages: parts of it are laid out in tasks, the driver puts them together."""
    number = {lang: i for i, lang in enumerate(langs)}

    def lay(rows: pa.Table) -> pa.Table:
        slot, part = rows["slot"].to_numpy(), np.zeros((PART, len(langs)), np.float32)
        part[slot % PART, [number[lang] for lang in rows["lang"].to_pylist()]] = rows["n"].to_numpy()
        return pa.table({"part": pa.array([slot[0] // PART], pa.int32()), "cells": pa.array([part.tobytes()], pa.binary())})

    out = np.zeros((SLOTS, len(langs)), np.float32)
    for r in found.groupBy(F.floor(F.col("slot") / PART)).applyInArrow(lay, "part int, cells binary").toLocalIterator():
        out[r.part * PART : (r.part + 1) * PART] = np.frombuffer(r.cells, np.float32).reshape(PART, -1)
    return out


def learn(docs: DataFrame) -> Model:
    """Model from rows with a language that are not held out, SAMPLE_ROWS of them at most, each language with its share.

    Rows are taken whole, by the least hashes of doc_id and text, rows that repeat both counting once (`tables.bottom`). A
    language whose texts have no letter isn't learned. More than MOST_LANGUAGES labels raise a ValueError.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("label"))
    rows = rows.where("label is not null and label <> 'und'").where(~F.coalesce(held_out(), F.lit(False)))
    # about how many rows there are, however often one of them repeats
    n = F.approx_count_distinct("doc_id") + F.count_if(F.col("doc_id").isNull())
    by_lang = rows.groupBy("label").agg(n.alias("n")).limit(MOST_LANGUAGES + 1).collect()
    langs = sorted(r.label for r in by_lang)
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in lang")
    if not langs:
        return Model([], np.zeros((SLOTS, 0), np.float32))
    # each language has a share of the bound, so that rare ones are learned in full
    bound = max(1, SAMPLE_ROWS // len(langs))
    shares = docs.sparkSession.createDataFrame([(r.label, overdrawn(bound, r.n)) for r in by_lang], "of string, share double")
    drawn = rows.where("text is not null").join(F.broadcast(shares), F.col("label") == F.col("of")).where(share("doc_id", "text") < F.col("share"))
    sampled = bottom(drawn.select("doc_id", "text", "label"), dict.fromkeys(langs, bound))
    n = matrix(counts(sampled.withColumnRenamed("label", "lang")), langs)
    seen = n.any(axis=0)  # a language of texts without a letter teaches nothing
    if not seen.all():
        langs, n = [lang for lang, s in zip(langs, seen, strict=True) if s], n[:, seen]
    n += 0.5
    total = n.sum(axis=0, dtype=np.float64)
    return Model(langs, np.subtract(np.log(n, out=n), np.log(total).astype(np.float32), out=n))


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns `keep` of docs (doc_id by default) with the predicted language and score of each row, under `names`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = keep or ["doc_id"]
    rows = docs.select(*keep, *([] if "text" in keep else ["text"]))
    at, width = rows.columns.index("text"), len(keep)

    def run(batches):
        forget()
        for batch in slices(batches):
            langs, scores = shared.value.score(batch.column(at).to_pylist())
            columns = [*batch.columns[:width], pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:width], *names])

    schema = rows.select(*keep).schema.add(names[0], "string").add(names[1], "double")
    return rows.mapInArrow(run, schema)


def identified(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Rows of docs, columns as they are, whose language the model can tell: neither `und` nor of a score under KEEP.

    Nulls, empty and very long texts, ties and repeated rows are as in `language_id`, and every copy of a kept row stays.
    Without anything to learn from all rows go. An empty table gives an empty result; other columns are kept.
    """
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    found = predict(docs, model or learn(docs), docs.columns, (lang, score))
    return found.where((F.col(lang) != UNDETERMINED) & (F.col(score) >= KEEP)).drop(lang, score)


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, by a model learned from docs' own labelled rows.

    A null text, and one without a letter, gets `und` and score 0; so does every text if nothing can be learned. The
    score is the share of the best language in the posterior, tempered to STEADY n-grams. Ties go to the smaller label.
    A very long text is read as a whole, block after block, and its n-grams are those of one pass.
    Repeated rows give repeated results; a null doc_id is learned from and its held_out is false. An empty table gives
    an empty result. Columns other than doc_id, text and lang, whatever
    their names, are not looked at.
    """
    found = predict(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
