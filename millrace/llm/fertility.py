"""Quality rules by tokeniser fertility.

One pass over whole texts gives base counts (words, symbols, repeated lines and windows) and, for each public
vocabulary, characters per token, the share of byte-fallback tokens and the entropy of the token ids. Bands then come
from all documents that pass the base rules: for each language (the script where the language is null) the quartiles of
each measure, taken exactly on a fixed grid, widened by FENCE times their distance. Each language has its own band,
however few its texts; the fewer, the wider, by a part that falls with the root of their number. A document outside a
band is rejected. A text counts once for each language, however many copies of it there are, so that no group of copies
sets a band; every row is judged. Bands follow the corpus, and quartiles hold while under a quarter of a language's
different texts is junk of one side. Texts that differ at all, near copies too, count each.

The tables of bands have a row for each language and measure; the grid bounds what the quartiles are counted from.
"""
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tables import slices, stash
from millrace.llm.vocabularies import Vocabularies, blocks, vocabularies

MIN_WORDS = 50
GRID = 0.005  # measures are counted in steps of this
FENCE = 2.5
STEADY_TOKENS = 600  # a shorter text's measures spread more: its bands widen by the root of this over its tokens
FEW = 1.0  # bands of few texts widen by this over the root of their number: about 2.5 standard errors of a quartile
LEAST_WIDTH = 0.02  # a band reaches at least this far beyond its quartiles

# The symbols that count, and white space between words.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = ["chars_per_token", "byte_share", "token_entropy"]  # beside them the count, tokens

# Blocks of scripts by first and last code point.
SCRIPTS = {
    "latin": "A-Za-zªºÀ-ÖØ-öø-ʸḀ-ỿ",
    "greek": "Ͱ-Ͽἀ-῿",
    "cyrillic": "Ѐ-ԯ",
    "arabic": "؀-ۿݐ-ݿ",
    "hebrew": "֐-׿",
    "devanagari": "ऀ-ॿ",
    "han": "㐀-鿿",
    "kana": "぀-ヿ",
    "hangul": "가-힯",
}
_SCRIPTS = {name: re.compile(f"[{ranges}]") for name, ranges in SCRIPTS.items()}


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one whole text."""
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat_words(words)


def repeat_words(words: list) -> int:
    """Words within a window of three that occurs twice or more, the first occurrence included."""
    n = len(words) - 2
    if n < 2 or len(set(zip(words, words[1:], words[2:], strict=False))) == n:
        return 0
    number: dict = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    _, pairs = np.unique(codes[:-1] * len(number) + codes[1:], return_inverse=True)
    _, of, times = np.unique(pairs[:-1] * len(number) + codes[2:], return_inverse=True, return_counts=True)
    often = times[of] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + n] |= often
    return int(covered.sum())


def script(text: str) -> str:
    """The script of the most letters, "none" without any; ties go to the earlier in SCRIPTS."""
    if text.isascii():
        return "latin" if _SCRIPTS["latin"].search(text) else "none"
    counts = {name: len(p.findall(text)) for name, p in _SCRIPTS.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] else "none"


def measures(table: Vocabularies, texts: list[str]) -> list[np.ndarray]:
    """For each vocabulary the rows chars_per_token, byte_share, token_entropy (of that of as many different tokens) and
    tokens, a column a text; 0 for a text without tokens."""
    chars = np.fromiter(map(len, texts), np.float64, len(texts))
    return [_measures(steps, chars, is_byte) for steps, (_, is_byte) in zip(table.gather(texts), table.readers, strict=True)]


def _measures(steps, chars: np.ndarray, is_byte: np.ndarray) -> np.ndarray:
    n_texts = len(chars)
    tokens, fallback, keys, times = np.zeros(n_texts), np.zeros(n_texts), [], []
    for text, own in steps:
        tokens += np.bincount(text, minlength=n_texts)
        fallback += np.bincount(text, is_byte[own], minlength=n_texts)
        key = (text.astype(np.uint64) << np.uint64(32)) | own
        key.sort()
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        keys.append(key[first])
        times.append(np.diff(np.append(first, len(key))))
    several = len(keys) > 1  # then a text may stand in two steps
    keys, times = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (keys, times))
    if several:
        keys, where = np.unique(keys, return_inverse=True)
        times = np.bincount(where, times, minlength=len(keys))
    spread = np.bincount((keys >> np.uint64(32)).astype(np.int64), times * np.log2(np.maximum(times, 1)), minlength=n_texts)
    n = np.maximum(tokens, 1)
    entropy = np.maximum(np.log2(n) - spread / n, 0) / np.log2(np.maximum(n, 2))
    some = tokens > 0
    return np.array([np.where(some, chars / n, 0), fallback / n, np.where(some, entropy, 0), tokens])


def measure(docs: DataFrame, files: dict[str, str]) -> DataFrame:
    """doc_id, key, a digest of the text, the base counts and the measures <vocabulary>_<measure> of every row."""
    names = [f"{v}_{m}" for v in files for m in (*MEASURES, "tokens")]

    def run(batches):
        table = vocabularies(*files.values())
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts = [base_counts(t) for t in texts]
            digests = [xxhash.xxh3_128_digest(t.encode()) for t in texts]
            keys = [lang if lang is not None else f"script:{script(t)}" for t, lang in zip(texts, batch.column(2).to_pylist(), strict=True)]
            longs = np.array(counts, np.int64).reshape(-1, len(_COUNTS)).T
            doubles = np.hstack([np.vstack(measures(table, block)) for block in blocks(texts)])
            columns = [batch.column(0), pa.array(keys, pa.string()), pa.array(digests, pa.binary()), *map(pa.array, longs), *map(pa.array, doubles)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "digest", *_COUNTS, *names])

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    schema = ", ".join(["doc_id long", "key string", "digest binary", *(f"{c} long" for c in _COUNTS), *(f"{n} double" for n in names)])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), lang.alias("lang"))
    return rows.mapInArrow(run, schema).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def different(measured: DataFrame, names: list[str]) -> DataFrame:
    """One row for each key and text that passes the base rules, whatever the number of its copies."""
    passed = measured.where("not base_failed").select("key", "digest", "base_failed", *names)
    return passed.dropDuplicates(["key", "digest"])  # copies collapse before the shuffle, too


def bands(measured: DataFrame, names: list[str]) -> DataFrame:
    """key, measure, q1, q3 and reach: quartiles of the rows of each key that pass the base rules, and the fence."""
    stacked = F.explode(F.array(*(F.struct(F.lit(n).alias("measure"), F.round(F.col(n) / GRID).cast("long").alias("bin")) for n in names)))
    binned = measured.where("not base_failed").select("key", stacked.alias("m"))
    counted = binned.groupBy("key", "m.measure", "m.bin").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("key", "measure")
    ranked = counted.withColumn("upto", F.sum("n").over(whole.orderBy("bin"))).withColumn("total", F.sum("n").over(whole))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("bin"))) * GRID
    quartiles = ranked.groupBy("key", "measure").agg(at(0.25).alias("q1"), at(0.75).alias("q3"), F.max("total").alias("rows"))
    reach = F.greatest(FENCE * (F.col("q3") - F.col("q1")), F.lit(LEAST_WIDTH)) * (1 + FEW / F.sqrt("rows"))
    return quartiles.select("key", "measure", "q1", "q3", reach.alias("reach"))


def quality_rules(docs: DataFrame, files: dict[str, str]) -> DataFrame:
    """The measures of every row with base_failed, band (whose bands it is held to), outside (measures beyond) and kept.

    A null text has no words and fails the base rules, as every text under MIN_WORDS words. Null languages take the
    bands of their script. A language with one text that passes the base rules has a band around that text. Very long
    texts are measured as a whole, one at a time. Ties: a measure on its band's end is inside, and equal texts of a
    language have equal results. Repeated rows give repeated results and count once in the bands. An empty table gives an
    empty result. Columns other than doc_id, text and lang, whatever their names, are not looked at; lang may be missing.
    """
    names = [f"{v}_{m}" for v in files for m in MEASURES]
    measured = stash(measure(docs, files), "fertility")
    limits = bands(different(measured, names), names).groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("measure", F.struct("q1", "q3", "reach")))).alias("bands"))
    joined = measured.join(stash(limits, "bands"), "key", "left")

    def beyond(vocabulary: str, name: str):
        value, own_band = F.col(f"{vocabulary}_{name}"), F.col("bands")[f"{vocabulary}_{name}"]
        reach = own_band["reach"] * F.sqrt(F.greatest(F.lit(1.0), STEADY_TOKENS / F.greatest(F.col(f"{vocabulary}_tokens"), F.lit(1.0))))
        return F.when((value < own_band["q1"] - reach) | (value > own_band["q3"] + reach), F.lit(f"{vocabulary}_{name}"))

    outside = F.array_compact(F.array(*(beyond(v, m) for v in files for m in MEASURES)))
    out = joined.withColumn("outside", outside).withColumn("kept", ~F.col("base_failed") & (F.size("outside") == 0))
    return out.withColumnRenamed("key", "band").drop("bands", "digest")
