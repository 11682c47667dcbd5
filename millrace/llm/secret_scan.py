"""Secret scans: candidates by pattern, false positives removed by a random forest.

Candidates are found in whole texts: private key blocks (encrypted ones and ones that are cut off, too), values assigned
to secret names, bearer tokens, passwords in URLs, and long strings of letters and digits. A forest scores each from its length and alphabet, its character transitions (against those of labelled
secrets and others), how much of it dictionary words cover, the path, and the words around it. The forest is trained on
the driver from labelled findings, a bounded set, and is small; scoring runs in the pass that finds candidates.
"""
import hashlib
import re
from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.forest import Forest, grow
from millrace.llm.secret_findings import BENIGN_NAMES, PROSE, WORDS, Finding, labelled_findings
from millrace.llm.tables import forget, free_name, slices

THRESHOLD = 0.5
AROUND = 48  # characters before and after a candidate
TREES, DEPTH = 40, 10
REDACTED = "[SECRET]"

# Patterns of candidates, secret names and public key prefixes.
_BEGIN = r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
_BLOCK = _BEGIN + r"(?:(?!-----)[\s\S])+-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
_CUT_OFF = _BEGIN + r"(?:(?:\s|\\[rn])+(?:[A-Za-z][A-Za-z-]*:[^\n]*|[A-Za-z0-9+/=]{16,}(?![A-Za-z0-9+/=])))+"
_ASSIGNED = r"(?ai:(?:api_?-?key|secret|token|passw(?:or)?d|passwd|pwd|credential|(?:access|secret|private|auth|account|encryption|signing)_?-?key)s?)[\"']?\s*[:=]\s*[\"']?(?P<assigned>[^\s\"'&]{8,})"
_BEARER = r"(?ai:\bbearer)[ \t]+(?P<bearer>[A-Za-z0-9._~+/\-]{16,}=*)"
_IN_URL = r"://[^\s:/@]+:(?P<in_url>[^\s:/@]{6,})@"
_LONG = r"(?<![A-Za-z0-9_+/=.\-])(?=[A-Za-z_+/=.\-]*[0-9])[A-Za-z0-9_+/=.\-]{16,}"
_CANDIDATE = re.compile("|".join([_BLOCK, _CUT_OFF, _ASSIGNED, _BEARER, _IN_URL, _LONG]))
_HINTS = ["private key", "://", "key", "secret", "token", "passw", "pwd", "credential", "bearer"]  # all patterns but _LONG need one
_LONG_ONLY = re.compile(_LONG)
_SECRET_NAME = re.compile(r"(?i)(token|secret|api.?key|passw|pwd|credential|auth|bearer|private.?key|access.?key)")
_BENIGN_NAME = re.compile("(?i)\\b(" + "|".join(BENIGN_NAMES + ["hash", "url", "http", "https", "phone", "card"]) + ")\\b")
_PREFIX = re.compile(r"(AKIA|ASIA|gh[pousr]_|sk_live_|rk_live_|sk-|xox[abprs]-|AIza|eyJ|-----BEGIN)")
_PLACEHOLDER = re.compile(r"(?i)(your|example|dummy|placeholder|insert|change.?me|xxxx|here$)")
_MOCK_PATH = re.compile(r"(?i)(test|spec|mock|fixture|sample|example|doc)")
_SECRET_PATH = re.compile(r"(?i)(\.env|\.pem|secret|credential|prod|deploy|config|settings)")
_ENDS_ASSIGNED = re.compile(r"[:=]\s*[\"']?$")
_DOMAIN = re.compile(r"(?i)\.(com|org|net|io|html?|php|jpg|png|js|py)\b")
_WORD = re.compile("|".join(sorted({*WORDS, *(w for w in PROSE if len(w) > 2)}, key=len, reverse=True)), re.I)


def _kind(c: str) -> str:
    return "0" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c


class Transitions:
    """Log-odds of character pairs, secrets against others."""

    def __init__(self, findings: list[Finding]):
        counts = {True: Counter(), False: Counter()}
        for f in findings:
            counts[f.secret].update(zip(f.candidate, f.candidate[1:], strict=False))
        pairs = set(counts[True]) | set(counts[False])
        total = {k: sum(c.values()) + len(pairs) for k, c in counts.items()}
        self.odds = {p: log((counts[True][p] + 1) / total[True]) - log((counts[False][p] + 1) / total[False]) for p in pairs}

    def mean(self, candidate: str) -> float:
        pairs = list(zip(candidate, candidate[1:], strict=False))
        return sum(self.odds.get(p, 0.0) for p in pairs) / max(1, len(pairs))


def features(path: str, before: str, candidate: str, after: str, transitions: Transitions) -> list[float]:
    n = max(1, len(candidate))
    times = Counter(candidate)
    entropy = -sum(k / n * log(k / n, 2) for k in times.values())
    kinds = [_kind(c) for c in candidate]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))
    covered = sum(len(m) for m in _WORD.findall(candidate))
    return [
        n, entropy, entropy / max(1.0, log(n, 2)), len(times) / n, kinds.count("0") / n, kinds.count("A") / n, kinds.count("a") / n,
        float(set(candidate.lower()) <= set("0123456789abcdef")), changes / n, transitions.mean(candidate), covered / n,
        float(bool(_SECRET_NAME.search(before))), float(bool(_BENIGN_NAME.search(before))), float(bool(_ENDS_ASSIGNED.search(before))),
        float(after[:1] in "\"'" and after != ""), float(bool(_PREFIX.match(candidate))), float(bool(_PLACEHOLDER.search(candidate))),
        float(bool(_MOCK_PATH.search(path))), float(bool(_SECRET_PATH.search(path))), float(bool(_DOMAIN.search(candidate))), float(candidate.count("-") == 4 and n == 36),
    ]


class Scanner:
    """Candidates of a text with their scores."""

    def __init__(self, findings: list[Finding]):
        self.transitions = Transitions(findings)
        x = np.array([features(f.path, f.before[-AROUND:], f.candidate, f.after[:AROUND], self.transitions) for f in findings])
        y = np.array([f.secret for f in findings], np.float64)
        self.forest: Forest = grow(x, y, TREES, DEPTH)

    def candidates(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of each candidate in order; they don't overlap."""
        low = text.lower()
        found = (_CANDIDATE if any(hint in low for hint in _HINTS) else _LONG_ONLY).finditer(text)
        return [m.span(m.lastgroup) if m.lastgroup else m.span() for m in found]

    def scan(self, texts: list[str], paths: list[str]) -> list[list[tuple[int, int, float]]]:
        """(start, end, score) of the candidates of each text. A private key block is a secret as it stands."""
        found = [self.candidates(t) for t in texts]
        x = [features(p, t[max(0, a - AROUND) : a], t[a:b], t[b : b + AROUND], self.transitions) for t, p, spans in zip(texts, paths, found, strict=True) for a, b in spans]
        scores = iter(self.forest.score(np.array(x)).tolist() if x else [])
        return [[(a, b, 1.0 if t.startswith("-----BEGIN", a) else s) for (a, b), s in zip(spans, scores, strict=False)] if spans else [] for t, spans in zip(texts, found, strict=True)]


def _shared(docs: DataFrame, findings: list[Finding] | None):
    return docs.sparkSession.sparkContext.broadcast(Scanner(findings or labelled_findings()))


def _path(docs: DataFrame):
    return F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")


def secret_scan(docs: DataFrame, findings: list[Finding] | None = None) -> DataFrame:
    """A row per candidate: doc_id, start, end (characters), sha256 of it, score and is_secret.

    Null and empty texts have none; very long ones are scanned as a whole. The path is the column source where there is
    one, null counting as empty. Repeated rows give repeated results. Ties: candidates in one text don't overlap, the
    leftmost one wins, and a score of exactly THRESHOLD is a secret. An empty table gives an empty result. Columns other
    than doc_id, text and source, whatever their names, are not looked at.
    """
    shared = _shared(docs, findings)

    def run(batches):
        forget()
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            out = [
                (d, a, b, hashlib.sha256(t[a:b].encode()).hexdigest(), s)
                for d, t, spans in zip(batch.column(0).to_pylist(), texts, shared.value.scan(texts, [p or "" for p in batch.column(2).to_pylist()]), strict=True)
                for a, b, s in spans
            ]
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "start", "end", "sha256", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _path(docs).alias("path"))
    return rows.mapInArrow(run, "doc_id long, start long, end long, sha256 string, score double").withColumn("is_secret", F.col("score") >= THRESHOLD)


def replaced(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """text with REDACTED for each of the spans, which are in order and don't overlap."""
    if not spans:
        return text
    starts, ends = zip(*spans, strict=True)
    return REDACTED.join(text[a:b] for a, b in zip((0, *ends), (*starts, len(text)), strict=True))


def redact(docs: DataFrame, findings: list[Finding] | None = None) -> DataFrame:
    """docs with each secret in text replaced by REDACTED; n_chars, where there is one, follows. Rows and columns stay.

    Null and empty texts stay as they are; very long ones are scanned as a whole. Rows without a doc_id and repeated rows
    change like others. Ties are as in `secret_scan`. An empty table gives an empty result. Columns other than text, source
    and n_chars, whatever their names, are kept and not looked at.
    """
    shared = _shared(docs, findings)
    schema, at, name = docs.schema, docs.columns.index("text"), free_name(docs, "path")

    def run(batches):
        forget()
        for batch in slices(batches):
            texts = batch.column(at).to_pylist()
            new = []
            for text, spans in zip(texts, shared.value.scan([t or "" for t in texts], [p or "" for p in batch.column(batch.num_columns - 1).to_pylist()]), strict=True):
                new.append(replaced(text, [(a, b) for a, b, s in spans if s >= THRESHOLD]))
            columns = [*batch.columns[:-1]]
            columns[at] = pa.array(new, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    out = docs.withColumn(name, _path(docs)).mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
