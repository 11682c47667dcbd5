"""Ids of a word-end BPE file, as the tokenizers library gives them, through a bounded cache of words.

The file's normaliser and splitter never join text across white space, so a text's ids are those of its runs between
white space one after another. A run of ASCII and Latin-1 letters is lower-cased and split here by the file's own
alternatives, and each part's ids come once from the library's merges, without its normaliser and splitter; any other run
goes to the library whole, as does a run with the string of a special token.
"""
import os
import re
from array import array
from functools import lru_cache

from millrace.llm.tables import forgettable

CACHE = 1_000_000  # entries; cleared when full, which costs time only
LONG = 48  # characters; longer texts are not cached

# The file's white space is Unicode's White_Space; its alternatives, for plain runs, are fixed values.
_SPACE = re.compile("[%s]+" % "".join(c for c in map(chr, range(0x3001)) if c.isspace() and not "\x1c" <= c <= "\x1f"))
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")
_PLAIN = re.compile("[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
_ODD = re.compile("[\x1c-\x1f]")  # white space to str.split only
# Byte-level vocabularies spell a byte that isn't printable in Latin-1 as a character from 256 on, in order.
_ODD_BYTES = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_SPELT = {b: 256 + i for i, b in enumerate(_ODD_BYTES)}


class WordBPE:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a worker has one core
        self.library = Tokenizer.from_file(path)
        self._merges = self.library.model.tokenize
        self._ids: dict[str, bytes] = {}  # of runs and of parts, since a part is a run with itself as its only part

    def _whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _merged(self, part: str) -> bytes:
        """Ids of a part of a plain run."""
        spelt = part if part.isascii() else part.encode().decode("latin-1").translate(_SPELT)
        return array("I", [t.id for t in self._merges(spelt)]).tobytes()

    def _kept(self, text: str, ids: bytes) -> bytes:
        if len(text) <= LONG:
            if len(self._ids) >= CACHE:
                self._ids.clear()
            self._ids[text] = ids
        return ids

    def _part(self, text: str) -> bytes:
        known = self._ids.get(text)
        return self._kept(text, self._merged(text)) if known is None else known

    def _run(self, text: str) -> bytes:
        if not _PLAIN.fullmatch(text) or "<|" in text:
            return self._kept(text, self._whole(text))
        parts = _PARTS.findall(text.lower())
        if len(parts) == 1 and parts[0] == text:
            return self._part(text)
        return self._kept(text, b"".join(map(self._part, parts)))

    @staticmethod
    def _split(text: str) -> list[str]:
        return _SPACE.split(text) if _ODD.search(text) else text.split()

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of a text; none for null."""
        if not text:
            return b""
        runs = self._split(text)
        found = list(map(self._ids.get, runs))
        if None in found:
            found = [self._run(r) if f is None else f for r, f in zip(runs, found, strict=True)]
        return b"".join(found)

    def many(self, texts: list[str]) -> list[bytes]:
        """encode() of each text, for short texts that the caller keeps: parts are kept here, runs aren't."""
        split = [[_PARTS.findall(r.lower()) if _PLAIN.fullmatch(r) and "<|" not in r else r for r in self._split(t)] for t in texts]
        known = self._ids
        if len(known) >= CACHE:
            known.clear()
        new = {p for runs in split for r in runs if type(r) is list for p in r}.difference(known)
        known.update((p, self._merged(p)) for p in new)
        out = [b"".join([b"".join([known[p] for p in r]) if type(r) is list else self._whole(r) for r in runs]) for runs in split]
        for p in new:
            if len(p) > LONG:
                del known[p]
        return out


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBPE:
    """One encoder a worker and file."""
    return WordBPE(path)


forgettable(word_bpe.cache_clear)
