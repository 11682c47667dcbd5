"""Ids of many texts under public vocabularies, through one bounded table of what stands between single spaces.

No token goes across a single space, so a text's ids are those of its chunks one after another; a text with other spaces
at its ends or in a row, or with the space mark itself, is one chunk. The table has each chunk's place in one array of
ids for each vocabulary; chunks that it lacks go to the vocabulary's library together. Ids are gathered by array
operations for a block of texts at a time.
"""
from array import array
from functools import lru_cache

import numpy as np

from millrace.llm.tables import forgettable
from millrace.llm.word_bpe import word_bpe

CACHE = 500_000  # chunks in a worker's table; when it is full, others are encoded each time, which costs time only
AGAIN = 4  # times as many others as that, and it starts anew, so that it follows the texts
LONG = 48  # characters; longer chunks leave the table after their block
BLOCK = 1 << 20  # characters of a block of texts, about
STEP = 1 << 18  # chunks whose ids are gathered at once


def _pieces(path: str):
    """(ids as bytes of each of many texts, whether an id is a fallback byte) of a sentencepiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    is_byte = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
    return lambda texts: [array("I", ids).tobytes() for ids in model.encode(texts, num_threads=1)], is_byte


def _words(path: str):
    """The same of a word-end file, which has no fallback bytes."""
    words = word_bpe(path)
    return words.many, np.zeros(words.library.get_vocab_size(), bool)


class Vocabularies:
    """The table of some vocabulary files. Chunks over LONG characters, and those that come while it is full, leave it."""

    def __init__(self, *paths: str):
        self.readers = [_pieces(p) if p.endswith(".model") else _words(p) for p in paths]
        self.number: dict[str, int] = {}
        self.passed = 0
        self.ids = [array("I") for _ in self.readers]
        self.ends = [array("Q", [0]) for _ in self.readers]

    def _add(self, chunks: list[str]) -> None:
        for (encode, _), ids, ends in zip(self.readers, self.ids, self.ends, strict=True):
            for found in encode(chunks):
                ids.frombytes(found)
                ends.append(len(ids))
        for chunk in chunks:
            self.number[chunk] = len(self.number)

    def _drop(self, chunks: list[str]) -> None:
        """Forgets the chunks, which were added last."""
        for chunk in chunks:
            del self.number[chunk]
        for ids, ends in zip(self.ids, self.ends, strict=True):
            del ends[len(self.number) + 1 :]
            del ids[ends[-1] :]

    def gather(self, texts: list[str]):
        """For each vocabulary the ids of all texts: pairs (number of the text of each id, ids), some chunks at a time."""
        words, many = [], []
        for t in texts:
            own = (t.split(" ") if single_spaced(t) else [t]) if t else []
            words += own
            many.append(len(own))
        new = set(words).difference(self.number)
        if self.passed > AGAIN * CACHE:
            self._drop(list(self.number))
            self.passed, new = 0, set(words)
        short = [c for c in new if len(c) <= LONG][: CACHE - len(self.number)]
        self._add(short)
        passing = list(new.difference(short)) if len(short) < len(new) else []
        self._add(passing)
        self.passed += len(passing)
        at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        of_word = np.repeat(np.arange(len(texts)), many)
        # copies, as the arrays can't grow while something looks at them
        tables = [(np.array(ids, "<u4"), np.array(ends, np.int64)) for ids, ends in zip(self.ids, self.ends, strict=True)]
        self._drop(passing)
        return [self._steps(at, of_word, *table) for table in tables]

    @staticmethod
    def _steps(at, of_word, ids, ends):
        for a in range(0, len(at), STEP):
            place, text = at[a : a + STEP], of_word[a : a + STEP]
            lengths = ends[place + 1] - ends[place]
            first = ends[place] - np.concatenate(([0], np.cumsum(lengths)[:-1]))
            yield np.repeat(text, lengths), ids[np.arange(int(lengths.sum())) + np.repeat(first, lengths)]


def single_spaced(text: str) -> bool:
    """Whether every space stands alone between other characters, and no space mark is in the text itself."""
    return not ("  " in text or text[:1] == " " or text[-1:] == " " or "▁" in text)


def blocks(texts: list[str]):
    """The texts in runs of at most BLOCK characters, about."""
    block, held = [], 0
    for t in texts:
        block.append(t)
        held += len(t)
        if held >= BLOCK:
            yield block
            block, held = [], 0
    if block:
        yield block


@lru_cache(maxsize=2)
def vocabularies(*paths: str) -> Vocabularies:
    """One table a worker and choice of files."""
    return Vocabularies(*paths)


forgettable(vocabularies.cache_clear)
