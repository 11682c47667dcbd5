"""SentencePiece BPE encoding by a table over prefixes, and decoding.

The method. For merge-type BPE, a sequence of tokens is the encoding of its text if and only if each token encodes to
itself and each adjacent pair (a, b) is compatible: the text of a followed by that of b encodes to [a, b]. So every
prefix of a text has exactly one last token: the token t that ends there such that the last token of the prefix before
t is compatible with t. `_prefix_table` finds it for each prefix from left to right, out of the vocabulary matches that
an Aho-Corasick automaton gives at that position; `_recover` then reads the ids off backwards.

Before that a text is cut wherever no piece of the vocabulary spans the two characters, since no merge can cross such a
place. Runs of the space mark are cut off as units: their pieces share one score, so that there the order of merges is
by position alone and pairs don't decide; the runs are merged by position instead.

Tables are built once a worker process and hold the vocabulary; caches are bounded by entries.
"""
from functools import lru_cache
from itertools import chain

import ahocorasick

from millrace.llm.tables import forgettable

MARK = "▁"  # stands for a space
CACHE = 1_000_000  # entries; cleared when full, which costs time only
LONG = 48  # characters; longer texts are not cached


class PieceBPE:
    """Encoder and decoder of one model file: identity normalisation, dummy prefix, byte fallback."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        _refuse_others(model)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.byte_id = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.control = {i for i in range(size) if model.is_control(i)}
        self.unknown = {i for i in range(size) if model.is_unknown(i)}
        plain = [i for i in range(size) if not (i in self.byte_of or i in self.control or i in self.unknown or model.is_unused(i))]
        self.id_of = {self.pieces[i]: i for i in plain}
        self.rank = {p: -model.get_score(i) for p, i in self.id_of.items()}
        self.spanned = {p[i : i + 2] for p in self.id_of for i in range(len(p) - 1)}
        self.spanned.discard(MARK + MARK)  # runs of marks are units
        self.longest_run = max((len(p) for p in self.id_of if not p.strip(MARK)), default=1)
        self.length = [len(p) for p in self.pieces]
        self._pairs: dict[int, bool] = {}
        self._segments: dict[str, tuple[int, ...]] = {}
        self._ids: dict[str, tuple[int, ...]] = {}
        self.rendered: dict[str, tuple[int, str, str]] = {}
        self.automaton = ahocorasick.Automaton()
        for p in self.id_of:
            if len(p) == 1 or self._merged(p) == [p]:  # others never stand in an encoding
                self.automaton.add_word(p, self.id_of[p])
        self.automaton.make_automaton()

    def _merged(self, text: str) -> list[str]:
        """The merges themselves, least rank first and then leftmost: for pairs, for runs of marks, and as brute force."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, a: int, b: int) -> bool:
        """Whether the text of token a followed by that of b encodes to the two."""
        x, y = self.pieces[a], self.pieces[b]
        known = x[-1] + y[0] not in self.spanned or self._merged(x + y) == [x, y]
        if len(self._pairs) >= CACHE:
            self._pairs.clear()
        self._pairs[a << 20 | b] = known
        return known

    def _prefix_table(self, text: str) -> list[int]:
        """Id of the last token of each prefix of a segment; -1 for a character outside the vocabulary.

        The automaton gives the pieces that end at a place one after another; one at most is compatible there.
        """
        last, pairs, length = [-1] * len(text), self._pairs, self.length
        for end, i in self.automaton.iter(text):
            if last[end] < 0:
                before = end - length[i]
                if before < 0 or (j := last[before]) < 0:
                    last[end] = i
                else:
                    fits = pairs.get(j << 20 | i)
                    if fits or fits is None and self._compatible(j, i):
                        last[end] = i
        return last

    def _recover(self, text: str, last: list[int]) -> list[int]:
        """Ids from the end of the text to its start, each character outside the vocabulary as its bytes; then turned."""
        ids, at, length = [], len(last) - 1, self.length
        while at >= 0:
            if (i := last[at]) >= 0:
                ids.append(i)
                at -= length[i]
            else:
                ids += [self.byte_id[b] for b in reversed(text[at].encode())]
                at -= 1
        return ids[::-1]

    def _run(self, text: str) -> list[str]:
        """Tokens of a run of marks: they fill up from the left to the longest piece, again and again."""
        whole = max(0, len(text) - 3 * self.longest_run) // self.longest_run
        return [MARK * self.longest_run] * whole + self._merged(text[whole * self.longest_run :])

    def _segment(self, text: str) -> tuple[int, ...]:
        if (known := self._segments.get(text)) is None:
            if text.startswith(MARK + MARK):
                known = tuple(self.id_of[p] for p in self._run(text))
            else:
                known = tuple(self._recover(text, self._prefix_table(text)))
            if len(text) <= LONG:
                if len(self._segments) >= CACHE:
                    self._segments.clear()
                self._segments[text] = known
        return known

    def _cut(self, text: str) -> list[str]:
        """Segments between which no merge can take place; a run of marks is kept with what it may merge with."""
        spanned, out, start = self.spanned, [], 0
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in spanned:
                out.append(text[start:i])
                start = i
        out.append(text[start:])
        return out

    def chunk(self, text: str) -> tuple[int, ...]:
        """Ids of a space and the text after it, which holds no space."""
        parts, segment, of = self._cut(MARK + text), self._segment, self._segments
        if len(parts) == 1:
            return of.get(parts[0]) or segment(parts[0])
        ids: list[int] = []
        for p in parts:
            ids += of.get(p) or segment(p)
        return tuple(ids)

    def chunks(self, text: str, make, cache: dict) -> list:
        """make(ids) of each chunk of a text whose spaces are single, through a bounded cache that the caller keeps."""
        words = text.split(" ")
        found = list(map(cache.get, words))
        if None in found:
            for at, (word, known) in enumerate(zip(words, found, strict=True)):
                if known is None and (known := cache.get(word)) is None:
                    known = make(self.chunk(word))
                    if len(word) <= LONG:
                        if len(cache) >= CACHE:
                            cache.clear()
                        cache[word] = known
                found[at] = known
        return found

    def _plain(self, marked: str) -> list[int]:
        """Ids of a text in which spaces are marks already; runs of marks become units of the cut."""
        ids: list[int] = []
        at, n = 0, len(marked)
        while at < n:
            run = at
            while run < n and marked[run] == MARK:
                run += 1
            if run - at >= 2:
                # the last mark of a run may merge with the text behind it; that merge has a better score than any run's
                end = run
                while end < n and marked[end] != MARK:
                    end += 1
                tail = self._cut(marked[run - 1 : end])
                first = self._segment(tail[0])
                if len(tail[0]) > 1 and self.pieces[first[0]] != MARK:
                    ids += self._segment(marked[at : run - 1])
                    ids += [i for s in tail for i in self._segment(s)]
                else:
                    ids += self._segment(marked[at:run])
                    if end > run:
                        ids += [i for s in self._cut(marked[run:end]) for i in self._segment(s)]
                at = end
            else:
                end = run
                while end < n and marked[end] != MARK:
                    end += 1
                ids += [i for s in self._cut(marked[at:end]) for i in self._segment(s)]
                at = end
        return ids

    @staticmethod
    def single_spaced(text: str) -> bool:
        """Whether every space stands alone between other characters, and no mark is in the text itself."""
        return not ("  " in text or text[:1] == " " or text[-1:] == " " or MARK in text)

    def encode(self, text: str | None) -> list[int]:
        """Ids as the library gives them without begin or end ids; null is as empty."""
        if not text:
            return []
        if not self.single_spaced(text):
            return self._plain(MARK + text.replace(" ", MARK))
        return list(chain.from_iterable(self.chunks(text, tuple, self._ids)))

    def decode(self, ids) -> str:
        """Text of ids as the library gives it: the first space goes, broken bytes become U+FFFD."""
        out, held, first = [], bytearray(), True
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                first = False
                continue
            if held:
                out.append(_utf8(bytes(held)))
                held.clear()
            if i in self.control:
                continue
            p = " ⁇ " if i in self.unknown else self.pieces[i].replace(MARK, " ")
            if first and p.startswith(" ") and i not in self.unknown:
                p = p[1:]
            first = False
            out.append(p)
        if held:
            out.append(_utf8(bytes(held)))
        return "".join(out)


def _refuse_others(model) -> None:
    """Raises a ValueError for a model whose normaliser changes texts, or that lacks what the encoder builds on."""
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
    norm, train = spec.normalizer_spec, spec.trainer_spec
    wrong = [
        name
        for name, bad in {
            "not of merge type": train.model_type != train.BPE,
            "a normaliser that changes texts": norm.precompiled_charsmap or norm.normalization_rule_tsv,
            "white space is removed": norm.remove_extra_whitespaces,
            "spaces are not marked": not norm.escape_whitespaces,
            "no space mark before the text": not norm.add_dummy_prefix,
            "the space mark is a suffix": train.treat_whitespace_as_suffix,
            "no byte fallback": not train.byte_fallback,
            "user-defined symbols": any(p.type == p.USER_DEFINED for p in spec.pieces),
        }.items()
        if bad
    ]
    if wrong:
        raise ValueError(f"this encoder can't read the model: {', '.join(wrong)}")


def _utf8(raw: bytes) -> str:
    """Whole characters as they are, each byte that belongs to none as U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def piece_bpe(model_path: str) -> PieceBPE:
    """One encoder a worker and file."""
    return PieceBPE(model_path)


forgettable(piece_bpe.cache_clear)
