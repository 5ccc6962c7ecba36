"""Token ids of whole texts by a public tokenizer, with a cache of words."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np

#: A worker keeps the ids of at most twice so many words: when so many are new, those not met since the last time go.
CACHED = 250_000
#: A text is handled in pieces of about so many characters, cut at white space.
PIECE = 1 << 20
ASCII_SPACE = re.compile(r"[\t-\r ]+")
#: What str.split takes for white space besides.
PYTHON_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


#: Words that byte-pair encoding takes as they are but for lower case: Latin letters, then ASCII punctuation.
PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]*)([!-/:-@\[-`{-~]*)")
BEYOND_LATIN = re.compile("[\u0130\u0250-\U0010ffff]")
#: Printable stand-ins of bytes in byte-level vocabularies: a byte without a visible Latin-1 character gets the next from 256 on.
VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
STAND_IN = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in VISIBLE)}


class WordEncoder:
    """Encodes texts with word_bpe_49k or a file like it: pretokens never cross ASCII white space.

    The ids of a text are those of its words in order, and are cached by word. A plain word's letters and its
    punctuation are one pretoken each and go to the byte-pair model directly. Other words go to the tokenizer.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a worker has one core
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        #: Tokens that stand for themselves in raw text, such as an end mark; the tokenizer finds them inside words too.
        self.specials = [t.content for t in self.plain.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.model = self.plain.model
        self.ends: dict[str, bytes] = {"": b""}

    def _pretoken(self, text: str) -> bytes:
        shown = text if text.isascii() else text.encode().decode("latin-1").translate(STAND_IN)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])

    def _ending(self, end: str) -> bytes:
        if (ids := self.ends.get(end)) is None:
            if len(self.ends) > CACHED:
                self.ends = {"": b""}
            ids = self.ends[end] = self._pretoken(end)
        return ids

    def _learn(self, fresh: list[str]) -> None:
        rest = []
        for word in fresh:
            if not (parts := PLAIN.fullmatch(word)):
                rest.append(word)
                continue
            letters, end = parts.groups()
            letters = letters.lower()
            if end and (ids := self.words.get(letters)) is not None:
                self.words[word] = ids + self._ending(end)
            else:
                self.words[letters] = ids = self._pretoken(letters) if letters else b""
                self.words[word] = ids + self._ending(end)
        for word, found in zip(rest, self.plain.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.words[word] = np.array(found.ids, "<u4").tobytes()

    def _bytes_of(self, words: list[str]) -> bytes:
        known = self.words
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            if len(known) > CACHED:
                self.older, self.words = known, {}
                known = self.words
            older, fresh = self.older, []
            for word in set(words):
                if word in known:
                    continue
                if (ids := older.get(word)) is None:
                    fresh.append(word)
                else:
                    known[word] = ids
            self._learn(fresh)
            return b"".join(map(known.__getitem__, words))

    def id_bytes(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers; null is an empty text."""
        if not text:
            return b""
        if not BEYOND_LATIN.search(text):
            lowered = text.lower()  # as the tokenizer does; fewer words to know
            if not any(s in lowered for s in self.specials):
                text = lowered
        return b"".join(self._bytes_of(words) for words in pieces(text))


def pieces(text: str) -> Iterable[list[str]]:
    """The words of a text between ASCII white space, in lists that bound memory."""
    if len(text) <= PIECE:
        yield words_of(text)
        return
    start = 0
    while start < len(text):
        cut = ASCII_SPACE.search(text, start + PIECE)
        stop = cut.end() if cut else len(text)
        yield words_of(text[start:stop])
        start = stop


def words_of(text: str) -> list[str]:
    """Words between ASCII white space; str.split where it does the same, which is faster."""
    if PYTHON_SPACE.search(text):
        return [w for w in ASCII_SPACE.split(text) if w]
    return text.split()


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The encoder of this worker for a tokenizer file."""
    return WordEncoder(path)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
