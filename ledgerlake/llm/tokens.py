"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker.

A byte-pair tokenizer never joins text across the places where its pre-tokenizer cuts, and every pre-tokenizer used here
cuts before a single space between two visible characters and around line breaks. Texts are taken apart there. The library
normalises, pre-tokenizes and encodes every word it has not seen; ids are put together again. The result equals that of encoding
the whole text at once; tests compare both. Added tokens of the file, such as <|endoftext|>, have their own ids as the library
gives them by default: a text that may hold one is encoded by the library whole.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

#: Words, and runs of letters, kept by each worker, about 200 bytes each. A half-full table is set aside, and words met again
#: move on into the next one.
CACHE_WORDS = 1_000_000
# Western letters, then marks other than the apostrophe: always these two pre-tokens.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch
_MARKS = re.compile(r"[!-/:-@\[-`{-~]*")
_GAP = re.compile(r" (?=\S)(?<=\S )")
# White space but the space and the line break: ASCII controls and the Unicode spaces.
_ODD = re.compile("[" + "".join(chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n") + "]").search


class Table:
    """Ids by word; learns the missing ones."""

    def __init__(self, learn, most: int):
        self._learn, self._most = learn, most
        self._known: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}

    def with_all(self, words: list[str]) -> dict[str, bytes]:
        """The table, with all these words in it."""
        known = self._known
        missing = set(words).difference(known)
        if missing:
            if len(known) > self._most // 2:
                self._before, self._known = known, {}
                known, missing = self._known, set(words)
            before, learn = self._before, self._learn
            for word in missing:
                known[word] = before.get(word) or learn(word)
        return known


class WordEncoder:
    """``encode(text)``: the ids as little-endian unsigned 32-bit integers. ``spaced``: the tokenizer keeps spaces, each
    as part of the word after it. ``added``: strings of added tokens get the ids of these; else they are ordinary text."""

    def __init__(self, path: str, spaced: bool, words: int = CACHE_WORDS, added: bool = False):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._normalizer, self._model = self._tokenizer.normalizer, self._tokenizer.model
        # How the library writes a leading space, and whether it lower-cases.
        self._mark = self._pre_tokens(" a")[0][:-1] if spaced else ""
        self._lower = self._pre_tokens("A")[0] == "a"
        self._written = {ord(c): self._pre_tokens(c)[0] for c in map(chr, range(0xC0, 0x100)) if c.isalpha()}
        self._break = self._all("\n")
        self._drops = not spaced and not self._break  # all white space goes
        # A word after a space, one after none, and a run of marks after letters.
        self._spaced = Table(lambda word: self._one(self._mark, word, " " if spaced else ""), words)
        self._bare = Table(lambda word: self._one("", word, ""), words) if spaced else self._spaced
        self._letters, self._most = {}, words
        # Marks that the added tokens begin with, which no normalizer changes; of a token without any: every text.
        tokens = self._tokenizer.get_added_tokens_decoder().values() if added else ()
        self._added = sorted({_MARKS.match(t.content)[0] for t in tokens})

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text; of none: nothing."""
        if not text:
            return b""
        if any(marks in text for marks in self._added):
            return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if self._drops and not _ODD(text):
            words = text.split()
            return b"".join(map(self._spaced.with_all(words).__getitem__, words))
        lines = self._lines(text)
        spaced = self._spaced.with_all([word for line in lines for word in line[1:]])
        bare = self._bare.with_all([line[0] for line in lines])
        return self._break.join([bare[line[0]] + b"".join(map(spaced.__getitem__, line[1:])) for line in lines])

    def _lines(self, text: str) -> list[list[str]]:
        """Lines of words. Where white space is other than single spaces and line breaks, there is one line, and its words hold
        that white space."""
        # Of more than two line breaks, or two at the end, the pre-tokenizer makes one piece.
        if "\n\n\n" not in text and text[-2:] != "\n\n" and not _ODD(text):
            lines = [line.split(" ") for line in text.split("\n")]
            if not any("" in line and len(line) > 1 for line in lines):
                return lines
        return [_GAP.split(text)]

    def _pre_tokens(self, word: str) -> list[str]:
        if self._normalizer is not None:
            word = self._normalizer.normalize_str(word)
        return [token for token, _ in self._tokenizer.pre_tokenizer.pre_tokenize_str(word)]

    def _token(self, token: str) -> bytes:
        return array("I", [t.id for t in self._model.tokenize(token)]).tobytes()

    def _all(self, text: str) -> bytes:
        return b"".join(map(self._token, self._pre_tokens(text)))

    def _one(self, mark: str, word: str, lead: str) -> bytes:
        plain = _PLAIN(word)
        if plain is None:
            return self._all(lead + word)
        letters, marks = plain.groups()
        ids = self._run(mark, letters)
        return ids + self._run("", marks) if marks else ids

    def _run(self, mark: str, run: str) -> bytes:
        """Ids of letters, or of marks; many words differ in the marks behind them only."""
        known, key = self._letters, mark + run
        ids = known.get(key)
        if ids is None:
            if len(known) > self._most:
                known.clear()
            if self._lower:
                run = run.lower()
            ids = known[key] = self._token(mark + (run if run.isascii() else run.translate(self._written)))
        return ids


@lru_cache(maxsize=2)
def encoder(path: str, spaced: bool, words: int = CACHE_WORDS) -> WordEncoder:
    """One per worker process: its words serve all its tasks."""
    return WordEncoder(path, spaced, words, added=True)
