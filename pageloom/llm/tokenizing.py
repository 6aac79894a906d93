"""Token ids of whole texts by the public tokenizers, with the ids of words kept.

Both tokenizers cut a text into words before they merge, so the ids of a text are those of
its words, one after another. Words repeat; their ids are looked up. The tables of known
words are bounded; what falls out of them is encoded again when it comes again.
"""

from __future__ import annotations

import os
import re

# Entries of a table of known words; about 200 bytes each, and two tables.
KNOWN_WORDS = 300_000
# Texts of these characters are cut here just as the tokenizer would cut them: letters, single
# digits, runs of other marks, and the contractions that its pattern names. White space goes.
_SPACE = " \t\n\v\f\r"
_LETTERS = "a-zß-öø-ÿ"
_PLAIN = re.compile(r"[\x00-\x7FÀ-ÖØ-öø-ÿ]*")
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_SPACE}{_LETTERS}0-9]+")


def tokenizer_path(name: str) -> str:
    """The place of a vocabulary file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Ids, as little-endian 32-bit numbers, of a tokenizer file that lower-cases, drops white
    space, never joins across it, and merges bytes written as visible characters."""

    def __init__(self, name: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self._visible = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return self._known(_WORDS.findall(text.lower()), self._word)
        # Elsewhere the tokenizer itself cuts what stands between spaces.
        chunks = text.replace("\n", " ").split(" ")
        return b"".join([self.ids(c) if _PLAIN.fullmatch(c) and "<|" not in c else self._known([f" {c}"], self._chunk) for c in chunks])

    def _known(self, words: list[str], encode) -> bytes:
        try:
            return b"".join([self._new[w] for w in words])
        except KeyError:
            return b"".join([self._new.get(w) or self._learned(w, encode) for w in words])

    def _learned(self, word: str, encode) -> bytes:
        if len(self._new) >= KNOWN_WORDS:
            self._old, self._new = self._new, {}
        found = self._old.get(word)
        if found is None:
            found = b"".join(i.to_bytes(4, "little") for i in encode(word))
        self._new[word] = found
        return found

    def _word(self, word: str) -> list[int]:
        visible = word if word.isascii() and word.isprintable() else self._visible.pre_tokenize_str(word)[0][0]
        return [t.id for t in self._tokenizer.model.tokenize(visible)]

    def _chunk(self, chunk: str) -> list[int]:
        return self._tokenizer.encode(chunk, add_special_tokens=False).ids


def byte_encoding(name: str):
    """A byte-level tokenizer whose special tokens are ordinary text."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(tokenizer_path(name), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class PieceCounter:
    """Pre-tokens of a byte-level tokenizer and the number of tokens of each."""

    def __init__(self, name: str):
        import public_tokenizers
        import regex

        self._pattern = regex.compile(public_tokenizers.PATTERN)
        self._encoding = byte_encoding(name)
        self._new: dict[str, int] = {}
        self._old: dict[str, int] = {}

    def pieces(self, text: str) -> list[str]:
        return self._pattern.findall(text)

    def pieces_from(self, text: str, start: int):
        """The pre-tokens of `text` from `start`, a place where one begins, one at a time."""
        return (m[0] for m in self._pattern.finditer(text, start))

    def tokens(self, piece: str) -> int:
        n = self._new.get(piece)
        if n is None:
            if len(self._new) >= KNOWN_WORDS:
                self._old, self._new = self._new, {}
            n = self._old.get(piece)
            if n is None:
                n = len(self._encoding.encode_ordinary(piece))
            self._new[piece] = n
        return n
