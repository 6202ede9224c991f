"""Token ids of whole texts by a public tokenizer, with a cache of the pieces of texts.

The tokenizer composes and lower-cases a text, drops white space, cuts the rest into
contractions, runs of letters, single digits and runs of other characters, and gives every such
piece its ids by itself. Texts of ASCII and Latin letters are cut here by the same rule, each
piece is looked up, and pieces not seen yet go to the tokenizer's model. Words with any other
character, whose case or composition is less plain, go through the whole tokenizer, which never joins
across white space. Ids are kept as packed bytes.

A worker process keeps one cache per vocabulary for all its tasks. It has two generations:
pieces not met for a while leave with the older one, so frequent ones stay and memory is
bounded by ``CACHE_BYTES``. That never changes a result.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

#: Bytes of both generations together, with ``ENTRY_BYTES`` for an entry beside its contents.
CACHE_BYTES = 96 << 20
ENTRY_BYTES = 180

END_ID = 0
_ID = "I" if array("I").itemsize == 4 else "L"

#: A special token of the vocabulary; it separates words handed to the library together.
_MARK = b"<|startoftext|>"
_SPECIAL = "<|"

#: Texts whose lower case and composed form are plain.
_PLAIN = re.compile(r"[\x00-\x7FÀ-ÖØ-öø-įıĲ-ſ]*")

#: Fixed value: how the tokenizer cuts lower-case text, for the characters of plain texts.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^\x20\x09-\x0D0-9a-zß-öø-ſ]+")

#: The byte-level alphabet: printable bytes stand for themselves, the others for 256 and on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LEVEL = {b: chr(b) for b in _PRINTED}
_LEVEL |= {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _LEVEL)}


class PieceCache:
    """Known pieces, and words that are not plain, with their ids as little-endian 32-bit bytes."""

    def __init__(self, path: str, limit: int = CACHE_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.limit = limit // 2
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def packed_ids(self, text: bytes) -> bytes:
        """Ids of a UTF-8 text and the closing id, as little-endian unsigned 32-bit numbers."""
        whole = text.decode()
        if _PLAIN.fullmatch(whole) and _SPECIAL not in whole:
            ids = self._plain(whole)
        else:
            words = [w.decode() for w in text.split()]
            self._learn_words({w for w in words if not self._is_plain(w)})
            ids = b"".join([self._plain(w) if self._is_plain(w) else self.known[w] for w in words])
        if self.held > self.limit:
            self.older, self.known, self.held = self.known, {}, 0
        return ids + END_ID.to_bytes(4, "little")

    @staticmethod
    def _is_plain(word: str) -> bool:
        return word.isascii() and _SPECIAL not in word

    def _plain(self, text: str) -> bytes:
        pieces = _PIECES.findall(text.lower())
        ids = list(map(self.known.get, pieces))
        if None in ids:
            older, tokenize = self.older, self.model.tokenize
            for piece in {p for p, found in zip(pieces, ids) if found is None}:
                found = older.get(piece)
                if found is None:
                    printed = piece.isascii() and piece.isprintable()
                    form = piece if printed else "".join(map(_LEVEL.__getitem__, piece.encode()))
                    found = array(_ID, [t.id for t in tokenize(form)]).tobytes()
                self._keep(piece, found)
            ids = map(self.known.__getitem__, pieces)
        return b"".join(ids)

    def _keep(self, piece: str, ids: bytes) -> None:
        self.known[piece] = ids
        self.held += ENTRY_BYTES + len(piece) + len(ids)

    def _learn_words(self, words: set[str]) -> None:
        unknown = []
        for word in words.difference(self.known):
            if word in self.older:
                self._keep(word, self.older[word])
            else:
                unknown.append(word)
        plain = [w for w in unknown if _SPECIAL not in w]
        for word, ids in zip(plain, self._encode(plain)):
            self._keep(word, ids)
        for word in set(unknown).difference(plain):
            found = self.tokenizer.encode(word, add_special_tokens=False)
            self._keep(word, array(_ID, found.ids).tobytes())

    def _encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word, by one library call over all of them with marks between."""
        if not words:
            return []
        text = f" {_MARK.decode()} ".join(words)
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        mark = self.tokenizer.token_to_id(_MARK.decode())
        out, at = [], 0
        for _ in words[1:]:
            end = found.index(mark, at)
            out.append(array(_ID, found[at:end]).tobytes())
            at = end + 1
        return [*out, array(_ID, found[at:]).tobytes()]


@lru_cache(maxsize=1)
def shared_cache(path: str) -> PieceCache:
    """The cache of this process; one vocabulary is kept at a time."""
    return PieceCache(path)
