"""Token ids of texts by a public tokenizer file, exact and cheap on repeated words."""

from __future__ import annotations

import re
import struct
import threading

import numpy as np
from tokenizers import Tokenizer

#: Bytes of the words whose ids a worker keeps, and of the pieces that new words are made
#: of; at that size a store is emptied and fills anew.
KEPT_WORDS, KEPT_PIECES = 72 << 20, 18 << 20
#: What an entry of a store takes beside its bytes.
_ENTRY = 160
_HELD: dict[str, WordIds] = {}
_LOCK = threading.Lock()


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds:
    """Ids of the words between ASCII white space, as little-endian unsigned 32-bit bytes.

    The vocabulary drops white space and no pre-token spans it, so a text's ids are those of
    its words in a row. Words of ASCII and Latin-1 letters are lower-cased and cut here and
    go straight to the model; any other word, and any text with a special token's brackets,
    goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.plain = re.compile("[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+").fullmatch
        letter = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
        self.cut = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[0-9]|[^{letter}0-9]+").findall
        #: The byte-level alphabet, asked of the tokenizer itself.
        chars = [chr(c) for c in (*range(33, 127), *range(0xC0, 0x100)) if chr(c) not in "\xd7\xf7"]
        byte_level = self.whole.pre_tokenizer
        self.alphabet = {ord(c): "".join(p for p, _ in byte_level.pre_tokenize_str(c)) for c in chars if not c.isupper()}
        #: By id: whether a sentence may end after this token.
        vocabulary = self.whole.get_vocab(with_added_tokens=True)
        self.stops = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.stops[i] = token.removesuffix("</w>")[-1:] in (".", "!", "?") and token.endswith("</w>")
        self.kept: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.kept_size = self.pieces_size = 0

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if not self.plain(text):
            return _packed(self.whole.encode(text, add_special_tokens=False).ids)
        out, pieces = [], self.pieces
        for piece in self.cut(text.lower()):
            known = pieces.get(piece)
            if known is None:
                if self.pieces_size >= KEPT_PIECES:
                    pieces.clear()
                    self.pieces_size = 0
                known = pieces[piece] = _packed([t.id for t in self.model.tokenize(piece.translate(self.alphabet))])
                self.pieces_size += _ENTRY + len(piece) + len(known)
            out.append(known)
        return b"".join(out)

    def words(self, text: bytes) -> list[bytes]:
        """The ids of each of the text's words; a text with special tokens is one word."""
        if b"<|" in text:
            ids = self.whole.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
            return [_packed(ids)]
        words = text.lower().split()
        kept = self.kept
        if self.kept_size > KEPT_WORDS:
            kept.clear()
            self.kept_size = 0
        for w in set(words).difference(kept):
            kept[w] = ids = self._word(w)
            self.kept_size += _ENTRY + len(w) + len(ids)
        return list(map(kept.__getitem__, words))


def held(path: str) -> WordIds:
    """The worker's tokenizer for this file; workers keep it between tasks."""
    with _LOCK:
        if path not in _HELD:
            _HELD[path] = WordIds(path)
        return _HELD[path]
