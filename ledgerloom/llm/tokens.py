"""Whole texts to token ids with the tokenizers library, for use inside tasks.

A text is cut at spaces and line feeds, which the word vocabulary drops and never joins over; each piece
between them passes the library's whole normaliser, splitter and merges. A piece met before is looked up, so
the library works once per distinct piece while the table of pieces lasts. A table of ``limit`` pieces becomes the
older one, of which only pieces met again are carried on: it saves work and never changes a result.

Special tokens of the vocabulary that a text holds are one id each, as in the library, or with ``special_as_text`` text as any
other. A piece that holds one, in whatever case, is given to the library as it is.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from string import punctuation
from unicodedata import normalize

import numpy as np

LONG = 100  # characters; longer pieces are not remembered
MARK = "\x01"
BATCH = 4_000_000  # characters looked at together


def _parts(piece: str) -> tuple[str, str]:
    """A piece that many others share, and what follows it.

    Marks after a letter or digit are a word of their own, and ASCII letters are lowered
    by the vocabulary anyway.
    """
    core = piece.rstrip(punctuation)
    if piece.isascii():
        if not core or not core[-1].isalnum():
            core = piece
        return core.lower(), piece[len(core) :]
    # some letters end in a mark once they are normalised and lowered, and marks join what follows
    if not core or not normalize("NFC", core[-1]).lower()[-1].isalnum():
        core = piece
    return core.lower() if core.isascii() else core, piece[len(core) :]


class PieceEncoder:
    """``encode(texts)`` gives the ids of each text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, limit: int = 450_000, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = special_as_text
        added = [] if special_as_text else self._library.get_added_tokens_decoder().values()
        self._special = [t.content.lower() for t in added if t.special]
        if any(" " in t or "\n" in t for t in self._special):
            raise ValueError("texts are cut at spaces and line feeds, which no special token may hold")
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        (self._mark,) = self._ids(MARK)
        self._limit = limit
        suffix = json.loads(self._library.to_str())["model"].get("end_of_word_suffix")
        vocabulary = self._library.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, id in vocabulary.items() if suffix else ():
            self._ends[id] = token.endswith(suffix)

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        held: list[str] = []
        size = 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= BATCH:
                yield from self._flush(held)
                held, size = [], 0
        yield from self._flush(held)

    def _flush(self, texts: list[str]) -> Iterator[bytes]:
        held = [text.replace("\n", " ").split(" ") for text in texts]
        if len(self._known) > self._limit:
            self._known, self._older = {}, self._known
        known, older = self._known, self._older
        new = set().union(*held).difference(known)
        for piece in new.intersection(older):
            known[piece] = older[piece]
        new = new.difference(known)
        # whole texts are searched for special tokens first, and single pieces only if one is there
        special = {p for p in new if self._holds_special(p)} if any(map(self._holds_special, texts)) else ()
        cut: list[tuple[str, str, str]] = []  # pieces that are not their own core
        cores = set()
        for piece in new:
            if piece.isalpha() and piece.isascii() and piece.islower() or piece in special:
                cores.add(piece)
                continue
            core, tail = _parts(piece)
            cores.add(core)
            if tail or core != piece:
                cores.add(tail)
                cut.append((piece, core, tail))
        cores.discard("")
        self._learn(list(cores.difference(known)))
        known[""] = b""
        for piece, core, tail in cut:
            known[piece] = known[core] + known[tail] if tail else known[core]
        for pieces in held:
            yield b"".join(map(known.__getitem__, pieces))
        if max(map(len, new), default=0) > LONG:
            for piece in [p for p in new | cores if len(p) > LONG]:
                known.pop(piece, None)

    def _holds_special(self, piece: str) -> bool:
        if not self._special:
            return False
        low = piece.lower()
        return any(t in low for t in self._special)

    def _learn(self, pieces: list[str]) -> None:
        """Encode ``pieces``, many in one text: words of ASCII letters side by side, as each has one id that ends a word, others with
        a mark between them, which is one id that no other word has."""
        plain = []
        words = []
        for piece in pieces:
            if piece.isalpha() and piece.isascii():
                words.append(piece)
            elif MARK in piece:
                self._known[piece] = np.asarray(self._ids(piece), "<u4").tobytes()
            else:
                plain.append(piece)
        for at in range(0, len(words), 4096):
            part = words[at : at + 4096]
            ids = np.asarray(self._ids(" ".join(part)), "<u4")
            ends = np.flatnonzero(self._ends[ids]) + 1 if self._ends.any() else ()
            if len(ends) != len(part):  # another kind of vocabulary
                plain += part
                continue
            self._keep(part, ids, [0, *ends.tolist()[:-1]], ends.tolist())
        for at in range(0, len(plain), 4096):
            part = plain[at : at + 4096]
            ids = np.asarray(self._ids(f" {MARK} ".join(part)), "<u4")
            marks = np.flatnonzero(ids == self._mark).tolist()
            self._keep(part, ids, [0, *[m + 1 for m in marks]], [*marks, len(ids)])

    def _keep(self, pieces: list[str], ids: np.ndarray, lows: list[int], highs: list[int]) -> None:
        data = ids.tobytes()
        for piece, low, high in zip(pieces, lows, highs, strict=True):
            self._known[piece] = data[4 * low : 4 * high]

    def _ids(self, text: str) -> list[int]:
        # without offsets, which nothing here needs
        return self._library.encode_batch_fast([text], add_special_tokens=False)[0].ids


_ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, special_as_text: bool = True) -> PieceEncoder:
    """One encoder for each vocabulary, way with special tokens and Python worker."""
    if (path, special_as_text) not in _ENCODERS:
        _ENCODERS[path, special_as_text] = PieceEncoder(path, special_as_text=special_as_text)
    return _ENCODERS[path, special_as_text]
