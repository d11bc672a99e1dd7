"""Batch tokenisation inside tasks.

A text is split before it reaches the tokenizer, and each distinct piece is encoded once per worker. Cuts are made
only where both vocabularies' own pre-tokenizers cut for certain: around one ASCII white-space character between
two others that aren't white space. Texts with white space beyond ASCII, or with the separators 1C-1F that libraries
disagree on, go to the tokenizer whole. Joined pieces therefore equal the whole text's encoding.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache, partial
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct pieces a worker remembers before it starts again.
CACHE_PIECES = 1_000_000
#: Pieces encoded in one call: the library's own records of a call are far larger than its ids.
LEARN_PIECES = 8192
#: Plain pieces that are encoded as one text.
RUN_PIECES = 256
#: Bytes of text that are split and looked up at a time.
GROUP_BYTES = 4 << 20

# A blank and some visible ASCII or two-byte characters, among which is no white space; those of them that keep their number of
# bytes in lower case and NFC, ASCII and U+00C0 to U+00FF; and what separates such pieces: a blank and a control character, which
# isn't one of them and so a piece of its own to both vocabularies.
_PLAIN = re.compile(rb" (?:[!-~]|[\xc3-\xdf][\x80-\xbf]){1,60}")
_LATIN = re.compile(rb" (?:[!-~]|\xc3[\x80-\xbf]){1,60}")
_MARK = b" \x01"

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MAYBE = np.zeros(256, bool)
_MAYBE[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True  # their strings in a text are ordinary text
    return found


class Encoder:
    """Encodes string arrays; keeps ids of pieces seen before, at most about ``CACHE_PIECES``."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.mark, self.widths, self.folded = self._mark_ids(), self._byte_widths(), self._folded_widths()
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 20, np.uint16 if self.tokenizer.get_vocab_size() < 1 << 16 else np.uint32)
        self.ends = np.zeros(1 << 16, np.int64)

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode new pieces. A call costs much more than a piece, so plain ones go in runs.

        Where a piece's ids end in a run is told by the bytes its ids stand for, or by a mark behind each piece.
        """
        ways = []
        if self.widths is not None:
            ways.append((_PLAIN, partial(self._by_width, widths=self.widths, left_out=0)))
        else:
            if self.folded is not None:
                ways.append((_LATIN, partial(self._by_width, widths=self.folded, left_out=1)))
            if self.mark is not None:
                ways.append((_PLAIN, self._by_mark))
        ids, sizes, learnt = [], [], []
        for plain, way in ways:
            fits = list(map(plain.fullmatch, pieces))
            if own := list(compress(pieces, fits)):
                pieces = [p for p, fit in zip(pieces, fits, strict=True) if not fit]
                flat, n = way(own)
                ids.append(flat)
                sizes.append(n)
                learnt += own
        if pieces:
            flat, own = self._flat([p.decode() for p in pieces])
            ids.append(flat)
            sizes.append(own)
            learnt += pieces
        flat, own = np.concatenate(ids), np.concatenate(sizes)
        at = len(self.place)
        top = self.ends[at - 1] if at else 0
        while top + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while at + len(own) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[top : top + len(flat)] = flat
        self.ends[at : at + len(own)] = top + np.cumsum(own)
        self.place.update(zip(learnt, range(at, at + len(own)), strict=True))

    def _by_width(self, pieces: list[bytes], widths: np.ndarray, left_out: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain pieces in runs, and how many each has, told by the bytes that ids stand for; no id stands for ``left_out`` of a piece's."""
        flat, _ = self._flat([b"".join(pieces[k : k + RUN_PIECES]).decode() for k in range(0, len(pieces), RUN_PIECES)])
        done = np.cumsum(widths[flat])
        wanted = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) - left_out)
        ends = np.searchsorted(done, wanted) + 1
        if done[-1] != wanted[-1] or (done[ends - 1] != wanted).any():
            raise ValueError("ids reach over pieces")
        return flat, np.diff(ends, prepend=0)

    def _by_mark(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain pieces in runs, and how many each has, told by a mark behind each."""
        flat, _ = self._flat([(_MARK.join(pieces[k : k + RUN_PIECES]) + _MARK).decode() for k in range(0, len(pieces), RUN_PIECES)])
        ends = np.flatnonzero(flat == self.mark[-1]) + 1
        if len(ends) != len(pieces):
            raise ValueError("marks are lost in encoding")
        marks = (ends[:, None] - np.arange(1, len(self.mark) + 1)).ravel()
        return np.delete(flat, marks), np.diff(ends, prepend=0) - len(self.mark)

    def _flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, and how many each has."""
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes

    def _byte_widths(self) -> np.ndarray | None:
        """For a vocabulary of bytes, how many each id stands for: its tokens are spelt with a character per byte."""
        if "ByteLevel" not in str(self.tokenizer.decoder) or "Sequence" in str(self.tokenizer.decoder):
            return None
        return self._spelt_widths("")

    def _folded_widths(self) -> np.ndarray | None:
        """The same for a vocabulary that leaves out blanks, marks ends of words and may fold case: it holds for letters that keep their length.

        Three probes tell whether the vocabulary is one.
        """
        widths = self._spelt_widths(json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix") or "")
        probes = [" a", " \u00c9a's", " Zq-9\u00ff!"]
        ids = [self.tokenizer.encode(probe, add_special_tokens=False).ids for probe in probes]
        return widths if all(widths[own].sum() == len(probe.encode()) - 1 for own, probe in zip(ids, probes, strict=True)) else None

    def _spelt_widths(self, word_end: str) -> np.ndarray:
        widths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            widths[i] = len(token.removesuffix(word_end))
        return widths

    def _mark_ids(self) -> list[int] | None:
        """The ids of the mark, if its last one can stand for nothing else in a plain piece."""
        found = self.tokenizer.encode(_MARK.decode(), add_special_tokens=False).ids
        after = self.tokenizer.encode(f" a{_MARK.decode()} b{_MARK.decode()}", add_special_tokens=False).ids
        alone = [self.tokenizer.encode(f" {c}", add_special_tokens=False).ids for c in "ab"]
        return found if found and after == [*alone[0], *found, *alone[1], *found] else None

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text, and each text's number of ids."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        data, bounds = _buffers(texts)
        out, counts = [], np.zeros(len(texts), np.int64)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + GROUP_BYTES, "right")) - 1)
            ids, counts[first:last] = self._group(data, bounds[first : last + 1])
            out.append(ids)
            first = last
        return np.concatenate(out) if out else self.ids[:0], counts

    def _group(self, data, bounds) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = int(bounds[0]), int(bounds[-1])
        if lo == hi:
            return self.ids[:0], np.zeros(len(bounds) - 1, np.int64)
        chunk = data[lo:hi]
        starts = np.zeros(hi - lo + 1, bool)
        space = _SPACE[chunk]
        lone = np.zeros(hi - lo, bool)
        lone[1:-1] = space[1:-1] & ~space[:-2] & ~space[2:]
        if len(odd := _odd_space(chunk)):
            for text in np.unique(np.searchsorted(bounds, odd + lo, "right") - 1):
                lone[bounds[text] - lo : bounds[text + 1] - lo] = False
        starts[:-1] = lone
        # A lone line feed or tab is a piece of its own; a lone blank goes with the word after it.
        starts[1:] |= lone & (chunk != 32)
        starts[bounds[:-1][bounds[:-1] < hi] - lo] = True
        starts[-1] = True
        cuts = np.flatnonzero(starts)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(chunk))]
        )
        coded = pieces.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.place) > CACHE_PIECES:
            self.clear()
        known = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        new = [words[k] for k in np.flatnonzero(known < 0).tolist()]
        for k in range(0, len(new), LEARN_PIECES):
            self._learn(new[k : k + LEARN_PIECES])
        known[known < 0] = np.fromiter(map(self.place.__getitem__, new), np.int64, len(new))
        places = known[coded.indices.to_numpy()]
        ends = self.ends[places]
        begins = np.where(places > 0, self.ends[places - 1], 0)
        sizes = ends - begins
        done = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.arange(done[-1]) + np.repeat(begins - done[:-1], sizes)]
        totals = done[np.searchsorted(cuts, bounds - lo)]
        return ids, np.diff(totals)


def _odd_space(data: np.ndarray) -> np.ndarray:
    """Where bytes stand that may belong to white space that isn't ASCII's, or to a separator 1C-1F.

    In UTF-8 such characters start with C2 85, C2 A0, E1 9A, E1 A0, E2 80, E2 81, E3 80 or EF BB.
    """
    odd = np.flatnonzero(_MAYBE[data])
    if not len(odd):
        return odd
    first, second = data[odd], data[np.minimum(odd + 1, len(data) - 1)]
    near = ((first == 0xC2) & ((second == 0x85) | (second == 0xA0))) | ((first == 0xE1) & ((second == 0x9A) | (second == 0xA0)))
    near |= ((first == 0xE2) & ((second == 0x80) | (second == 0x81))) | ((first == 0xE3) & (second == 0x80)) | (first == 0xEF)
    return odd[near | (first < 0x20)]


def _buffers(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and its bounds in them."""
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2] if len(texts) else None
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), bounds


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
