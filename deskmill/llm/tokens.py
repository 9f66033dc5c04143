"""Token ids of many texts at once, made with the tokenizers library.

Each distinct pre-token is encoded by the library once and kept in the worker; texts are
then put together from numpy arrays. That holds for tokenizers that drop white space and
split by the rule below; any other tokenizer, and any text for which the short way could
differ (characters that normalisation changes, special tokens), goes to the library whole.
"""

from __future__ import annotations

import functools
import json
import os
import unicodedata

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark keeps the cores busy

#: The normalisation and splitting rule for which texts may be cut into pre-tokens here.
KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
KNOWN_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
ENDINGS_OF_ONE = "stmd"
ENDINGS_OF_TWO = ["re", "ve", "ll"]

#: Pre-tokens that a worker keeps; it starts anew beyond them.
KEPT = 900_000
#: Slots of the table they are looked up in; free ones end a search.
SLOTS = 1 << 21

SPACE, LETTER, NUMBER, OTHER, ODD = range(5)


@functools.cache
def character_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case form, class and hash value of every code point.

    Classes are of the lowered point, and ODD where normalisation may change it.
    """
    import regex

    from deskmill.llm import arrays

    lower = np.arange(0x110000, dtype=np.uint32)
    kind = np.full(0x110000, OTHER, np.uint8)
    chars = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, value in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"[\p{White_Space}]", SPACE)):
        found = "".join(regex.findall(pattern, chars))
        kind[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = value
    odd = []
    for char in chars:
        small = char.lower()
        if small != char:
            if len(small) == 1:
                lower[ord(char)] = ord(small)
            else:
                odd.append(char)
        if unicodedata.decomposition(char)[:1] not in ("", "<"):
            odd += [chr(int(x, 16)) for x in unicodedata.decomposition(char).split()[1:]]
            if not unicodedata.is_normalized("NFC", char):
                odd.append(char)
        if unicodedata.combining(char) or unicodedata.category(char) == "Cn":
            odd.append(char)
    plain = kind[lower]  # the text is lowered first
    plain[0x1100:0x1200] = ODD
    plain[[ord(c) for c in odd]] = ODD
    plain[[0x1C, 0x1D, 0x1E, 0x1F, 0x85]] = ODD
    return lower, plain, arrays.mixed(np.arange(0x110000, dtype=np.uint64) + np.uint64(0x632BE59BD9B4E019))


@functools.cache
def letter_table() -> np.ndarray:
    """True for every code point that is a letter."""
    import regex

    table = np.zeros(0x110000, bool)
    chars = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table[np.frombuffer("".join(regex.findall(r"\p{L}", chars)).encode("utf-32-le"), np.uint32)] = True
    return table


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of joined UTF-8 texts, and where each text's begin."""
    leads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=leads[1:])
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32), leads[offsets]


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges ``starts[i] .. starts[i] + lengths[i]``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class Encoder:
    """Encodes texts with the tokenizer file at ``path``, without special tokens of its own."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        rules = json.loads(self.whole.to_str())
        self.special = [t["content"].encode() for t in rules["added_tokens"]]
        parts = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
        steps = [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])]
        self.by_parts = bool(parts) and parts[0].get("pattern") == {"Regex": KNOWN_PATTERN} and steps == KNOWN_NORMALIZERS
        if self.by_parts:
            self.part = Tokenizer(self.whole.model)
            self.part.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            )
        self._clear()

    def _clear(self) -> None:
        self.known = 0
        self.keys = np.zeros(SLOTS, np.uint64)  # 0: free
        self.begin = np.zeros(SLOTS, np.int32)
        self.length = np.zeros(SLOTS, np.int32)
        self.flat, self.used = np.zeros(1 << 20, np.uint32), 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or the free one where it would go."""
        slot = (keys & np.uint64(SLOTS - 1)).astype(np.int64)
        there = self.keys[slot]
        open_ = np.flatnonzero((there != keys) & (there != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (SLOTS - 1)
            there = self.keys[slot[open_]]
            open_ = open_[(there != keys[open_]) & (there != 0)]
        return slot

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Keep the ids of distinct new pre-tokens."""
        made = [np.array(e.ids, np.uint32) for e in self.part.encode_batch_fast(words, add_special_tokens=False)]
        length = np.array([len(m) for m in made], np.int64)
        begin = self.used + np.cumsum(length) - length
        while self.used + length.sum() > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + length.sum()] = np.concatenate(made)
        self.used += int(length.sum())
        self.known += len(keys)
        left = np.arange(len(keys))
        while len(left):
            slot = self._slots(keys[left])
            self.keys[slot] = keys[left]  # of those that want one slot, one gets it
            got = self.keys[slot] == keys[left]
            self.begin[slot[got]], self.length[slot[got]] = begin[left[got]], length[left[got]]
            left = left[~got]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the offsets at which each text's begin."""
        from deskmill.llm import arrays

        data, offsets = arrays.utf8(texts)
        if not self.by_parts:
            return self._encode_whole([data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
        lower, kinds, values = character_tables()
        points, rows = code_points(data, offsets)
        points, kind = lower[points], kinds[points]
        odd_rows = self._odd_rows(data, offsets, kind, rows)
        starts, stops = self._parts(points, kind, rows)
        keys = point_hashes(values[points], starts, stops)
        slot = self._slots(keys)
        new = np.flatnonzero(self.keys[slot] != keys)
        if len(new):
            distinct, first = np.unique(keys[new], return_index=True)
            if self.known + len(distinct) > KEPT:
                self._clear()
                distinct, first = np.unique(keys, return_index=True)
                new = np.arange(len(keys))
            for cut in range(0, len(distinct), KEPT):  # more than that only in a text of tens of megabytes
                some = new[first[cut : cut + KEPT]]
                if self.known + len(some) > SLOTS // 2:
                    return self._encode_whole([data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
                words = [points[starts[i] : stops[i]].tobytes().decode("utf-32-le") for i in some]
                self._learn(distinct[cut : cut + KEPT], words)
            slot = self._slots(keys)
        per_part = self.length[slot].astype(np.int64)
        ids = self.flat[_ragged(self.begin[slot], per_part)] if len(slot) else np.zeros(0, np.uint32)
        counted = np.zeros(len(slot) + 1, np.int64)
        np.cumsum(per_part, out=counted[1:])
        ends = counted[np.searchsorted(starts, rows)]
        if not len(odd_rows):
            return ids, ends
        whole, whole_ends = self._encode_whole([data[offsets[i] : offsets[i + 1]].tobytes() for i in odd_rows])
        pieces = [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        for k, i in enumerate(odd_rows):
            pieces[i] = whole[whole_ends[k] : whole_ends[k + 1]]
        return np.concatenate(pieces), np.cumsum([0] + [len(p) for p in pieces])

    def _encode_whole(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        made = [np.array(e.ids, np.uint32) for e in self.whole.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.uint32), *made]), np.cumsum([0] + [len(m) for m in made])

    def _odd_rows(self, data, offsets, kind, rows) -> np.ndarray:
        """Rows that the library has to encode whole."""
        at = np.searchsorted(rows, np.flatnonzero(kind == ODD), side="right") - 1
        text = data.tobytes()
        found = []
        for mark in self.special:
            spot = text.find(mark)
            while spot >= 0:
                found.append(np.searchsorted(offsets, spot, side="right") - 1)
                spot = text.find(mark, spot + 1)
        return np.unique(np.concatenate([at, np.array(found, np.int64)]))

    @staticmethod
    def _parts(points, kind, rows) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pre-tokens."""
        n = len(points)
        change = np.ones(n, bool)
        change[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        change[rows[:-1][rows[:-1] < n]] = True
        # An apostrophe that begins a run of signs, and an ending, are one pre-token.
        marks = np.flatnonzero((points == ord("'")) & change)
        if len(marks):
            padded = np.concatenate([points, np.zeros(3, np.uint32)])
            row_end = rows[np.searchsorted(rows, marks, side="right")]
            one, two = padded[marks + 1], padded[marks + 2]
            size = np.where(np.isin(one, [ord(c) for c in ENDINGS_OF_ONE]), 1, 0)
            for pair in ENDINGS_OF_TWO:
                size = np.where((one == ord(pair[0])) & (two == ord(pair[1])), 2, size)
            good = (size > 0) & (marks + size < row_end)
            marks, size, row_end = marks[good], size[good], row_end[good]
            change[marks + 1] = False
            after = marks + 1 + size
            change[after[after < n]] = True  # no text ends sooner, so this begins a pre-token anyway
        edges = np.flatnonzero(change)
        stops = np.append(edges[1:], n)
        solid = kind[edges] != SPACE
        return edges[solid], stops[solid]


def point_hashes(values, starts, stops) -> np.ndarray:
    """64-bit hashes, never 0, of spans of code points, from the hash values of the points."""
    from deskmill.llm import arrays

    out = np.empty(len(starts), np.uint64)
    block, i = 1 << 18, 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(stops, low + block, side="right")))
        width = int(stops[j - 1] - low)
        up, down = arrays.powers(width)
        sums = np.zeros(width + 1, np.uint64)
        np.cumsum(values[low : low + width] * up[:width], out=sums[1:])
        at = starts[i:j] - low
        out[i:j] = (sums[stops[i:j] - low] - sums[at]) * down[at]
        i = j
    out = arrays.mixed(out + (stops - starts).astype(np.uint64))
    out[out == 0] = 1
    return out


@functools.cache
def encoder(path: str) -> Encoder:
    """The worker's encoder of a file; it lives as long as the worker."""
    return Encoder(path)
