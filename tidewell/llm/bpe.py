"""Byte-pair encoding of many texts at once by rank-synchronous merging of ragged arrays.

The pre-tokens of a batch stand one after another in flat numpy arrays.  In each round every
pre-token finds the lowest-ranked pair of neighbours it holds and merges all places of that pair,
for all pre-tokens at once; a pre-token without a mergeable pair leaves with its symbols.  A pair
made by a merge always ranks behind it, so the outcome is the library's own.

Texts in ASCII and Latin-1 letters are cut into pre-tokens on the byte buffer.  Any other text is
normalised and cut by the library first and then takes the same merges.  Symbols of recent
pre-tokens up to 24 bytes are remembered in a direct-mapped table of fixed size that holds their bytes.
"""

from __future__ import annotations

import json
import re

import numpy as np

from .blocks import LOWER, U64, lane_at, lanes, mix

_NONE = np.iinfo(np.int64).max
#: Slots, ids a slot holds, and lanes of eight bytes in its key; longer pre-tokens are merged each time.
_MEMORY_BITS, _MEMORY_WIDTH, _MEMORY_LANES = 20, 6, 3
# Byte classes of the byte path: white space, letter, digit, other; SLOW sends the row to the library.
_SPACE, _LETTER, _DIGIT, _OTHER, _SLOW = range(5)
_CLASS = np.full(256, _SLOW, np.uint8)
_CLASS[0x20:0x7F] = _OTHER
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _LETTER


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_chars() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class BpeEngine:
    """Ids of texts under a lower-casing byte-level BPE vocabulary with word ends."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in merges]
        suffix = spec["model"]["end_of_word_suffix"] or ""
        self.width = max(vocab.values()) + 1
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self._index([vocab[a] * self.width + vocab[b] for a, b in pairs])
        chars = _byte_chars()
        self.byte_of = {c: b for b, c in enumerate(chars)}
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + suffix] for c in chars], np.int64)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        parts = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.added_pattern = re.compile("(" + "|".join(parts) + ")") if parts else None
        self.held_key = np.zeros((1 << _MEMORY_BITS, _MEMORY_LANES), U64)
        self.held_size, self.held_n = np.zeros((2, 1 << _MEMORY_BITS), np.uint8)
        self.held_ids = np.zeros((1 << _MEMORY_BITS, _MEMORY_WIDTH), np.uint16 if self.width < 1 << 16 else np.uint32)

    def _index(self, keys: list[int]) -> None:
        """An open-addressing table from a pair of symbols to its rank."""
        self.shift = 64 - max(10, (len(keys) * 4).bit_length())
        size = 1 << (64 - self.shift)
        self.pair_key, self.pair_rank = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        spots = self._spot(np.array(keys, np.int64)).tolist()
        for rank, (key, at) in enumerate(zip(keys, spots, strict=True)):
            while self.pair_key[at] != -1:
                at = (at + 1) % size
            self.pair_key[at], self.pair_rank[at] = key, rank

    def _spot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(U64) * U64(0x9E3779B97F4A7C15)) >> U64(self.shift)).astype(np.int64)

    def rank(self, key: np.ndarray) -> np.ndarray:
        at = self._spot(key)
        found = self.pair_key[at]
        rank = np.where(found == key, self.pair_rank[at], _NONE)
        left = np.flatnonzero((found != key) & (found != -1))
        at = at[left]
        while len(left):
            at = (at + 1) % len(self.pair_key)
            found = self.pair_key[at]
            same = found == key[left]
            rank[left[same]] = self.pair_rank[at[same]]
            on = ~same & (found != -1)
            left, at = left[on], at[on]
        return rank

    def merge(self, raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids) of pre-tokens whose bytes stand one after another in ``raw``."""
        out_n = np.zeros(len(size), np.int64)
        done_ids, done_names = [], []
        symbol = self.inner[raw]
        ends = np.cumsum(size) - 1
        symbol[ends] = self.last[raw[ends]]
        name = np.arange(len(size))
        while len(name):
            start = np.r_[0, np.cumsum(size)[:-1]]
            seq = np.repeat(np.arange(len(size)), size)
            rank = np.full(len(symbol), _NONE)
            inside = np.flatnonzero(seq[:-1] == seq[1:])
            rank[inside] = self.rank(symbol[inside] * self.width + symbol[inside + 1])
            least = np.minimum.reduceat(rank, start)
            going = least != _NONE
            if not going.all():
                out_n[name[~going]] = size[~going]
                gone = ~going[seq]
                done_ids.append(symbol[gone])
                done_names.append(np.repeat(name[~going], size[~going]))
            at = np.flatnonzero((rank == least[seq]) & going[seq])
            # in a run of touching places of one pair, every second one is merged, from the left
            if len(at):
                head = np.r_[True, np.diff(at) != 1]
                at = at[(np.arange(len(at)) - np.flatnonzero(head)[np.cumsum(head) - 1]) % 2 == 0]
                symbol[at] = self.made[rank[at]]
            keep = going[seq]
            keep[at + 1] = False
            symbol = symbol[keep]
            size = np.bincount(seq[keep], minlength=len(size))[going]
            name = name[going]
        if not done_ids:
            return np.zeros(0, np.int64), out_n
        owner = np.concatenate(done_names)
        return np.concatenate(done_ids)[np.argsort(owner, kind="stable")], out_n

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(lower-cased bytes, start, stop of pre-tokens, rows that need the library)."""
        kind = _CLASS[data]
        low = LOWER[data]
        wide = np.flatnonzero(data >= 0x80)
        if len(wide):
            after = np.zeros(len(data) + 1, np.uint8)
            after[:-1] = data
            lead = wide[(data[wide] == 0xC3) | (data[wide] == 0xC2)]
            then = after[lead + 1]
            first = data[lead] == 0xC3
            letter = lead[first & (then >= 0x80) & (then < 0xC0) & (then != 0x97) & (then != 0xB7)]
            mark = lead[~first & ((then == 0xA1) | (then == 0xBF))]
            kind[letter] = kind[letter + 1] = _LETTER
            kind[mark] = kind[mark + 1] = _OTHER
            upper = letter[data[letter + 1] < 0x9F]
            low[upper + 1] += 0x20
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        slow_before = np.r_[0, np.cumsum(kind == _SLOW)]
        slow = np.flatnonzero(slow_before[offsets[1:]] > slow_before[offsets[:-1]])
        for row in slow:
            kind[offsets[row] : offsets[row + 1]] = _SPACE
        cut = edge.copy()
        cut[1:-1] |= kind[1:] != kind[:-1]
        cut[:-1] |= kind == _DIGIT
        quote = np.flatnonzero((low == 0x27) & cut[:-1])
        if len(quote):
            ahead = np.zeros(len(low) + 3, np.uint8)
            ahead[:-3] = low
            one, two = ahead[quote + 1], ahead[quote + 2]
            fenced = np.r_[edge, True, True]
            short = np.isin(one, list(b"stmd")) & ~fenced[quote + 1]
            long = (((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)) & ~fenced[quote + 1] & ~fenced[quote + 2]
            for places, length in ((quote[short], 2), (quote[long & ~short], 3)):
                cut[places + 1] = False
                cut[places + length] = True
        at = np.flatnonzero(cut[:-1])
        stop = np.r_[at[1:], len(data)]
        real = kind[at] != _SPACE if len(at) else np.zeros(0, bool)
        return low, at[real], stop[real], slow

    def _remembered(self, raw: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids) of the pre-tokens raw[start:stop], in their order."""
        if not len(start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        length, wide = stop - start, lanes(raw)
        key = np.stack([lane_at(wide, start + 8 * j, length - 8 * j) for j in range(_MEMORY_LANES)], axis=1)
        mark = length.astype(U64)
        for j in range(_MEMORY_LANES):
            mark = mix(mark * U64(0x9E3779B97F4A7C15) ^ key[:, j])
        short = length <= 8 * _MEMORY_LANES
        slot = (mark >> U64(64 - _MEMORY_BITS)).astype(np.int64)
        hit = short & (self.held_size[slot] == length) & (self.held_key[slot] == key).all(axis=1)
        n = np.where(hit, self.held_n[slot], 0).astype(np.int64)
        ids = self.held_ids[slot]
        miss = np.flatnonzero(~hit)
        spill: dict[int, np.ndarray] = {}
        if len(miss):
            _, first, back = np.unique(mark[miss], return_index=True, return_inverse=True)
            like = miss[first[back]]
            # pre-tokens of one mark are one only if their bytes are
            odd = np.flatnonzero(~short[miss] | (length[like] != length[miss]) | (key[like] != key[miss]).any(axis=1))
            back[odd] = len(first) + np.arange(len(odd))
            first = np.r_[first, odd]
            size = stop[miss[first]] - start[miss[first]]
            begin = np.r_[0, np.cumsum(size)]
            flat = np.repeat(start[miss[first]] - begin[:-1], size) + np.arange(begin[-1])
            made, made_n = self.merge(raw[flat], size)
            made_at = np.r_[0, np.cumsum(made_n)[:-1]]
            width = np.minimum(made_n, _MEMORY_WIDTH)
            block = np.zeros((len(first), _MEMORY_WIDTH), self.held_ids.dtype)
            col = np.arange(_MEMORY_WIDTH)
            filled = col < width[:, None]
            block[filled] = made[(made_at[:, None] + col)[filled]]
            fits = made_n <= _MEMORY_WIDTH
            kept = np.flatnonzero(fits & short[miss[first]])
            kept = kept[np.unique(slot[miss[first[kept]]], return_index=True)[1]]
            spot, whose = slot[miss[first[kept]]], miss[first[kept]]
            self.held_key[spot], self.held_size[spot], self.held_n[spot], self.held_ids[spot] = key[whose], length[whose], made_n[kept], block[kept]
            n[miss], ids[miss] = made_n[back], block[back]
            spill = {int(i): made[made_at[j] : made_at[j] + made_n[j]] for i, j in zip(miss, back, strict=True) if not fits[j]} if not fits.all() else {}
        flat_ids = ids[np.arange(_MEMORY_WIDTH) < np.minimum(n, _MEMORY_WIDTH)[:, None]].astype(np.int64)
        if spill:
            where = np.cumsum(np.minimum(n, _MEMORY_WIDTH))
            order = sorted(spill)
            tails = [spill[i][_MEMORY_WIDTH:] for i in order]
            flat_ids = np.insert(flat_ids, np.repeat(where[order], [len(t) for t in tails]), np.concatenate(tails))
        return flat_ids, n

    def encode_text(self, text: str) -> np.ndarray:
        """Ids of one text of any kind, cut by the library."""
        out = []
        for part in self.added_pattern.split(text) if self.added_pattern else [text]:
            if part in self.added:
                out.append(np.array([self.added[part]], np.int64))
            elif part:
                found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
                raw = np.array([self.byte_of[c] for t, _ in found for c in t], np.uint8)
                stop = np.cumsum([len(t) for t, _ in found], dtype=np.int64)
                out.append(self._remembered(raw, np.r_[0, stop[:-1]] if len(stop) else stop, stop)[0])
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def encode_rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids) of the texts data[offsets[i]:offsets[i+1]], without added ids."""
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(rows, np.int64)
        low, start, stop, slow = self._cut(data, offsets)
        whole = data.tobytes()
        special = {int(np.searchsorted(offsets, m.start(), "right")) - 1 for m in re.finditer(self.added_pattern.pattern.encode(), whole)} if self.added_pattern else set()
        row = np.searchsorted(offsets, start, "right") - 1
        apart = sorted(special.union(slow.tolist()))
        if apart:
            keep = ~np.isin(row, apart)
            start, stop, row = start[keep], stop[keep], row[keep]
        ids, n = self._remembered(low, start, stop)
        counts = np.bincount(row, n, minlength=rows).astype(np.int64)
        if apart:
            ends = np.cumsum(counts)
            extra = [self.encode_text(whole[offsets[r] : offsets[r + 1]].decode()) for r in apart]
            sizes = [len(x) for x in extra]
            ids = np.insert(ids, np.repeat(ends[apart], sizes), np.concatenate(extra))
            counts[apart] = sizes
        return ids, counts


_ENGINES: dict[str, BpeEngine] = {}


def engine(path: str) -> BpeEngine:
    """The worker's engine for a vocabulary file."""
    if path not in _ENGINES:
        _ENGINES[path] = BpeEngine(path)
    return _ENGINES[path]
