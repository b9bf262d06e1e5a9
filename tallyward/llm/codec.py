"""Byte-level BPE through a public vocabulary, with a table of encoded words.

``Codec`` gives the ids that the tokenizers library gives for the same JSON file
with ``add_special_tokens=False`` and no truncation or padding: a special
token's own string in a text becomes its id.

A text may be cut before a space that follows a visible character: no
alternative of the pre-token pattern spans such a place and none looks behind,
so the pieces encode on their own to the ids of the whole. ``Codec`` cuts a batch
there, finds the pieces in a table of ``SLOTS`` entries, and sends those it does not know
to tiktoken in one call. Ids are reused for equal bytes only: an entry holds the bytes of its
piece in 64-bit words, which are compared; pieces of more than ``PIECE_BYTES`` bytes are not
kept and meet by their bytes inside a batch. Texts where a space follows white space go to
tiktoken whole.
"""

from __future__ import annotations

import json
import re

import numpy as np
import tiktoken

from tallyward.llm.common import Flat

# Fixed value: the pre-token pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Places of the table of known pieces, and the ids that it may hold.
SLOTS = 1 << 20
POOL = 6 << 20

#: Bytes of the longest pieces that the table holds, in words of 8 bytes.
WORDS = 3
PIECE_BYTES = 8 * WORDS
#: The first k bytes of a little-endian word.
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)

#: Bytes after which a space is no safe cut: white space, and the last bytes of white space beyond ASCII.
_WHITE = np.zeros(256, bool)
_WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_WIDE_WHITE = re.compile(r"[^\S\x00-\x7f] ")


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of bytes in the JSON vocabulary: visible Latin-1
    characters stand for themselves, the rest follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of each span, one after the other."""
    ends = np.cumsum(counts)
    if not len(ends):
        return np.zeros(0, np.int64)
    return np.arange(int(ends[-1])) + np.repeat(starts - (ends - counts), counts)


def _words(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The first PIECE_BYTES bytes of each span as words, zeros after its end."""
    padded = np.zeros(len(data) + PIECE_BYTES, np.uint8)
    padded[: len(data)] = data
    loads = np.ndarray((len(padded) - 7,), "<u8", buffer=padded, strides=(1,))
    out = [loads[starts] & _MASKS[np.minimum(sizes, 8)]]
    for k in range(1, WORDS):
        longer = np.flatnonzero(sizes > 8 * k)
        word = np.zeros(len(starts), np.uint64)
        word[longer] = loads[starts[longer] + 8 * k] & _MASKS[np.minimum(sizes[longer] - 8 * k, 8)]
        out.append(word)
    return out


def _keys(words: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """A hash of each piece's words and size."""
    key = sizes.astype(np.uint64)
    for word in words:
        key = (key ^ word) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return key


class Codec:
    _made: dict[str, Codec] = {}

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_bytes = [x.encode() for x in self.special]
        ranks = {token: i for token, i in ranks.items() if i not in self.special.values()}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.words = [np.zeros(SLOTS, np.uint64) for _ in range(WORDS)]
        self.sizes = np.zeros(SLOTS, np.uint8)  # 0: a free place
        self.places = np.zeros(SLOTS, np.int32)
        self.counts = np.zeros(SLOTS, np.uint8)
        self.pool = np.zeros(POOL, "<u2")
        self.used = 0
        size = max([*ranks.values(), *self.special.values()]) + 1
        if size > 1 << 16:
            raise ValueError("ids beyond 65535 do not fit the packed form")
        self.token_bytes = [b""] * size
        for token, i in ranks.items():
            self.token_bytes[i] = token
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.token_size = np.array([len(x) for x in self.token_bytes])
        self.decimal = [b"%d," % i for i in range(size)]
        self._split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    @classmethod
    def of(cls, path: str) -> Codec:
        """The worker's codec for a vocabulary file, made once."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _plain(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype("<u2")

    def _encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after the other, and how many each has. Pieces that begin
        with a space and a visible character, and end visibly, are encoded in one text,
        whose ids are dealt out by their bytes; the others each alone."""
        alone, joined = [], []
        for i, piece in enumerate(pieces):
            word = piece.decode()
            if len(word) > 1 and word[0] == " " and not word[1].isspace() and not word[-1].isspace():
                joined.append(i)
            else:
                alone.append((i, self._plain(word)))
        ids = self._plain(b"".join([pieces[i] for i in joined]).decode())
        stops = np.searchsorted(np.cumsum(self.token_size[ids]), np.cumsum([len(pieces[i]) for i in joined])) + 1
        counts = np.zeros(len(pieces), np.int64)
        counts[joined] = np.diff(stops, prepend=0)
        for i, own in alone:
            counts[i] = len(own)
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]) if len(ends) else 0, "<u2")
        inside = np.ones(len(out), bool)
        for i, own in alone:
            out[ends[i] - len(own) : ends[i]] = own
            inside[ends[i] - len(own) : ends[i]] = False
        out[inside] = ids
        return out, counts

    def _keep(self, slots: np.ndarray, words: list[np.ndarray], sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Enter pieces whose place in the table is free, as far as the pool goes."""
        slots, first = np.unique(slots, return_index=True)
        free = (self.sizes[slots] == 0) & (counts[first] <= 64)
        slots, first = slots[free], first[free]
        n = counts[first]
        starts = np.cumsum(counts)[first] - n
        total = int(n.sum())
        if self.used + total > POOL:
            return
        self.pool[self.used : self.used + total] = ids[_ranges(starts, n)]
        self.places[slots] = self.used + np.cumsum(n) - n
        self.counts[slots] = n
        for column, word in zip(self.words, words):
            column[slots] = word[first]
        self.sizes[slots] = sizes[first]
        self.used += total

    def _safe(self, flat: Flat) -> np.ndarray:
        """Rows that may be cut before each space."""
        data, safe = flat.data, np.ones(len(flat), bool)
        second = np.flatnonzero((data[1:] == 0x20) & _WHITE[data[:-1]]) + 1
        rows = np.searchsorted(flat.offsets, second, side="right") - 1
        safe[rows[flat.offsets[rows] != second]] = False
        text = None
        for i in range(len(flat)) if self.special or (data >= 0xC2).any() else ():
            text = flat.row(i)
            if any(s in text for s in self.special_bytes):
                safe[i] = False
            elif not text.isascii() and _WIDE_WHITE.search(text.decode()):
                safe[i] = False
        return safe

    def _whole(self, text: str) -> np.ndarray:
        """Ids of a text that may hold special tokens, by tiktoken."""
        parts = self._split.split(text) if self._split else [text]
        return np.concatenate([np.array([self.special[x]], "<u2") if x in self.special else self._plain(x) for x in parts])

    def encode_flat(self, flat: Flat) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows one after the other (uint16), and each row's place (len + 1)."""
        data = flat.data
        if not len(data):
            return np.zeros(0, "<u2"), np.zeros(len(flat) + 1, np.int64)
        cut = data == 0x20
        heads = flat.offsets[:-1]
        cut[heads[heads < len(data)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        rows = np.searchsorted(flat.offsets, starts, side="right") - 1
        safe = self._safe(flat)
        if not safe.all():
            inside = safe[rows]
            starts, ends, rows = starts[inside], ends[inside], rows[inside]
        sizes = ends - starts
        short = sizes <= PIECE_BYTES
        words = _words(data, starts, sizes)
        keys = _keys(words, sizes)
        slots = (keys & np.uint64(SLOTS - 1)).astype(np.int64)
        known = self.sizes[slots] == sizes  # long pieces are in no place
        for column, word in zip(self.words, words):
            known &= column[slots] == word
        places, counts = self.places[slots].astype(np.int64), self.counts[slots].astype(np.int64)
        pool = self.pool[: self.used]
        if not known.all():
            missing = np.flatnonzero(~known & short)
            _, first, which = np.unique(keys[missing], return_index=True, return_inverse=True)
            one = missing[first]
            same = sizes[missing] == sizes[one][which]
            for word in words:
                same &= word[missing] == word[one][which]
            raw = data.tobytes()
            # long pieces, and those whose key another piece has: by their bytes
            rest = np.concatenate([np.flatnonzero(~short), missing[~same]])
            own: dict[bytes, int] = {}
            number = [own.setdefault(raw[a:b], len(own)) for a, b in zip(starts[rest].tolist(), ends[rest].tolist())]
            pieces = [raw[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist())]
            ids, n = self._encode_pieces([*pieces, *own])
            at = self.used + np.cumsum(n) - n
            places[missing], counts[missing] = at[which], n[which]
            which = len(pieces) + np.array(number, np.int64)
            places[rest], counts[rest] = at[which], n[which]
            pool = np.concatenate([pool, ids])
            self._keep(slots[one], [word[one] for word in words], sizes[one], ids, n[: len(pieces)])
        out = pool[_ranges(places, counts)]
        sizes = np.bincount(rows, weights=counts, minlength=len(flat)).astype(np.int64)
        if safe.all():
            return out, np.concatenate([[0], np.cumsum(sizes)])
        whole = {int(i): self._whole(flat.row(i).decode()) for i in np.flatnonzero(~safe)}
        at = np.concatenate([[0], np.cumsum(sizes)])
        parts = [whole.get(i, out[at[i] : at[i + 1]]) for i in range(len(flat))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])

    def encode_many(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each UTF-8 text."""
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
        ids, at = self.encode_flat(Flat(np.frombuffer(b"".join(texts), np.uint8), offsets, 0))
        return [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]

    def ids(self, text: str) -> np.ndarray:
        return self.encode_many([text.encode()])[0]

    def decode(self, ids: np.ndarray) -> str:
        """What the library's ``decode(ids, skip_special_tokens=False)`` gives."""
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")

    def as_decimals(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.decimal.__getitem__, ids.tolist()))[:-1]
