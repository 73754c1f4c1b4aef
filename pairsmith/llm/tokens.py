"""Token ids of whole texts, by the tokenizers library from a given vocabulary file.

A byte-level vocabulary parts a text by a fixed pattern before it merges bytes. Some of its boundaries follow from the
classes of two or three characters in a row (a blank after a letter, a full stop after a letter); between those lies a unit,
mostly one word with the blank before it, whose ids don't depend on what stands around it. A batch of texts is cut at
all of these at once, and the ids of a unit are remembered: those of at most 15 bytes in a table of fixed size, found by
their bytes (a unit takes the place of another one of its slot, so frequent units are soon back), those of at most
64 bytes in a bounded dictionary. Only units that are not remembered go through the library. Where the classes leave a
boundary open, there is no cut. Other vocabularies encode each text as one, and so do texts in
which an added token of the vocabulary (such as its end mark) is spelt out: it gets its own id, as the library gives it.
"""

from __future__ import annotations

import json
import os
import re
from itertools import accumulate, chain

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

REMEMBERED = 1 << 20  # slots of the table, a power of two; an eighth of that are long units
SHORT = 15  # bytes of a unit that the table takes, and so its ids at most
LONG = 64  # bytes of a unit that is remembered at all
BLOCK = 1 << 16  # units looked up at a time; bounds the temporary arrays
_encoders: dict[str, "Encoder"] = {}

# Classes of bytes. A byte of a longer character has the class of the character.
_OPEN, _BLANK, _WHITE, _LETTER, _DIGIT, _SIGN, _QUOTE, _OTHER = range(8)  # _OPEN: controls and unusual white space, _OTHER: no white space
_CLASS = np.full(256, _OPEN, np.uint8)
_CLASS[0x21:0x7F] = _SIGN
_CLASS[0x80:] = _OTHER
for _chars, _class in ((b" ", _BLANK), (b"\t\n\x0b\x0c\r", _WHITE), (b"'", _QUOTE), (bytes(range(0x30, 0x3A)), _DIGIT), (bytes(c for c in range(0x80) if chr(c).isalpha()), _LETTER)):
    _CLASS[list(_chars)] = _class
_CLASS[0xC3:0xCA] = _LETTER  # first bytes of U+00C0 to U+027F
_CLASS_OF_SECOND = np.full(256, _LETTER, np.uint8)
_CLASS_OF_SECOND[[0x97, 0xB7]] = _OTHER  # the signs of multiplication and division; as second bytes after 0xC3 alone they are no letters
_UNUSUAL = [c.encode() for c in map(chr, range(0x80, 0x3001)) if c.isspace() or c in "\u180e\u200b"] + ["\ufeff".encode()]
_FIRST_OF_UNUSUAL = {c[:1] for c in _UNUSUAL}
_FIND_UNUSUAL = re.compile(b"|".join(map(re.escape, _UNUSUAL)))


def _cuts() -> np.ndarray:
    """Whether there is a boundary before a character, by its class and those of the two before it (the farthest first)."""
    solid, cut = [_LETTER, _DIGIT, _SIGN, _QUOTE, _OTHER], np.zeros((8, 8, 8), bool)
    for a in solid:
        cut[:, a, [_BLANK, _WHITE]] = True
        cut[a, _WHITE, solid] = True  # one white character alone; of more, the last one stands apart
    for a, after in ((_LETTER, [_DIGIT, _SIGN, _QUOTE]), (_DIGIT, [_LETTER, _SIGN, _QUOTE]), (_SIGN, [_LETTER, _DIGIT]), (_QUOTE, [_DIGIT])):
        cut[:, a, after] = True  # a letter after a quote may belong to it, as in 's
    return cut.ravel()


_CUT = _cuts()
#: Units that the pattern doesn't part any further.
_ONE = re.compile(rb" ?(?:(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc9][\x80-\xbf])+|[0-9]+|[!-&(-/:-@\[-`{-~]+)|[\t\n\x0b\x0c\r]")
_PLACES = np.arange(SHORT, dtype=np.uint8)
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str) -> "Encoder":
    """One encoder per worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, spelt_out=False)
    return _encoders[path]


def _byte_names() -> np.ndarray:
    """The code point of the character that stands for each byte in a byte-level vocabulary: itself where it prints, else from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    names = np.arange(256, dtype="<u4")
    names[others] = 0x100 + np.arange(len(others))
    return names


def units(data: bytes, firsts: np.ndarray) -> np.ndarray:
    """Where the units of UTF-8 texts start that stand in ``data`` one after the other from ``firsts`` on."""
    codes = np.frombuffer(data, np.uint8)
    kind = _CLASS[codes]
    second = np.flatnonzero((codes >= 0xC3) & (codes <= 0xC9)) + 1
    kind[second] = kind[second - 1] = np.where(codes[second - 1] == 0xC3, _CLASS_OF_SECOND[codes[second]], _LETTER)
    if any(first in data for first in _FIRST_OF_UNUSUAL):
        for found in _FIND_UNUSUAL.finditer(data):
            kind[found.start():found.end()] = _OPEN
    code = kind.astype(np.uint16)
    code[1:] += kind[:-1].astype(np.uint16) << 3
    code[2:] += kind[:-2].astype(np.uint16) << 6
    cut = _CUT.take(code)
    cut[firsts[firsts < len(data)]] = True
    return np.flatnonzero(cut)


class Encoder:
    """``encode`` gives for each text its ids as little-endian bytes of ``dtype``; no token is put before or after.

    An added token that stands in a text is one id, as the library has it by default; ``spelt_out`` reads it as the
    characters it is written with instead. The operators don't use ``spelt_out``.
    """

    def __init__(self, path: str, spelt_out: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if spelt_out:
            self.tokenizer.encode_special_tokens = True
        about = json.loads(self.tokenizer.to_str())
        before = about.get("pre_tokenizer") or {}
        self.by_units = about.get("normalizer") is None and before.get("type") == "ByteLevel" \
            and before.get("use_regex", True) and not before.get("add_prefix_space")
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        added = [t for t in about.get("added_tokens") or [] if t["content"]]
        self.added = [t["content"].encode() for t in added if not (spelt_out and t["special"])]
        self.names = _byte_names()
        self.bits = max(1, (REMEMBERED - 1).bit_length())
        if self.by_units:
            self.heads, self.tails = np.zeros((2, 1 << self.bits), np.uint64)  # bytes 0 to 7; 8 to 14 and the length
            self.rows, self.sizes = np.zeros((1 << self.bits, SHORT), self.dtype), np.zeros(1 << self.bits, np.uint8)
        self.long: dict[bytes, bytes] = {}

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _unknown(self, found: list[bytes]) -> list[list[int] | np.ndarray]:
        """Ids of units, by the library."""
        spelt = self.names[np.frombuffer(b"".join(found), np.uint8)].tobytes().decode("utf-32-le")  # a character for each byte
        ends = accumulate(map(len, found))
        tokenize, one = self.tokenizer.model.tokenize, _ONE.fullmatch
        ids = [[t.id for t in tokenize(spelt[b - len(u):b])] if one(u) else None for u, b in zip(found, ends)]
        others = iter(self._whole([u.decode() for u, i in zip(found, ids) if i is None]))
        return [next(others) if i is None else i for i in ids]

    def _block(self, padded: np.ndarray, data: bytes, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units in a row, and their number for each."""
        eights = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
        head = eights[starts] & _MASK[np.minimum(lengths, 8)]
        tail = eights[starts + 8] & _MASK[np.clip(lengths - 8, 0, 7)] | lengths.astype(np.uint64) << np.uint64(56)
        slot = (((head ^ tail * np.uint64(0xBF58476D1CE4E5B9)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)
        short = lengths <= SHORT
        known = short & (self.heads.take(slot) == head) & (self.tails.take(slot) == tail)
        rows, sizes = self.rows.take(slot, 0), self.sizes.take(slot)
        lost = np.flatnonzero(short & ~known)
        if len(lost):
            lost = lost[np.lexsort((tail[lost], head[lost]))]
            new = np.ones(len(lost), bool)
            new[1:] = (head[lost[1:]] != head[lost[:-1]]) | (tail[lost[1:]] != tail[lost[:-1]])
            own, which = lost[new], np.cumsum(new) - 1
            ids = self._unknown([data[a:a + k] for a, k in zip(starts[own].tolist(), lengths[own].tolist())])
            count = np.fromiter(map(len, ids), np.uint8)
            table = np.zeros((len(own), SHORT), self.dtype)
            table[_PLACES < count[:, None]] = np.fromiter(chain.from_iterable(ids), self.dtype)
            rows[lost], sizes[lost] = table[which], count[which]
            taken, kept = np.unique(slot[own], return_index=True)  # one unit a slot
            self.heads[taken], self.tails[taken] = head[own[kept]], tail[own[kept]]
            self.rows[taken], self.sizes[taken] = table[kept], count[kept]
        far = np.flatnonzero(~short)
        sizes[far] = 0
        ids, sizes = rows[_PLACES < sizes[:, None]], sizes.astype(np.int64)
        if len(far):
            found = self._long([data[a:a + k] for a, k in zip(starts[far].tolist(), lengths[far].tolist())])
            count = np.fromiter(map(len, found), np.int64) // self.dtype.itemsize
            ids = np.insert(ids, np.repeat((np.cumsum(sizes) - sizes)[far], count), np.frombuffer(b"".join(found), self.dtype))
            sizes[far] = count
        return ids, sizes

    def _long(self, found: list[bytes]) -> list[bytes]:
        """Ids of units that the table doesn't take, as bytes."""
        ids = {u: self.long.get(u) for u in found}
        missing = [u for u, i in ids.items() if i is None]
        new = {u: np.array(i, self.dtype).tobytes() for u, i in zip(missing, self._unknown(missing))}
        ids.update(new)
        kept, most = [(u, i) for u, i in new.items() if len(u) <= LONG], REMEMBERED >> 3
        if len(self.long) + len(kept) > most:
            self.long = {}
        self.long.update(kept[:most])
        return [ids[u] for u in found]

    def _by_units(self, texts: list[bytes]) -> list[bytes]:
        data = b"".join(texts)
        ends = np.cumsum([len(t) for t in texts])
        firsts = np.concatenate([[0], ends[:-1]])
        starts = units(data, firsts)
        lengths = np.diff(starts, append=len(data))
        padded = np.frombuffer(data + bytes(16), np.uint8)
        ids, sizes = zip(*[self._block(padded, data, starts[a:a + BLOCK], lengths[a:a + BLOCK]) for a in range(0, len(starts), BLOCK)])
        raw = np.concatenate(ids).tobytes()
        total = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) * self.dtype.itemsize
        places = total[np.searchsorted(starts, [*firsts, len(data)])].tolist()
        return [raw[a:b] for a, b in zip(places, places[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        raw = [t.encode() for t in texts]
        whole = [i for i, t in enumerate(raw) if not self.by_units or any(mark in t for mark in self.added)]
        out = dict(zip(whole, [i.tobytes() for i in self._whole([texts[i] for i in whole])]))
        rest = [i for i in range(len(raw)) if i not in out]
        if any(raw[i] for i in rest):
            out.update(zip(rest, self._by_units([raw[i] for i in rest])))
        return [out.get(i, b"") for i in range(len(raw))]
