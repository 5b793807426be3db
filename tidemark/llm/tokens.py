"""Byte-level BPE by the tokenizers library, encoding each distinct piece once.

A byte-level BPE first cuts a text into pre-tokens and merges bytes only within
them, so a text's ids are those of its pieces, one after the other, for any cut
that no pre-token crosses.  ``cuts`` marks such points in a whole block of texts
with array operations.  The pieces, mostly words, repeat, so the library is
asked for each piece once and a table of fixed size remembers the answers.
``encode`` gives exactly the ids of encoding every whole text by itself.

With ``added``, as the registered queries and the pipeline have it, the strings of
the file's added tokens stand for these tokens, as the library reads them: texts are
cut there first.  Without, they are ordinary text.
"""

from __future__ import annotations

import re

import numpy as np

#: Slots of a worker's table, at 56 bytes each; a newer piece takes an older one's slot.
SLOTS_LOG2 = 21
#: Bytes of a piece, and ids of it, that fit a slot; larger pieces are encoded when met.
PIECE_BYTES, PIECE_IDS = 32, 8
#: Bytes of text handled at a time; longer texts are cut at a safe point.
BLOCK = 1_000_000

_LATIN = re.compile(r"[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _is(*ranges: tuple[int, int]) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        t[lo : hi + 1] = True
    return t


_LETTER = _is((65, 90), (97, 122))
_PUNCT = _is((33, 38), (40, 47), (58, 64), (91, 96), (123, 126))  # the apostrophe starts contractions
_SEEN = _is((33, 126))
#: After a space: neither white space nor a byte that may begin a character which is.
_AFTER_SPACE = ~_is((0, 32), (127, 127), (0x80, 0xC2), (0xE1, 0xE3))


def cuts(b: np.ndarray) -> np.ndarray:
    """Where a pre-token is sure to begin.  ``b``: UTF-8 bytes with three zeros before and eight behind."""
    p3, p2, p1, x, n1 = b[:-11], b[1:-10], b[2:-9], b[3:-8], b[4:-7]
    sign = np.uint8(0x97), np.uint8(0xB7)  # the multiplication and division signs
    latin = (p2 == 0xC3) & (p1 != sign[0]) & (p1 != sign[1])  # p1 ends a Latin-1 letter
    latin_next = (x == 0xC3) & (n1 != sign[0]) & (n1 != sign[1])
    letter, punct = _LETTER[p1] | latin, _PUNCT[x]
    newline = p1 == 10
    c = (x == 32) & _AFTER_SPACE[n1]
    c |= letter & punct
    c |= _PUNCT[p1] & (_LETTER[x] | latin_next)
    c |= (x == 10) & (letter | _SEEN[p1])
    c |= newline & (_SEEN[p2] | ((p3 == 0xC3) & (p2 >= 0x80))) & (_SEEN[x] | latin_next)
    return c


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # pieces are ordinary text; added tokens are cut out before
        known = self.tokenizer.get_added_tokens_decoder() if added else {}
        for t in known.values():
            if t.lstrip or t.rstrip or t.single_word or any(map(str.isspace, t.content)) or (t.normalized and self.tokenizer.normalizer):
                raise ValueError(f"added token {t.content!r}: white space, whole words and normalised text are not supported")
        self.added = {t.content.encode(): i for i, t in known.items()}
        #: Bytes around an edit that a token may reach to, with what decides whether a pre-token begins there.
        self.context = max(map(len, self.added)) + 3 if self.added else 0
        self.find_added = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + b")") if self.added else None
        self.model = self.tokenizer.model
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.letters = _byte_letters()
        n = 1 << SLOTS_LOG2
        self.keys = np.zeros((n, PIECE_BYTES // 8), dtype=np.uint64)
        self.counts = np.zeros(n, dtype=np.uint8)  # 0: empty
        self.slots = np.zeros((n, PIECE_IDS), dtype=np.uint16 if self.vocabulary <= 1 << 16 else np.uint32)

    def piece_ids(self, piece: str) -> list[int]:
        word = piece[1:] if piece[0] == " " else piece
        if _LATIN.fullmatch(word):  # one pre-token, so only its bytes are to be merged
            return [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))]
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def _look_up(self, data: np.ndarray, at: np.ndarray, size: np.ndarray):
        """Slot rows (ids, counts) of short pieces; unknown ones are encoded and put in."""
        windows = np.lib.stride_tricks.as_strided(data.view(np.uint8), (len(data) - 7, 8), (1, 1))
        key = np.empty((len(at), PIECE_BYTES // 8), dtype=np.uint64)
        h = size.astype(np.uint64)
        top = len(data) - 8
        for j in range(PIECE_BYTES // 8):
            left = np.clip(size - 8 * j, 0, 8)
            if j and not left.any():
                key[:, j] = 0
                continue
            word = windows[np.minimum(at + 8 * j, top)].view(np.uint64)[:, 0]
            keep = np.where(left == 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (left * 8).astype(np.uint64)) - np.uint64(1))
            key[:, j] = word & np.where(left > 0, keep, np.uint64(0))
            h = (h ^ key[:, j]) * _ODD
            h ^= h >> np.uint64(32)
        slot = ((h * _ODD) >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)
        hit = self._holds(slot, key)
        other = np.flatnonzero(~hit)
        twin = slot[other] ^ 1
        found = self._holds(twin, key[other])
        slot[other[found]] = twin[found]
        ids, counts = self.slots[slot], self.counts[slot]
        large: dict[int, list[int]] = {}
        miss = other[~found]
        if len(miss):
            _, first, which = np.unique(h[miss], return_index=True, return_inverse=True)
            first = miss[first]
            same = (key[miss] == key[first][which]).all(axis=1)
            raw = data.tobytes()
            new = [self.piece_ids(raw[a : a + n].decode()) for a, n in zip(at[first].tolist(), size[first].tolist())]
            long = np.fromiter(map(len, new), dtype=np.int64, count=len(new))
            rows = np.zeros((len(new), PIECE_IDS), dtype=self.slots.dtype)
            for i, x in enumerate(new):
                rows[i, : min(len(x), PIECE_IDS)] = x[:PIECE_IDS]
            ids[miss], counts[miss] = rows[which], np.minimum(long, PIECE_IDS)[which]
            for i in miss[(long[which] > PIECE_IDS) | ~same].tolist():  # too many ids for a slot, or equal hashes of two pieces
                large[i] = self.piece_ids(raw[at[i] : at[i] + size[i]].decode())
                counts[i] = 0
            keep = long <= PIECE_IDS
            where = slot[first[keep]]
            where = np.where((self.counts[where] > 0) & (self.counts[where ^ 1] == 0), where ^ 1, where)
            where, one = np.unique(where, return_index=True)
            self.keys[where], self.counts[where], self.slots[where] = key[first[keep]][one], long[keep][one], rows[keep][one]
        return ids, counts, large

    def _holds(self, slot: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Whether the slots hold these pieces.  Pieces with a zero byte never come here."""
        out = self.counts[slot] > 0
        for j in range(key.shape[1]):
            out &= self.keys[slot, j] == key[:, j]
        return out

    def block(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row; ids and pieces in each text; bytes and ids of each piece."""
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        joined = b"".join(texts)
        data = np.frombuffer(b"\0\0\0" + joined + b"\0" * 8, dtype=np.uint8)
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        parts, part_ends, fixed = lengths, ends, np.zeros(0, dtype=np.int64)
        if self.find_added and self.find_added.search(joined):  # added tokens, and what lies between them, are texts of their own
            split = [self.find_added.split(t) for t in texts]  # every other one is an added token
            parts = np.array([len(x) for s in split for x in s], dtype=np.int64)
            part_ends = np.cumsum(parts)
            odd_one = np.array([i % 2 == 1 for s in split for i in range(len(s))])
            fixed = (part_ends - parts)[odd_one]
        c = cuts(data)
        tail = (part_ends - 1)[parts > 0]
        c[tail[data[tail + 3] == 32]] = False  # what follows a text's last space is another text
        for lo, size in zip(fixed.tolist(), parts[odd_one].tolist() if len(fixed) else []):
            c[lo : lo + size] = False
        c[(part_ends - parts)[parts > 0]] = True
        at = np.flatnonzero(c)
        size = np.diff(at, append=total)
        short = size <= PIECE_BYTES
        short[np.searchsorted(at, fixed)] = False
        if total and (zero := np.flatnonzero(data[3:-8] == 0)).size:  # a key could not tell a zero byte from padding
            short[np.searchsorted(at, zero, side="right") - 1] = False
        ids, counts, large = self._look_up(data, at[short] + 3, size[short])
        n = np.zeros(len(at), dtype=np.int64)
        n[short] = counts
        whole = data.tobytes()
        where = np.flatnonzero(short)
        odd = {int(where[i]): x for i, x in large.items()}
        for i in np.flatnonzero(~short).tolist():
            piece = whole[3 + at[i] : 3 + at[i] + size[i]]
            odd[i] = [self.added[piece]] if piece in self.added else self.piece_ids(piece.decode())
        for i, x in odd.items():
            n[i] = len(x)
        starts = np.cumsum(n) - n
        out = np.empty(int(n.sum()), dtype=np.uint32)
        fast = starts[short]
        for j in range(PIECE_IDS):
            has = counts > j
            out[fast[has] + j] = ids[has, j]
        for i, x in odd.items():
            out[starts[i] : starts[i] + len(x)] = x
        upto = np.concatenate([[0], np.cumsum(n)])
        pieces = np.searchsorted(at, ends) - np.searchsorted(at, ends - lengths)
        last = np.searchsorted(at, ends)
        return out, upto[last] - upto[last - pieces], pieces, np.stack([size, n])

    def encode(self, texts: list[str | None]):
        """The ids of each whole text (None: none), as arrays of 32-bit integers, in order."""
        group, weight = [], 0
        for t in texts:
            raw = (t or "").encode()
            if len(raw) > BLOCK:
                yield from self._flush(group)
                group, weight = [], 0
                yield np.concatenate([self.block([x])[0] for x in _shares(raw)])
                continue
            group.append(raw)
            weight += len(raw)
            if weight >= BLOCK:
                yield from self._flush(group)
                group, weight = [], 0
        yield from self._flush(group)

    def _flush(self, group: list[bytes]):
        if group:
            ids, n, _, _ = self.block(group)
            yield from np.split(ids, np.cumsum(n)[:-1])


def _shares(raw: bytes) -> list[bytes]:
    """A very long text cut into shares of about BLOCK bytes before a space and an ASCII letter."""
    cut, out, start = re.compile(rb" (?=[A-Za-z])"), [], 0
    while len(raw) - start > BLOCK and (m := cut.search(raw, start + BLOCK)):
        out.append(raw[start : m.start()])
        start = m.start()
    return [*out, raw[start:]]


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, added: bool = False) -> Encoder:
    """One per Python worker and reading of added tokens, with its table."""
    if (path, added) not in _encoders:
        _encoders[path, added] = Encoder(path, added)
    return _encoders[path, added]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
