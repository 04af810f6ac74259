"""Token ids of many texts at once with a word-level public tokenizer.

The tokenizer drops white space and never merges across it, so a text's ids are
the ids of its pieces in a row. Pieces are white-space separated chunks, cut
further where that is certain not to change a thing: between letters, single
digits and punctuation of a chunk of plain characters. Each distinct piece is
encoded once per worker (``cache_pieces`` are kept) and looked up afterwards by a
hash of its bytes, which are compared with those of the piece found; pieces over 16
bytes are looked up as they are. Chunks with an apostrophe, '<', or a character outside ASCII
and the Latin-1 letters are encoded as a whole.
"""

from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer

from tirepulse.llm import textscan as ts

_LETTER, _DIGIT, _OTHER = 1, 2, 3
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[0x30:0x3A] = _DIGIT
for _lo, _hi in ((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _CLASS[_lo:_hi + 1] = _LETTER
_CLASS[~ts.SOLID_BYTES] = 0
#: ASCII characters that can start or be part of something that spans classes.
_BINDS = ts.byte_set((0x27, 0x27), (0x3C, 0x3C))


def default_tokenizer() -> str:
    """Place of the public word-level vocabulary on this machine."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def pieces(data: np.ndarray, cut: np.ndarray):
    """Lower-cased bytes, piece starts and ends."""
    n = data.size
    low = ts.LOWER[data]
    lead = data == 0xC3
    tail = np.zeros(n, bool)
    tail[1:] = lead[:-1]
    letter = tail & (data != 0x97) & (data != 0xB7)
    low[letter & (data >= 0x80) & (data <= 0x9E)] += 0x20
    plain_lead = np.zeros(n, bool)
    plain_lead[:-1] = letter[1:]
    odd = _BINDS[data] | ((data >= 0x80) & ~letter & ~(lead & plain_lead))
    cs, ce = ts.runs(ts.SOLID_BYTES[data], cut)
    if not cs.size:
        return low, cs, ce
    n_odd = np.concatenate([[0], np.cumsum(odd)])
    safe = n_odd[ce] == n_odd[cs]
    inside = np.zeros(n + 1, np.int8)                 # inside a safe chunk
    inside[cs[safe]] += 1                             # starts differ, and so do ends
    inside[ce[safe]] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
    kind = _CLASS[data]
    head = np.zeros(n, bool)
    head[1:] = inside[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
    head[cs] = True
    start = np.flatnonzero(head)
    end = np.empty(start.size, np.int64)
    end[:-1] = start[1:]
    end[-1] = n
    chunk = np.searchsorted(cs, start, side="right") - 1
    return low, start, np.minimum(end, ce[chunk])


class PieceEncoder:
    """Encodes pieces, each distinct one once while it is kept."""

    def __init__(self, path: str, cache_pieces: int = 600_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends_word[number] = token.endswith("</w>")
        self.limit = cache_pieces
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.one, self.two, self.size = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.at, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.others: dict[bytes, tuple[int, int]] = {}
        self.others_bytes = 0
        self.pool = np.zeros(0, np.uint32)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pieces, and where each piece's ids begin and how many they are. Plain
        pieces, one word to the tokenizer, are encoded together and parted at the word ends."""
        ids, length, alone = [], np.zeros(len(words), np.int64), []
        plain = [k for k, w in enumerate(words) if w.isalpha() and (w.isascii() or max(w) < "\u0100")
                 or w.isascii() and not any(c.isalnum() or c in "'<" for c in w)]
        order = []
        for lo in range(0, len(plain), 2048):
            some = plain[lo:lo + 2048]
            own = self.tokenizer.encode_batch_fast([" ".join([words[k] for k in some])], add_special_tokens=False)[0].ids
            own = np.array(own, np.uint32)
            ends = np.flatnonzero(self.ends_word[own]) + 1
            if ends.size != len(some):
                alone += some
                continue
            length[some] = np.diff(ends, prepend=0)
            ids.append(own)
            order += some
        alone += sorted(set(range(len(words))).difference(plain))
        for lo in range(0, len(alone), 2048):
            some = alone[lo:lo + 2048]
            for k, e in zip(some, self.tokenizer.encode_batch_fast([words[k] for k in some], add_special_tokens=False)):
                ids.append(np.array(e.ids, np.uint32))
                length[k] = len(e.ids)
        order += alone
        at = np.zeros(len(words), np.int64)
        at[order] = np.cumsum(length[order]) - length[order]
        return np.concatenate(ids) if ids else np.zeros(0, np.uint32), at, length

    def _add(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encodes pieces into the pool: where each one's ids begin and how many they are."""
        ids, at, length = self._encode(words)
        at += self.pool.size
        self.pool = np.concatenate([self.pool, ids])
        return at, length

    def _short(self, text: bytes, h, one, two, start, end):
        """Place and number of ids of each piece of up to 16 bytes, and where a hash met other bytes."""
        distinct, index, inverse = np.unique(h, return_index=True, return_inverse=True)     # sorted
        size = end - start
        own = (one[index], two[index], size[index])
        place = np.minimum(np.searchsorted(self.known, distinct), max(0, self.known.size - 1))
        there = self.known[place] == distinct if self.known.size else np.zeros(distinct.size, bool)
        missing = index[~there]
        if missing.size:
            at, length = self._add([text[s:e].decode() for s, e in zip(start[missing].tolist(), end[missing].tolist())])
            fresh = np.zeros(self.known.size + missing.size, bool)
            fresh[np.searchsorted(self.known, h[missing]) + np.arange(missing.size)] = True
            old = ~fresh
            for name, new in (("known", h[missing]), ("one", one[missing]), ("two", two[missing]), ("size", size[missing]),
                              ("at", at), ("length", length)):
                merged = np.empty(fresh.size, new.dtype)
                merged[fresh], merged[old] = new, getattr(self, name)
                setattr(self, name, merged)
            place = np.searchsorted(self.known, distinct)
        same = (self.one[place] == own[0]) & (self.two[place] == own[1]) & (self.size[place] == own[2])
        odd = ~same[inverse] | (one != own[0][inverse]) | (two != own[1][inverse]) | (size != own[2][inverse])
        return self.at[place][inverse], self.length[place][inverse], odd

    def _other(self, text: bytes, start, end):
        """Place and number of ids of each of some pieces, looked up by their bytes."""
        words = [text[s:e] for s, e in zip(start.tolist(), end.tolist())]
        fresh = [w for w in dict.fromkeys(words) if w not in self.others]
        if fresh:
            at, length = self._add([w.decode() for w in fresh])
            self.others |= dict(zip(fresh, zip(at.tolist(), length.tolist())))
            self.others_bytes += sum(map(len, fresh))
        return np.array([self.others[w] for w in words], np.int64).reshape(-1, 2).T

    def encode(self, data: np.ndarray, cut: np.ndarray, last_id: int):
        """Ids of all documents in a row, each closed by ``last_id``; each
        document's first id (and the end); ends of sentences among the ids."""
        low, start, end = pieces(data, cut)
        first = np.searchsorted(start, cut)
        if self.known.size + len(self.others) > self.limit or self.others_bytes > self.limit * 64:
            self._clear()
        text = low.tobytes()
        one, two = ts.packed(low, start, end)
        h = ts.mix(one ^ ts.mix(two + (end - start).astype(np.uint64)))
        at, length = np.zeros(start.size, np.int64), np.zeros(start.size, np.int64)
        odd = end - start > ts.PACKED
        short = np.flatnonzero(~odd)
        at[short], length[short], odd[short] = self._short(text, h[short], one[short], two[short], start[short], end[short])
        rest = np.flatnonzero(odd)
        at[rest], length[rest] = self._other(text, start[rest], end[rest])
        # a closing piece after each document's last one
        length = np.insert(length, first[1:], 1)
        source = np.insert(at, first[1:], -1)
        closes = np.insert(np.isin(data[end - 1], np.frombuffer(b".!?", np.uint8)) if end.size else np.zeros(0, bool),
                           first[1:], True)
        stop = np.cumsum(length)
        total = int(stop[-1]) if stop.size else 0
        where = np.repeat(source - (stop - length), length) + np.arange(total)
        out = self.pool[np.maximum(where, 0)] if self.pool.size else np.zeros(total, np.uint32)
        final = stop[first[1:] + np.arange(cut.size - 1)] if cut.size > 1 else np.zeros(0, np.int64)
        out[final - 1] = last_id
        return out, np.concatenate([[0], final]), stop[closes]
