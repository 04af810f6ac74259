"""Words and sequences that meet under polynomial hashes modulo 2^64 are told apart."""

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm import brute
from tests.llm.helpers import table
from tirepulse.llm import substring_dedup
from tirepulse.llm import textscan as ts
from tirepulse.llm.tokens import PieceEncoder, default_tokenizer


def _thue_morse(n, a="a", b="b"):
    word = "".join(b if k.bit_count() % 2 else a for k in range(n))
    return word, word.translate(str.maketrans({a: b, b: a}))


def _words(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return data, *ts.runs(ts.SOLID_BYTES[data], np.array([0, data.size]))


def test_the_words_do_meet_modulo_a_power_of_two():
    one, two = _thue_morse(1024)
    assert one != two and ts.hash_of(one, 1) == ts.hash_of(two, 1) and ts.hash_of(one, 2) == ts.hash_of(two, 2)


def test_word_keys_and_rings_part_them():
    one, two = _thue_morse(1024)
    for keys in ts.word_keys(*_words(f"{one} {two}")):
        assert keys[0] != keys[1]
    first, second = (_words(" ".join(w)) for w in (one, two))
    rings = [ts.Ring(ts.word_keys(*w)[1]).of(np.array([0]), np.array([1024]))[0] for w in (first, second)]
    assert rings[0] != rings[1]


@pytest.mark.parametrize("size", [512, 1024, 2048])
def test_substring_dedup_keeps_words_that_only_hash_alike(spark, size):
    one, two = _thue_morse(size)
    shared = " ".join(f"w{k}" for k in range(19))
    rows = [(1, f"{one} {shared}"), (2, f"{two} {shared}"), (3, f"x {two} {shared} y")]
    got = {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept)) for r in substring_dedup.remove_repeats(table(spark, rows)).collect()}
    assert got == brute.word_repeats(rows) and got[2][1] == 0 and got[3][1] == 20


def test_tokens_of_words_that_only_hash_alike():
    plain = Tokenizer.from_file(default_tokenizer())
    encoder = PieceEncoder(default_tokenizer())
    texts = [w for n in (64, 1024, 2048) for w in _thue_morse(n)] + ["ab\x00 ab ab\x00\x00", "a" * 16, "a" * 17, "", " "]
    texts += [" ".join(reversed(texts[:6]))]
    for some in (texts[:1], texts[1:2], texts):
        raw = [t.encode() for t in some]
        cut = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        ids, bounds, _ = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), cut, 1)
        got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        assert got == [plain.encode(t, add_special_tokens=False).ids + [1] for t in some]


def test_a_hash_that_meets_another_piece_in_the_cache():
    """All pieces forced to one hash: the bytes still tell them apart."""
    encoder = PieceEncoder(default_tokenizer())
    text = b"one two three two one four"
    data, start, end = _words(text.decode())
    one, two = ts.packed(data, start, end)
    for _ in range(2):
        _, _, odd = encoder._short(text, np.zeros(start.size, np.uint64), one, two, start, end)
        assert odd.tolist() == [False, True, True, True, False, True]


def test_packed_bytes_and_ring_products():
    data, start, end = _words("a bb 12345678 123456789 1234567890123456 12345678901234567 ü")
    one, two = ts.packed(data, start, end)
    for k, (s, e) in enumerate(zip(start, end)):
        raw = data[s:e].tobytes()[:16].ljust(16, b"\0")
        assert (int(one[k]), int(two[k])) == (int.from_bytes(raw[:8], "little"), int.from_bytes(raw[8:], "little"))
    rng = np.random.default_rng(0)
    a, b = (np.concatenate([rng.integers(0, ts._PRIME, 500), [0, 1, ts._PRIME - 1]]).astype(np.uint64) for _ in range(2))
    assert ts.ring_product(a, b).tolist() == [int(x) * int(y) % ts._PRIME for x, y in zip(a, b)]
    values = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    ring = ts.Ring(np.concatenate([values, values[:100], values]))
    same = ring.of(np.array([0, 400, 7, 407, 307]), np.array([100, 500, 60, 460, 360]))
    assert same[0] == same[1] and same[2] == same[3] == same[4] and same[0] != same[2]
