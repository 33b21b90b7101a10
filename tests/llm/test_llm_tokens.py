"""Piece-wise encoding, wavelet shards and packing: exact against the tokenizers library."""

import itertools
import random
import tracemalloc
import zlib

import numpy as np
import plain
import public_tokenizers
import pytest

from trackmill.llm import packing, wavelet
from trackmill.llm.packing import Plan, search
from trackmill.llm.tokens import PieceEncoder

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "a", " a", "a ", "a  b", "a \n b\n\nc  ", "\ta\t b", "x　y z", "don't we'll 's 12 3.4", "é áb",
    "\x1c a\x1cb", "ΑΣ ΣΑΣ. Σ", "İI ıi ſ ﬁ", "a　 \nb", "é    x", "\n a  b", "<|endoftext|> b", "日本語 テスト", "👍🏽 ok👍",
    "x" * 5000, "a b " * 3000,
]


@pytest.fixture(scope="module")
def encoders():
    return {f: PieceEncoder(f, joined) for f, joined in ((BYTE, True), (WORD, False))}


def whole(encoder, text):
    return encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("file", [BYTE, WORD])
def test_pieces_encode_like_whole_texts(encoders, file):
    encoder = encoders[file]
    rng = random.Random(2)
    spaces = [" ", " ", " ", "\n", "  ", "\t", " ", "　 ", ". ", ",", "'s ", "\r\n", "\x85", "  "]
    texts = ODD + ["".join(rng.choice(["ab", "É", "naïve", "12", "Σ", "x-y"]) + rng.choice(spaces) for _ in range(40)) for _ in range(200)]
    ids, counts = encoder.encode_all([t.encode() for t in texts], most_bytes=4000)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [whole(encoder, t) for t in texts]


def test_odd_characters_in_any_order(encoders):
    encoder = encoders[BYTE]
    rng = random.Random(5)
    odd = [*"ab Z9.,'!?-_\n\t\r \v\f\x1c\x1f\x85\xa0é\u0301ß中٣½\u2003\u2028\u3000\u200b\u1680\u00ad$€…’<|>/\\~^`\"x  ''sdlrevtm\0"]
    odd += ["<|endoftext|>", "'s", "'ll", "'re", " '", " \n", "İ", "🙂"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 40))) for _ in range(8000)]
    ids, counts = encoder.encode_all([t.encode() for t in texts])
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [whole(encoder, t) for t in texts]


def test_a_word_is_learned_once_whatever_marks_follow_it():
    encoder = PieceEncoder(BYTE, True)
    words, marks = ["".join(w) for w in itertools.product("abcd", repeat=3)], [".", ",", "!", "?", ";", ":", "..."]
    text = "".join(f" {w}{m}" for w in words for m in marks)
    assert encoder.encode_all([text.encode()])[0].tolist() == whole(encoder, text)
    assert len(encoder.hashes) == len(words) + len(marks)


def test_a_full_table_starts_anew(monkeypatch):
    monkeypatch.setattr("trackmill.llm.tokens.KNOWN_PIECES", 50)
    encoder = PieceEncoder(BYTE, True)
    rng = random.Random(4)
    texts = [plain.sentence(rng, 30) for _ in range(40)]
    ids, counts = encoder.encode_all([t.encode() for t in texts], most_bytes=300)
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [whole(encoder, t) for t in texts]


@pytest.mark.parametrize("top", [1, 2, 5, 300, 70_000])
def test_wavelet_matrix_answers_like_the_sequence(top):
    rng = np.random.default_rng(top)
    row = np.minimum(rng.integers(0, top, 3000), rng.integers(0, top, 3000)).astype(np.uint32)
    matrix = wavelet.WaveletMatrix.build(row)
    assert (matrix.ids() == row).all()
    for i in rng.integers(0, 3000, 40):
        assert matrix.access(int(i)) == row[i]
    for value in [0, top - 1, top + 5, int(row[7])]:
        places = np.flatnonzero(row == value)
        assert matrix.count(value) == len(places)
        assert matrix.rank(value, 1111) == (places < 1111).sum()
        for k in range(0, len(places), max(1, len(places) // 20)):
            assert matrix.select(value, k) == places[k]
    with pytest.raises(IndexError):
        matrix.select(top + 5, 0)


def test_shards_hold_all_documents(spark, encoders, tmp_path):
    docs, rows = plain.documents(spark)
    wavelet.write_shards(docs, str(tmp_path / "shards"), BYTE, joined=True)
    found = wavelet.read_documents(spark, str(tmp_path / "shards")).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, expected = 0, []
    for i, t in ordered:
        ids = np.array(whole(encoders[BYTE], t or "") + [0], "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    key = lambda r: (r[1], r[2])
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found), key=key) == sorted(expected, key=key)

    token = whole(encoders[BYTE], rows[0][1])[0]
    total = sum(whole(encoders[BYTE], t or "").count(token) for _, t in rows)
    assert sum(r.n for r in wavelet.count_token(spark, str(tmp_path / "shards"), token).collect()) == total
    at = wavelet.occurrences(spark, str(tmp_path / "shards"), token).collect()
    assert len(at) == total
    by_id = {i: t for i, t in rows if i is not None}
    for r in at[:50]:
        if r.doc_id is not None:
            assert whole(encoders[BYTE], by_id[r.doc_id])[r.position] == token


def test_shards_of_nothing(spark, tmp_path):
    wavelet.write_shards(plain.empty(spark), str(tmp_path / "none"), BYTE, joined=True)
    assert wavelet.read_documents(spark, str(tmp_path / "none")).count() == 0


def check_packed(found, rows, encoder, capacity):
    by_id = {}
    for i, t in rows:
        by_id.setdefault(i, []).append(np.array(whole(encoder, t or "") + [0], "<u4"))
    places = {}
    for r in found:
        assert r.start == r.piece * capacity
        options = {zlib.crc32(x[r.start : r.start + r.length].tobytes()) for x in by_id[r.doc_id]}
        assert r.ids_crc32 in options
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sum(r.length for r in found) == sum(len(x) for xs in by_id.values() for x in xs)
    return len(places)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_holds_every_piece_once(spark, encoders, capacity):
    docs, rows = plain.documents(spark)
    pieces = packing.token_pieces(docs, WORD, joined=False, capacity=capacity)
    found = packing.pack(pieces, capacity).collect()
    used = check_packed(found, rows, encoders[WORD], capacity)
    bound = -(-sum(r.length for r in found) // capacity)
    assert bound <= used <= bound * 1.1 + 1
    assert packing.pack(packing.token_pieces(plain.empty(spark), WORD, joined=False)).count() == 0


def fewest(lengths, capacity):
    """Plain search over all packings of a few pieces."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity and bins[k] not in bins[:k]:
                place(i + 1, bins[:k] + [bins[k] + lengths[i]] + bins[k + 1 :])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best[0]


def test_search_is_near_the_fewest():
    rng = random.Random(8)
    worse = 0
    for _ in range(40):
        lengths = [rng.randrange(5, 70) for _ in range(11)]
        plan = search(np.bincount(lengths, minlength=101), 100)
        counts = np.zeros(101, dtype=int)
        for filling, times in plan.steps:
            assert sum(n * k for n, k in filling) <= 100
            for n, k in filling:
                counts[n] += k * times
        assert (counts == np.bincount(lengths, minlength=101)).all()
        worse += plan.sequences - fewest(lengths, 100)
    assert 0 <= worse <= 2
    assert search(np.zeros(101, dtype=int), 100) == Plan()


def plain_undominated(counts, largest, capacity):
    """Every filling, and of these the ones that no swap of some pieces for a longer one betters."""
    left = {n: int(c) - (n == largest) for n, c in enumerate(counts) if n and c > (n == largest)}
    room = capacity - largest
    kinds = [[n] * min(left[n], room // n) for n in left]
    fillings = {f for f in itertools.product(*[range(len(k) + 1) for k in kinds])}
    kept = set()
    for f in fillings:
        pieces = [n for n, k in zip(left, f) for _ in range(k)]
        if sum(pieces) > room:
            continue
        subsets = {c for k in range(len(pieces) + 1) for c in itertools.combinations(pieces, k)}
        unused = [n for n, k in zip(left, f) if k < left[n]]
        if not any(sum(c) <= x <= sum(c) + room - sum(pieces) and c != (x,) for c in subsets for x in unused):
            kept.add(tuple(sorted([largest, *pieces], reverse=True)))
    return kept


def test_all_undominated_fillings_are_tried():
    rng = random.Random(3)
    for _ in range(60):
        counts = np.bincount([rng.randrange(3, 30) for _ in range(9)], minlength=61)
        largest = int(np.flatnonzero(counts)[-1])
        found = list(packing.Completions(counts, largest, 60).fillings(lambda total: True))
        found = [tuple(n for n, k in f for _ in range(k)) for f in found if f]
        assert len(found) == len(set(found))
        assert set(found) == plain_undominated(counts, largest, 60)
        assert [sum(f) for f in found] == sorted(map(sum, found), reverse=True)


def test_large_groups_of_equal_lengths_leave_no_room():
    counts = np.zeros(2049, dtype=int)
    counts[600], counts[362] = 1000, 4000
    assert search(counts) == Plan([(((600, 1), (362, 4)), 1000)])


def test_search_holds_little_of_the_nodes_on_its_path():
    lengths = np.random.default_rng(7).lognormal(6.8, 1, 20_000)
    counts = np.bincount(np.clip(lengths.astype(int), 1, 2048), minlength=2049)
    tracemalloc.start()
    plan = search(counts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60e6
    used = np.zeros_like(counts)
    for filling, times in plan.steps:
        assert sum(n * k for n, k in filling) <= 2048
        for n, k in filling:
            used[n] += times * k
    assert (used == counts).all()


def test_search_finds_the_fewest_of_groups():
    rng = random.Random(5)
    for _ in range(40):
        kinds = [rng.randrange(8, 60) for _ in range(4)]
        lengths = [n for n in kinds for _ in range(rng.randrange(1, 4))]
        assert search(np.bincount(lengths, minlength=101), 100).sequences == fewest(lengths, 100)
