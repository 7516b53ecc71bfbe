import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import bpe_matrix, packing, tokens, wavelet

public_tokenizers = pytest.importorskip("public_tokenizers")
LIBRARY = tokens.WordTokenizer(tokens.default_tokenizer())


def ids_of(text):
    return LIBRARY.library.encode(text or "", add_special_tokens=False).ids


def mixed_texts():
    rng = random.Random(5)
    alphabet = "ab c\n\té漢🙂's\x1c .,!0  "
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 400))) for _ in range(40)] + ["a" * 3000, "-" * 300 + " x", " "]


def test_words_give_the_ids_of_whole_texts():
    texts = mixed_texts()
    assert [np.frombuffer(x, LIBRARY.dtype).tolist() for x in LIBRARY.encode(texts)] == [ids_of(t) for t in texts]


def test_cut_places_and_small_gathers(monkeypatch):
    monkeypatch.setattr(tokens, "GATHER_WORDS", 7)
    odd = ["", "\n", "\na", "a b\nc d.\nE'll don't.", "x\n", "\x01a \x01b\n\x01", "a\u00a0 \u0301b\x85", "<|endoftext|> a", "漢字…(x)²!"]
    texts = odd + mixed_texts() + odd
    assert [np.frombuffer(x, LIBRARY.dtype).tolist() for x in LIBRARY.encode(texts)] == [ids_of(t) for t in texts]


def test_added_tokens_are_one_id_as_in_a_fresh_library():
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(tokens.default_tokenizer())
    end = "<|endoftext|>"
    texts = [f"one{end} start", end, end * 3, f"a  {end}\n\n b", "plain text", f"<|endoftext{end}|>", "<|endoftext |>", f"x.{end}\x01y", ""]
    got = [np.frombuffer(x, LIBRARY.dtype).tolist() for x in LIBRARY.encode(texts + mixed_texts())]
    assert got == [fresh.encode(t, add_special_tokens=False).ids for t in texts + mixed_texts()]
    assert got[1] == [50256]


def test_matrix_bpe_equals_the_reference_encoder():
    import tiktoken

    path, pattern = bpe_matrix.default_vocabulary()
    own = bpe_matrix.MatrixBpe(path, pattern)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    for text, ids in zip(mixed_texts(), own.encode(mixed_texts())):
        assert np.frombuffer(ids, "<u4").tolist() == other.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_wavelet_matrix_answers_like_the_sequence():
    ids = np.random.default_rng(1).integers(0, 300, 5000).astype(np.uint16)
    matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.of(ids, 9).to_bytes())
    assert (matrix.sequence() == ids).all() and (matrix.access(np.arange(5000)) == ids).all()
    for symbol in (0, 7, 299, 511, 100_000):
        places = np.flatnonzero(ids == symbol)
        assert matrix.count(symbol) == len(places) and matrix.rank(symbol, 2500) == (places < 2500).sum()
        assert (matrix.occurrences(symbol) == places).all()
    assert matrix.select(7, 3) == np.flatnonzero(ids == 7)[3]


def test_wavelet_lookups_open_few_chunks():
    rng = np.random.default_rng(2)
    for n in (0, 1, 511, 512, wavelet.CHUNK - 1, wavelet.CHUNK, 5 * wavelet.CHUNK + 77):
        ids = np.minimum(rng.zipf(1.3, n), 50_000).astype(np.uint16)
        data = wavelet.WaveletMatrix.of(ids, 16).to_bytes()
        assert (wavelet.WaveletMatrix.from_bytes(data).sequence() == ids).all()
        for place in rng.integers(0, n, 5 if n else 0).tolist():
            matrix = wavelet.WaveletMatrix.from_bytes(data)
            symbol = int(ids[place])
            assert matrix.access(np.array([place]))[0] == symbol
            assert matrix.unpacked <= 16 * wavelet.CHUNK // 8
            before = int((ids[:place] == symbol).sum())
            assert matrix.rank(symbol, place) == before and matrix.select(symbol, before) == place
            assert matrix.count(symbol, 3, n) == (ids[3:] == symbol).sum()
            assert (matrix.occurrences(symbol) == np.flatnonzero(ids == symbol)).all()
        with pytest.raises(IndexError):
            wavelet.WaveletMatrix.from_bytes(data).select(65_000, 0)


def test_a_shard_whose_counts_disagree_fails(monkeypatch):
    monkeypatch.setattr(wavelet.WaveletMatrix, "access", lambda self, places: np.full(len(places), 7, np.uint32))
    row = {"part": 0, "seq": 0, "planes": wavelet.WaveletMatrix.of(np.array([5, 0], np.uint16), 16).to_bytes()}
    row |= {"doc_ids": np.array([1], "<i8").tobytes(), "no_id": b"\0", "lengths": np.array([2], "<i8").tobytes()}

    with pytest.raises(ValueError, match="disagree"):
        list(wavelet._documents(iter([pa.RecordBatch.from_pylist([row])])))


def test_round_trip_of_odd_rows(odd_docs, no_docs):
    got = {(r.doc_id, r.n_tokens, r.decoded_sha256) for r in bpe_matrix.round_trip(odd_docs).collect()}
    want = {(r.doc_id, len(ids_of(r.text)), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in odd_docs.collect()}
    assert {(a, c) for a, _, c in got} == {(a, c) for a, _, c in want}
    assert bpe_matrix.round_trip(no_docs).count() == 0


def test_stored_tokens_in_order(odd_docs, no_docs):
    rows = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    want, start = [], 0
    for row in rows:
        data = np.array([*ids_of(row.text), 0], "<u4").tobytes()
        want.append((row.doc_id, start, len(data) // 4, zlib.crc32(data)))
        start += len(data) // 4
    got = sorted((tuple(r) for r in wavelet.store_tokens(odd_docs).collect()), key=lambda r: r[1])
    assert got == want
    assert wavelet.store_tokens(no_docs).count() == 0


def test_packing_covers_every_id_once(odd_docs, no_docs):
    ids = defaultdict(list)
    for row in odd_docs.collect():
        ids[row.doc_id].append([*ids_of(row.text), 0])
    pieces = packing.pack(odd_docs, group_pieces=8).collect()
    ends = defaultdict(int)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == ends[p.sequence_id]
        ends[p.sequence_id] += p.length
        sums = [zlib.crc32(np.array(d[p.start : p.start + p.length], "<u4").tobytes()) for d in ids[p.doc_id] if len(d) == p.doc_tokens]
        assert p.ids_crc32 in sums
    assert max(ends.values()) <= packing.SEQUENCE
    assert sum(p.length for p in pieces) == sum(len(d) for group in ids.values() for d in group)
    assert packing.pack(no_docs).count() == 0


def test_first_fit_is_first_fit():
    lengths = np.random.default_rng(2).integers(1, 100, 300)
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    free = []
    for i in np.argsort(-lengths, kind="stable"):
        at = next((b for b, room in enumerate(free) if room >= lengths[i]), len(free))
        free += [100] * (at == len(free))
        assert (bins[i], offsets[i]) == (at, 100 - free[at])
        free[at] -= lengths[i]
