"""Token counts, BPE and packing against the tokenizer library."""

import random
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from signalwatch.llm import bpe, packing, token_count
from signalwatch.llm.common import newer_code_points

from .conftest import ODD

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def library(path):
    return Tokenizer.from_file(path)


def texts():
    rng = random.Random(3)
    out = [t or "" for _, t in ODD]
    ranges = [(32, 127), (0, 0x300), (0x300, 0x3000), (0x3000, 0xD000), (0xE000, 0x20000)]
    for _ in range(1500):
        out.append("".join(chr(rng.choice([rng.randrange(*rng.choice(ranges)), 32, 10])) for _ in range(rng.randrange(1, 40))))
    return out + ["\x1c a\x1d\x1e\x1f b", "\x85x\xa0y z᠎​ q", "a" * 700, " " * 900 + "a", "İstanbul ǅ ß I'LL 's'S don't"]


def test_heap_counts_equal_the_library():
    counter = token_count.HeapCounter(BYTE, newer_code_points()[0])
    want = [len(e.ids) for e in library(BYTE).encode_batch(texts(), add_special_tokens=False)]
    assert [counter.count(t) for t in texts()] == want


def test_heap_count_is_symbols_less_merges():
    counter = token_count.HeapCounter(BYTE)
    assert counter.merges("a") == 0 and counter["zqxj"] == 4 - counter.merges("zqxj")


def test_merge_rounds_equal_the_library_and_decode_back():
    coder, tok = bpe.WordBpe(WORD, *newer_code_points()), library(WORD)
    want = [e.ids for e in tok.encode_batch(texts(), add_special_tokens=False)]
    assert coder.encode_batch(texts()) == want
    assert [coder.decode(x) for x in want] == [tok.decode(x, skip_special_tokens=False) for x in want]


def test_overlapping_places_of_one_pair():
    coder, tok = bpe.WordBpe(WORD), library(WORD)
    for n in range(1, 40):
        word = "a" * n
        assert list(coder.merge_rounds([word, "b" + word])[0]) == tok.encode(word, add_special_tokens=False).ids


def test_count_operator_on_odd_rows(odd, nothing):
    rows = token_count.count_tokens(odd, BYTE).collect()
    tok = library(BYTE)
    want = [(i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in ODD]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in rows), key=key) == sorted(want, key=key)
    assert all(r.over_limit == (r.n_tokens > 512) for r in rows)
    assert token_count.count_tokens(nothing, BYTE).count() == 0


def test_bpe_operators_on_odd_rows(odd, nothing):
    tok = library(WORD)
    enc = bpe.encode(odd, WORD)
    back = {(r.doc_id, r.text) for r in bpe.decode(enc, WORD).collect()}
    dig = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip_digests(odd, WORD).collect()}
    want_text, want_dig = set(), set()
    for i, t in ODD:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        want_text.add((i, text))
        want_dig.add((i, len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(text.encode()).hexdigest()))
    assert back == want_text and dig == want_dig and enc.count() == len(ODD)
    assert bpe.round_trip_digests(nothing, WORD).count() == 0


def check_pieces(rows, docs, size):
    """Every id of every document lies in exactly one piece and sequences have no gap."""
    tok = library(BYTE)
    ids = [(i, [*tok.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in docs]
    seqs = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append(r)
    used = 0
    for s in seqs.values():
        s.sort(key=lambda r: r["offset"])
        at = 0
        for r in s:
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= size
        used += at
    assert used == sum(len(x) for _, x in ids)
    by_doc = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    for i, x in ids:
        got = by_doc[(i, len(x))]
        if len([1 for j, y in ids if (j, len(y)) == (i, len(x))]) == 1:
            flat = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in got])
            assert flat.tolist() == x and [r["start"] for r in got] == np.cumsum([0, *(r["length"] for r in got)])[:-1].tolist()
    return seqs


@pytest.mark.parametrize("size", [64, 2048])
def test_packing_odd_rows(odd, nothing, size):
    rows = [r.asDict() for r in packing.pack(odd, BYTE, size=size, stretch=20_000).collect()]
    check_pieces(rows, ODD, size)
    assert packing.pack(nothing, BYTE).count() == 0


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n, size = int(rng.integers(1, 60)), 16
        at = np.union1d(np.union1d(rng.integers(0, n + 1, 20), np.arange(0, n + 1, 7)), [0, n])
        penalty = rng.choice([0.0, 1.0, 8.0], len(at))
        cuts = packing.cheapest_cuts(at, penalty, size)
        price = dict(zip(at.tolist(), penalty.tolist()))

        def step(a, b):
            return (packing.SHORT if b - a in (size // 2, size // 4) and size - (b - a) > packing.SHORT else size - (b - a)) + price[b]
        best = {0: 0.0}
        for b in at[1:].tolist():
            best[b] = min(best[a] + step(a, b) for a in at.tolist() if a < b and b - a <= size)
        assert sum(step(a, b) for a, b in zip(cuts, cuts[1:])) == pytest.approx(best[n])
        assert packing.power_tail([0, n], 64)[-1] == n


def test_packing_pads_little_and_crc_matches(spark):
    from signalwatch.llm.queries import op9_packing
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows = packing.pack(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), BYTE).collect()
    seqs = check_pieces([r.asDict() for r in rows], docs, 2048)
    lengths = np.array([sum(r["length"] for r in s) for s in seqs.values()])
    padding = np.where(lengths & (lengths - 1) == 0, 0, 2048 - lengths).sum()
    assert padding < 0.02 * lengths.sum()
    got = {(r.doc_id, r.start): r.ids_crc32 for r in op9_packing(spark, "/root/testdata/sf0.001").collect()}
    assert got == {(r.doc_id, r.start): zlib.crc32(bytes(r.ids)) for r in rows}
