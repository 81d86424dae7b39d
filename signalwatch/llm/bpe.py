"""BPE encoding and decoding in batched numpy merge rounds.

The words of many texts that no earlier batch has met are laid end to end in one
flat symbol array. In each round the rank of every adjacent pair is found by
binary search over the sorted pair keys, every word picks its lowest rank, and
all places of that pair are joined at once (left to right where they overlap).
A word leaves the array when no pair of it has a rank. Joining all places of one
rank in a round equals joining them one by one as long as no merge makes a
symbol that an earlier merge needs; the table checks that when it is built.

Encoding keeps a bounded table of word -> ids for each Python worker. Decoding
looks the ids up in the vocabulary and joins the tokens the way the vocabulary's
decoder does (by a space when it has none). One pass, no shuffle.

Defined cases: null and empty text give no ids and the empty text; a string of a
special token inside a text gives that token; every row gives one row; other
columns are ignored.
"""

from __future__ import annotations

import json
from hashlib import sha256
from itertools import chain
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from signalwatch.llm.common import WHITE, newer_code_points, rows_of, two_columns, worker_cache
from signalwatch.llm.token_count import Cutter, byte_chars

#: Fixed value: the word pattern of the lower-case vocabulary with word ends.
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+"
#: Words kept for each worker (about 150 MB); when full, the table starts anew.
MAX_CACHED = 500_000
NONE = np.int64(1) << 40


class WordBpe:
    """A lower-case byte-pair vocabulary with word ends, read from its file."""

    def __init__(self, path: str, new: str = "", lowered: dict[int, str] | None = None):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        names = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.tokens = [names.get(i, "") for i in range(max(names) + 1)]
        self.digits = [str(i) for i in range(len(self.tokens))]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        chars = byte_chars()
        self.inner = np.array([vocab[chars[b]] for b in range(256)], np.int64)
        self.final = np.array([vocab[chars[b] + end] for b in range(256)], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        first_use: dict[str, int] = {}
        for k, (a, b) in enumerate(pairs):
            first_use.setdefault(a, k)
            first_use.setdefault(b, k)
        if any(first_use.get(a + b, k) < k for k, (a, b) in enumerate(pairs)):
            raise ValueError("a merge makes a symbol that an earlier merge needs: rounds would not be exact")
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.joined = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.cut = Cutter(WORDS, new)
        self.lowered = lowered or {}
        self.stop = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.known: dict[str, tuple] = {s: (i,) for s, i in self.special.items()}

    def words(self, text: str) -> list[str]:
        """The words of a text: NFC, each character lowered by itself; white space is in no word, so its runs may stay."""
        if any(s in text for s in self.special):
            parts = self.stop.split(text)
            return list(chain.from_iterable([p] if p in self.special else self.words(p) for p in parts))
        # the final form of sigma depends on its place in str.lower(), not here
        lower = normalize("NFC", text).replace("Σ", "σ").lower()
        if lower.isascii() or not self.cut.beyond(lower):
            return self.cut.plain(lower)
        return self.cut(lower.translate(self.lowered))

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge_rounds(self, words: list[str]) -> list[tuple]:
        """The ids of each word (none is empty), all words at once."""
        data = [w.encode() for w in words]
        size = np.array([len(d) for d in data], np.int64)
        raw = np.frombuffer(b"".join(data), np.uint8)
        last = np.zeros(len(raw), bool)
        last[np.cumsum(size) - 1] = True
        sym = np.where(last, self.final[raw], self.inner[raw])
        owner = np.repeat(np.arange(len(words)), size)
        rank = np.where(last, NONE, self._rank(sym, np.append(sym[1:], 0)))
        done: list = [None] * len(words)
        while len(sym):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat(rank, starts)
            count = np.diff(np.append(starts, len(sym)))
            over = best == NONE
            if over.any():
                for s, n in zip(starts[over].tolist(), count[over].tolist()):
                    done[owner[s]] = tuple(sym[s:s + n].tolist())
                stay = np.repeat(~over, count)
                sym, rank, owner, last = sym[stay], rank[stay], owner[stay], last[stay]
                best, count = best[~over], count[~over]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == np.repeat(best, count))
            new_run = np.append(True, np.diff(at) != 1)
            at = at[(at - at[new_run][np.cumsum(new_run) - 1]) % 2 == 0]
            sym[at], last[at] = self.joined[rank[at]], last[at + 1]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            at = at - np.arange(len(at))
            sym, rank, owner, last = sym[stay], rank[stay], owner[stay], last[stay]
            near = np.unique(np.append(at, np.maximum(at - 1, 0)))
            right = np.append(sym, 0)[near + 1]
            rank[near] = np.where(last[near], NONE, self._rank(sym[near], right))
        return done

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text; words that the table lacks are merged in one batch."""
        cut = [self.words(t) for t in texts]
        if len(self.known) > MAX_CACHED:
            self.known = {s: (i,) for s, i in self.special.items()}
        fresh = list(set(chain.from_iterable(cut)).difference(self.known))
        known = self.known
        for lo in range(0, len(fresh), 50_000):
            part = fresh[lo:lo + 50_000]
            known.update(zip(part, self.merge_rounds(part)))
        return [list(chain.from_iterable(map(known.__getitem__, w))) for w in cut]

    def decode(self, ids: list[int]) -> str:
        """The tokens of the ids, joined by a space (this vocabulary names no decoder)."""
        return " ".join(map(self.tokens.__getitem__, ids))


def _bpe(path: str, unicode: tuple = ("", None)) -> WordBpe:
    return worker_cache(f"word bpe {path}", lambda: WordBpe(path, *unicode))


def _map(docs: DataFrame, key: str, text: str, run, columns: str) -> DataFrame:
    pairs = two_columns(docs, key, text)
    return pairs.mapInArrow(run, f"doc_id long, {columns}")


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of each row."""
    unicode = newer_code_points()

    def run(batches):
        for ids, texts in rows_of(batches):
            got = _bpe(vocabulary, unicode).encode_batch(texts)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(got, pa.list_(pa.int32()))],
                                             ["doc_id", "ids"])
    return _map(docs, key, text, run, "ids array<int>")


def decode(encoded: DataFrame, vocabulary: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and the decoded text of each row of ids."""
    unicode = newer_code_points()

    def run(batches):
        for b in batches:
            got = [_bpe(vocabulary, unicode).decode(x or []) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.string())], ["doc_id", "text"])
    rows = encoded.select(encoded[key].cast("long").alias("doc_id"), encoded[ids].alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the text that they decode to."""
    unicode = newer_code_points()

    def run(batches):
        for keys, texts in rows_of(batches):
            bpe = _bpe(vocabulary, unicode)
            got = bpe.encode_batch(texts)
            yield pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()), pa.array(map(len, got), pa.int64()),
                pa.array([sha256(" ".join(map(bpe.digits.__getitem__, x)).encode()).hexdigest() for x in got]),
                pa.array([sha256(bpe.decode(x).encode()).hexdigest() for x in got])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return _map(docs, key, text, run, "n_tokens long, ids_sha256 string, decoded_sha256 string")
