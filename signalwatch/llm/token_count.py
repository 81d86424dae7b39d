"""Token counts by heap-and-linked-list byte-pair merging; no ids are emitted.

A text is cut into pieces by the vocabulary's own pattern. In a piece every byte
is a symbol in a linked list; a heap holds the adjacent pairs that have a merge
rank. The lowest rank (then the leftmost place) is popped, the two symbols are
joined and the two new neighbour pairs pushed. The count of a piece is its
symbols minus its merges. Pieces repeat, so a bounded table of counts is kept
for each Python worker; a miss costs one merge run and never changes a count.

One pass without a shuffle: a document is counted where it is read.

Defined cases: null and empty text give 0 tokens and 0 bytes; every row of the
input gives one row, repeated ids included; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from signalwatch.llm.common import WHITE, newer_code_points, rows_of, two_columns, worker_cache

#: Fixed value: the cutting pattern of byte-level vocabularies of this kind.
PIECES = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+"
          rf"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: Counts kept for each worker (about 120 MB); when full, the table starts anew.
MAX_CACHED = 900_000


class Cutter:
    """Finds all matches of a pattern; ``new`` code points count as no letter or number."""

    def __init__(self, pattern: str, new: str):
        self.plain = regex.compile(pattern).findall
        self.has_new = re.compile(f"[{new}]").search if new else lambda text: None
        self.beyond = re.compile(f"[^\0-{chr(ord(new[0]) - 1)}]").search if new else lambda text: None
        strict = pattern.replace(r"^" + WHITE + r"\p{L}\p{N}", "^" + WHITE + rf"[\p{{L}}\p{{N}}--[{new}]]")
        for kind in ("L", "N"):
            strict = strict.replace(rf" ?\p{{{kind}}}+", rf" ?[\p{{{kind}}}--[{new}]]+")
            strict = strict.replace(rf"|\p{{{kind}}}", rf"|[\p{{{kind}}}--[{new}]]")
        self.strict = regex.compile(strict, regex.V1).findall if new else self.plain

    def __call__(self, text: str) -> list[str]:
        old = text.isascii() or not self.beyond(text) or not self.has_new(text)
        return self.plain(text) if old else self.strict(text)


def byte_chars() -> dict[int, str]:
    """The printable character by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class HeapCounter(dict):
    """Piece -> number of tokens. Symbols are numbered by the vocabulary's ids."""

    def __init__(self, path: str, new: str = ""):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        chars = byte_chars()
        self.byte_id = [vocab[chars[b]] for b in range(256)]
        self.rank: dict[int, int] = {}
        self.joined: list[int] = []
        for k, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.rank[vocab[a] << 32 | vocab[b]] = k
            self.joined.append(vocab[a + b])
        self.cut = Cutter(PIECES, new)
        self.stop = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))

    def merges(self, piece: str) -> int:
        """How many merges the piece takes."""
        data = piece.encode("utf-8", "surrogatepass")
        n = len(data)
        if n == 1:
            return 0
        rank, byte_id = self.rank.get, self.byte_id
        sym = [byte_id[b] for b in data]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [r << 32 | i for i in range(n - 1) if (r := rank(sym[i] << 32 | sym[i + 1])) is not None]
        heapify(heap)
        done = 0
        while heap:
            top = heappop(heap)
            i, r = top & 0xFFFFFFFF, top >> 32
            j = after[i]
            if sym[i] < 0 or j >= n or rank(sym[i] << 32 | sym[j]) != r:
                continue  # the pair has gone meanwhile
            sym[i], sym[j] = self.joined[r], -1
            k = after[i] = after[j]
            done += 1
            if k < n:
                before[k] = i
                if (q := rank(sym[i] << 32 | sym[k])) is not None:
                    heappush(heap, q << 32 | i)
            h = before[i]
            if h >= 0 and (q := rank(sym[h] << 32 | sym[i])) is not None:
                heappush(heap, q << 32 | h)
        return done

    def __missing__(self, piece: str) -> int:
        n = len(piece.encode("utf-8", "surrogatepass")) - self.merges(piece)
        if len(self) >= MAX_CACHED:
            self.clear()
        if len(piece) <= 64:
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of a whole text; a special token's string counts as that one token."""
        if self.special and any(s in text for s in self.special):
            parts = self.stop.split(text)
            return len(parts) - 1 + sum(self.count(p) for p in parts)
        return sum(map(self.__getitem__, self.cut(text)))


def count_tokens(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text",
                 limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of each row of ``docs``."""
    pairs = two_columns(docs, key, text)
    new, _ = newer_code_points()

    def run(batches):
        counter = worker_cache(f"heap counter {vocabulary}", lambda: HeapCounter(vocabulary, new))
        for ids, texts in rows_of(batches):
            n = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return pairs.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
