"""Order-preserving packing of token streams into fixed windows by dynamic programming.

The documents of a partition are laid end to end in their order. Windows may be
cut behind a document (free), behind a sentence (a small penalty) or inside a
long stretch without either (a larger one). The cheapest set of cuts minimises
padding plus penalties:

    cost[j] = penalty[j] + size - at[j] + min(cost[i] + at[i])  over at[j] - at[i] <= size

The minimum over a sliding range is kept in a monotone queue, so every place
enters and leaves once. A window whose length is a power of two needs no padding;
that move (for half and quarter windows) competes with the queue's best. The plan
is made over stretches of ``stretch`` tokens; the last windows of a stretch are
planned again with the next one, so stretch ends leave no mark. What is left at
the end of a partition is cut into powers of two.

One pass, no shuffle: memory is one stretch per task. Sequence ids join the
partition number and a counter; a lost task repeats the same cuts.

Defined cases: a null or empty text is its end token alone; each row is a
document of its own, also when ids repeat; a document longer than a window spans
several; an empty table gives no sequence; other columns are ignored.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from signalwatch.llm.common import rows_of, two_columns, worker_cache
from signalwatch.llm.token_count import byte_chars

#: Penalties in tokens of padding: a cut behind a sentence, a cut elsewhere, a short window.
SENTENCE, ELSEWHERE, SHORT = 1.0, 8.0, 64.0
#: Without a sentence end, a place to cut every so many tokens.
EVERY = 64


class Stream:
    """Token ids by the byte-level vocabulary of a tokenizers file, and where sentences end."""

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = {c: b for b, c in byte_chars().items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        ranks = {bytes(of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        pattern = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.path = path
        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.slow = None
        size = max([*ranks.values(), *special.values()]) + 1
        self.ends = np.zeros(size, bool)
        for t, i in ranks.items():
            self.ends[i] = t.rstrip(b" ")[-1:] in (b".", b"!", b"?", b"\n")

    def ids(self, text: str) -> np.ndarray:
        """The same ids from either library; the second takes texts that the first one's pattern engine refuses."""
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except BaseException as e:  # noqa: BLE001  the library raises a panic that is no Exception
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
        if self.slow is None:
            from tokenizers import Tokenizer
            self.slow = Tokenizer.from_file(self.path)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def places(ends: np.ndarray, doc_ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows may be cut (ascending, 0 and n included) and the penalty of each place."""
    kind = np.full(n + 1, np.inf)
    kind[np.flatnonzero(ends) + 1] = SENTENCE
    kind[doc_ends] = 0.0
    kind[0] = kind[n] = 0.0
    known = np.flatnonzero(np.isfinite(kind))
    gap = np.diff(known)
    wide = np.flatnonzero(gap > EVERY)
    if len(wide):
        extra = np.concatenate([np.arange(known[k] + EVERY, known[k + 1], EVERY) for k in wide])
        kind[extra] = ELSEWHERE
        known = np.flatnonzero(np.isfinite(kind))
    return known, kind[known]


def cheapest_cuts(at: np.ndarray, penalty: np.ndarray, size: int) -> list[int]:
    """Cut places of least cost from ``at[0]`` to ``at[-1]``, both included."""
    m = len(at)
    moves = []
    for part in (size // 2, size // 4):
        k = np.minimum(np.searchsorted(at, at - part), m - 1)
        moves.append(np.where((at >= part) & (at[k] == at - part), k, -1).tolist())
    half, quarter = moves
    pos, pen = at.tolist(), penalty.tolist()
    cost, key, back = [0.0] * m, [0.0] * m, [0] * m
    key[0] = float(pos[0])
    queue, head = [0], 0
    for j in range(1, m):
        p = pos[j]
        while pos[queue[head]] < p - size:
            head += 1
        i = queue[head]
        best = key[i] + size - p
        h = half[j]
        if h >= 0 and cost[h] + SHORT < best:
            i, best = h, cost[h] + SHORT
        h = quarter[j]
        if h >= 0 and cost[h] + SHORT < best:
            i, best = h, cost[h] + SHORT
        best += pen[j]
        cost[j], back[j] = best, i
        k = key[j] = best + p
        while len(queue) > head and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
        if head > 4096:
            del queue[:head]
            head = 0
    cuts = [m - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return [pos[k] for k in reversed(cuts)]


def power_tail(cuts: list[int], size: int) -> list[int]:
    """The last window cut into powers of two, which need no padding."""
    lo, hi = cuts[-2], cuts[-1]
    out = cuts[:-1]
    if hi - lo == size:
        return cuts
    while lo < hi:
        lo += 1 << ((hi - lo).bit_length() - 1)
        out.append(lo)
    return out


class Packer:
    """Takes documents in order and gives the pieces of finished windows."""

    def __init__(self, ends: np.ndarray, size: int, stretch: int, first_id: int):
        self.ends, self.size, self.stretch, self.next_id = ends, size, stretch, first_id
        self.docs: list[tuple] = []  # doc_id, remaining ids, ids before them, ids of the whole document
        self.held = 0

    def add(self, doc_id, ids: np.ndarray):
        self.docs.append((doc_id, ids, 0, len(ids)))
        self.held += len(ids)
        if self.held >= self.stretch:
            yield from self.flush(False)

    def flush(self, final: bool):
        if not self.docs:
            return
        flat = np.concatenate([d[1] for d in self.docs])
        doc_at = np.cumsum([0, *(len(d[1]) for d in self.docs)])
        at, penalty = places(self.ends[flat], doc_at[1:], len(flat))
        cuts = cheapest_cuts(at, penalty, self.size)
        if final:
            cuts = power_tail(cuts, self.size)
        else:  # the last windows wait for the next stretch
            cuts = cuts[:max(2, len(cuts) - 8)]
        bounds = np.array(cuts, np.int64)
        over = int(bounds[-1])
        starts = np.union1d(doc_at[:-1][doc_at[:-1] < over], bounds[:-1])
        stops = np.append(starts[1:], over)
        doc = np.searchsorted(doc_at, starts, "right") - 1
        seq = np.searchsorted(bounds, starts, "right") - 1
        base = np.array([d[2] for d in self.docs], np.int64)
        yield {"doc_id": [self.docs[k][0] for k in doc.tolist()], "start": starts - doc_at[doc] + base[doc],
               "length": stops - starts,
               "ids": [flat[a:b].astype("<u4").tobytes() for a, b in zip(starts.tolist(), stops.tolist())],
               "doc_tokens": np.array([d[3] for d in self.docs], np.int64)[doc], "sequence_id": self.next_id + seq,
               "offset": starts - bounds[seq]}
        self.next_id += len(bounds) - 1
        k = int(np.searchsorted(doc_at, over, "right")) - 1
        rest = self.docs[k:]
        if rest:
            used = over - int(doc_at[k])
            name, ids, before, whole = rest[0]
            rest[0] = (name, ids[used:], before + used, whole)
        self.docs, self.held = rest, len(flat) - over


def pack(docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 1, key: str = "doc_id",
         text: str = "text", stretch: int = 1 << 18) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    if size < 4 or size & (size - 1):
        raise ValueError("size must be a power of two")

    def run(batches):
        stream = worker_cache(f"stream {vocabulary}", lambda: Stream(vocabulary))
        ends = stream.ends.copy()
        ends[end_id] = False
        packer = Packer(ends, size, stretch, TaskContext.get().partitionId() << 32)

        def rows(found):
            return pa.RecordBatch.from_arrays(
                [pa.array(found["doc_id"], pa.int64()), *(pa.array(found[c], pa.int64()) for c in ("start", "length")),
                 pa.array(found["ids"], pa.binary()),
                 *(pa.array(found[c], pa.int64()) for c in ("doc_tokens", "sequence_id", "offset"))],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for ids, texts in rows_of(batches):
            for name, t in zip(ids, texts):
                for found in packer.add(name, np.append(stream.ids(t), np.uint32(end_id))):
                    yield rows(found)
        for found in packer.flush(True):
            yield rows(found)

    return two_columns(docs, key, text).mapInArrow(
        run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
