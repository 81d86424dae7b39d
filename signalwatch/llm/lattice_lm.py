"""Document probabilities from a subword lattice.

An existing subword vocabulary gives the pieces and their starting scores. A word
is the lattice of all its segmentations into pieces (a word starts with the
vocabulary's word mark; a character without a piece of its own is spelled by byte
pieces). A forward recursion in log space sums over all segmentations, so a word's
score is its marginal probability; a backward recursion gives every piece's
expected count, and ``rounds`` of such counts over all training words fit the piece
probabilities. No piece crosses a word, so a text's marginal probability is the
product over its words and the end.

How it runs. Texts are read once, in chunks of bounded size; a chunk keeps its
distinct words with their training counts, and each document as numbers of those
words. Counts are summed over chunks by word, the lattice runs once for each
distinct word, and counts and scores go back to the chunks by a join on the word:
what is shuffled is a row for each word of a chunk, never one for each token. A
frequent word has one row for each chunk, so no key is hot. Chunks and the word
table are written to the shared folder. Only the piece counts (the vocabulary's
size) reach the driver.

Defined cases: a null or empty text is the end alone; each row is scored by
itself, also when ids repeat; without training rows the base score is 0 and all
pieces are equally likely; a row with a null id counts as training; other columns
are ignored.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.common import worker_cache
from signalwatch.session import ensure_checkpoint_dir

MARK = "▁"
#: Pseudo-count of every piece, so that none is impossible.
FLOOR = 0.1
NO_PIECE = -1


class Vocabulary:
    """Pieces of a sentencepiece file as a trie over code points, and 256 byte pieces behind them."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        order = [i for i in range(sp.get_piece_size())
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        order = [i for i in order if MARK not in sp.id_to_piece(i)[1:]]
        self.pieces = [sp.id_to_piece(i) for i in order]
        # the file's scores fall by one with each rank; a harmonic law makes them probabilities
        rank = -np.array([sp.get_score(i) for i in order])
        start = 1.0 / (rank - rank.min() + 10.0)
        self.size = len(self.pieces) + 256
        start = np.append(start, np.full(256, start.min()))
        self.start = np.log(start / start.sum())
        self._trie()

    def _trie(self):
        """Transitions as sorted keys (state and code point), and the piece that ends in each state."""
        states: dict[tuple[int, str], int] = {}
        ends = {}
        for k, p in enumerate(self.pieces):
            s = 0
            for c in p:
                s = states.setdefault((s, c), len(states) + 1)
            ends[s] = k
        keys = np.array([s << 21 | ord(c) for s, c in states], np.int64)
        order = np.argsort(keys)
        self.keys, self.next = keys[order], np.array(list(states.values()), np.int64)[order]
        self.ends = np.full(len(states) + 1, NO_PIECE, np.int64)
        self.ends[list(ends)] = list(ends.values())

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        key = state << 21 | code
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.next[at], -1)


class Lattice:
    """All segmentations of many words: arcs between the places of their characters."""

    def __init__(self, v: Vocabulary, words: list[str]):
        self.v, self.n = v, len(words)
        marked = [MARK + w for w in words]
        size = np.array([len(w) for w in marked], np.int64)
        code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        # node k of word w is self.first[w] + k; a word of n characters has n + 1 nodes
        self.first = np.cumsum(np.append(0, size + 1))[:-1]
        self.last = self.first + size
        owner = np.repeat(np.arange(self.n), size)
        left = (np.cumsum(size)[owner]) - np.arange(len(code))  # characters from here to the end of the word
        at, state, length = np.arange(len(code)), np.zeros(len(code), np.int64), 1
        src, dst, piece = [], [], []
        alone = np.zeros(len(code), bool)
        while len(at):
            state = v.step(state, code[at + length - 1])
            go = state >= 0
            at, state = at[go], state[go]
            end = v.ends[state]
            hit = end != NO_PIECE
            src.append(at[hit] + owner[at[hit]])
            dst.append(src[-1] + length)
            piece.append(end[hit])
            if length == 1:
                alone[at[hit]] = True
            length += 1
            more = left[at] >= length
            at, state = at[more], state[more]
        bare = np.flatnonzero(~alone)
        self.spelled = code[bare]  # characters without a piece: arcs numbered from v.size on
        chars, which = np.unique(self.spelled, return_inverse=True)
        self.spell = [np.frombuffer(chr(c).encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64) for c in chars.tolist()]
        src.append(bare + owner[bare])
        dst.append(src[-1] + 1)
        piece.append(v.size + which)
        self.src, self.dst, self.piece = (np.concatenate(x) for x in (src, dst, piece))
        node_word = np.repeat(np.arange(self.n), size + 1)
        self.far = self.dst - self.first[node_word[self.dst]]
        self.near = self.last[node_word[self.src]] - self.src
        self.word = node_word[self.src]
        self.nodes = int(self.last[-1]) + 1 if self.n else 0

    def arc_scores(self, scores: np.ndarray) -> np.ndarray:
        spelled = [scores[len(self.v.pieces) + s].sum() for s in self.spell]
        return np.append(scores, spelled)[self.piece]

    def _sweep(self, start: np.ndarray, depth: np.ndarray, frm: np.ndarray, to: np.ndarray, score: np.ndarray) -> np.ndarray:
        """log of the summed probability of all ways from the start nodes; arcs are taken in order of ``depth`` of their end."""
        total = np.full(self.nodes, -np.inf)
        total[start] = 0.0
        order = np.lexsort((to, depth))
        frm, to, score, depth = frm[order], to[order], score[order], depth[order]
        cut = np.flatnonzero(np.append(True, depth[1:] != depth[:-1]))
        for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(depth)]):
            x, node = total[frm[lo:hi]] + score[lo:hi], to[lo:hi]
            first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            top = np.maximum.reduceat(x, first)
            width = np.diff(np.append(first, hi - lo))
            total[node[first]] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, width)), first))
        return total

    def log_probability(self, scores: np.ndarray) -> np.ndarray:
        """Natural logarithm of each word's marginal probability."""
        if not self.n:
            return np.zeros(0)
        return self._sweep(self.first, self.far, self.src, self.dst, self.arc_scores(scores))[self.last]

    def expected_counts(self, scores: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """How often each piece occurs over all segmentations, words weighted by their counts."""
        if not self.n:
            return np.zeros(self.v.size)
        s = self.arc_scores(scores)
        ahead = self._sweep(self.first, self.far, self.src, self.dst, s)
        behind = self._sweep(self.last, self.near, self.dst, self.src, s)
        share = np.exp(ahead[self.src] + s + behind[self.dst] - ahead[self.last][self.word]) * weight[self.word]
        got = np.bincount(self.piece, share, self.v.size + len(self.spell))
        out = got[:self.v.size]
        for k, s in enumerate(self.spell):
            np.add.at(out, len(self.v.pieces) + s, got[self.v.size + k])
        return out


def _vocabulary(path: str) -> Vocabulary:
    return worker_cache(f"lattice {path}", lambda: Vocabulary(path))


def chunks(docs: DataFrame, train: Column, key: str, text: str, chunk_chars: int) -> DataFrame:
    """Documents in chunks: the distinct words of a chunk, how often they occur in training rows, and where."""
    rows = docs.select(docs[key].cast("long").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"),
                       F.coalesce(train, F.lit(True)).alias("train"))

    def run(batches):
        part, number = TaskContext.get().partitionId() << 32, 0
        ids, flags, found, size, held = [], [], [], [], 0

        def close():
            nonlocal number, ids, flags, found, size, held
            index: dict[bytes, int] = {}
            place = np.array([index.setdefault(w, len(index)) for d in found for w in d], np.int32)
            train_of = np.repeat(np.array(flags, bool), size)
            count = np.bincount(place[train_of], minlength=len(index))
            row = pa.RecordBatch.from_arrays([
                pa.array([part + number], pa.int64()),
                pa.array([[w.decode() for w in index]], pa.list_(pa.string())), pa.array([count], pa.list_(pa.int64())),
                pa.array([ids], pa.list_(pa.int64())), pa.array([flags], pa.list_(pa.bool_())),
                pa.array([size], pa.list_(pa.int64())), pa.array([place.tobytes()], pa.binary())],
                ["chunk", "words", "counts", "ids", "train", "sizes", "places"])
            number, ids, flags, found, size, held = number + 1, [], [], [], [], 0
            return row

        for b in batches:
            texts = b.column(1)
            for k, (i, f) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist())):
                data = texts[k].as_py().encode().lower()  # of bytes: A-Z alone
                w = data.split()  # of bytes: at ASCII white space alone
                ids.append(i)
                flags.append(f)
                found.append(w)
                size.append(len(w))
                held += len(data)
                if held >= chunk_chars:
                    yield close()
        if ids:
            yield close()

    return rows.mapInArrow(run, "chunk long, words array<string>, counts array<long>, ids array<long>, train array<boolean>, "
                                "sizes array<long>, places binary")


def piece_scores(words: DataFrame, vocabulary: str, rounds: int) -> np.ndarray:
    """Log probabilities of the pieces, fitted by ``rounds`` of expected counts over all distinct training words."""
    start = Vocabulary(vocabulary)
    size, scores = start.size, start.start
    known = words.filter("c > 0").select("word")

    def count_with(given):
        def run(batches):
            v, total = _vocabulary(vocabulary), None
            for b in batches:
                w = b.column(0).to_pylist()
                for lo in range(0, len(w), 20_000):
                    n = Lattice(v, w[lo:lo + 20_000]).expected_counts(given, np.ones(len(w[lo:lo + 20_000])))
                    total = n if total is None else total + n
            if total is not None:
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.float64())], ["piece", "n"])
        return run

    for _ in range(rounds):
        got = (known.mapInArrow(count_with(scores), "piece int, n double")
               .groupBy("piece").agg(F.sum("n").alias("n")).collect())  # at most a row for each piece
        n = np.zeros(size)
        n[[r["piece"] for r in got]] = [r["n"] for r in got]
        scores = np.log((n + FLOOR) / (n.sum() + FLOOR * size))
    return scores


def mixed(lattice: np.ndarray, c: np.ndarray, n_train: int, distinct: int, discount: float) -> np.ndarray:
    """Natural logarithm of a word's probability: its own piece and all smaller segmentations together."""
    if not n_train:
        return lattice + np.log(0.5)
    with np.errstate(divide="ignore"):
        whole = np.log(np.maximum(c - discount, 0.0) / n_train)
    return np.logaddexp(whole, np.log(max(discount * distinct, 0.5) / n_train) + lattice)


def score(docs: DataFrame, train: Column, vocabulary: str, key: str = "doc_id", text: str = "text",
          rounds: int = 3, chunk_chars: int = 1 << 23) -> DataFrame:
    """doc_id, train flag, token counts, base score and log10 marginal probability of each row of ``docs``.

    Only rows where ``train`` holds are learned from. The base score is that of a
    word model with add-one smoothing.
    """
    spark = docs.sparkSession
    base = os.path.join(ensure_checkpoint_dir(spark), f"lattice-{uuid.uuid4().hex}")
    chunks(docs, train, key, text, chunk_chars).write.option("compression", "zstd").parquet(f"{base}/chunks")
    read = spark.read.parquet(f"{base}/chunks")
    pairs = read.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "w")).select(
        "chunk", "pos", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    pairs.groupBy("word").agg(F.sum("n").alias("c")).write.option("compression", "zstd").parquet(f"{base}/words")
    words = spark.read.parquet(f"{base}/words")
    seen = [F.count(F.when(F.col("c") >= 1, 1)), F.count(F.when(F.col("c") == 1, 1)), F.count(F.when(F.col("c") == 2, 1))]
    n, v, once, twice = words.agg(F.coalesce(F.sum("c"), F.lit(0)), *seen).first()
    ends = read.select(F.size(F.filter("train", lambda x: x)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    n_train, distinct = n + ends, v + (ends > 0)
    discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
    scores = piece_scores(words, vocabulary, rounds)
    end_score = float(np.log(max(ends, 0.5) / n_train if n_train else 0.5))

    def word_scores(batches):
        known = _vocabulary(vocabulary)
        for b in batches:
            w, c = b.column(0).to_pylist(), np.array(b.column(1).to_pylist(), float)
            got = [mixed(Lattice(known, w[lo:lo + 20_000]).log_probability(scores), c[lo:lo + 20_000], n_train, v, discount)
                   for lo in range(0, len(w), 20_000)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.concatenate([*got, np.zeros(0)]))],
                                             ["word", "c", "lp"])

    scored = words.mapInArrow(word_scores, "word string, c long, lp double")
    back = pairs.select("chunk", "pos", "word").join(scored, "word").select("chunk", "pos", "c", "lp")
    base_low = np.log10(n_train + 1.0 * (distinct + 1))

    def finish(_, payload: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = []
        order = np.empty(len(found), np.int64)
        order[found["pos"].to_numpy()] = np.arange(len(found))
        c, lp = found["c"].to_numpy()[order], found["lp"].to_numpy()[order]
        for r in payload.itertuples(index=False):
            size = np.asarray(r.sizes, np.int64)
            at = np.frombuffer(r.places, np.int32)
            doc, k = np.repeat(np.arange(len(size)), size), len(size)
            out.append(pd.DataFrame({
                "doc_id": pd.array([int(i) if n else None for i, n in zip(r.ids, r.named)], dtype="Int64"), "train": r.train,
                "n_tokens": size + 1, "n_known": np.bincount(doc, c[at] > 0, k).astype(np.int64) + (ends > 0),
                "train_tokens": n_train,
                "base_score": np.bincount(doc, np.log10(c[at] + 1.0) - base_low, k) + np.log10(ends + 1.0) - base_low,
                "score": (np.bincount(doc, lp[at], k) + end_score) / np.log(10)}))
        return pd.concat(out) if out else pd.DataFrame({x: [] for x in (
            "doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score")})

    payload = spark.read.parquet(f"{base}/chunks").select(
        "chunk", F.transform("ids", lambda x: F.coalesce(x, F.lit(0))).alias("ids"),
        F.transform("ids", lambda x: x.isNotNull()).alias("named"), "train", "sizes", "places")
    return (payload.groupBy("chunk").cogroup(back.groupBy("chunk"))
            .applyInPandas(finish, "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, "
                                   "base_score double, score double"))
