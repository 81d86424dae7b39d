"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, no random access.

A term's impact in a document is its whole contribution to a score (weight times
saturated frequency), so a score is a sum of impacts and every list is sorted by
falling impact. A query reads its lists in blocks, side by side. Each document met so
far has a lower bound, the impacts read, and an upper bound, that plus what the
unread heads of the other lists still allow; a document not met yet has the sum of
all heads. Reading goes on until the ``k`` best are settled: nothing outside can
reach or tie the last of them, and each one's own bounds have met, so that scores
and the order of equal ones are exact.

How it runs.

1. Queries go block by block (``BLOCK_CHARS`` characters, or one query that is longer),
   each against all documents; the terms of a block are the size of what is sent out.
2. One pass over the texts counts, for each document, all its terms and those of the
   block's that it holds; that table is written. Its sums give N, L and each term's
   document frequency.
3. Each task reads its part of that table in shards of bounded size, sorts the shard's
   postings by term and impact, and runs NRA for every query. The k best so far of a
   query go on to the task's next shard as a bar that bounds must reach, so later
   shards are read only a little way. No posting is shuffled.
4. Every task gives at most k rows a query; these are ranked, first within a hash of
   the document and then over all.

Defined cases: a null or empty text has no term, is not counted and is never found;
rows that repeat an id are documents of their own; a null id comes last among
equal scores; queries without a term, and queries whose terms no document holds,
give no row; rows that repeat a query id are queries of their own; an empty table on
either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.session import RunFolder

#: Characters of the queries that are searched at once.
BLOCK_CHARS = 4_000_000
#: Postings and documents of a shard.
SHARD_POSTINGS, SHARD_DOCS = 1_500_000, 32_768
#: Postings of a list that the first round reads; each round reads twice as many as the last.
FIRST_READ = 64
#: The formula's parameter: the share of a document's length that counts, in per cent.
B = 75
NO_ID = np.iinfo(np.int64).max

# digits, letters and all beyond ASCII make terms; A-Z are lower-cased, all else parts
KEPT = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return (text or "").encode().translate(KEPT).split()


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, w: np.ndarray, n: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """What a term adds to a document's score, in 64-bit integers."""
    if int(n.max(initial=0)) * n_docs * B < 1 << 63:
        m = 100 - B + (B * n * n_docs) // max(length, 1)
    else:  # the product alone is too long for 64 bits
        m = np.array([100 - B + B * x * n_docs // length for x in n.tolist()], np.int64)
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


@dataclass
class Shard:
    """Impact-sorted lists of some documents: those of term t lie in [start[t], start[t + 1])."""

    ids: np.ndarray
    start: np.ndarray
    doc: np.ndarray
    impact: np.ndarray

    @classmethod
    def of(cls, ids, n, count, term, tf, weights, n_docs, length) -> Shard:
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), count)
        impact = impacts(tf.astype(np.int64), weights[term], n[doc], n_docs, length)
        order = np.lexsort((-impact, term))
        start = np.searchsorted(term[order], np.arange(len(weights) + 1))
        return cls(ids, start, doc[order], impact[order])


def ahead(score: np.ndarray, ids: np.ndarray, than: tuple[int, int]) -> np.ndarray:
    """Which (score, id) rank before ``than``: a higher score, or the same and a smaller id."""
    return (score > than[0]) | ((score == than[0]) & (ids < than[1]))


def nra(shard: Shard, query: list[tuple[int, int]], k: int, best: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], int]:
    """The k best (score, id) among the shard's documents and ``best``, and how many postings were read.

    ``query``: (term, times in the query). ``best`` has exact scores and is sorted.
    """
    lists = [(t, q, int(shard.start[t]), int(shard.start[t + 1])) for t, q in query if shard.start[t] < shard.start[t + 1]]
    read = 0
    if not lists:
        return best, read
    low, met = np.zeros(len(shard.ids), np.int64), np.zeros(len(shard.ids), bool)
    shown = np.zeros(len(shard.ids), bool)
    at = [a for _, _, a, _ in lists]
    heads = np.array([q * shard.impact[a] for _, q, a, _ in lists], np.int64)
    step = FIRST_READ
    while True:
        bar = best[k - 1] if len(best) >= k else (0, -1)  # a score above 0 is wanted
        high = low + heads.sum()
        for j, (_, _, a, _) in enumerate(lists):  # a list that has shown a document allows it no more
            if heads[j] and at[j] > a:
                high[shard.doc[a:at[j]]] -= heads[j]
        # what may still come in: bounds that rank before the bar
        new_may = bool(heads.any()) and not met.all() and heads.sum() >= max(bar[0], 1)
        hope = np.flatnonzero(met & ahead(high, shard.ids, bar))
        if len(hope) > k:  # the k-th lower bound is a bar too: it is a score that k documents reach
            kth = np.partition(low[hope], len(hope) - k)[len(hope) - k]
            if kth > bar[0]:
                hope = hope[high[hope] >= kth]
                new_may = new_may and heads.sum() >= kth
        if not new_may and (low[hope] == high[hope]).all():
            found = [(int(low[x]), int(shard.ids[x])) for x in hope.tolist()]
            return sorted([*best, *found], key=lambda x: (-x[0], x[1]))[:k], read
        for j, (_, q, first, end) in enumerate(lists):
            if not heads[j] or new_may and 4 * heads[j] < heads.max():  # the highest heads hold the bounds up
                continue
            if not new_may:  # only documents met may win: a list that has shown all of these is done with
                shown[:] = False
                shown[shard.doc[first:at[j]]] = True
                if shown[hope].all():
                    continue
            a, b = at[j], min(at[j] + step, end)
            if a < b:
                docs = shard.doc[a:b]
                low[docs] += q * shard.impact[a:b]
                met[docs] = True
                at[j], read = b, read + b - a
                heads[j] = q * shard.impact[b] if b < end else 0
        step *= 2


def shards(batches, weights: np.ndarray, n_docs: int, length: int) -> Iterator[Shard]:
    """Shards of bounded size from Arrow rows (doc_id, n, terms, tfs)."""
    held, postings, docs = [], 0, 0

    def made() -> Shard:
        cols = [pa.concat_arrays([b.column(c) for b in held]) for c in range(4)]
        ids = cols[0].fill_null(NO_ID).to_numpy(zero_copy_only=False)
        return Shard.of(ids, cols[1].to_numpy(zero_copy_only=False), cols[2].value_lengths().to_numpy(zero_copy_only=False),
                        cols[2].flatten().to_numpy(zero_copy_only=False), cols[3].flatten().to_numpy(zero_copy_only=False),
                        weights, n_docs, length)

    for b in batches:
        lo = 0
        while lo < len(b):  # a document whole, so a shard passes its bound by one document at most
            ends = np.cumsum(b.column(2).slice(lo).value_lengths().to_numpy(zero_copy_only=False))
            take = min(int(np.searchsorted(ends, SHARD_POSTINGS - postings)) + 1, SHARD_DOCS - docs, len(b) - lo)
            held.append(b.slice(lo, take))
            postings, docs, lo = postings + int(ends[take - 1]), docs + take, lo + take
            if postings >= SHARD_POSTINGS or docs >= SHARD_DOCS:
                yield made()
                held, postings, docs = [], 0, 0
    if held:
        yield made()


def counted(docs: DataFrame, known: dict[bytes, int], key: str, text: str) -> DataFrame:
    """doc_id, n (all terms) and the known terms of each document that has a term, with their frequencies."""
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text")).filter("text is not null")
    shared = docs.sparkSession.sparkContext.broadcast(known)  # at most BLOCK_CHARS characters, or one query

    def run(batches):
        number = shared.value
        for b in batches:
            for lo in range(0, len(b), 256):
                part, out = b.slice(lo, 256), []
                for i, t in zip(part.column(0).to_pylist(), part.column(1)):
                    found = terms(t.as_py())
                    if found:
                        tf = {number[x]: c for x, c in Counter(found).items() if x in number}
                        out.append((i, len(found), list(tf), list(tf.values())))
                if out:
                    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], ["doc_id", "n", "terms", "tfs"])

    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def search_block(folder: RunFolder, docs: DataFrame, queries: list[tuple[int, Counter]], k: int, key: str, text: str, name: str) -> DataFrame:
    """(query, doc_id, score) of the k best of every task for a block of queries."""
    spark = docs.sparkSession
    known: dict[bytes, int] = {}
    asked = [(i, [(known.setdefault(t, len(known)), c) for t, c in q.items()]) for i, q in queries]
    table = folder.keep(counted(docs, known, key, text), name)
    total = table.agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
    n_docs, length = total["docs"], total["length"] or 0
    weights = np.zeros(len(known), np.int64)
    for r in table.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).toLocalIterator():
        weights[r["t"]] = weight(r["df"], n_docs)
    shared = spark.sparkContext.broadcast((asked, weights))  # bounded by the block

    def run(batches):
        asked, weights = shared.value
        best: list[list[tuple[int, int]]] = [[] for _ in asked]
        for shard in shards(batches, weights, n_docs, length):
            for j, (_, q) in enumerate(asked):
                best[j], _ = nra(shard, q, k, best[j])
        out = [(i, None if x == NO_ID else x, s) for (i, _), found in zip(asked, best) for s, x in found]
        for lo in range(0, len(out), 50_000):
            cols = zip(*out[lo:lo + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query", "doc_id", "score"])

    return table.mapInArrow(run, "query long, doc_id long, score long")


def best_of(rows: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query with their rank; first within a hash of the document, so that no query's rows meet at once."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    rows = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("query", "part").orderBy(*order)))
    rows = rows.filter(F.col("rank") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
    return rows.filter(F.col("rank") <= k).select("query", "rank", "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", query_key: str = "item_id",
           query_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the k documents of highest score above 0 for every row of ``queries``."""
    folder = RunFolder(docs.sparkSession)
    asked = queries.select(queries[query_key].alias("item_id"), queries[query_text].alias("text"), F.monotonically_increasing_id().alias("query"))
    asked = folder.keep(asked, "queries")
    found, block, chars = [], [], 0

    def close() -> None:
        rows = search_block(folder, docs, block, k, key, text, f"counts-{len(found)}")
        found.append(folder.keep(rows, f"found-{len(found)}"))

    for r in asked.filter("text is not null").toLocalIterator():  # a block is in the driver at a time
        q = Counter(terms(r["text"]))
        if block and chars + len(r["text"]) > block_chars:
            close()
            block, chars = [], 0
        if q:
            block.append((r["query"], q))
            chars += len(r["text"])
    if block or not found:
        close()
    rows = found[0]
    for x in found[1:]:
        rows = rows.unionByName(x)
    return best_of(rows, k).join(asked.select("query", "item_id"), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
