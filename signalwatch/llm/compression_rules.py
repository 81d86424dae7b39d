"""Quality rules by compression bands.

The zstandard ratio (bytes over compressed bytes) of the whole text and of its
fixed chunks must lie inside the band of their length: above it a text is
repetitive, below it incompressible (keys, binary data, noise). Short texts
compress worse, so the bands depend on the length. A text fails when the whole
lies outside its band or more than ``chunk_share`` of its chunks do; the bytes after
the last full chunk belong to that chunk, as few bytes alone have no ratio to judge. The base
counts of repeated lines, repeated word windows and signs come with it.

The limits are the fences of the corpus' own ratios (``fences``): the quartiles of
all documents of a length, widened by ``SPREAD`` times their distance. Quartiles do
not move with the few per cent of junk that the bands are to find.

The verdict is one pass over whole texts, no shuffle, one text at a time; the
fences are one aggregate with a row for each length.

Defined cases: null and empty texts have no words and fail the base rule; lines
and windows are counted in one text, so repeated rows do not touch each other;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.common import rows_of, two_columns

#: Parameter: below so many bytes, the smallest and the largest ratio; ``fences`` of the 10,000 documents of sf0.1.
BANDS = ((256, 0.11, 2.05), (1024, 1.33, 2.12), (4096, 1.72, 2.35), (16384, 2.04, 2.43), (float("inf"), 2.23, 2.61))
#: Quartile distances between a quartile and its fence.
SPREAD = 1.5
#: Bytes of a chunk, and the largest share of chunks outside their band.
CHUNK, CHUNK_SHARE = 4096, 0.25
SIGNS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"


def inside(n: int, ratio: float, bands=BANDS) -> bool:
    """Does a ratio lie in the band of a length? No bytes lie in every band."""
    low, high = next((low, high) for most, low, high in bands if n < most)
    return n == 0 or low <= ratio <= high


def fences(docs: DataFrame, key: str = "doc_id", text: str = "text", level: int = 3, spread: float = SPREAD,
           edges: tuple = tuple(b[0] for b in BANDS)) -> tuple[tuple[float, float, float], ...]:
    """Bands from the ratios of all documents: for each length its quartiles, widened by ``spread`` times their distance.

    A length without documents gets limits that reject nothing.
    """
    def run(batches):
        compress = zstandard.ZstdCompressor(level=level).compress
        for _, texts in rows_of(batches):
            found = [(next(k for k, most in enumerate(edges) if len(d) < most), len(d) / len(compress(d)))
                     for d in (t.encode() for t in texts) if d]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), (pa.int32(), pa.float64()))], ["band", "ratio"])

    rows = two_columns(docs, key, text).mapInArrow(run, "band int, ratio double")
    quarters = {r["band"]: r["q"] for r in rows.groupBy("band").agg(F.percentile("ratio", F.array(F.lit(0.25), F.lit(0.75))).alias("q")).collect()}
    out = []
    for k, most in enumerate(edges):
        low, high = quarters.get(k, (0.0, float("inf")))
        wide = spread * (high - low)
        out.append((most, round(max(low - wide, 0.0), 2), round(high + wide, 2)))
    return tuple(out)


def band_verdict(data: bytes, compress, chunk: int = CHUNK, chunk_share: float = CHUNK_SHARE) -> tuple[float, float, bool]:
    """Ratio of the whole, share of chunks outside their band, and whether the text stays."""
    n = len(data)
    if not n:
        return 0.0, 0.0, True
    ratio = n / len(compress(data))
    if n <= chunk:
        share = 0.0
    else:
        ends = [*range(chunk, n - chunk + 1, chunk), n]  # what is left over belongs to the last full chunk
        parts = [data[a:b] for a, b in zip([0, *ends], ends)]
        share = sum(not inside(len(p), len(p) / len(compress(p))) for p in parts) / len(parts)
    return ratio, share, inside(n, ratio) and share <= chunk_share


def repeated_words(found: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    n = len(found)
    if n < 4:
        return 0
    number: dict = {}
    w = np.array([number.setdefault(x, len(number)) for x in found], np.int64)
    if len(number) < 1 << 21:
        k = len(number)
        _, kind, times = np.unique((w[:-2] * k + w[1:-1]) * k + w[2:], return_inverse=True, return_counts=True)
        again = times[kind] > 1
    else:
        seen = Counter(zip(found, found[1:], found[2:]))
        again = np.array([seen[x] > 1 for x in zip(found, found[1:], found[2:])])
    inside_any = np.zeros(n, bool)
    for k in range(3):
        inside_any[k:n - 2 + k] |= again
    return int(inside_any.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def apply_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", level: int = 3) -> DataFrame:
    """Base counts, ratios and verdict of each row."""
    def run(batches):
        compress = zstandard.ZstdCompressor(level=level).compress
        for ids, texts in rows_of(batches):
            out = []
            for t in texts:
                data = t.encode()
                found = data.split()  # bytes split at ASCII white space alone
                n, rep = len(found), repeated_words(found)
                failed = n < 50 or 100 * rep > 50 * n
                ratio, share, good = band_verdict(data, compress)
                out.append((n, len(t) - sum(map(t.count, BLANKS)), sum(map(t.count, SIGNS)), duplicate_lines(t), rep,
                            failed, ratio, share, good and not failed))
            cols = list(zip(*out))
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                              "base_failed", "ratio", "chunks_outside", "kept"])

    return two_columns(docs, key, text).mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, ratio double, chunks_outside double, kept boolean")
