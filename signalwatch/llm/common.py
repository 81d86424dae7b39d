"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
import unicodedata
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Code points that the tokenizer libraries' ``\s`` matches (Unicode White_Space).
WHITE = r"\t-\r\x20\x85\xa0  -     　"
#: Words of the contracts: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def newer_code_points() -> tuple[str, dict[int, str]]:
    """Where the ``regex`` module and Python know another Unicode version than the tokenizer library.

    The code points (as the inside of a character class) that ``regex`` takes for
    letters or numbers and the library does not, and those that only the library
    lowers. Only code points that Python has no name for can differ, so the
    library is asked about those alone, on the driver.
    """
    import regex
    from tokenizers import Regex, normalizers, pre_tokenizers
    unnamed = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Cn")
    mine = regex.findall(r"[\p{L}\p{N}]", unnamed)
    theirs = pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]"), "removed", invert=True).pre_tokenize_str("".join(mine))
    known = {c for part, _ in theirs for c in part}
    lower = normalizers.Lowercase()
    lowered = {ord(c): x for c in mine if (x := lower.normalize_str(c)) != c}
    ranges: list[list[int]] = []
    for c in (ord(c) for c in mine if c not in known):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges), lowered


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One given table, whole."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bucket(n: int, key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def two_columns(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the id and the text, whatever else the table holds; a null text is empty."""
    return docs.select(docs[key].cast("long").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))


def worker_cache(name: str, build: Callable[[], object]) -> object:
    """A value that lives as long as the Python worker, built on first use.

    Functions are shipped by value, so the globals of their modules last for one
    task only; a vocabulary is read once per worker instead.
    """
    store = sys.modules.setdefault("_corpus_worker_cache", types.ModuleType("_corpus_worker_cache")).__dict__
    if name not in store:
        store[name] = build()
    return store[name]


def rows_of(batches: Iterable, max_chars: int = 1 << 21) -> Iterator[tuple[list, list]]:
    """(ids, texts) of Arrow batches in pieces of about ``max_chars`` characters, a whole text at least."""
    for b in batches:
        ids, texts = b.column(0).to_pylist(), b.column(1)
        lo = size = 0
        out: list = []
        for k in range(len(ids)):
            t = texts[k].as_py()
            out.append(t)
            size += len(t)
            if size >= max_chars:
                yield ids[lo:k + 1], out
                lo, size, out = k + 1, 0, []
        if out:
            yield ids[lo:], out


def bounded_sample(rows: DataFrame, label: str, per_label: int, key: str = "doc_id") -> DataFrame:
    """About ``per_label`` rows of each value of ``label`` (all, where there are fewer), chosen by a hash of the id.

    One count per value goes to the driver; the choice itself is a filter, so it
    is the same in every run and needs no sort. Of rows that repeat id and label one
    stays, so an id that holds a large share of the rows does not break the bound.
    Labels must be few (classes).
    """
    rows = rows.filter(F.col(label).isNotNull())
    share = {r[label]: min(1.0, per_label / r["n"]) for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if not share:
        return rows
    at = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in share.items() for x in kv]), F.col(label)), F.lit(0.0))
    place = F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    return rows.filter(place < at).dropDuplicates([key, label])


def class_table():
    """Code point -> 0 other, 1 white space, 2 lower or other letter, 3 upper-case letter, 4 digit, 5 sign of the noise set."""
    import numpy as np
    table = np.zeros(sys.maxunicode + 1, np.uint8)
    for c in range(sys.maxunicode + 1):
        x = chr(c)
        if x.isspace():
            table[c] = 1
        elif x.isalpha():
            table[c] = 3 if x.isupper() else 2
        elif x.isdigit():
            table[c] = 4
    table[[ord(x) for x in "#*$%&|<>"]] = 5
    return table
