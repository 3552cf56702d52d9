"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over training tokens.

The windows of the benchmark are numbered words. A document's words are looked
up; only where enough neighbours are benchmark words can a window occur, and
only there is the n-gram looked up in the set and so verified word by word.

The benchmark is the query set: it is read in blocks of bounded size, one
broadcast at a time, against all rows. Documents are never shuffled. Defined
results: a null or empty text has no words and no hits; an item without words
has no window; repeated items count once; a null item id is written as an empty
string; other columns are kept, and a column named like ``out`` is replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.llm.words import alnum_words
from tellerlake.operators.joins import written

#: Bytes of index in one broadcast, and about those of a window in it.
BLOCK_BYTES = 128 << 20
WINDOW_BYTES = 300
WINDOW = 13

HITS = "struct<n_words:bigint,words:array<int>,items:array<string>>"
_HITS_ARROW = pa.struct(
    [("n_words", pa.int64()), ("words", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))]
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class Index:
    """The windows of a block of items: numbered words, and per window length its set of n-grams."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        self.names: list[str] = []
        self.grams: dict[int, dict[bytes, list[int]]] = {}
        for name, text in items:
            words = alnum_words(text)
            if not words:
                continue
            ids = np.array([self.number.setdefault(w, len(self.number) + 1) for w in words], np.int32)
            size, item = min(window, len(words)), len(self.names)
            self.names.append(name)
            grams = self.grams.setdefault(size, {})
            for k in range(len(ids) - size + 1):
                owners = grams.setdefault(ids[k : k + size].tobytes(), [])
                if not owners or owners[-1] != item:
                    owners.append(item)
        #: Per length, which words begin a window.
        self.first = {}
        for size, grams in self.grams.items():
            first = np.zeros(len(self.number) + 1, bool)
            first[[np.frombuffer(g[:4], np.int32)[0] for g in grams]] = True
            self.first[size] = first

    @classmethod
    def of(cls, parts: dict) -> Index:
        """The index whose attributes are ``parts``: plain data, which any worker can unpickle."""
        index = cls([])
        vars(index).update(parts)
        return index

    def occurrences(self, words: list[bytes]) -> tuple[np.ndarray, list[str]]:
        """Positions of the words inside any window, and the items whose windows occur."""
        ids = np.array(list(map(self.number.get, words, repeat(0))), np.int32)
        hit, items = np.zeros(len(ids), bool), set()
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        for size, grams in self.grams.items():
            if size > len(ids):
                continue
            full = known[size:] - known[:-size] == size
            for at in np.flatnonzero(full & self.first[size][ids[: len(full)]]):
                owners = grams.get(ids[at : at + size].tobytes())
                if owners:
                    hit[at : at + size] = True
                    items.update(owners)
        return np.flatnonzero(hit), sorted({self.names[i] for i in items})


def _scanner(parts) -> Column:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        block = Index.of(parts.value)
        for batch in batches:
            rows = []
            for text in batch.cast(pa.binary()):
                words = alnum_words(text.as_py())
                at, items = block.occurrences(words)
                rows.append({"n_words": len(words), "words": at.tolist(), "items": items})
            yield pa.array(rows, _HITS_ARROW)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, HITS)


def _blocks(benchmark: DataFrame, item: str, text: str, window: int, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The distinct items in blocks with an index of about ``block_bytes``; one block is in the driver at a time."""
    name = F.coalesce(F.col(f"`{item}`").cast("string"), F.lit(""))
    items = benchmark.select(name.alias("item"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    items = written(items.distinct(), "benchmark-items")
    words = F.regexp_count("text", F.lit(_WORD.pattern))
    bytes_of = F.octet_length("text") + WINDOW_BYTES * F.greatest(words - window + 1, F.lit(1))
    sizes = items.agg(F.sum(bytes_of).alias("bytes"), F.count("*").alias("n")).first()
    count = max(1, min(sizes["n"], math.ceil((sizes["bytes"] or 0) / block_bytes)))
    items = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(count)))
    for block in range(count):
        rows = items.where(F.col("block") == block).select("item", "text").collect()
        # Without rows only the first block is needed, for the words of the documents.
        if rows or not block:
            yield [(r["item"], r.text.encode()) for r in rows]


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    out: str = "hits",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``out``: number of words, positions of the hit words, items found."""
    context = docs.sparkSession.sparkContext
    column, docs, begun = F.col(f"`{text}`"), docs.drop(out), False
    for rows in _blocks(benchmark, item, item_text, window, block_bytes):
        scan = _scanner(context.broadcast(vars(Index(rows, window))))
        if not begun:
            docs, begun = docs.withColumn(out, scan(column)), True
            continue
        # Written down between blocks, so that a job needs one broadcast only.
        before, after = F.col(f"`{out}`"), F.col("`__hits`")
        docs = written(docs, "decontaminate").withColumn("__hits", scan(column))
        both = [F.array_sort(F.array_union(before[k], after[k])).alias(k) for k in ("words", "items")]
        docs = docs.withColumn(out, F.struct(before["n_words"].alias("n_words"), *both)).drop("__hits")
    return docs


def contaminated(hits: Column, share: int = 20) -> Column:
    """At least one word in ``share`` is part of a benchmark window."""
    n_hit = F.size(hits["words"])
    return (n_hit > 0) & (n_hit * share >= hits["n_words"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", share: int = 20, **names) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    found = find(docs, benchmark, text, out="__found", **names)
    return found.where(~contaminated(F.col("__found"), share)).drop("__found")


def cut_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **names) -> DataFrame:
    """``docs`` with every hit word and what lies between hit neighbours cut out of ``text``."""

    def run(batches):
        for texts, hits in batches:
            done = []
            for t, positions in zip(texts, hits):
                t, at = t.as_py(), positions.as_py()
                if t and at:
                    places = [m.span() for m in _WORD.finditer(t)]
                    parts, end, last = [], 0, -2
                    for k in at:
                        parts.append(t[end : places[k][0]] if k != last + 1 else "")
                        end, last = places[k][1], k
                    t = "".join(parts) + t[end:]
                done.append(t)
            yield pa.array(done, pa.string())

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    found = find(docs, benchmark, text, out="__found", **names)
    return found.withColumn(text, F.arrow_udf(run, "string")(F.col(f"`{text}`"), F.col("__found.words"))).drop("__found")
