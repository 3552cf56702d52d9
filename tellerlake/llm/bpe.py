"""Byte-pair encoding and decoding, exactly as the tokenizers library does it.

Tree concatenation: a long text is cut into halves, and those again, down to
leaves. All leaves of a batch of texts are encoded together; then, from the
leaves up, each pair is joined: a window around the join is encoded anew and
grows until something of the left half and something of the right half reappear
in it at the same place.

What must reappear depends on the vocabulary. Where white space separates what it
encodes on its own (found out when it is loaded), units are the pieces between
white space: halves are cut anywhere, mostly inside a piece, and a window has to
show a whole piece of either side. Every distinct piece of a batch is encoded
once, by the library, and frequent ones are remembered. Pieces longer than a leaf,
and texts under any other vocabulary, are joined by tokens: a window has to show
a token of either half with the same place and id.

Why one shared unit on either side is exact: a piece's tokens depend on the piece
alone; and a sequence of merges is right if each adjacent pair of tokens is, and
every pair of the result lies inside one sequence that the library itself made
(left half, window or right half). No special token can reach over the join as
far as a shared token must lie from it, and no cut or window edge falls into a
run of combining marks. If the window has grown over both halves, it is the
library's own result.

Decoding joins the tokens by a space if the vocabulary has no decoder, as the
library does, and is the library's own where it has one.

Every row is encoded by itself: no shuffle, memory bounded by one text, a batch
and what is remembered, and a lost task is run again. Defined results: a null
text counts as empty and has no tokens; repeated rows are encoded alike; an empty
table stays empty; other columns are kept, and a column named like ``out`` is
replaced.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, _parse_datatype_string

#: Text of more code points than this is encoded as a tree of halves.
LEAF_CHARS = 4096
#: First reach of a window to either side of a join.
REACH = 64
#: Distinct pieces remembered a task, in two generations, and the longest piece that is.
CACHE_PIECES = 120_000
CACHE_CHARS = 48
#: New pieces that the library encodes as one text.
TOGETHER = 64
#: Bytes of text cut into pieces at a time.
GROUP_BYTES = 1 << 20


def load(path: str):
    """The tokenizer in ``path``, without truncation and padding."""
    os.environ.setdefault("RAYON_NUM_THREADS", "2")
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


Placed = list[tuple[int, int, int]]  # (id, start, end) in code points of the text


def _placed(encoding, shift: int) -> Placed:
    return [(i, a + shift, b + shift) for i, (a, b) in zip(encoding.ids, encoding.offsets)]


def _starter(text: str, at: int, step: int, limit: int) -> int:
    """The first place from ``at`` on, by ``step``, whose character is no combining mark; else ``limit``."""
    while at != limit and unicodedata.combining(text[at]):
        at += step
    return at


def longest_special(tokenizer) -> int:
    return max((len(t.content) for t in tokenizer.get_added_tokens_decoder().values()), default=1)


def _join(tokenizer, text: str, left: Placed, right: Placed, begin: int, cut: int, end: int, reach: int) -> Placed:
    """Tokens of text[begin:end] from those of text[begin:cut] and text[cut:end]; reach/4 exceeds any special token."""
    while True:
        start = _starter(text, max(begin, cut - reach), -1, begin)
        stop = min(end, cut + reach)
        stop = _starter(text, stop, 1, end) if stop < end else end
        window = _placed(tokenizer.encode(text[start:stop], add_special_tokens=False), start)
        low = (0, 0) if start == begin else _sync_left(left, window, start + reach // 4, cut - reach // 4)
        high = (len(right), len(window)) if stop == end else _sync_right(right, window, cut + reach // 4, stop - reach // 4)
        if low and high and low[1] <= high[1]:
            return left[: low[0]] + window[low[1] : high[1]] + right[high[0] :]
        if start == begin and stop == end:
            return window
        reach *= 2


def _sync_left(left: Placed, window: Placed, low: int, high: int) -> tuple[int, int] | None:
    """(tokens of left to keep, where the window goes on): the last token both have between low and high."""
    at = {token: k for k, token in enumerate(window) if low <= token[1] < token[2] <= high}
    for k in range(len(left) - 1, -1, -1):
        if left[k][1] < low:
            return None
        if left[k] in at:
            return k, at[left[k]]
    return None


def _sync_right(right: Placed, window: Placed, low: int, high: int) -> tuple[int, int] | None:
    """(where right goes on, tokens of the window to keep): the first token both have between low and high."""
    at = {token: k for k, token in enumerate(window) if low <= token[1] < token[2] <= high}
    for k, token in enumerate(right):
        if token[2] > high:
            return None
        if token in at:
            return k, at[token]
    return None


def halved(text: str, leaf_chars: int) -> list[int]:
    """Borders of the leaves of a text, by halving; none lies before a combining mark."""
    cuts, longest = [0, len(text)], len(text)
    while longest > leaf_chars:
        cuts = sorted({*cuts, *(_starter(text, (a + b) // 2, 1, b) for a, b in zip(cuts, cuts[1:]))})
        longest = (longest + 1) // 2
    return cuts


def encode_tree(tokenizer, text: str, leaf_chars: int = LEAF_CHARS, reach: int = REACH) -> list[int]:
    """Ids of a text, by joining the tokens of separately encoded halves."""
    reach = max(reach, 4 * longest_special(tokenizer) + 4)
    cuts = halved(text, max(leaf_chars, 2))
    leaves = tokenizer.encode_batch([text[a:b] for a, b in zip(cuts, cuts[1:])], add_special_tokens=False)
    level = [(a, b, _placed(e, a)) for a, b, e in zip(cuts, cuts[1:], leaves)]
    while len(level) > 1:
        pairs = zip(level[::2], level[1::2])
        joined = [(a, c, _join(tokenizer, text, x, y, a, b, c, reach)) for (a, b, x), (_, c, y) in pairs]
        level = joined + level[len(level) - len(level) % 2 :]
    return [i for i, _, _ in level[0][2]]


#: Texts by which a vocabulary shows whether it encodes what white space separates on its own.
_PROBES = ["ab", "Don't", "a1!?", "x" * 40, "\u00e9\u0301", "\u65e5\u672c", "<|", "-"]
_SPACES = [" ", "  ", "\n", "\t ", "\r\n", "\x0b", "\x0c"]


def separates(tokenizer) -> bool:
    """Whether white space between two texts leaves no trace and no bond in their tokens."""

    def ids(text):
        return tokenizer.encode(text, add_special_tokens=False).ids

    alone = {p: ids(p) for p in _PROBES}
    joined = ((ids(f"{s}{a}{s}{b}"), alone[a] + alone[b]) for a in _PROBES for b in _PROBES for s in _SPACES)
    return all(x == y for x, y in joined) and not any(ids(s) for s in _SPACES)


def _window(text: str, begin: int, cut: int, end: int, reach: int) -> tuple[int, int, int, int]:
    """(start, stop, pieces before the cut, pieces after it) of the smallest window that shows a whole
    piece of either half, beside the one that the cut and the one that the window's edge may have split."""
    left = right = reach
    while True:
        start = max(begin, cut - left)
        before = len(text[start:cut].encode().split())
        if start == begin or before > 2:
            break
        left *= 2
    while True:
        stop = min(end, cut + right)
        after = len(text[cut:stop].encode().split())
        if stop == end or after > 2:
            return start, stop, before, after
        right *= 2


class Encoder:
    """Encodes texts; a piece is remembered as (ids as text, tokens as text)."""

    def __init__(self, path: str, leaf_chars: int = LEAF_CHARS, reach: int = REACH):
        self.tokenizer, self.leaf_chars, self.reach = load(path), max(leaf_chars, 2), reach
        self.by_piece = separates(self.tokenizer)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.digits = [str(i) for i in range(size)]
        self.tokens = [self.tokenizer.id_to_token(i) for i in range(size)] if self.tokenizer.decoder is None else None
        self.young: dict[str, tuple[str, str]] = {}
        self.old: dict[str, tuple[str, str]] = {}
        #: Joins made so far.
        self.joins = 0

    def _entry(self, ids: list[int]) -> tuple[str, str]:
        tokens = " ".join(map(self.tokens.__getitem__, ids)) if self.tokens else ""
        return " ".join(map(self.digits.__getitem__, ids)), tokens

    def _encoded(self, pieces: list[str]) -> list[tuple[str, str]]:
        """Entries of new pieces: short ones many to a text, long ones as trees of their own."""
        found: dict[str, tuple[str, str]] = {}
        short = [p for p in pieces if len(p) <= self.leaf_chars]
        groups = [short[k : k + TOGETHER] for k in range(0, len(short), TOGETHER)]
        # What the library returns is many times the text, so it goes before the next lot comes.
        lots = (groups[k : k + TOGETHER] for k in range(0, len(groups), TOGETHER))
        encoded = (
            pair
            for lot in lots
            for pair in zip(lot, self.tokenizer.encode_batch([" ".join(g) for g in lot], add_special_tokens=False))
        )
        for group, encoding in encoded:
            ids, offsets = encoding.ids, encoding.offsets
            end, first, n = 0, 0, len(ids)
            for piece in group:
                end += len(piece)
                last = first
                while last < n and offsets[last][0] < end:
                    last += 1
                found[piece] = self._entry(ids[first:last])
                first, end = last, end + 1
        for piece in pieces:
            if len(piece) > self.leaf_chars:
                self.joins += len(halved(piece, self.leaf_chars)) - 2
                found[piece] = self._entry(encode_tree(self.tokenizer, piece, self.leaf_chars, self.reach))
        return [found[p] for p in pieces]

    def entries(self, pieces: list[str]) -> list[tuple[str, str]]:
        """Entries of distinct pieces; new ones are remembered in place of those not met for longest."""
        young, old = self.young, self.old
        found = [young.get(p) or old.get(p) for p in pieces]
        missing = [k for k, e in enumerate(found) if e is None]
        for k, entry in zip(missing, self._encoded([pieces[k] for k in missing])):
            found[k] = entry
        for piece, entry in zip(pieces, found):
            if len(piece) <= CACHE_CHARS:
                young[piece] = entry
        if len(young) > CACHE_PIECES // 2:
            self.young, self.old = {}, young
        return found

    def _rows(self, texts: list[str]) -> tuple[list[str], list[list[tuple]]]:
        """Leaves and windows of all texts as rows to encode, and per text its tree: (begin, end, row) of the
        leaves, then for each level the joins (row of the window, pieces before and after the cut)."""
        rows, trees = [], []
        for text in texts:
            cuts = halved(text, self.leaf_chars)
            level = [(a, b, len(rows) + k) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            rows += [text[a:b] for a, b, _ in level]
            tree: list = [[row for _, _, row in level]]
            while len(level) > 1:
                joins, above = [], []
                for (a, b, _), (_, c, _) in zip(level[::2], level[1::2]):
                    start, stop, before, after = _window(text, a, b, c, self.reach)
                    joins.append((len(rows), before, after, start == a, stop == c))
                    rows.append(text[start:stop])
                    above.append((a, c, None))
                self.joins += len(joins)
                tree.append(joins)
                level = above + level[len(level) - len(level) % 2 :]
            trees.append(tree)
        return rows, trees

    def __call__(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """Per text: number of tokens, ids joined by a space, the decoded text."""
        texts = [t or "" for t in texts]
        yield from self._by_pieces(texts) if self.by_piece and self.tokens else self._by_tokens(texts)

    def _by_tokens(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        for text in texts:
            self.joins += max(len(halved(text, self.leaf_chars)) - 2, 0)
            ids = encode_tree(self.tokenizer, text, self.leaf_chars, self.reach)
            decoded = self.tokenizer.decode(ids, skip_special_tokens=False)
            yield len(ids), " ".join(map(self.digits.__getitem__, ids)), decoded

    def _by_pieces(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        rows, trees = self._rows(texts)
        cut = pc.ascii_split_whitespace(pa.array(rows, pa.large_string()))
        owner = np.repeat(np.arange(len(rows)), pc.list_value_length(cut).to_numpy(zero_copy_only=False))
        flat = cut.flatten()
        some = pc.greater(pc.binary_length(flat), 0)
        coded = flat.filter(some).dictionary_encode()
        owner = owner[some.to_numpy(zero_copy_only=False)]
        codes = coded.indices.to_numpy().astype(np.int64)
        edges = np.searchsorted(owner, np.arange(len(rows) + 1))
        found = self.entries(coded.dictionary.to_pylist())
        ids, tokens = pa.array([e[0] for e in found], pa.large_string()), pa.array([e[1] for e in found], pa.large_string())
        lengths = np.array([e[0].count(" ") + 1 if e[0] else 0 for e in found], np.int64)
        of_text = [_concatenated(codes, edges, tree) for tree in trees]
        # Pieces without a token leave no place between two spaces either.
        of_text = [c[lengths[c] > 0] for c in of_text]
        every = pa.array(np.concatenate([np.zeros(0, np.int64), *of_text]))
        offsets, space = pa.array(np.cumsum([0, *map(len, of_text)]), pa.int64()), pa.scalar(" ", pa.large_string())
        joined = [pc.binary_join(pa.LargeListArray.from_arrays(offsets, x.take(every)), space).to_pylist() for x in (ids, tokens)]
        counts = (int(lengths[c].sum()) for c in of_text)
        yield from zip(counts, *joined)


def _concatenated(codes: np.ndarray, edges: np.ndarray, tree: list) -> np.ndarray:
    """The pieces of a text, from those of its leaves and windows."""

    def pieces(row: int) -> np.ndarray:
        return codes[edges[row] : edges[row + 1]]

    leaves, *levels = tree
    parts = [pieces(row) for row in leaves]
    for joins in levels:
        joined = []
        for (row, before, after, from_begin, to_end), left, right in zip(joins, parts[::2], parts[1::2]):
            window = pieces(row)
            # The piece before the one at the cut, in the left half and in the window; likewise after it.
            first, last = (0, 0) if from_begin else (before - 1, len(left) - 1)
            stop, rest = (len(window), len(right)) if to_end else (len(window) - after + 1, 1)
            if (first and left[last - 1] != window[first - 1]) or (rest < len(right) and right[rest] != window[stop]):
                raise AssertionError("a window and its halves differ")
            joined.append(np.concatenate([left[:last], window[first:stop], right[rest:]]))
        parts = joined + parts[len(parts) - len(parts) % 2 :]
    return parts[0]


def grouped(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Runs of texts of about GROUP_BYTES, so that only so many pieces exist at a time."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t or b"")
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def _arrow_type(kind: DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def ids_and_text(n: int, ids: str, decoded: str) -> dict:
    """The plain result of a text: its ids and their decoding."""
    return {"ids": [int(i) for i in ids.split()], "decoded": decoded}


def encode(
    docs: DataFrame,
    vocabulary: str,
    text: str = "text",
    out: str = "bpe",
    finish: Callable[[int, str, str], dict] = ids_and_text,
    fields: str = "ids:array<int>,decoded:string",
    leaf_chars: int = LEAF_CHARS,
) -> DataFrame:
    """``docs`` with a struct ``out`` of what ``finish`` makes of each text's tokens.

    ``finish`` gets the number of tokens, the ids joined by one space and the
    decoded text, in the task that encoded them; ``fields`` names its results.
    """
    returned = _parse_datatype_string(f"struct<{fields}>")
    arrow = _arrow_type(returned)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(vocabulary, leaf_chars)
        for batch in batches:
            texts = batch.to_pylist()
            yield pa.array([finish(*r) for group in grouped(texts) for r in encoder(group)], arrow)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(out, F.arrow_udf(run, returned)(F.col(f"`{text}`")))
