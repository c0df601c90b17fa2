"""Benchmark decontamination by greedy string tiling.

A text and a test item that share a run of ``least`` tokens are tiled: the longest runs that both have and that no tile
covers yet are marked, found by running Karp-Rabin hashes over the unmarked tokens, until no run of ``least`` tokens
is left. The share of the item's tokens under tiles is its coverage. As tiles may stand in any order, an item whose passages
were put in another order is covered too.

The items are sent to the tasks in passes of at most ``PASS_BYTES``, and every text is held against every item. Of one pass,
a task has the seeds of one block of ``BLOCK_BYTES`` at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.words import BASE, mixed, raw_texts, token_hashes
from corpusmill.sources.staging import stage

BLOCK_BYTES = 16 << 20
PASS_BYTES = 64 << 20
TEXT_BYTES = 16 << 20  # texts that a task holds against one block after another
SLICE = 1 << 19  # pairs of equal seeds looked at together
KEPT = 1 << 18  # longest runs marked in one round; what is left comes in the next
MATCH = "array<struct<item_id:bigint,coverage:double,item_tokens:int,tiles:array<struct<text_at:int,item_at:int,tokens:int>>>>"


class _Sums:
    """Running Karp-Rabin sums, from which the hash of any run of tokens is read."""

    def __init__(self, tokens: np.ndarray):
        powers = np.full(len(tokens) + 1, BASE, dtype=np.uint64)
        inverse = np.full(len(tokens) + 1, pow(BASE, -1, 1 << 64), dtype=np.uint64)
        powers[0] = inverse[0] = 1
        self.sums = np.zeros(len(tokens) + 1, dtype=np.uint64)
        np.cumsum(tokens * np.cumprod(powers)[:-1], out=self.sums[1:])
        self.inverse = np.cumprod(inverse)

    def runs(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self.sums[at + size] - self.sums[at]) * self.inverse[at]


def window_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``size`` tokens, by running sums."""
    if len(tokens) < size:
        return np.zeros(0, dtype=np.uint64)
    return mixed(_Sums(tokens).runs(np.arange(len(tokens) - size + 1), size))


def _free(marked: np.ndarray) -> np.ndarray:
    """How many tokens from each place on are unmarked."""
    stops = np.where(marked, np.arange(len(marked)), len(marked))
    return np.minimum.accumulate(stops[::-1])[::-1] - np.arange(len(marked))


def _lengths(item: _Sums, text: _Sums, at_item: np.ndarray, at_text: np.ndarray, least: int, most: np.ndarray) -> np.ndarray:
    """How far the tokens agree from each pair of places on: at least ``least``, at most ``most``."""
    low, high = np.full(len(most), least), most.copy()
    while (todo := np.flatnonzero(low < high)).size:
        middle = (low[todo] + high[todo] + 1) // 2
        same = item.runs(at_item[todo], middle) == text.runs(at_text[todo], middle)
        low[todo[same]] = middle[same]
        high[todo[~same]] = middle[~same] - 1
    return low


def tiles(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two token sequences: (place in text, place in item, length), longest first.

    Each round marks the longest runs, by place in the item and then in the text; it covers at least ``least`` tokens of the
    item. Pairs of equal seeds are looked at in slices, so memory is bounded however often a token is repeated.
    """
    of_item, of_text = window_hashes(item, least), window_hashes(text, least)
    if not len(of_item) or not len(of_text):
        return []
    item_sums, text_sums = _Sums(item), _Sums(text)
    marked_item, marked_text = np.zeros(len(item), dtype=bool), np.zeros(len(text), dtype=bool)
    shared = np.flatnonzero(np.isin(of_text, of_item))
    out = []
    while True:
        free_item, free_text = _free(marked_item), _free(marked_text)
        open_item, open_text = free_item[: len(of_item)] >= least, free_text[: len(of_text)] >= least
        p, t = np.flatnonzero(open_item), shared[open_text[shared]]
        p = p[np.argsort(of_item[p], kind="stable")]
        low = np.searchsorted(of_item[p], of_text[t], side="left")
        count = np.searchsorted(of_item[p], of_text[t], side="right") - low
        t, low, count = t[count > 0], low[count > 0], count[count > 0]
        if not len(t):
            return out
        ends, longest, best = np.cumsum(count), least, np.zeros((0, 2), dtype=np.int64)
        start = 0
        while start < len(t):
            before = ends[start] - count[start]
            end = max(start + 1, int(np.searchsorted(ends, before + SLICE, side="right")))
            n = count[start:end]
            at_text = np.repeat(t[start:end], n)
            step = np.arange(n.sum()) - np.repeat(ends[start:end] - n - before, n)
            at_item = p[np.repeat(low[start:end], n) + step]
            # A run begins where the seeds before do not agree.
            inner = (at_text > 0) & (at_item > 0)
            inner &= open_text[at_text - 1] & open_item[at_item - 1] & (of_text[at_text - 1] == of_item[at_item - 1])
            at_text, at_item = at_text[~inner], at_item[~inner]
            most = np.minimum(free_item[at_item], free_text[at_text])
            able = most >= longest
            at_text, at_item, most = at_text[able], at_item[able], most[able]
            length = _lengths(item_sums, text_sums, at_item, at_text, least, most)
            top = length.max(initial=longest)
            if top > longest:
                longest, best = top, best[:0]
            best = np.concatenate([best, np.column_stack([at_item, at_text])[length == longest]])
            if len(best) > 2 * KEPT or end == len(t):
                best = best[np.lexsort((best[:, 1], best[:, 0]))][:KEPT]
            start = end
        taken = -1
        for b, a in best.tolist():
            if b != taken and not marked_item[b : b + longest].any() and not marked_text[a : a + longest].any():
                marked_text[a : a + longest] = marked_item[b : b + longest] = True
                out.append((a, b, int(longest)))
                taken = b


class _Block:
    """Tokens and seeds of some items."""

    def __init__(self, texts: list[bytes], least: int):
        hashes, bounds = token_hashes(texts)
        self.tokens = [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        windows = [window_hashes(t, least) for t in self.tokens]
        seeds = np.concatenate([np.zeros(0, np.uint64), *windows])
        owner = np.repeat(np.arange(len(self.tokens)), [len(w) for w in windows])
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.owner = seeds[order], owner[order]

    def near(self, runs: np.ndarray, at: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
        """(text, item) with a seed in common; ``runs`` are the seeds of texts that begin at ``at``."""
        if not len(self.seeds):
            return
        low = np.searchsorted(self.seeds, runs, side="left")
        hit = np.flatnonzero(self.seeds[np.minimum(low, len(self.seeds) - 1)] == runs)
        row = np.searchsorted(at, hit, side="right") - 1
        inside = hit + least <= at[row + 1]
        hit, row = hit[inside], row[inside]
        cuts = np.flatnonzero(np.diff(row, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            mine = np.unique(runs[hit[a:b]])
            left, right = np.searchsorted(self.seeds, mine, side="left"), np.searchsorted(self.seeds, mine, side="right")
            for k in np.unique(np.concatenate([np.unique(self.owner[x:y]) for x, y in zip(left, right, strict=True)])):
                yield int(row[a]), int(k)


def _groups(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The rows in runs of about ``TEXT_BYTES`` of text, of one row at least."""
    for whole in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(whole.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < whole.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + TEXT_BYTES, side="right")))
            yield whole.slice(start, end - start)
            start = end


def _match(items, least: int, coverage: float, text_column: int, first: bool) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = items.value
        only = _Block(blocks[0][2], least) if len(blocks) == 1 else None
        for batch in _groups(batches, text_column):
            found = [[] for _ in range(batch.num_rows)]
            own, at = token_hashes(raw_texts(batch.column(text_column)))
            runs = window_hashes(own, least)
            for names, times, texts in blocks:
                block = only or _Block(texts, least)
                for i, k in block.near(runs, at, least):
                    size = len(block.tokens[k])
                    marked = tiles(block.tokens[k], own[at[i] : at[i + 1]], least)
                    share = sum(n for _, _, n in marked) / size
                    if share >= coverage:
                        found[i] += times[k] * [{
                            "item_id": names[k], "coverage": share, "item_tokens": size,
                            "tiles": [{"text_at": a, "item_at": b, "tokens": n} for a, b, n in marked],
                        }]
            columns, fields = list(batch.columns), list(batch.schema.names)
            if not first:
                before = columns.pop().to_pylist()
                found = [a + b for a, b in zip(before, found, strict=True)]
                fields.pop()
            kind = pa.list_(pa.struct([
                ("item_id", pa.int64()), ("coverage", pa.float64()), ("item_tokens", pa.int32()),
                ("tiles", pa.list_(pa.struct([("text_at", pa.int32()), ("item_at", pa.int32()), ("tokens", pa.int32())]))),
            ]))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], names=[*fields, "matches"])

    return work


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    least: int = 4, coverage: float = 0.6,
) -> DataFrame:
    """The columns of ``docs`` and matches: the items whose tokens the text's tiles cover to ``coverage`` or more.

    Tokens are runs of letters, digits and non-ASCII signs of the lower-cased texts. An item of fewer than ``least`` tokens or
    without a text matches nothing, and so does a null or empty text. Repeated items are told each; repeated rows get equal
    matches. ``tiles`` has token places from 0. Without items, all matches are empty; an empty table stays empty. A column
    ``matches`` of ``docs`` is replaced. Beyond ``PASS_BYTES`` of items the texts are read once more for each pass.
    """
    docs = docs.drop("matches")
    spark = docs.sparkSession
    rows = benchmark.select(F.col(f"`{item}`").cast("long").alias("id"), F.col(f"`{item_text}`").alias("text")).where("text is not null")
    rows = stage(rows.groupBy("id", "text").agg(F.count(F.lit(1)).alias("times")), "items")
    size = int(rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0)
    passes = max(1, -(-size // PASS_BYTES))
    blocks = max(1, -(-size // (passes * BLOCK_BYTES)))
    schema = T.StructType([*docs.schema.fields, T.StructField("matches", T._parse_datatype_string(MATCH))])
    out, column = docs, docs.columns.index(text)
    at = F.pmod(F.xxhash64("id", "text"), F.lit(passes * blocks))
    for turn in range(passes):
        items = []
        for block in range(turn * blocks, (turn + 1) * blocks):
            part = rows.where(at == block).orderBy("id", "text").collect()
            items.append(([r["id"] for r in part], [r["times"] for r in part], [r["text"].encode() for r in part]))
        sent = spark.sparkContext.broadcast(items)
        out = out.mapInArrow(_match(sent, least, coverage, column, turn == 0), schema)
        if passes > 1:
            out = stage(out, "matches")
            sent.unpersist()
    return out
