"""Phrase collocations from sorted count streams that are merged in lockstep.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and into words at spaces and tabs. Counting goes order
by order, and only what can still be frequent is counted:

1. words are counted per language, exactly;
2. hashes of the pairs of frequent words are counted, to learn which pairs can be frequent;
3. these pairs, and the triples made of two of them, are counted exactly, by their words.

Two filters of bounded size, over frequent words and over hashes of frequent pairs, tell a task what to leave out. They let too
much pass at worst, so their size changes the work and never the counts. Every part of a frequent phrase is frequent itself,
so the table of frequent words, pairs and triples holds all parts of all its phrases, and two sorted streams of it give the rest:

* in suffix order (by the last word, the one before, ...) the last word or last two words of a phrase are the nearest
  earlier rows of those lengths: their counts come from the running position, and a pair's left extensions follow it;
* in prefix order the same holds for the first words and for right extensions.

Both streams are range-partitioned and sorted by Spark and read once, batch by batch; nothing is looked up by a hash. What a
partition lacks from the ones before it concerns one word and one pair at most, and is filled in afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.words import BASE, mixed, pieces, raw_texts
from corpusmill.sources.staging import stage

CHUNK = 8 << 20  # bytes that a task counts at once
SPACE, BREAK = 1, 2
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t")] = SPACE
KIND[list(b".,;:!?\n\x0b\x0c\r")] = BREAK
FILTER_BITS = 1 << 26  # 8 MB: the largest filter
BITS_PER_KEY = 16
UNKNOWN = "und"
PARTS = 16  # parts of a language that are ranked on their own first


class Chunk:
    """Words of a run of text: their numbers, languages and links, and the dictionary behind the numbers.

    ``first`` words at the start are repeated from the chunk before, as context.
    """

    def __init__(self, joined: bytes, bounds: np.ndarray, owners: np.ndarray, langs: list[str], first: int):
        data = np.frombuffer(joined, dtype=np.uint8)
        kind = KIND[data]
        inside = np.zeros(len(data) + 2, dtype=bool)
        inside[1:-1] = kind == 0
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.joined, self.first, self.langs = joined, first, langs
        self.starts, self.ends = edges[::2], edges[1::2]
        breaks = np.flatnonzero(kind == BREAK)
        before = np.searchsorted(breaks, self.starts)
        self.open_end = bool(len(before)) and before[-1] == len(breaks)
        self.linked = np.zeros(len(before), dtype=bool)
        self.linked[1:] = before[1:] == before[:-1]
        offsets = np.zeros(len(before) + 1, np.int32)
        np.cumsum(self.ends - self.starts, out=offsets[1:])
        words = pa.Array.from_buffers(pa.binary(), len(before), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside[1:-1]])])
        coded = words.dictionary_encode()
        lang = owners[np.searchsorted(bounds, self.starts, side="right") - 1] if len(before) else np.zeros(0, np.int64)
        pairs = lang.astype(np.int64) * max(len(coded.dictionary), 1) + coded.indices.to_numpy()
        #: ``ids`` numbers the distinct (language, word); ``words`` and ``lang`` have one entry for each.
        distinct, self.ids = np.unique(pairs, return_inverse=True)
        self.lang, at = np.divmod(distinct, max(len(coded.dictionary), 1))
        self.words = coded.dictionary.take(pa.array(at))

    def tail(self) -> list[bytes]:
        """The last words that a phrase can go on from: two at most, none after a break."""
        if not self.open_end:
            return []
        at = [len(self.starts) - 1]
        if self.linked[-1]:
            at.insert(0, at[0] - 1)
        return [self.joined[self.starts[i] : self.ends[i]] for i in at]

    def hashes(self) -> np.ndarray:
        """64-bit hash of each distinct (language, word)."""
        lang = np.array([_text_hash(x.encode()) for x in self.langs], dtype=np.uint64)
        return word_hashes(self.words) ^ lang[self.lang]

    def ends_of(self, order: int) -> np.ndarray:
        """Places where a phrase of ``order`` linked words ends, each counted in one chunk only."""
        good = np.ones(len(self.ids), dtype=bool)
        good[: max(self.first, order - 1)] = False
        for back in range(order - 1):
            good[back:] &= self.linked[: len(good) - back] if back else self.linked
        return np.flatnonzero(good)


def _text_hash(text: bytes) -> np.uint64:
    return word_hashes(pa.array([text + b"|"], pa.binary()))[0]


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word: a polynomial of its bytes, mixed. Words are not empty."""
    if not len(words):
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    lengths = np.diff(offsets)
    powers = np.full(int(lengths.max()), BASE, dtype=np.uint64)
    np.cumprod(powers, out=powers)
    place = np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], lengths)
    return mixed(np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * powers[place], offsets[:-1] - offsets[0]))


def pair_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * np.uint64(BASE) + b)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """Chunks of the texts of batches with the columns text (binary) and lang. Long texts go on in the next chunk."""
    codes: dict[str, int] = {}
    run: list[bytes] = []
    starts, owners = [0], [0]
    size = first = 0

    def made() -> Chunk:
        return Chunk(b"".join(run), np.array(starts), np.array(owners), list(codes) or [UNKNOWN], first)

    for batch in batches:
        for text, lang in zip(raw_texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            code = codes.setdefault(lang, len(codes))
            lead = b"\n"
            for part in pieces(text.lower()) if len(text) > 1 << 20 else (text.lower(),):
                starts.append(size)
                owners.append(code)
                run += [lead, part]
                size += len(lead) + len(part)
                lead = b""
                if size >= CHUNK:
                    chunk = made()
                    yield chunk
                    kept = chunk.tail()
                    run, first = [b" ".join(kept)], len(kept)
                    starts, owners, size = [0], [code], len(run[0])
    if size:
        yield made()


def _rows(chunk: Chunk, at: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """One row per distinct phrase: ``at`` has its words' numbers, one row each."""
    langs = pa.array(chunk.langs, pa.string()).take(pa.array(chunk.lang[at[:, 0]]))
    empty = pa.array([b""] * 1, pa.binary())
    columns = [chunk.words.take(pa.array(at[:, i])) if i < at.shape[1] else empty.take(pa.array(np.zeros(len(at), np.int32))) for i in range(3)]
    return pa.RecordBatch.from_arrays([langs, *columns, pa.array(counts.astype(np.int64))], names=["lang", "w1", "w2", "w3", "a"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches):
        counts = np.bincount(chunk.ids[chunk.first :], minlength=len(chunk.words))
        seen = np.flatnonzero(counts)
        yield _rows(chunk, seen[:, None], counts[seen])


class Filter:
    """Two bits for each 64-bit key; ``has`` is never false for a key that was added."""

    def __init__(self, bits: int):
        self.mask, self.words = np.uint64(bits - 1), np.zeros(bits // 64, np.uint64)

    def _bits(self, keys: np.ndarray) -> list[np.ndarray]:
        return [keys & self.mask, (keys >> np.uint64(32)) * np.uint64(0x9E3779B1) & self.mask]

    def add(self, keys: np.ndarray) -> None:
        for bit in self._bits(keys):
            np.bitwise_or.at(self.words, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), dtype=bool)
        for bit in self._bits(keys):
            found &= (self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return found


def filter_bits(keys: int) -> int:
    """A power of two, ``BITS_PER_KEY`` bits a key or ``FILTER_BITS`` in all."""
    return min(FILTER_BITS, 1 << max(10, (keys * BITS_PER_KEY - 1).bit_length()))


def _fill(bits: int, kinds: tuple[str, ...]) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Filter(bits)
        for batch in batches:
            if kinds == ("h",):
                made.add(batch.column(0).to_numpy().view(np.uint64))
                continue
            keys = word_hashes(batch.column(len(kinds) - 1))
            if len(kinds) > 1 and len(keys):
                names = batch.column(0).dictionary_encode()
                keys ^= np.array([_text_hash(x.encode()) for x in names.dictionary.to_pylist()], dtype=np.uint64)[names.indices.to_numpy()]
            made.add(keys)
        hit = np.flatnonzero(made.words)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(made.words[hit].view(np.int64))], names=["at", "bits"])

    return work


def made_filter(keys: DataFrame):
    """A filter over ``keys``, made in the tasks and sent to all of them: at most ``FILTER_BITS`` bits.

    The keys are hashes (the column h), words (one binary column), or languages and words.
    """
    made = Filter(filter_bits(keys.count()))
    parts = keys.mapInArrow(_fill(64 * len(made.words), tuple(keys.columns)), "at long, bits long")
    merged = parts.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    made.words[merged.column(0).to_numpy()] = merged.column(1).to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast((64 * len(made.words), made.words))


def filter_of(sent) -> Filter:
    """The filter that was sent, in a task."""
    bits, words = sent.value
    found = Filter(64)
    found.mask, found.words = np.uint64(bits - 1), words
    return found


def _count_pair_hashes(frequent) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = filter_of(frequent)
        for chunk in chunks(batches):
            word = chunk.hashes()
            good = known.has(word)
            at = chunk.ends_of(2)
            a, b = chunk.ids[at - 1], chunk.ids[at]
            both = good[a] & good[b]
            keys, counts = np.unique(pair_hashes(word[a[both]], word[b[both]]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], names=["h", "n"])

    return work


def _count_phrases(pairs) -> Callable:
    """Pairs that pass the filter, and triples of two such pairs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = filter_of(pairs)
        for chunk in chunks(batches):
            word, ids = chunk.hashes(), chunk.ids
            at = chunk.linked.nonzero()[0]
            good = np.zeros(len(ids), dtype=bool)
            good[at] = known.has(pair_hashes(word[ids[at - 1]], word[ids[at]]))
            at = chunk.ends_of(2)
            at = at[good[at]]
            keys, counts = np.unique(ids[at - 1] << 32 | ids[at], return_counts=True)
            yield _rows(chunk, np.stack([keys >> 32, keys & 0xFFFFFFFF], axis=1), counts)
            at = chunk.ends_of(3)
            at = at[good[at] & good[at - 1]]
            first, inverse = np.unique(ids[at - 2] << 32 | ids[at - 1], return_inverse=True)
            keys, counts = np.unique(inverse.astype(np.int64) << 32 | ids[at], return_counts=True)
            first = first[keys >> 32]
            yield _rows(chunk, np.stack([first >> 32, first & 0xFFFFFFFF, keys & 0xFFFFFFFF], axis=1), counts)

    return work


ROW = "lang string, w1 binary, w2 binary, w3 binary, a long"


def frequent_phrases(docs: DataFrame, least: int, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, w1, w2, w3, a) of all words, pairs and triples that occur ``least`` times or more, and (lang, n) of all words."""
    rows = docs.select(F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)))
    keys = ["lang", "w1", "w2", "w3"]
    words = rows.mapInArrow(_count_words, ROW).groupBy("lang", "w1").agg(F.sum("a").alias("a"))
    words = stage(words, "words-by-language")
    totals = stage(words.groupBy("lang").agg(F.sum("a").alias("n")), "language-totals")
    single = words.where(F.col("a") >= least)
    hashes = rows.mapInArrow(_count_pair_hashes(made_filter(single.select("lang", "w1"))), "h long, n long")
    hashes = stage(hashes.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h"), "pair-hashes")
    phrases = rows.mapInArrow(_count_phrases(made_filter(hashes)), ROW).groupBy(*keys).agg(F.sum("a").alias("a"))
    none = F.lit(b"")
    every = single.select("lang", "w1", none.alias("w2"), none.alias("w3"), "a").unionByName(phrases.where(F.col("a") >= least))
    return stage(every, "frequent-phrases"), totals


def _lockstep(order_of: tuple[int, int]) -> Callable:
    """Counts of the one-word and two-word context of each row, and of the largest extension of each pair, from a sorted stream.

    ``order_of`` has the columns that hold a second and a third word in this order. Contexts are the nearest earlier rows of
    their length. Only the counts of the open contexts are kept from batch to batch, and the open pair, whose extensions go on.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = {1: None, 2: None}  # counts of the open contexts; None while they lie in an earlier partition
        held: pa.RecordBatch | None = None  # the open pair, with its largest extension so far
        widest = 0
        known_pair = False

        def out(batch: pa.RecordBatch, one, two, most) -> pa.RecordBatch:
            columns = [*[batch.column(i) for i in range(batch.num_columns)], one, two, most]
            return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "one", "two", "most"])

        def of_held() -> pa.RecordBatch:
            return out(held, pa.array([held_one], pa.int64()), pa.array([None], pa.int64()), pa.array([widest], pa.int64()))

        held_one = None
        for batch in batches:
            if not batch.num_rows:
                continue
            a = batch.column(batch.schema.get_field_index("a")).to_numpy()
            longer = [np.diff(np.frombuffer(batch.column(c).buffers()[1], np.int32)[batch.column(c).offset :][: batch.num_rows + 1]) > 0 for c in order_of]
            order = 1 + longer[0].astype(np.int64) + longer[1]
            place = np.arange(len(a))
            at = {k: np.maximum.accumulate(np.where(order == k, place, -1)) for k in (1, 2)}
            found = {}
            for k in (1, 2):
                counts = a[np.maximum(at[k], 0)]
                missing = at[k] < 0
                have = ~missing | (last[k] is not None)
                found[k] = pa.array(np.where(missing, last[k] or 0, counts), mask=~(have & (order > k)))
            extends = np.flatnonzero(order == 3)
            most = np.zeros(len(a), np.int64)
            owner = at[2][extends]
            np.maximum.at(most, owner[owner >= 0], a[extends[owner >= 0]])
            if known_pair and (owner < 0).any():
                widest = max(widest, int(a[extends[owner < 0]].max()))
            pairs = np.flatnonzero(order == 2)
            shorter = np.flatnonzero(order < 3)
            if held is not None and len(shorter):
                yield of_held()
                held = None
            keep = np.ones(len(a), dtype=bool)
            if len(pairs) and pairs[-1] == shorter[-1]:  # the last pair may go on in the next batch
                keep[pairs[-1]] = False
                held, widest = batch.slice(pairs[-1], 1), int(most[pairs[-1]])
                held_one = found[1][pairs[-1]].as_py()
            if len(shorter):
                known_pair = held is not None
            for k in (1, 2):
                if at[k][-1] >= 0:
                    last[k] = int(a[at[k][-1]])
            mask = pa.array(keep)
            yield out(batch, found[1], found[2], pa.array(most)).filter(mask)
        if held is not None:
            yield of_held()

    return work


def merged(phrases: DataFrame, keys: list[str], names: tuple[str, str, str]) -> DataFrame:
    """``phrases`` with the counts of their first word and first two words in the order of ``keys``, and of a pair's largest
    extension by a third, under the three ``names``. The words of a phrase lie in the columns ``keys``, empty ones last.
    """
    one, two, most = names
    order = ["lang", *keys]
    ordered = phrases.repartitionByRange(*order).sortWithinPartitions(*order)
    places = tuple(phrases.columns.index(k) for k in keys[1:])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in phrases.schema)
    out = stage(ordered.mapInArrow(_lockstep(places), f"{kinds}, one long, two long, most long"), "merged-phrases")
    # At the start of a partition, rows lack contexts of earlier partitions: those of one word and one pair at most.
    no_third, no_second = F.length(keys[2]) == 0, F.length(keys[1]) == 0
    lacks_one = out.where(~no_second & F.col("one").isNull()).select("lang", keys[0]).distinct()
    lacks_two = out.where(~no_third & F.col("two").isNull()).groupBy("lang", *keys[:2]).agg(F.max("a").alias("_most"))
    lacks_one, lacks_two = stage(lacks_one, "open-words"), stage(lacks_two, "open-pairs")
    singles = phrases.where(no_second).join(F.broadcast(lacks_one), ["lang", keys[0]]).select("lang", keys[0], F.col("a").alias("_one"))
    pairs = phrases.where(~no_second & no_third).join(F.broadcast(lacks_two), ["lang", *keys[:2]])
    pairs = pairs.select("lang", *keys[:2], F.col("a").alias("_two"), "_most")
    singles, pairs = stage(singles, "open-word-counts"), stage(pairs, "open-pair-counts")  # a row per partition at most
    full = out.join(F.broadcast(singles), ["lang", keys[0]], "left").join(F.broadcast(pairs), ["lang", *keys[:2]], "left")
    return full.select(
        *phrases.columns, F.coalesce("one", F.when(~no_second, F.col("_one"))).alias(one),
        F.coalesce("two", F.when(~no_third, F.col("_two"))).alias(two),
        F.when(~no_second & no_third, F.greatest("most", F.coalesce("_most", F.lit(0)))).alias(most),
    )


def _cut_score(left: str, right: str) -> str:
    """floor(1000000 * a * a / (left * right)) over decimals of 38 digits."""
    wide = "CAST({} AS DECIMAL(19, 0))".format
    return f"({wide('a')} * {wide('a')} * 1000000) DIV ({wide(left)} * {wide(right)})"


def collocations(docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two or three words of each language.

    a counts the phrase, l and r the two sides of its lowest-scoring cut, n all words of the language. Phrases that occur less
    than ``least`` times are left out, and pairs that lie in a triple with at least ``share`` percent of their count. A null
    text is empty, a null language is ``und``. Texts without words add nothing, an empty table gives no rows; repeated rows
    count each time; ties are ordered by count, then by the bytes of the phrase. Other columns of ``docs`` are not looked at.
    """
    phrases, totals = frequent_phrases(docs, least, text, lang)
    none = F.lit(b"")
    third, second = F.length("w3") > 0, F.length("w2") > 0
    # In suffix order the last word comes first.
    back = phrases.select(
        "lang", F.when(third, F.col("w3")).when(second, F.col("w2")).otherwise(F.col("w1")).alias("s1"),
        F.when(third, F.col("w2")).when(second, F.col("w1")).otherwise(none).alias("s2"),
        F.when(third, F.col("w1")).otherwise(none).alias("s3"), "a",
    )
    back = merged(back, ["s1", "s2", "s3"], ("last_one", "last_two", "left_most"))
    third, second = F.length("s3") > 0, F.length("s2") > 0
    forth = back.select(
        "lang", F.when(third, F.col("s3")).when(second, F.col("s2")).otherwise(F.col("s1")).alias("w1"),
        F.when(third, F.col("s2")).when(second, F.col("s1")).otherwise(none).alias("w2"),
        F.when(third, F.col("s1")).otherwise(none).alias("w3"), "a", "last_one", "last_two", "left_most",
    )
    forth = stage(forth, "suffix-counts")
    both = merged(forth, ["w1", "w2", "w3"], ("first_one", "first_two", "right_most"))
    both = both.where(F.length("w2") > 0)
    is_pair = F.length("w3") == 0
    # A pair whose largest extension has the share is inside a longer candidate.
    outside = ~is_pair | (100 * F.greatest("left_most", "right_most") < share * F.col("a"))
    scored = both.where(outside).select(
        "lang", F.concat_ws(" ", *[F.when(F.length(w) > 0, F.col(w).cast("string")) for w in ("w1", "w2", "w3")]).alias("phrase"), "a",
        F.when(is_pair, F.lit(None)).otherwise(F.col("first_two")).alias("l2"), F.col("last_one").alias("r2"), F.col("first_one").alias("l1"),
        F.when(is_pair, F.col("last_one")).otherwise(F.col("last_two")).alias("r1"),
    )
    scored = scored.withColumns({"score1": F.expr(_cut_score("l1", "r1")), "score2": F.expr(f"CASE WHEN l2 IS NOT NULL THEN {_cut_score('l2', 'r2')} END")})
    later = F.col("score2") < F.col("score1")
    scored = scored.select(
        "lang", "phrase", "a", F.when(later, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(later, F.col("r2")).otherwise(F.col("r1")).alias("r"), F.when(later, F.col("score2")).otherwise(F.col("score1")).alias("score"),
    )
    return _best(scored, totals, top)


def _best(scored: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language: of each part of it first, so that the last task ranks ``PARTS`` * ``top`` at most."""

    def first(rows: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase")
        return rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)

    parts = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    best = first(first(parts, "lang", "part").drop("rank", "part"), "lang")
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
