"""Words, hashes and shingles of whole texts, over Arrow batches inside Spark tasks.

A word is a run of bytes other than space and 0x09-0x0D, after A-Z became a-z. Texts are cut into pieces
of about ``PIECE`` bytes at white space, so the work space does not grow with the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
# Any odd constants serve; these spread the bits of 64-bit hashes.
BASE = 0x9E3779B97F4A7C15
MIX_1 = 0xBF58476D1CE4E5B9
MIX_2 = 0x94D049BB133111EB


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_2)
    return x ^ (x >> np.uint64(31))


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null becomes empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``text`` in runs of about ``size`` bytes that end at white space."""
    start = 0
    while len(text) - start > size:
        cut = start + size
        ends = [i for i in (text.find(s, cut) for s in (b" ", b"\n", b"\t", b"\x0b", b"\x0c", b"\r")) if i >= 0]
        if not ends:
            break
        yield text[start : min(ends)]
        start = min(ends)
    yield text[start:]


#: Bytes of words, and bytes of tokens: letters, digits and all that is not ASCII.
IN_WORD = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])
IN_TOKEN = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def _hashes(joined: bytes, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of a joined run of lower-cased texts.

    The hash is a polynomial of the bytes modulo 2**64, read off running sums and then mixed.
    """
    data = np.frombuffer(joined, dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = in_word[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, np.zeros(0, dtype=np.uint64)
    powers = np.full(len(data), BASE, dtype=np.uint64)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers, out=sums[1:])
    inverse = np.full(len(data), pow(BASE, -1, 1 << 64), dtype=np.uint64)
    inverse[0] = 1
    np.cumprod(inverse, out=inverse)
    return starts, mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """As ``word_hashes``, over the tokens of the lower-cased texts."""
    return word_hashes([x.decode("utf-8", "replace").lower().encode() for x in texts], IN_TOKEN)


def word_hashes(texts: list[bytes], in_word: np.ndarray = IN_WORD) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of ``texts``, and where each text's words begin (one more than texts)."""
    counts = np.zeros(len(texts) + 1, dtype=np.int64)
    out: list[np.ndarray] = []
    run: list[bytes] = []
    owners: list[int] = []
    size = 0

    def flush() -> None:
        starts, hashes = _hashes(b" ".join(run).lower(), in_word)
        bounds = np.cumsum([0] + [len(x) + 1 for x in run[:-1]])
        of = np.searchsorted(bounds, starts, side="right") - 1
        np.add.at(counts, np.asarray(owners)[of] + 1, 1)
        out.append(hashes)

    for i, text in enumerate(texts):
        for piece in pieces(text) if len(text) > PIECE else (text,):
            run.append(piece)
            owners.append(i)
            size += len(piece)
            if size >= PIECE:
                flush()
                run, owners, size = [], [], 0
    if run:
        flush()
    return (np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)), np.cumsum(counts)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``k`` words; fewer words are one run; no word, no run."""
    n = min(k, len(words))
    if not n:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for j in range(n):
        total = total * np.uint64(BASE) + words[j : j + len(total)]
    return np.unique(mixed(total))


def groups_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal leading ``keys`` columns (integers), from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        if last is not None and first != last and held:
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-2], cuts[1:-1], strict=True):
            held.append(batch.slice(a, b - a))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cuts[-2], cuts[-1] - cuts[-2]))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)
