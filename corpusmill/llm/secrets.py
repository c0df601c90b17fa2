"""Secret scans: fixed patterns, and a character convolutional network over every candidate with its context.

A candidate is a run of 16 or more key characters, or a pattern's finding. The network is trained on labelled findings: windows
of the text around pattern findings, against windows around ordinary words and around candidates made of words. A longer candidate has
windows that overlap by half, and counts as its most probable one. All different windows are taken; a third of them
is kept from training, to calibrate the probability and to set a threshold that finds ``recall`` of the findings with the fewest
false alarms. Up to ``at_once`` windows are fitted at once; more are dealt to parts, whose networks are averaged after each round, and are
calibrated by sums and counts of all of them. All windows count twice, once
without their context, and long keys a third time behind other characters, as in a run that joins a path to a key. Candidates above it are added to the
pattern findings, which always stay.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.names import unused
from corpusmill.sources.staging import stage

KINDS = ("assign", "access", "hex", "network")
BEFORE, INSIDE, AFTER = 24, 48, 16  # characters of the window before, in and after a candidate
WIDTH = BEFORE + INSIDE + AFTER
AT_ONCE = 6000  # windows that one task learns from
ROUNDS = 6
HEAVIEST = 10.0  # weight of a rarer label's windows at most, where parts are averaged
RECALL = 0.95
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
WORD = re.compile(r"[^\W\d_]{4,15}")
# Parts of a candidate that is made of words: words in one case or joined by capitals, single letters, decimal numbers.
LIKE_WORD = re.compile(r"[A-Z]?[a-z]{2,20}(?:[A-Z][a-z]{2,20})*|[A-Za-z]|[A-Z]{2,15}|[0-9]+")
JOINS = re.compile(r"[+/_.=-]+")
# The text is matched after A-Z became a-z; lengths do not change.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the run before a match of 24 or more cannot hold hex digits, as matching goes on from it
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Character classes of the network: 0 is outside the text, then ASCII signs, then all others.
CLASSES = 97


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns in order; places in code points."""
    low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    found = []
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(low) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def window(text: str, start: int, end: int) -> bytes:
    """Classes of the characters around and in a span, then where the span lies; a long span is cut in the window only."""
    def classes(part: str) -> bytes:
        return bytes(ord(c) - 31 if 32 <= ord(c) < 127 else CLASSES - 1 for c in part)

    inside = classes(text[start : min(end, start + INSIDE)])
    before = classes(text[max(0, start - BEFORE) : start]).rjust(BEFORE, b"\0")
    return before + inside.ljust(INSIDE, b"\0") + classes(text[end : end + AFTER]).ljust(AFTER, b"\0")


def parts(start: int, end: int) -> list[tuple[int, int]]:
    """A span, or the half-overlapping runs of ``INSIDE`` characters that cover a longer one."""
    if end - start <= INSIDE:
        return [(start, end)]
    return [(s, s + INSIDE) for s in [*range(start, end - INSIDE, INSIDE // 2), end - INSIDE]]


def windows(text: str, start: int, end: int) -> list[bytes]:
    """A window for each of the parts of a span. What stands beside a part inside the span is not shown."""
    out = []
    for s, e in parts(start, end):
        own = window(text, s, e)
        own = own if s == start else bytes(BEFORE) + own[BEFORE:]
        out.append(own if e == end else own[: BEFORE + INSIDE] + bytes(AFTER))
    return out


def made_of_words(candidate: str) -> bool:
    return all(LIKE_WORD.fullmatch(p) for p in JOINS.split(candidate) if p)


def _hash(data: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "big", signed=True)


def _scan(text_column: int, added: list[str]) -> Callable:
    """Adds pattern findings, candidates outside them with their windows, and the training windows of each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                spans, others, judged, labels, shown = [], [], [], [], []
                for text in batch.column(text_column).to_pylist():
                    text = text or ""
                    found = pattern_spans(text)
                    spans.append([{"start": s, "kind": k, "end": e} for s, k, e in found])
                    free, kept, row_windows, plain = [], [], [], []
                    for m in CANDIDATE.finditer(text):
                        if not any(s < m.end() and m.start() < e for s, _, e in found):
                            free.append({"start": m.start(), "end": m.end()})
                            own = windows(text, m.start(), m.end())
                            row_windows += own
                            if made_of_words(m[0]):
                                plain += own
                    for s, k, e in found:
                        # The keyword itself is no part of the span, so that the network looks at the key.
                        inner = CANDIDATE.search(text, s, e) if k == 0 else None
                        kept += [(1, w) for w in windows(text, *(inner.span() if inner else (s, e)))]
                    kept += [(0, w) for w in plain]
                    if len(text) > 3:
                        word = WORD.search(text, _hash(text[:64].encode("utf-8", "surrogatepass")) % max(1, len(text) - 15))
                        if word and not any(s < word.end() and word.start() < e for s, _, e in found):
                            kept.append((0, window(text, word.start(), word.end())))
                    others.append(free)
                    judged.append(row_windows)
                    labels.append([label for label, _ in kept])
                    shown.append([w for _, w in kept])
                span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
                place = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(spans, span), pa.array(others, place), pa.array(judged, pa.list_(pa.binary())),
                     pa.array(labels, pa.list_(pa.int32())), pa.array(shown, pa.list_(pa.binary()))],
                    names=[*batch.schema.names, *added],
                )

    return work


class Network:
    """Embedding, one convolution with ReLU, the largest value of each filter, one output."""

    SIZE, REACH, FILTERS = 8, 5, 24

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        deep = self.SIZE + 1
        self.weights = [
            rng.normal(0, 0.3, (CLASSES, self.SIZE)), rng.normal(0, (2 / (deep * self.REACH)) ** 0.5, (self.REACH * deep, self.FILTERS)),
            np.zeros(self.FILTERS), rng.normal(0, 0.3, self.FILTERS), np.zeros(1),
        ]
        self.slope, self.shift = 1.0, 0.0
        self.inside = np.zeros(WIDTH)
        self.inside[BEFORE : BEFORE + INSIDE] = 1

    def _forward(self, codes: np.ndarray) -> tuple:
        letters, filters, bias, out, last = self.weights
        deep = np.concatenate([letters[codes], np.broadcast_to(self.inside[None, :, None], (*codes.shape, 1))], axis=2)
        runs = np.lib.stride_tricks.sliding_window_view(deep, self.REACH, axis=1)
        runs = runs.transpose(0, 1, 3, 2).reshape(len(codes), WIDTH - self.REACH + 1, -1)
        hidden = np.maximum(runs @ filters + bias, 0)
        return runs, hidden, hidden.max(axis=1) @ out + last[0]

    def logits(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0), *[self._forward(codes[i : i + 256])[2] for i in range(0, len(codes), 256)]])

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(codes) + self.shift, -30, 30)))

    def train(
        self, codes: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, step: float = 0.01, seed: int = 7, weights: np.ndarray | None = None
    ) -> None:
        rng = np.random.default_rng(seed)
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        turn = 0
        for _ in range(rounds):
            for part in np.array_split(rng.permutation(len(codes)), max(1, len(codes) // 64)):
                turn += 1
                grads = self._gradients(codes[part], labels[part], 1.0 if weights is None else weights[part])
                for w, g, m, v in zip(self.weights, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= step * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)

    def _gradients(self, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray | float = 1.0) -> list[np.ndarray]:
        letters, filters, _, out, _ = self.weights
        runs, hidden, logit = self._forward(codes)
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) * weights / len(codes)
        place = hidden.argmax(axis=1)
        top = np.take_along_axis(hidden, place[:, None, :], axis=1)[:, 0, :]
        back = np.where(top > 0, error[:, None] * out, 0)
        chosen = runs[np.arange(len(codes))[:, None], place]
        by_filter = np.einsum("nfd,nf->df", chosen, back)
        spread = (back[:, :, None] * filters.T[None]).reshape(*place.shape, self.REACH, self.SIZE + 1)[..., : self.SIZE]
        at = place[:, :, None] + np.arange(self.REACH)
        by_letter = np.zeros_like(letters)
        np.add.at(by_letter, codes[np.arange(len(codes))[:, None, None], at], spread)
        return [by_letter, by_filter, back.sum(0), top.T @ error, np.array([error.sum()])]

    def calibrate(self, codes: np.ndarray, labels: np.ndarray, recall: float) -> float:
        """Fit slope and shift on held-out windows; a threshold with that recall on them and no more false alarms than need be.

        It lies halfway between the highest threshold with that recall and the next other window below it, or at 0.5 where the
        half lies lower; but never over the highest threshold with that recall.
        """
        x = self.logits(codes)
        slope, shift = 1.0, 0.0
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(slope * x + shift, -30, 30)))
            error = p - labels
            slope -= 0.1 * ((error * x).mean() + 1e-3 * (slope - 1))
            shift -= 0.1 * error.mean()
        self.slope, self.shift = float(max(slope, 1e-3)), float(shift)
        chance = self.probability(codes)
        right = np.sort(chance[labels == 1])
        highest = right[int((1 - recall) * len(right))]
        below = chance[(labels == 0) & (chance < highest)]
        return float(min(max((highest + below.max(initial=0)) / 2, 0.5), highest))


def _codes(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), dtype=np.uint8).reshape(-1, WIDTH)


def fit(
    scanned: DataFrame, labels: str, windows: str, recall: float = RECALL, at_once: int = AT_ONCE
) -> tuple[Network, float] | None:
    """Network and threshold from the columns of labels and windows; None when one of the labels has under 6 windows."""
    rows = scanned.select(F.explode(F.arrays_zip(labels, windows)).alias("x"))
    rows = stage(rows.select(F.col("x")[labels].alias("label"), F.col("x")[windows].alias("window")).distinct(), "windows")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # two labels
    if min(counts.get(k, 0) for k in (0, 1)) < 6:
        return None
    if sum(counts.values()) > at_once:
        return _learned_in_parts(rows, counts, recall, at_once)
    found = rows.withColumn("h", F.xxhash64("window")).orderBy("h", "window").collect()  # at most ``at_once``
    return learned(*[[bytes(r["window"]) for r in found if r["label"] == k] for k in (1, 0)], recall)


def _learned_in_parts(rows: DataFrame, counts: dict[int, int], recall: float, at_once: int) -> tuple[Network, float]:
    """Rounds over parts of all windows, each from the mean of the networks of the round before."""
    total = sum(counts.values())
    n = -(-total // at_once)
    weight = np.array([min(HEAVIEST, max(1.0, counts[1 - k] / counts[k])) for k in (0, 1)])
    held = lambda salt: F.pmod(F.xxhash64("window", F.lit(salt)), F.lit(3)) == 0
    sides = rows.agg(*[F.count_if(held(s) & (F.col("label") == 1)) for s in range(16)]).first()
    salt = next(s for s in range(16) if 0 < sides[s] < counts[1])  # findings on both sides, however few there are
    dealt = rows.select("label", "window", held(salt).alias("held"), F.pmod(F.xxhash64("window"), F.lit(n)).cast("long").alias("part"))
    dealt = stage(dealt.repartition(n, "part"), "dealt-windows").repartition(n, "part").groupBy("part")

    def trained(weights: list[np.ndarray], turn: int) -> Callable:
        def work(table: pa.Table) -> pa.Table:
            codes, labels, kept, part = _varied(table)
            network = Network()
            network.weights = [w.copy() for w in weights]
            codes, labels = codes[~kept], labels[~kept]
            if len(codes):
                network.train(codes, labels, 1, 0.01 / 2 ** (turn // 2), 7 + turn * n + part, weight[labels.astype(int)])
            return pa.table({"n": [len(codes)], "weights": pa.array([b"".join(w.tobytes() for w in network.weights)], pa.binary())})

        return work

    network = Network()
    for turn in range(ROUNDS):
        found = dealt.applyInArrow(trained(network.weights, turn), "n long, weights binary").collect()  # a network per part
        shares = np.array([r["n"] for r in found], float) / sum(r["n"] for r in found)
        mean = shares @ np.stack([np.frombuffer(r["weights"]) for r in found])
        bounds = np.cumsum([w.size for w in network.weights])[:-1]
        network.weights = [m.reshape(w.shape) for m, w in zip(np.split(mean, bounds), network.weights, strict=True)]

    def logits(table: pa.Table) -> pa.Table:
        codes, labels, kept, _ = _varied(table)
        return pa.table({"label": pa.array(labels[kept].astype(np.int32)), "x": pa.array(network.logits(codes[kept]))})

    return network, _calibrated(network, stage(dealt.applyInArrow(logits, "label int, x double"), "held-out"), recall)


def _varied(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Codes, labels and whether they are held out, of a part's windows and their variants; the part's number."""
    found = sorted(zip(*[table.column(c).to_pylist() for c in ("label", "window", "held")], strict=True), reverse=True)
    labels, held = np.array([float(r[0]) for r in found]), np.array([r[2] for r in found])
    codes, labels, held = _variants(_codes([r[1] for r in found]), labels, held)
    return codes, labels, held, table.column("part")[0].as_py()


def _calibrated(network: Network, held: DataFrame, recall: float) -> float:
    """``Network.calibrate`` over a table (label, x) of held-out logits, from sums and counts."""
    x, y = F.col("x"), F.col("label")
    slope, shift = 1.0, 0.0
    for _ in range(12):
        p = 1 / (1 + F.exp(-F.least(F.greatest(x * slope + shift, F.lit(-30.0)), F.lit(30.0))))
        e, v = p - y, p * (1 - p)
        ex, e1, vxx, vx, v1 = held.agg(F.avg(e * x), F.avg(e), F.avg(v * x * x), F.avg(v * x), F.avg(v)).first()
        move = np.linalg.solve([[vxx + 1e-3, vx], [vx, v1 + 1e-6]], [ex + 1e-3 * (slope - 1), e1])
        move *= min(1.0, 2.0 / max(np.abs(move).max(), 1e-300))
        slope, shift = float(max(slope - move[0], 1e-3)), float(shift - move[1])
    network.slope, network.shift = slope, shift
    right = held.where("label = 1")
    low, high, rank = *right.agg(F.min("x"), F.max("x")).first(), int((1 - recall) * right.count())
    for _ in range(4):  # the place of that rank among 4,096 parts of a range, and again
        width = (high - low) / 4096
        if width <= 0 or low + width == low:
            break
        cell = F.least(F.floor((x - low) / width), F.lit(4095))
        cells = sorted((r["c"], r["n"]) for r in right.where((x >= low) & (x <= high)).groupBy(cell.alias("c")).agg(F.count("*").alias("n")).collect())
        before = right.where(x < low).count()
        for c, n in cells:
            if before + n > rank:
                low, high = low + c * width, min(high, low + (c + 1) * width)
                break
            before += n
    highest = right.where(x >= low).agg(F.min("x")).first()[0]
    below = held.where((y == 0) & (x < highest)).agg(F.max("x")).first()[0]
    chance = lambda v: 0.0 if v is None else 1 / (1 + np.exp(-np.clip(slope * v + shift, -30, 30)))
    return float(min(max((chance(highest) + chance(below)) / 2, 0.5), chance(highest)))


def _behind_words(keys: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Each key moved to the right, as a window shows it that begins before the key; zeros for keys under half the width."""
    rng = np.random.default_rng(7)
    out = np.zeros_like(keys)
    if not len(others):
        return out
    for row, key, other in zip(out, keys, others[rng.integers(0, len(others), len(keys))], strict=True):
        inside, front = key[BEFORE : BEFORE + INSIDE], other[other > 0]
        n = int(rng.integers(1, INSIDE // 2 + 1))
        if np.count_nonzero(inside) >= INSIDE // 2 and len(front):
            row[BEFORE : BEFORE + n] = np.resize(front, n)
            row[BEFORE + n : BEFORE + INSIDE] = inside[: INSIDE - n]
    return out


def _variants(codes: np.ndarray, labels: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows and their variants, which are held out as their windows are."""
    # Each window a second time without what stands around it, so that the network also learns how a key itself looks.
    alone = codes.copy()
    alone[:, :BEFORE] = alone[:, BEFORE + INSIDE :] = 0
    behind = _behind_words(alone[labels == 1], alone[labels == 0])
    long = behind.any(axis=1)
    codes = np.concatenate([codes, alone, behind[long]])
    held = np.concatenate([held, held, held[labels == 1][long]])
    labels = np.concatenate([labels, labels, np.ones(long.sum())])
    return codes, labels, held


def learned(findings: list[bytes], others: list[bytes], recall: float = RECALL) -> tuple[Network, float]:
    """Network and threshold from the windows of either label; every third window calibrates."""
    codes = _codes([*findings, *others])
    labels = np.repeat([1.0, 0.0], [len(findings), len(others)])
    held = np.concatenate([np.arange(len(findings)) % 3 == 0, np.arange(len(others)) % 3 == 0])
    codes, labels, held = _variants(codes, labels, held)
    network = Network()
    network.train(codes[~held], labels[~held])
    return network, network.calibrate(codes[held], labels[held], recall)


def _judge(model: tuple | None, columns: list[str]) -> Callable:
    """The last three columns, what the patterns found, and the places and windows of candidates, become the secrets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, places, windows = (c.to_pylist() for c in batch.columns[-3:])
            flat = [w for row in windows for w in row]
            chance = model[0].probability(_codes(flat)) if model and flat else np.zeros(len(flat))
            at, spans = 0, []
            for own, free in zip(found, places, strict=True):
                mine = [{**s, "score": 1.0} for s in own]
                for place in free:
                    n = len(parts(place["start"], place["end"]))
                    most = chance[at : at + n].max()
                    if model and most >= model[1]:
                        mine.append({"start": place["start"], "kind": 3, "end": place["end"], "score": float(most)})
                    at += n
                spans.append(sorted(mine, key=lambda s: (s["start"], s["kind"], s["end"])))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], pa.array(spans, kind)], names=[*columns, "secrets"]
            )

    return work


def find(docs: DataFrame, text: str = "text", recall: float = RECALL, at_once: int = AT_ONCE) -> DataFrame:
    """The columns of ``docs`` and secrets, an array of (start, kind, end, score), by start and kind.

    ``kind`` is a place in ``KINDS``; places are code points, the end exclusive. A null or empty text has no secrets. Without enough
    findings to train on, only the patterns' findings are told. Repeated rows get equal spans, an empty table stays empty, and
    a column ``secrets`` of ``docs`` is replaced. The network looks at free runs of 16 key characters or more.
    """
    docs = docs.drop("secrets")
    added = unused([*docs.columns, "secrets"], "found", "places", "windows", "labels", "shown")
    kinds = ("array<struct<start:int,kind:int,end:int>>", "array<struct<start:int,end:int>>", "array<binary>", "array<int>", "array<binary>")
    fields = [T.StructField(n, T._parse_datatype_string(k)) for n, k in zip(added, kinds, strict=True)]
    schema = T.StructType([*docs.schema.fields, *fields])
    scanned = stage(docs.mapInArrow(_scan(docs.columns.index(text), added), schema), "scanned")
    model = fit(scanned, *added[3:], recall, at_once)
    out = T.StructField("secrets", T._parse_datatype_string("array<struct<start:int,kind:int,end:int,score:double>>"))
    kept = scanned.select(*[F.col(f"`{c}`") for c in docs.columns], *added[:3])
    return kept.mapInArrow(_judge(model, docs.columns), T.StructType([*docs.schema.fields, out]))



def redacted(found: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``text`` with each run of overlapping secrets replaced by a mark; the column of secrets goes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, spans in zip(batch.column(text).to_pylist(), batch.column("secrets").to_pylist(), strict=True):
                if value is None or not spans:
                    out.append(value)
                    continue
                parts, at, end = [], 0, -1
                for s in spans:
                    if s["start"] >= end:
                        parts += [value[at : s["start"]], mark]
                    at = end = max(end, s["end"])
                out.append("".join([*parts, value[at:]]))
            columns = [pa.array(out, pa.string()) if n == text else batch.column(n) for n in batch.schema.names if n != "secrets"]
            yield pa.RecordBatch.from_arrays(columns, names=[n for n in batch.schema.names if n != "secrets"])

    schema = T.StructType([f for f in found.schema.fields if f.name != "secrets"])
    return found.mapInArrow(work, schema)
