"""Byte-level BPE encoding and decoding.

Pre-tokenisation uses no regular expression. Every code point becomes a symbol: its class
(letter, number, white space, other) refined by what follows it. Symbols are transition
functions of a small automaton; functions compose associatively, so a scan of composed
functions gives the state before every code point at once, and with it each boundary.
The resulting slices are looked up in a cache of merged pieces; new ones are merged
together, a round of lowest-ranked pairs at a time.

Encoded rows keep each token's byte offset, and decoding needs the ranks alone.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.llm.language import code_points
from souk.llm.text import Fingerprints, Texts, slices

CACHE_PIECES = 150_000
LONG_PIECE = 256
_DECODE_ROWS = 256
_NONE = np.int64(1 << 40)

# --- boundaries -----------------------------------------------------------------------------

# States, by what has been read of the current token.
_FRESH, _LETTERS, _NUMBERS, _OTHERS, _SPACES, _JOINING, _ONE_LEFT, _TWO_LEFT = range(8)
# Symbols; eight more are the same at the start of a text.
_L, _N, _O, _SHORT, _LONG, _W, _W_JOINS, _W_ENDS = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a token starts at the symbol."""
    if symbol >= 8:
        return _step(_FRESH, symbol - 8)[0], True
    if symbol == _L:
        if state in (_ONE_LEFT, _TWO_LEFT):  # the letters of a contraction
            return (_FRESH if state == _ONE_LEFT else _ONE_LEFT), False
        return _LETTERS, state not in (_LETTERS, _JOINING)
    if symbol == _N:
        return _NUMBERS, state not in (_NUMBERS, _JOINING)
    if symbol in (_O, _SHORT, _LONG):
        if state in (_OTHERS, _JOINING) or symbol == _O:
            return _OTHERS, state not in (_OTHERS, _JOINING)
        return (_ONE_LEFT if symbol == _SHORT else _TWO_LEFT), True
    if symbol == _W:
        return _SPACES, state != _SPACES
    return (_JOINING if symbol == _W_JOINS else _FRESH), True


@lru_cache(maxsize=1)
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all compositions of symbols: each symbol's, their products, their values; starts."""
    symbols = [tuple(_step(s, x)[0] for s in range(8)) for x in range(16)]
    known = {tuple(range(8)): 0}
    queue = [tuple(range(8))]
    for function in queue:
        for symbol in symbols:
            product = tuple(symbol[s] for s in function)
            if product not in known:
                known[product] = len(known)
                queue.append(product)
    products = np.array(
        [[known[tuple(g[s] for s in f)] for g in queue] for f in queue], np.uint16
    )
    starts = np.array([[_step(s, x)[1] for x in range(16)] for s in range(8)])
    return (np.array([known[s] for s in symbols], np.uint16), products,
            np.array(queue, np.uint8), starts)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Letter, number, other or white space by code point."""
    table = np.full(0x110000, _O, np.uint8)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        text = "".join(map(chr, range(low, high)))
        for pattern, symbol in ((r"\p{L}+", _L), (r"\p{N}+", _N), (r"\p{White_Space}+", _W)):
            for match in regex.finditer(pattern, text):
                table[low + match.start():low + match.end()] = symbol
    return table


def _symbols(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    kind = _classes()[points]
    count = len(points)
    bounds = bounds[bounds < count]
    # What follows, within the same text; white space where nothing does.
    after = np.full(count + 2, _W, np.uint8)
    after[:count] = kind
    ahead = np.zeros(count + 3, np.uint32)
    ahead[:count] = points
    next_kind = after[1:count + 1].copy()
    one, two = ahead[1:count + 1].copy(), ahead[2:count + 2].copy()
    lasts = bounds[bounds > 0] - 1
    next_kind[lasts], one[lasts], two[lasts] = _W, 0, 0
    two[lasts[lasts > 0] - 1] = 0
    last_space = (kind == _W) & (next_kind != _W)
    symbol = kind.copy()
    symbol[last_space] = np.where(points[last_space] == 0x20, _W_JOINS, _W_ENDS)
    quotes = np.flatnonzero(points == 0x27)
    first, second = one[quotes], two[quotes]
    short = np.isin(first, [ord(c) for c in "stmd"])
    long = np.zeros(len(quotes), bool)
    for a, b in ("re", "ve", "ll"):
        long |= (first == ord(a)) & (second == ord(b))
    symbol[quotes[short]], symbol[quotes[long]] = _SHORT, _LONG
    symbol[bounds] += 8
    return symbol


def token_starts(points: np.ndarray, bounds: np.ndarray, width: int = 512) -> np.ndarray:
    """Where pre-tokens start among the code points of texts with these bounds."""
    if not len(points):
        return np.zeros(0, np.int64)
    function, products, values, starts = _automaton()
    symbols = _symbols(points, bounds)
    rows = -(-len(symbols) // width)
    padded = np.zeros(rows * width, np.uint8)
    padded[:len(symbols)] = symbols
    # Columns first: a step of the scan takes one symbol of every row.
    steps = np.ascontiguousarray(padded.reshape(rows, width).T)
    scanned = np.empty((width, rows), np.uint16)
    scanned[0] = function[steps[0]]
    for k in range(1, width):
        scanned[k] = products[scanned[k - 1], function[steps[k]]]
    whole, reach = scanned[-1].copy(), 1
    while reach < rows:  # then of whole rows, doubling the reach
        whole[reach:] = products[whole[:-reach], whole[reach:]]
        reach *= 2
    entering = np.zeros(rows, np.uint8)
    entering[1:] = values[whole[:-1], _FRESH]
    before = np.empty((width, rows), np.uint8)
    before[0] = entering
    before[1:] = values[scanned[:-1], entering]
    return np.flatnonzero(starts[before, steps].T.reshape(-1)[:len(symbols)])


# --- merging ----------------------------------------------------------------------------------


class Ranks:
    """A vocabulary: token bytes by id, and the id that two adjacent tokens merge into."""

    def __init__(self, tokens: dict[bytes, int]):
        self.ids = tokens
        size = max(tokens.values()) + 1
        self.tokens = [b""] * size
        for token, number in tokens.items():
            self.tokens[number] = token
        pairs = [
            (tokens[token[:cut]] << 32 | tokens[token[cut:]], number)
            for token, number in tokens.items() for cut in range(1, len(token))
            if token[:cut] in tokens and token[cut:] in tokens
        ]
        pairs.sort()
        self.pairs = np.array([p for p, _ in pairs] or [-1], np.int64)
        self.merged = np.array([m for _, m in pairs] or [0], np.int64)
        self.bytes = np.array([tokens[bytes([b])] for b in range(256)], np.int64)
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        self._forget()

    def __reduce__(self):
        return Ranks, (self.ids,)

    @staticmethod
    def load(path: str) -> Ranks:
        """Ranks from a file of lines ``base64 token, rank``."""
        with open(path, "rb") as lines:
            return Ranks({
                base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))
            })

    def merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair merges into, which is also its rank, or _NONE."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.merged[at], _NONE)

    def _forget(self) -> None:
        """Empties the cache: a slot per piece, whose ids are a run of ``flat``."""
        self.slots: dict[bytes, int] = {}
        self.low = self.sizes = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def slots_of(self, pieces: list[bytes]) -> np.ndarray:
        """The cache slots of different pieces; new ones are merged together."""
        new = [p for p in pieces if p not in self.slots]
        if len(self.slots) + len(new) > CACHE_PIECES:
            self._forget()
            new = pieces
        if new:
            sizes, flat = self._merge(new)
            self.low = np.append(self.low, len(self.flat) + np.cumsum(sizes) - sizes)
            self.sizes = np.append(self.sizes, sizes)
            self.flat = np.append(self.flat, flat)
            self.slots.update(zip(new, range(len(self.slots), len(self.slots) + len(new))))
        return np.fromiter(map(self.slots.__getitem__, pieces), np.int64, len(pieces))

    def _merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Each piece's number of ids, and all ids in order."""
        whole = np.fromiter((self.ids.get(p, -1) for p in pieces), np.int64, len(pieces))
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        known = np.flatnonzero(whole >= 0)
        done = [(known, np.ones(len(known), np.int64), whole[known])]
        for i in np.flatnonzero((whole < 0) & (length > LONG_PIECE)).tolist():
            ids = self._merge_long(pieces[i])
            done.append((np.array([i]), np.array([len(ids)]), ids))
        short = np.flatnonzero((whole < 0) & (length <= LONG_PIECE))
        if len(short):
            data = b"".join([pieces[i] for i in short.tolist()])
            self._merge_short(np.frombuffer(data, np.uint8), length[short], short, done)
        number, sizes, ids = (np.concatenate(x) for x in zip(*done))
        low = np.cumsum(sizes) - sizes
        order = np.argsort(number)
        return sizes[order], ids[_runs(low[order], sizes[order])].astype(np.uint32)

    def _merge_short(self, data, sizes, number, done) -> None:
        """All pieces at once: each round merges the first lowest pair of every piece."""
        ids = self.bytes[data]
        ranks = np.full(len(ids), _NONE)
        ranks[:-1] = self.merge_of(ids[:-1], ids[1:])
        while True:
            ends = np.cumsum(sizes)
            ranks[ends - 1] = _NONE
            lowest = np.minimum.reduceat(ranks, ends - sizes)
            over = lowest == _NONE
            if over.any():
                left = ~np.repeat(over, sizes)
                done.append((number[over], sizes[over], ids[~left]))
                ids, ranks = ids[left], ranks[left]
                number, sizes, lowest = number[~over], sizes[~over], lowest[~over]
                if not len(number):
                    return
                ends = np.cumsum(sizes)
            hits = np.flatnonzero(ranks == np.repeat(lowest, sizes))
            owner = np.searchsorted(ends, hits, "right")
            first = hits[np.concatenate(([True], owner[1:] != owner[:-1]))]
            ids[first] = lowest
            left = np.ones(len(ids), bool)
            left[first + 1] = False
            moved = first - np.arange(len(first))  # a place is lost per earlier merge
            ids, ranks = ids[left], ranks[left]
            sizes = sizes - 1
            for at in (moved, moved - 1):
                at = at[(at >= 0) & (at + 1 < len(ids))]
                ranks[at] = self.merge_of(ids[at], ids[at + 1])
            # Pairs across pieces are wrong here; the next round's first lines mend them.

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """One long piece, by a heap of its pairs."""
        ids = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        after = list(range(1, len(ids))) + [-1]
        before = list(range(-1, len(ids) - 1))
        first = self.merge_of(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(rank, i) for i, rank in enumerate(first.tolist()) if rank != _NONE]
        heapq.heapify(heap)

        def merge(a: int, b: int) -> int:
            wanted = ids[a] << 32 | ids[b]
            at = int(np.searchsorted(self.pairs, wanted))
            found = at < len(self.pairs) and self.pairs[at] == wanted
            return int(self.merged[at]) if found else -1

        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or merge(i, j) != rank:
                continue  # one side has been merged since
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (new := merge(a, b)) >= 0:
                    heapq.heappush(heap, (new, a))
        return np.array([x for x in ids if x >= 0], np.uint32)

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, each token's byte offset, and the texts' bounds among them."""
        points, bounds = code_points(texts)
        firsts = np.flatnonzero((texts.data & 0xC0) != 0x80)  # a code point's first byte
        heads = firsts[token_starts(points, bounds)]
        ends = np.append(heads[1:], len(texts.data))[:len(heads)]
        names = Fingerprints(texts.data).of(heads, ends)
        ids, stops = self._looked_up(texts, heads, ends, names)
        if not np.array_equal(self.decode(ids), texts.data):  # two pieces, one fingerprint
            numbers: dict[bytes, int] = {}
            ids, stops = self._looked_up(texts, heads, ends, np.array([
                numbers.setdefault(texts.data[a:b].tobytes(), len(numbers))
                for a, b in zip(heads.tolist(), ends.tolist())]))
        lengths = self.lengths[ids]
        offsets = np.cumsum(lengths) - lengths
        counts = np.append(0, stops)[np.searchsorted(heads, texts.bounds)]
        return ids, offsets, counts

    def _looked_up(
        self, texts: Texts, heads: np.ndarray, ends: np.ndarray, names: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, those of one name looked up once, and where each piece's end."""
        _, where, which = np.unique(names, return_index=True, return_inverse=True)
        data = texts.data.tobytes()
        pieces = [data[a:b] for a, b in zip(heads[where].tolist(), ends[where].tolist())]
        slot = self.slots_of(pieces)[which] if pieces else np.zeros(0, np.int64)
        repeats = self.sizes[slot]
        return self.flat[_runs(self.low[slot], repeats)], np.cumsum(repeats)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ``ids``, end to end."""
        lengths = self.lengths[ids]
        return self.blob[_runs(self.ends[ids] - lengths, lengths)]


def _runs(low: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``low[0] .. low[0] + sizes[0] - 1, low[1] .., ...``"""
    stops = np.cumsum(sizes)
    total = int(stops[-1]) if len(stops) else 0
    return np.arange(total) + np.repeat(low - (stops - sizes), sizes)


# --- operators ----------------------------------------------------------------------------------


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_tokens, ids, offsets), one per row of ``docs``.

    ``path`` names the ranks. ``ids`` packs the tokens as little-endian unsigned 32-bit
    integers, ``offsets`` the byte of the text at which each starts. A NULL or empty text
    has none. Repeated rows each have theirs; other columns are ignored.
    """
    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    ranks = docs.sparkSession.sparkContext.broadcast(Ranks.load(path))
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        partial(_encode, ranks=ranks), f"id {kind}, n_tokens long, ids binary, offsets binary"
    ).withColumnRenamed("id", id_col)


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` of ``encode`` with their text's bytes as ``decoded`` in place of ``offsets``.

    NULL ids decode to no bytes; an id that the ranks lack fails.
    """
    kept = [n for n in rows.columns if n not in ("offsets", "decoded")]
    ranks = rows.sparkSession.sparkContext.broadcast(Ranks.load(path))
    schema = StructType([*rows.select(*kept).schema]).add("decoded", "binary")
    return rows.select(*kept).mapInArrow(partial(_decode, ranks=ranks), schema)


def digests(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows (id, n_tokens, ids_sha256, decoded_sha256) of ``decode``'s."""
    return rows.select(
        id_col, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _encode(batches: Iterator[pa.RecordBatch], ranks) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches, "text"):
        ids, offsets, bounds = ranks.value.encode(texts)
        starts = np.repeat(texts.bounds[:-1], np.diff(bounds))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(np.diff(bounds)),
             _packed(ids.astype("<u4"), bounds), _packed((offsets - starts).astype("<u4"), bounds)],
            ["id", "n_tokens", "ids", "offsets"],
        )


def _packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of 32-bit values as binary cells."""
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1,
        [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(values)],
    )


def _decode(batches: Iterator[pa.RecordBatch], ranks) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, _DECODE_ROWS):
            batch = whole.slice(start, _DECODE_ROWS)
            decoded = [
                ranks.value.decode(np.frombuffer(b or b"", "<u4")).tobytes()
                for b in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], [*batch.schema.names, "decoded"]
            )
