"""Byte-level BPE: encode whole texts to token ids, decode ids to bytes.

Each match of the split pattern is merged on its own. A segment tree over the byte
positions of the match holds, for every live position, the rank of the pair that
starts there; its root is the leftmost pair of lowest rank. A merge changes the pairs
of the live neighbours only: three point updates of logarithmic cost, so that a match
of many thousand bytes (a line of one repeated sign) stays cheap.

Short matches are merged in lockstep: the trees of many different matches are the rows of
one array, and a step takes the roots of all and does the three updates in all. Long ones
are merged one at a time, by the same tree. A task remembers the ids of short matches.

The rank table is a file of bounded size (a vocabulary, about 50,000 entries); it is
read by the driver and broadcast, so executors need no copy of the file.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanpanel.llm.common import small_batches

NO_PAIR = 1 << 62
#: Bits for the position in a tree entry; the rank stands above them.
POSITION_BITS = 31
#: Matches whose ids a task remembers.
REMEMBERED = 200_000
#: Bytes of the longest match that is merged in lockstep and remembered, matches merged in
#: one array, and matches of texts held at a time.
LOCKSTEP_BYTES, LOCKSTEP_ROWS, HELD = 64, 4096, 50_000
#: A text of more characters is split and encoded by and by.
LONG_TEXT = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of `base64 rank` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one match of the pattern."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    half = 1
    while half < n:
        half *= 2
    # tree[half + i]: rank of the pair that starts at byte i, then i; an inner entry is
    # the smaller of its two children, so tree[1] is the leftmost pair of lowest rank.
    tree = [NO_PAIR] * (2 * half)
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            tree[half + i] = rank << POSITION_BITS | i
    for node in range(half - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    ends = list(range(1, n + 1))  # of the token that starts at i, while i is live
    before = list(range(-1, n))  # start of the token before the one that starts at i

    def put(i: int, entry: int) -> None:
        node = half + i
        tree[node] = entry
        while node > 1:
            other = tree[node ^ 1]
            node >>= 1
            least = entry if entry < other else other
            if tree[node] == least:
                return
            tree[node] = entry = least

    def pair(i: int, j: int) -> int:
        """The entry of the tokens that start at i and j, neighbours."""
        rank = ranks.get(piece[i : ends[j]]) if j < n else None
        return NO_PAIR if rank is None else rank << POSITION_BITS | i

    while tree[1] != NO_PAIR:
        i = tree[1] & ((1 << POSITION_BITS) - 1)
        j = ends[i]
        ends[i] = k = ends[j]
        before[k] = i
        put(j, NO_PAIR)
        put(i, pair(i, k))
        if (h := before[i]) >= 0:
            put(h, pair(h, i))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return ids


class Vocabulary:
    """A rank table, with what two tokens merge to for every pair that does."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        # single bytes that are no tokens get ids beyond the table: they merge with nothing
        self.of_byte = np.array([ranks.get(bytes([b]), len(self.tokens) + b) for b in range(256)], np.int64)
        pairs = {
            (ranks[token[:i]] << 32 | ranks[token[i:]]): rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        self.pairs = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[p] for p in self.pairs.tolist()], np.int64)

    def merge_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it does not merge; a token -1 is none."""
        if not len(self.pairs):
            return np.full(len(left), -1)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (left >= 0) & (right >= 0), self.merged[at], -1)


def merge_in_lockstep(pieces: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """The packed ids of matches of 2 to LOCKSTEP_BYTES bytes. All bytes must be tokens."""
    longest = max(map(len, pieces))
    half = 1 << (longest - 1).bit_length()
    m, position = len(pieces), (1 << POSITION_BITS) - 1
    given = np.frombuffer(b"".join(p.ljust(half, b"\0") for p in pieces), np.uint8).reshape(m, half)
    lengths = np.fromiter(map(len, pieces), np.int64, m)
    # one column more, no token, for what comes after the last byte and before the first
    token = np.full((m, half + 1), -1)
    token[:, :half] = np.where(np.arange(half) < lengths[:, None], vocabulary.of_byte[given], -1)
    after = np.tile(np.arange(1, half + 2), (m, 1))
    before = np.tile(np.arange(-1, half), (m, 1))
    ranks = vocabulary.merge_ranks(token[:, :half].ravel(), token[:, 1:].ravel()).reshape(m, half)
    tree = np.full((m, 2 * half), NO_PAIR)
    tree[:, half:] = np.where(ranks >= 0, ranks << POSITION_BITS | np.arange(half), NO_PAIR)
    level = half
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2
    rows = np.arange(m)
    while True:
        root = tree[rows, 1]
        rows, root = rows[root != NO_PAIR], root[root != NO_PAIR]
        if not len(rows):
            break
        i, new = root & position, root >> POSITION_BITS
        j = after[rows, i]
        k = after[rows, j]
        h = before[rows, i]
        token[rows, i], token[rows, j] = new, -1
        after[rows, i], before[rows, k] = k, i
        left = vocabulary.merge_ranks(token[rows, h], new)
        right = vocabulary.merge_ranks(new, token[rows, k])
        # without a token before there is nothing to update there: i once more does no harm
        h = np.where(h < 0, i, h)
        tree[rows, half + h] = np.where(left >= 0, left << POSITION_BITS | h, NO_PAIR)
        tree[rows, half + i] = np.where(right >= 0, right << POSITION_BITS | i, NO_PAIR)
        tree[rows, half + j] = NO_PAIR
        nodes = [half + h, half + i, half + j]
        for _ in range(half.bit_length() - 1):
            nodes = [node >> 1 for node in nodes]
            for node in nodes:
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
    live = token >= 0
    packed = token[live].astype("<u4").tobytes()
    ends = 4 * np.cumsum(live.sum(1))
    return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def packed(ids: Iterable[int]) -> bytes:
    return np.fromiter(ids, "<u4").tobytes()


class Encoder:
    """Texts to packed ids. Remembers a bounded number of short matches."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern, self.known = vocabulary, regex.compile(pattern), {}
        self.every_byte = int(vocabulary.of_byte.max()) < len(vocabulary.tokens)

    def __call__(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        waiting: list[list[str]] = []
        held = 0
        for text in texts:
            text = text or ""
            if len(text) > LONG_TEXT:
                yield from self._encoded(waiting)
                waiting, held = [], 0
                matches = self.pattern.finditer(text)
                parts = iter(lambda: [m.group() for m in islice(matches, HELD)], [])
                yield b"".join(ids for part in parts for ids in self._encoded([part]))
                continue
            waiting.append(self.pattern.findall(text))
            held += len(waiting[-1])
            if held >= HELD:
                yield from self._encoded(waiting)
                waiting, held = [], 0
        yield from self._encoded(waiting)

    def _encoded(self, texts: list[list[str]]) -> list[bytes]:
        """The packed ids of some texts, given as their matches."""
        known = self.known
        if len(known) > REMEMBERED:  # the older half goes
            for piece in list(islice(known, len(known) // 2)):
                del known[piece]
        fresh = set().union(*texts).difference(known)
        long = self._learn(fresh)
        found = [b"".join(map(known.__getitem__, pieces)) for pieces in texts]
        for piece in long:
            del known[piece]
        return found

    def _learn(self, pieces: set[str]) -> list[str]:
        """Adds the pieces' ids to the known ones; gives those that are not to stay."""
        ranks, known, long = self.vocabulary.ranks, self.known, []
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8")
            if raw in ranks:
                known[piece] = ranks[raw].to_bytes(4, "little")
            elif len(raw) <= LOCKSTEP_BYTES and self.every_byte:
                by_size.setdefault((len(raw) - 1).bit_length(), []).append((piece, raw))
            else:
                known[piece] = packed(merge(raw, ranks))
                long.append(piece)
        for same in by_size.values():
            for part in (same[at : at + LOCKSTEP_ROWS] for at in range(0, len(same), LOCKSTEP_ROWS)):
                known.update(zip([p for p, _ in part], merge_in_lockstep([raw for _, raw in part], self.vocabulary)))
        return long


def decoded(ids: bytes, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, memoryview(ids).cast("I")))


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    keep_ids: bool = True,
    digests: bool = False,
    copies: str | None = None,
) -> DataFrame:
    """One row per row of `docs`: its key, n_tokens, and ids (packed little-endian
    unsigned 32-bit integers, the form in which training files hold them).

    `digests` adds ids_sha256 and decoded_sha256 (lowercase hex, of the packed ids and of the
    bytes that they decode to), made where the ids are, so that these need not be kept
    (`keep_ids`) to be checked.

    `copies` names a column of whole numbers: the row has its text's ids so many times, one
    after the other, and n_tokens and the digests are of all of them. The text is merged once.

    A null or empty text has no ids. Repeated rows give repeated rows; other columns of
    `docs` are not read, whatever their names. Special tokens are ordinary text.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(ranks))
    fields = [("n_tokens", T.LongType(), pa.int64())]
    fields += [("ids", T.BinaryType(), pa.binary())] if keep_ids else []
    fields += [(name, T.StringType(), pa.string()) for name in ("ids_sha256", "decoded_sha256")] if digests else []
    schema = T.StructType(
        [T.StructField("key", docs.schema[key].dataType), *(T.StructField(name, t) for name, t, _ in fields)]
    )

    def row(ids: bytes, tokens: list[bytes]) -> tuple:
        out = (len(ids) // 4, ids) if keep_ids else (len(ids) // 4,)
        if digests:
            out += (hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded(ids, tokens)).hexdigest())
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        encoder = Encoder(vocabulary, pattern)
        for batch in batches:
            # large texts in small pieces: a batch's ids stay far from 2 GB
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                times = part.column(2).to_pylist() if copies else repeat(1, part.num_rows)
                encoded = encoder(t.as_py() for t in part.column(1))
                rows = [row(ids * n, vocabulary.tokens) for ids, n in zip(encoded, times, strict=True)]
                arrays = [pa.array(list(c), t) for c, (_, _, t) in zip(zip(*rows, strict=True), fields, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], names=schema.names)

    given = [F.col(key).alias("key"), F.col(text).alias("text"), *([F.col(copies).alias("copies")] if copies else [])]
    rows = docs.select(*given).mapInArrow(run, schema)
    return rows.select(F.col("key").alias(key), *(name for name, _, _ in fields))


def decode(ids: Column, ranks: dict[bytes, int], spark) -> Column:
    """The bytes of packed ids; null stays null. An id outside the table is an error."""
    shared = spark.sparkContext.broadcast({rank: token for token, rank in ranks.items()})

    @F.arrow_udf(T.BinaryType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([None if x is None else decoded(x, shared.value) for x in batch.to_pylist()], pa.binary())

    return run(ids)
