"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Texts are split without a regular-expression engine.  Every code point gets a
class; two look-ahead facts (an apostrophe opens a contraction, a white-space
character is the last of its run) are folded into the class.  What remains is a
small automaton over classes.  A class is a function from state to state, and
function composition is associative, so the state before every character comes
from a blocked prefix scan over the automaton's transition monoid.

The slices feed pair merging through a bounded cache of slice -> packed ids.
``encode`` retains where each slice begins, in code points and in tokens, so
that ``decode_span`` can decode any stretch of a text without the rest.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from dayflow.llm.common import stretches

# Classes of characters.
LETTER, NUMBER, OTHER, JOINING_SPACE, GAP_START, GAP_MORE, SHORT, LONG = range(8)
# States: what the token so far is.  FRESH: the next character starts a token.
FRESH, LETTERS, NUMBERS, OTHERS, SPACED, TWO_LEFT, ONE_LEFT = range(7)
N_STATES, N_CLASSES = 7, 8

# White_Space code points of Unicode.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Contractions: an apostrophe and one of these.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

GROUP_CHARS = 1 << 20      # code points split at a time
CACHE_SLICES = 1 << 18     # cached slices per worker; the cache is emptied when full
CACHED_CHARS = 48          # longer slices are merged each time
SCAN_BLOCK = 256
DECODE_TOKENS = 1 << 18     # tokens decoded at a time
NO_PAIR = 1 << 40          # above every rank


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of every code point, before look-ahead (white space: GAP_START)."""
    of = {"L": LETTER, "N": NUMBER}
    cat = unicodedata.category
    table = np.array([of.get(cat(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    table[WHITE_SPACE] = GAP_START
    return table


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, starts a token) by state and class."""
    nxt = np.zeros((N_STATES, N_CLASSES), np.uint8)
    start = np.zeros((N_STATES, N_CLASSES), bool)
    same = {LETTER: LETTERS, NUMBER: NUMBERS, OTHER: OTHERS}
    for cls, run in same.items():
        nxt[:, cls] = run
        start[[s for s in (FRESH, LETTERS, NUMBERS, OTHERS) if s != run], cls] = True
    nxt[TWO_LEFT, LETTER], nxt[ONE_LEFT, LETTER] = ONE_LEFT, FRESH
    for cls, state in ((SHORT, ONE_LEFT), (LONG, TWO_LEFT)):
        nxt[:, cls] = state
        nxt[[OTHERS, SPACED], cls] = OTHERS      # inside a run it is an ordinary mark
        start[[FRESH, LETTERS, NUMBERS], cls] = True
    nxt[:, JOINING_SPACE] = SPACED
    start[:, [JOINING_SPACE, GAP_START]] = True
    return nxt, start


NEXT, STARTS = _automaton()


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transition monoid: element of each class, composition, value at FRESH."""
    maps = {tuple(range(N_STATES)): 0}
    gens = [tuple(NEXT[:, c].tolist()) for c in range(N_CLASSES)]
    queue = list(maps)
    while queue:
        f = queue.pop()
        for g in gens:
            h = tuple(g[x] for x in f)
            if h not in maps:
                maps[h] = len(maps)
                queue.append(h)
    elems = list(maps)
    compose = np.array([[maps[tuple(g[x] for x in f)] for g in elems] for f in elems], np.uint8)
    return (np.array([maps[g] for g in gens], np.uint8), compose,
            np.array([f[FRESH] for f in elems], np.uint8))


ELEMENT, COMPOSE, AT_FRESH = _monoid()
_FLAT, _M = COMPOSE.ravel(), len(COMPOSE)


def _then(f: np.ndarray, g: np.ndarray) -> np.ndarray:
    return _FLAT[f.astype(np.uint16) * _M + g]


def scan(elems: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition: blocks side by side, then their totals."""
    n = len(elems)
    if n <= SCAN_BLOCK:
        out = np.empty(n, np.uint8)
        acc = 0
        for i, e in enumerate(elems.tolist()):
            acc = out[i] = COMPOSE[acc, e]
        return out
    blocks = -(-n // SCAN_BLOCK)
    lanes = np.zeros(blocks * SCAN_BLOCK, np.uint8)
    lanes[:n] = elems
    lanes = np.ascontiguousarray(lanes.reshape(blocks, SCAN_BLOCK).T)
    for k in range(1, SCAN_BLOCK):
        lanes[k] = _then(lanes[k - 1], lanes[k])
    before = np.zeros(blocks, np.uint8)
    before[1:] = scan(lanes[-1])[:-1]
    return _then(np.broadcast_to(before, lanes.shape), lanes).T.ravel()[:n]


def token_starts(joined: str, joints: np.ndarray) -> np.ndarray:
    """Code-point offsets at which pre-tokens of newline-joined texts start.

    ``joints`` are the places of the joining newlines; each is a slice of its
    own and ends the text before it.
    """
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    cls = class_table()[cps]
    gap = cls == GAP_START
    next_gap = np.ones(len(gap), bool)
    next_gap[:-1] = gap[1:]
    gap[joints] = False                     # a text's first gap starts a run
    more = np.zeros(len(gap), bool)
    more[1:] = gap[:-1]
    gap_more = gap & more & next_gap
    cls[gap_more] = GAP_MORE
    cls[gap & ~next_gap & (cps == 0x20)] = JOINING_SPACE
    marks = np.flatnonzero(cps == 0x27)
    if len(marks):
        one = np.append(cps, [0, 0])[marks + 1]
        two = np.append(cps, [0, 0])[marks + 2]
        for c in ONE_LETTER:
            cls[marks[one == ord(c)]] = SHORT
        for a, b in TWO_LETTERS:
            cls[marks[(one == ord(a)) & (two == ord(b))]] = LONG
    state = np.zeros(len(cls), np.uint8)
    state[1:] = AT_FRESH[scan(ELEMENT[cls])[:-1]]
    return np.flatnonzero(STARTS.ravel()[state * N_CLASSES + cls])


class Codec:
    """A vocabulary, with a bounded cache of slice -> packed ids."""

    def __init__(self, rank_lines: bytes):
        self.ranks = {base64.b64decode(a): int(b)
                      for a, b in (x.split() for x in rank_lines.splitlines() if x.strip())}
        self.packed = {a: b.to_bytes(4, "little") for a, b in self.ranks.items()}
        self.cache: dict[str, bytes] = {}
        self.size = max(self.ranks.values()) + 1
        by_id: list[bytes] = [b""] * self.size
        for a, b in self.ranks.items():
            by_id[b] = a
        self.lengths = np.array([len(x) for x in by_id], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        # every pair of tokens whose bytes make a token, as one sorted key array
        pairs = {self.ranks[t[:i]] * self.size + self.ranks[t[i:]]: r
                 for t, r in self.ranks.items() for i in range(1, len(t))
                 if t[:i] in self.ranks and t[i:] in self.ranks}
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of token pairs; ``NO_PAIR`` where they do not merge."""
        if not len(self.pair_keys):
            return np.full(len(left), NO_PAIR)
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_PAIR)

    def merge_many(self, raws: list[bytes]) -> list[bytes]:
        """Packed ids of distinct slices: in each round every slice merges its
        lowest-ranked adjacent pair, the leftmost of equals; a rank is the id of
        the merged token."""
        size = np.array([len(r) for r in raws])
        token = self.byte_ids[np.frombuffer(b"".join(raws), np.uint8)]
        owner = np.repeat(np.arange(len(raws)), size)
        rank = np.full(len(token), NO_PAIR)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self.rank_of(token[inner], token[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(token):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank, first)
            width = np.diff(np.r_[first, len(token)])
            low = np.repeat(best, width)
            over = low == NO_PAIR
            if over.any():                   # slices without a pair left
                done.append((owner[over], token[over]))
                token, owner, rank, low = (x[~over] for x in (token, owner, rank, low))
                if not len(token):
                    break
            at = np.flatnonzero(rank == low)
            at = at[np.r_[True, owner[at][1:] != owner[at][:-1]]]
            token[at] = rank[at]
            keep = np.ones(len(token), bool)
            keep[at + 1] = False
            at -= np.arange(len(at))         # places after the removal
            token, owner, rank = token[keep], owner[keep], rank[keep]
            right = at[at + 1 < len(token)]
            same = owner[right] == owner[right + 1]
            rank[at] = NO_PAIR
            rank[right[same]] = self.rank_of(token[right[same]], token[right[same] + 1])
            left = at[at > 0]
            left = left[owner[left - 1] == owner[left]] - 1
            rank[left] = self.rank_of(token[left], token[left + 1])
        owner = np.concatenate([o for o, _ in done])
        token = np.concatenate([t for _, t in done])
        order = np.argsort(owner, kind="stable")
        packed = token[order].astype("<u4").tobytes()
        ends = (np.cumsum(np.bincount(owner, minlength=len(raws))) * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def merge_long(self, raw: bytes) -> bytes:
        """One long slice: a heap of pairs over a linked list of parts."""
        get, n = self.ranks.get, len(raw)
        end, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(raw[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or j >= n or end[j] != stop or end[i] != j:
                continue                    # one of the two has grown meanwhile
            end[i], right[i], alive[j] = stop, right[j], False
            if right[j] < n:
                left[right[j]] = i
                k = right[j]
                if (r := get(raw[i:end[k]])) is not None:
                    heapq.heappush(heap, (r, i, end[k]))
            if left[i] >= 0 and (r := get(raw[left[i]:stop])) is not None:
                heapq.heappush(heap, (r, left[i], stop))
        return b"".join([self.packed[raw[i:end[i]]] for i in range(n) if alive[i]])

    def pieces(self, slices: list[str]) -> list[bytes]:
        """Packed ids of each slice."""
        ids = list(map(self.cache.get, slices))
        missed = dict.fromkeys(s for s, i in zip(slices, ids) if i is None)
        if not missed:
            return ids
        todo = []
        for s in missed:
            raw = s.encode("utf-8", "replace")
            if raw in self.packed:
                missed[s] = self.packed[raw]
            elif len(s) > CACHED_CHARS:
                missed[s] = self.merge_long(raw)
            else:
                todo.append((s, raw))
        if todo:
            missed.update(zip([s for s, _ in todo], self.merge_many([r for _, r in todo])))
        short = {s: i for s, i in missed.items() if len(s) <= CACHED_CHARS}
        if len(self.cache) + len(short) > CACHE_SLICES:
            self.cache.clear()
        self.cache.update(short)
        return [missed[s] if i is None else i for s, i in zip(slices, ids)]

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes, bytes]]:
        """Per text: packed ids, and each slice's start in code points and in tokens."""
        joined = "\n".join(texts) + "\n"
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts = token_starts(joined, ends)
        at = starts.tolist()
        ids = self.pieces([joined[a:b] for a, b in zip(at, [*at[1:], len(joined)])])
        tokens = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) >> 2
        lo = 0
        out = []
        for begin, hi in zip([0, *(ends[:-1] + 1).tolist()], np.searchsorted(starts, ends).tolist()):
            before = tokens[lo - 1] if lo else 0
            out.append((b"".join(ids[lo:hi]), (starts[lo:hi] - begin).astype("<u4").tobytes(),
                        (np.concatenate([[0], tokens[lo:hi - 1] - before])[:hi - lo])
                        .astype("<u4").tobytes()))
            lo = hi + 1                      # past the joint
        return out

    def decode(self, packed: bytes) -> bytes:
        out = []
        for lo in range(0, len(packed), 4 * DECODE_TOKENS):
            ids = np.frombuffer(packed[lo:lo + 4 * DECODE_TOKENS], "<u4")
            size = self.lengths[ids]
            shift = self.offsets[ids] - (np.cumsum(size) - size)
            out.append(self.bytes[np.repeat(shift, size) + np.arange(int(size.sum()))].tobytes())
        return b"".join(out)


_CODECS: dict[bytes, Codec] = {}


def _codec(lines: bytes) -> Codec:
    """One codec per worker process."""
    if lines not in _CODECS:
        _CODECS.clear()
        _CODECS[lines] = Codec(lines)
    return _CODECS[lines]


def parts_of(text: str) -> Iterator[str]:
    """Cut a very long text where no token can cross: before a space after a non-gap."""
    lo = 0
    while len(text) - lo > GROUP_CHARS:
        cut = text.find(" ", lo + GROUP_CHARS)
        while cut > 0 and text[cut - 1].isspace():
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[lo:cut]
        lo = cut
    yield text[lo:]


def encode_all(codec: Codec, texts: list[str | None]) -> Iterator[tuple[bytes, bytes, bytes]]:
    """Encode texts in groups of about ``GROUP_CHARS`` code points, in order."""
    def run() -> Iterator[tuple[bytes, bytes, bytes]]:
        done = codec.encode([p for _, p in group])
        k = 0
        while k < len(group):
            row, stop = group[k][0], k + 1
            while stop < len(group) and group[stop][0] == row:
                stop += 1
            if stop == k + 1:
                yield done[k]
            else:                            # parts of one long text
                chars = tokens = 0
                ids, at, tok = [], [], []
                for (_, part), (a, b, c) in zip(group[k:stop], done[k:stop]):
                    ids.append(a)
                    at.append((np.frombuffer(b, "<u4") + chars).astype("<u4").tobytes())
                    tok.append((np.frombuffer(c, "<u4") + tokens).astype("<u4").tobytes())
                    chars, tokens = chars + len(part), tokens + len(a) // 4
                yield b"".join(ids), b"".join(at), b"".join(tok)
            k = stop

    group: list[tuple[int, str]] = []
    size = 0
    for row, text in enumerate(texts):
        text = text or ""
        if group and size + len(text) > GROUP_CHARS:
            yield from run()
            group, size = [], 0
        if len(text) > GROUP_CHARS:
            for part in parts_of(text):      # each part is split on its own
                group.append((row, part))
        else:
            group.append((row, text))
        size += len(text)
    if group:
        yield from run()


FIELDS = ("ids", "piece_chars", "piece_tokens", "decoded")


def load_ranks(path: str) -> bytes:
    """A rank file's bytes; its size is bounded by the vocabulary, not the data."""
    with open(path, "rb") as f:
        return f.read()


def encode(spark: SparkSession, text: Column, ranks_path: str, decoded: bool = False) -> Column:
    """Struct of packed little-endian uint32 arrays: ``ids``, and per slice its start
    in code points (``piece_chars``) and in tokens (``piece_tokens``).

    With ``decoded`` the same pass also decodes the ids (field ``decoded``, bytes).
    Null and empty texts give empty arrays.  The rank file is read once on the
    driver and broadcast (a vocabulary: under 2 MB).
    """
    shared = spark.sparkContext.broadcast(load_ranks(ranks_path))
    names = FIELDS if decoded else FIELDS[:3]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(shared.value)
        for texts in stretches(batches):
            rows = encode_all(codec, texts)
            if decoded:
                rows = ((*r, codec.decode(r[0])) for r in rows)
            columns = list(zip(*rows))
            yield pa.StructArray.from_arrays([pa.array(c, pa.binary()) for c in columns],
                                             list(names))

    return F.arrow_udf(run, f"struct<{','.join(f'{n}:binary' for n in names)}>")(text)


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("bigint")


def decode(spark: SparkSession, ids: Column, ranks_path: str) -> Column:
    """Bytes of packed ids (null stays null)."""
    shared = spark.sparkContext.broadcast(load_ranks(ranks_path))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(shared.value)
        for packed in stretches(batches):
            yield pa.array([None if x is None else codec.decode(x) for x in packed], pa.binary())

    return F.arrow_udf(run, "binary")(ids)


def decode_span(codec: Codec, encoded: tuple[bytes, bytes, bytes], begin: int,
                end: int) -> tuple[int, bytes]:
    """Decode only the slices that touch code points ``begin`` to ``end``.

    Returns the code point at which the first such slice starts, and the bytes.
    """
    ids, chars, tokens = encoded
    at, tok = np.frombuffer(chars, "<u4"), np.frombuffer(tokens, "<u4")
    if begin >= end or not len(at):
        return begin, b""
    lo = max(0, int(np.searchsorted(at, begin, "right")) - 1)
    hi = int(np.searchsorted(at, end, "left"))
    stop = int(tok[hi]) if hi < len(tok) else len(ids) // 4
    return int(at[lo]), codec.decode(ids[4 * int(tok[lo]):4 * stop])
