"""Operator 6: byte-level BPE encoding and decoding with padded numpy matrices.

Texts are cut into pieces as the vocabulary's split pattern does; the distinct
pieces of a chunk that are not yet known are laid out in padded matrices, one
per length bucket.  In every round each row merges its leftmost pair of minimum
rank; pairs are looked up in an open-addressing hash table held in numpy arrays,
and rows without a mergeable pair leave the matrix (compaction).  Pieces longer
than ``LONGEST_ROW`` bytes take the same merges with a heap, as a matrix would
need as many rounds as the piece has bytes.  Texts go through in parts of about
256 KB, cut where a piece always begins (``textnum.may_cut``); a longer stretch
without blanks, signs or digits is one part.

The vocabulary (a rank file) is read once by the driver and broadcast; its size
is bounded by the file, whatever the data.

Defined cases: a null text is encoded as the empty text (no ids); repeated rows
are encoded each; other columns are ignored, whatever their names; an empty table
gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarry.llm import textnum as tn

LONGEST_ROW = 256
ROWS_AT_ONCE = 1 << 14
CACHED_PIECES = 150_000
_NONE = np.iinfo(np.int32).max
_SPACES = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3


def read_ranks(data: bytes) -> list[bytes]:
    """Tokens by rank of a rank file (a base64 token and its rank in every line)."""
    tokens: dict[int, bytes] = {}
    for line in data.splitlines():
        if line:
            token, rank = line.split()
            tokens[int(rank)] = base64.b64decode(token)
    return [tokens[i] for i in range(len(tokens))]


def _classes() -> np.ndarray:
    kinds = np.full(0x110000, _OTHER, np.uint8)
    for cp in range(0x110000):
        first = unicodedata.category(chr(cp))[0]
        if first == "L":
            kinds[cp] = _LETTER
        elif first == "N":
            kinds[cp] = _NUMBER
    kinds[_SPACES] = _SPACE
    return kinds


class PairTable:
    """(left id, right id) -> id of the merged token, by open addressing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self._mask = np.uint64((1 << bits) - 1)
        self._keys = np.full(1 << bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self._values = np.full(1 << bits, _NONE, np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self._keys[slot[left]] == np.uint64(0xFFFFFFFFFFFFFFFF)
            cand = left[free]
            _, first = np.unique(slot[cand], return_index=True)
            put = cand[first]
            self._keys[slot[put]], self._values[slot[put]] = keys[put], values[put]
            done = np.zeros(len(keys), bool)
            done[put] = True
            left = left[~done[left]]
            slot[left] = (slot[left] + np.uint64(1)) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) & self._mask

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._slot(keys)
        seen = self._keys[slot]
        out = np.where(seen == keys, self._values[slot], _NONE)
        open_ = np.flatnonzero((seen != keys) & (seen != np.uint64(0xFFFFFFFFFFFFFFFF)))
        while len(open_):
            slot[open_] = (slot[open_] + np.uint64(1)) & self._mask
            seen = self._keys[slot[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = self._values[slot[open_[hit]]]
            open_ = open_[~hit & (seen != np.uint64(0xFFFFFFFFFFFFFFFF))]
        return out


class _Bytes:
    """Byte strings by number, in one buffer."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(t) for t in strings], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids, and the number of bytes of each id."""
        size = self.size[ids]
        return self.data[tn.ragged(self.start[ids], size)], size


class Codec:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.byte_id = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for i, t in enumerate(tokens):
            for cut in range(1, len(t)):
                a, b = self.rank.get(t[:cut]), self.rank.get(t[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(i)
        keys = (np.array(left, np.uint64) << np.uint64(32)) | np.array(right, np.uint64)
        self.pairs = PairTable(keys, np.array(merged, np.int32))
        self.decode = _Bytes(tokens).of
        self.kinds = _classes()
        self._reset()

    # -- splitting ---------------------------------------------------------------------------------------------

    def split(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte starts of all pieces (plus the end) and the row of each piece.

        The rules of the split pattern, on runs of letters, numbers, white space and
        others: of a white-space run before something else the last character is
        cut off, and a plain space there joins the next run; an apostrophe alone
        with s, t, m, d, re, ve or ll behind it is a piece with them.
        """
        lead = np.flatnonzero((buf & 0xC0) != 0x80)
        cps = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        n = len(cps)
        if n == 0:
            return np.zeros(1, np.int64), np.zeros(0, np.int64)
        kind = self.kinds[cps]
        row_start = np.zeros(n + 1, bool)
        row_start[np.searchsorted(lead, off)] = True
        begins = np.concatenate(([True], kind[1:] != kind[:-1])) | row_start[:n]
        starts = begins.copy()
        run = np.flatnonzero(begins)
        end = np.concatenate((run[1:], [n]))
        inner = ~row_start[end]                      # the next run is in the same row
        gap = (kind[run] == _SPACE) & inner
        last, nxt = end[gap] - 1, end[gap]
        starts[last] = True
        starts[nxt[cps[last] == 32]] = False
        quote = inner & (kind[run] == _OTHER) & (end - run == 1) & (cps[run] == 39)
        quote &= starts[run]
        at = end[quote]                              # the run after the quote
        at = at[kind[at] == _LETTER]
        first = cps[at]
        second = cps[np.minimum(at + 1, n - 1)]
        run_end = end[np.searchsorted(run, at)]
        two = (at + 1 < run_end) & (((first == ord("r")) & (second == ord("e"))) | ((first == ord("v")) & (second == ord("e")))
                                    | ((first == ord("l")) & (second == ord("l"))))
        one = np.isin(first, [ord(c) for c in "stmd"])
        size = np.where(one, 1, np.where(two, 2, 0))
        at, size, run_end = at[size > 0], size[size > 0], run_end[size > 0]
        starts[at] = False
        rest = at + size
        starts[rest[rest < run_end]] = True
        first_cp = np.flatnonzero(starts)
        byte_start = lead[first_cp]
        row = np.searchsorted(off, byte_start, side="right") - 1
        return np.concatenate((byte_start, [len(buf)])), row

    # -- merging -----------------------------------------------------------------------------------------------

    def merge_rows(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces that are no token themselves, by length bucket."""
        out: list[np.ndarray | None] = [None] * len(words)
        length = np.array([len(w) for w in words])
        low = 0
        width = 4
        while low < LONGEST_ROW:
            bucket = np.flatnonzero((length > low) & (length <= width))
            for at in range(0, len(bucket), ROWS_AT_ONCE):
                self._merge_matrix(words, bucket[at:at + ROWS_AT_ONCE], width, out)
            low, width = width, width * 2
        for i in np.flatnonzero(length > LONGEST_ROW):
            out[i] = self._merge_heap(words[i])
        return out

    def _merge_matrix(self, words: list[bytes], rows: np.ndarray, width: int, out: list) -> None:
        raw = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in rows), np.uint8).reshape(-1, width)
        size = np.array([len(words[i]) for i in rows])
        ids = self.byte_id[raw]
        while len(rows):
            valid = np.arange(1, ids.shape[1])[None, :] < size[:, None]
            rank = np.full(valid.shape, _NONE, np.int32)
            rank[valid] = self.pairs.find(ids[:, :-1][valid], ids[:, 1:][valid])
            if rank.shape[1]:
                at = rank.argmin(axis=1)
                best = rank[np.arange(len(rows)), at]
            else:
                at, best = np.zeros(len(rows), np.int64), np.full(len(rows), _NONE, np.int32)
            done = best == _NONE
            for k in np.flatnonzero(done):
                out[rows[k]] = ids[k, :size[k]].copy()
            keep = ~done
            rows, size, ids, at, best = rows[keep], size[keep] - 1, ids[keep], at[keep], best[keep]
            if not len(rows):
                return
            ids[np.arange(len(rows)), at] = best
            column = np.arange(ids.shape[1] - 1)[None, :]
            ids = np.take_along_axis(ids, column + (column > at[:, None]), axis=1)[:, :max(1, int(size.max()))]

    def _merge_heap(self, word: bytes) -> np.ndarray:
        ids = [int(i) for i in self.byte_id[np.frombuffer(word, np.uint8)]]
        n = len(ids)
        prev, nxt, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        first = self.pairs.find(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != _NONE]
        heapq.heapify(heap)

        def push(i: int) -> None:
            if i >= 0 and nxt[i] < n:
                merged = self.rank.get(self.tokens[ids[i]] + self.tokens[ids[nxt[i]]])
                if merged is not None:
                    heapq.heappush(heap, (merged, i, ids[i], ids[nxt[i]]))

        while heap:
            merged, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], nxt[i] = merged, False, nxt[j]
            if nxt[j] < n:
                prev[nxt[j]] = i
            push(prev[i])
            push(i)
        return np.array([x for x, a in zip(ids, alive) if a], np.int32)

    # -- texts -------------------------------------------------------------------------------------------------

    def _reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.first = np.zeros(1 << 14, np.int64)
        self.count = np.zeros(1 << 14, np.int64)

    def _learn(self, words: list[bytes]) -> None:
        whole = [self.rank.get(w) for w in words]
        todo = [i for i, r in enumerate(whole) if r is None]
        merged = self.merge_rows([words[i] for i in todo])
        ids: list = [None if r is None else (r,) for r in whole]
        for i, m in zip(todo, merged):
            ids[i] = m
        size = np.array([len(x) for x in ids], np.int64)
        have, total = len(self.known), int(size.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while have + len(words) > len(self.first):
            self.first, self.count = (np.concatenate((x, np.zeros_like(x))) for x in (self.first, self.count))
        self.flat[self.used:self.used + total] = np.concatenate([np.asarray(x, np.int32) for x in ids])
        self.first[have:have + len(words)] = self.used + np.cumsum(size) - size
        self.count[have:have + len(words)] = size
        self.used += total
        for k, w in enumerate(words):
            self.known[w] = have + k

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each."""
        rows = len(off) - 1
        bounds, row = self.split(buf, off)
        if not len(row):
            return np.zeros(0, np.int32), np.zeros(rows, np.int64)
        start, end = bounds[:-1], bounds[1:]
        _, sample, code = np.unique(tn.Hasher(buf)(start, end), return_index=True, return_inverse=True)
        like = sample[code]
        size = end - start
        same = (size == size[like]).all() and bool((buf == buf[tn.ragged(start[like], size)]).all())
        if not same:                                 # two pieces with one hash: every piece for itself
            code = np.arange(len(start))
            sample = code
        data = buf.tobytes()
        words = [data[a:b] for a, b in zip(start[sample].tolist(), end[sample].tolist())]
        if len(self.known) > CACHED_PIECES:
            self._reset()
        known = self.known
        fresh = list(dict.fromkeys(w for w in words if w not in known))
        if fresh:
            self._learn(fresh)
        at = np.array([known[w] for w in words], np.int64)[code]
        size = self.count[at]
        ids = self.flat[tn.ragged(self.first[at], size)]
        per_row = np.bincount(row, weights=size, minlength=rows).astype(np.int64)
        return ids, per_row


_codecs: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    """The codec of this worker process, built once for a vocabulary."""
    tokens = shared.value
    key = hash((len(tokens), tokens[-1]))
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(tokens)
    return _codecs[key]


def _decoder(shared) -> _Bytes:
    """Bytes of all ids: what decoding needs, without the encoder's tables."""
    return _Bytes(shared.value)


def load_vocabulary(spark: SparkSession, path: str):
    """Broadcast the tokens of the rank file at ``path`` (read by the driver)."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(read_ranks(f.read()))


def _encoded(codec: Codec, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ids, ids per row) of some rows at a time; a long text comes in parts, all but the last with no row."""
    buf, off = tn.text_buffers(column)
    for lo, hi in tn.pieces(off):
        if hi - lo > 1:
            yield lo, *codec.encode(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            continue
        parts = list(tn.sections(buf, int(off[lo]), int(off[hi])))
        for a, b in parts:
            ids, n = codec.encode(buf[a:b], np.array([0, b - a]))
            yield lo, ids, n if b == parts[-1][1] else n[:0]


def encode(df: DataFrame, vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) for every row; a null text has no ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for batch in tn.slices(batches, 1):
            held: list[np.ndarray] = []
            for lo, ids, per_row in _encoded(codec, batch.column(1)):
                held.append(ids)
                if len(per_row):
                    own = np.concatenate(held) if len(held) > 1 else ids
                    ends = np.concatenate(([0], np.cumsum(per_row))) if len(per_row) > 1 else np.array([0, len(own)])
                    held = []
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(lo, len(per_row)),
                         pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(own))], names=[id_col, "ids"])

    schema = T.StructType([df.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return df.select(id_col, text_col).mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with the bytes of ``ids_col`` in a further binary column ``to``."""
    kept = [c for c in df.columns if c != to]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _decoder(vocabulary)
        for batch in batches:
            column = batch.column(kept.index(ids_col)).cast(pa.large_list(pa.int32()))
            first = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
            lo = 0
            while lo < len(column):
                hi = max(lo + 1, int(np.searchsorted(first, first[lo] + (1 << 19), side="right")) - 1)
                ids = column.values.to_numpy(zero_copy_only=False)[first[lo]:first[hi]]
                data, size = tokens.of(ids)
                ends = np.concatenate(([0], np.cumsum(size)))[first[lo:hi + 1] - first[lo]]
                out = pa.Array.from_buffers(pa.large_binary(), hi - lo,
                                            [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data.tobytes())])
                yield pa.RecordBatch.from_arrays([*[c.slice(lo, hi - lo) for c in batch.columns], out.cast(pa.binary())],
                                                 names=[*kept, to])
                lo = hi

    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField(to, T.BinaryType())])
    return df.select(*kept).mapInArrow(run, schema)


class _Digests:
    """SHA-256 of the decimal ids and of the decoded bytes of one text, part by part."""

    def __init__(self):
        self.n, self.ids, self.decoded = 0, hashlib.sha256(), hashlib.sha256()

    def add(self, n: int, numbers: bytes, decoded: bytes) -> None:
        if n:
            if self.n:
                self.ids.update(b" ")
            self.ids.update(numbers[:-1])          # each number has a blank behind it
            self.decoded.update(decoded)
            self.n += n

    def row(self) -> tuple[int, str, str]:
        return self.n, self.ids.hexdigest(), self.decoded.hexdigest()


def token_digests(df: DataFrame, vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, decode the ids again and give digests of both.

    One task does it all, so there is one codec a core, and a long text needs no more memory than a part of it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        numbers = _Bytes([b"%d " % i for i in range(len(codec.tokens))])
        for batch in tn.slices(batches, 1):
            rows, held = [], _Digests()
            for _, ids, per_row in _encoded(codec, batch.column(1)):
                (named, sizes), (data, lengths) = numbers.of(ids), codec.decode(ids)
                cut = np.concatenate(([0], np.cumsum(per_row))) if len(per_row) else np.array([0, len(ids)])
                at_name, at_data = (np.concatenate(([0], np.cumsum(x)))[cut].tolist() for x in (sizes, lengths))
                named, data, cut = named.tobytes(), data.tobytes(), cut.tolist()
                for k in range(max(1, len(per_row))):
                    held.add(cut[k + 1] - cut[k], named[at_name[k]:at_name[k + 1]], data[at_data[k]:at_data[k + 1]])
                    if len(per_row):
                        rows.append(held.row())
                        held = _Digests()
            if rows:
                n, ids, decoded = zip(*rows)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)],
                                                 names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    text = T.StringType()
    schema = T.StructType([df.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", text),
                           T.StructField("decoded_sha256", text)])
    return df.select(id_col, text_col).mapInArrow(run, schema)
