"""Operator 13: vector bin packing of tokenised examples into training sequences.

A sequence is a bin with three limits: tokens, segments (pieces) and tokens that
bear loss.  It is filled by the dot-product heuristic: of the examples that fit
in what is left, the one whose demands, as shares of the limits, have the largest
scalar product with the shares that are left comes next (ties: the earliest).
So a sequence with few segments left takes long examples, one with little loss
left takes examples of little loss.

With ``cut``, examples may be cut: whole sequences' worth is cut off long
examples at once, a sequence that no whole example fits any more is filled with a
part of the best one, and a sequence that can't be filled is cut back to a power of
two, where no padding is needed; what is cut off is an example again.

Tasks pack the rows of their partition in pools of at most POOL examples, in the
order in which they are read; nothing is shuffled, and what a pool can't use is carried to the
next.  A partition ends with at most as many short sequences as 2,048 has binary
digits.  Sequence ids come from the partition's number and a count, so rows that
are read again give the same ids; read from a table, not from a shuffle whose order may change.

Texts are tokenised in the same task: they are cut where the tokenizer's pattern
always begins a new piece (``textnum.may_cut``), and each distinct unit of a chunk is encoded once by the `tokenizers`
library.  Long texts go through in sections of about 1 MB, so only their ids are held
whole (a longer stretch without blanks, signs or digits is one section).

Defined cases: a null text is an empty text; an empty text has one id (the closing
one); null ids keep their pieces; repeated rows are packed each; examples without
tokens have no pieces; a null loss mask bears loss everywhere; without ``cut`` an
example beyond a limit is a sequence of its own; other columns are ignored,
whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import dataclasses
import itertools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import textnum as tn

CLOSING = 1
POOL = 1024
UNITS = 1_000_000     # distinct units whose ids a worker keeps (about 100 MB)
SECTION = 1 << 20


@dataclasses.dataclass(frozen=True)
class Limits:
    """What a sequence may hold."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


@dataclasses.dataclass
class Example:
    key: object
    ids: np.ndarray
    bears: np.ndarray | None       # tokens that bear loss; None: all
    start: int
    whole: int                     # tokens of the uncut example

    def __post_init__(self):
        self.loss = len(self.ids) if self.bears is None else int(self.bears.sum())

    def part(self, lo: int, hi: int) -> Example:
        return Example(self.key, self.ids[lo:hi].copy(), None if self.bears is None else self.bears[lo:hi].copy(),
                       self.start + lo, self.whole)

    def fits_up_to(self, tokens: int, loss: int) -> int:
        """How many of its first tokens fit."""
        n = min(tokens, len(self.ids))
        if self.bears is None:
            return min(n, loss)
        return min(n, int(np.searchsorted(np.cumsum(self.bears[:n]), loss, side="right")))


class Packer:
    """Packs examples as they come; ``closed`` sequences are lists of examples."""

    def __init__(self, limits: Limits, cut: bool, pool: int = POOL):
        if min(limits.tokens, limits.segments, limits.loss) < 1:
            raise ValueError("limits must be positive")
        self.limits, self.cut, self.pool = limits, cut, pool
        self.items: list[Example] = []
        self.closed: list[list[Example]] = []

    def add(self, item: Example) -> None:
        if not len(item.ids):
            return
        while self.cut and len(item.ids) > self.limits.tokens:
            n = item.fits_up_to(self.limits.tokens, self.limits.loss)
            if n < self.limits.tokens:             # a limit on loss: the pool mixes such examples with others
                n = max(1, n)
                self.items.append(item.part(0, n))
            else:
                self.closed.append([item.part(0, n)])
            item = item.part(n, len(item.ids))
        self.items.append(item)
        if len(self.items) >= self.pool:
            self.run(self.pool // 2)

    def run(self, leave: int) -> None:
        """Close sequences until at most ``leave`` examples are left."""
        cap = self.limits
        size = np.array([len(x.ids) for x in self.items], np.int64)
        loss = np.array([x.loss for x in self.items], np.int64)
        free = np.ones(len(self.items), bool)
        while free.sum() > leave:
            tokens, segments, bearing = cap.tokens, cap.segments, cap.loss
            held: list[Example] = []
            while tokens and segments and free.any():
                worth = (np.minimum(size, tokens) * (tokens / cap.tokens**2) + segments / cap.segments**2
                         + np.minimum(loss, bearing) * (bearing / cap.loss**2))
                fit = free & (size <= tokens) & (loss <= bearing)
                if fit.any():
                    k = int(np.where(fit, worth, -1).argmax())
                    n = int(size[k])
                elif self.cut:
                    k = int(np.where(free, worth, -1).argmax())
                    n = self.items[k].fits_up_to(tokens, bearing)
                elif not held:                     # beyond a limit by itself
                    k = int(np.flatnonzero(free)[0])
                    n = int(size[k])
                    segments = 1
                else:
                    break
                if n == 0:
                    break
                item = self.items[k]
                if n < size[k]:
                    held.append(item.part(0, n))
                    self.items[k] = item.part(n, len(item.ids))
                    size[k], loss[k] = size[k] - n, self.items[k].loss
                else:
                    held.append(item)
                    free[k] = False
                tokens, segments, bearing = max(0, tokens - n), segments - 1, max(0, bearing - held[-1].loss)
            back = self._to_power_of_two(held) if self.cut and tokens else []
            self.closed.append(held)
            if back:
                self.items += back
                size = np.concatenate((size, [len(x.ids) for x in back]))
                loss = np.concatenate((loss, [x.loss for x in back]))
                free = np.concatenate((free, np.ones(len(back), bool)))
        self.items = [x for x, f in zip(self.items, free) if f]

    @staticmethod
    def _to_power_of_two(held: list[Example]) -> list[Example]:
        """Cut a sequence back to a power of two; what is cut off."""
        total = sum(len(x.ids) for x in held)
        over, back = total - (1 << (total.bit_length() - 1)), []
        while over:
            last = held.pop()
            n = len(last.ids)
            if n > over:
                held.append(last.part(0, n - over))
                last = last.part(n - over, n)
            back.append(last)
            over -= len(last.ids)
        return back


class _Emitter:
    """Closed sequences as record batches."""

    def __init__(self, packer: Packer, id_type: pa.DataType, name: str, with_ids: bool):
        self.packer, self.id_type, self.name, self.with_ids, self.next = packer, id_type, name, with_ids, None

    def batch(self, part: int) -> pa.RecordBatch | None:
        if not self.packer.closed:
            return None
        self.next = part << 33 if self.next is None else self.next
        rows, ids = [], []
        for held in self.packer.closed:
            offset = 0
            for x in held:
                data = np.ascontiguousarray(x.ids, "<u4")
                rows.append((x.key, x.start, len(data), zlib.crc32(data.tobytes()), x.loss, x.whole, self.next, offset))
                ids.append(data)
                offset += len(data)
            self.next += 1
        self.packer.closed = []
        key, *numbers = zip(*rows)
        names = [self.name, "start", "length", "ids_crc32", "loss_tokens", "doc_tokens", "sequence_id", "offset"]
        columns = [pa.array(key, self.id_type), *[pa.array(n, pa.int64()) for n in numbers]]
        if self.with_ids:
            ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32))))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names=names)


def _schema(df: DataFrame, id_col: str, with_ids: bool) -> T.StructType:
    numbers = ("start", "length", "ids_crc32", "loss_tokens", "doc_tokens", "sequence_id", "offset")
    out = [T.StructField(id_col, df.schema[id_col].dataType), *[T.StructField(c, T.LongType()) for c in numbers]]
    return T.StructType([*out, T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else out)


def pack_examples(examples: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", loss_col: str | None = None,
                  limits: Limits = Limits(), cut: bool = True, pool: int = POOL, with_ids: bool = True) -> DataFrame:
    """Pieces of tokenised examples: id, start, length, ids_crc32, loss_tokens, doc_tokens, sequence_id, offset, ids.

    ``loss_col`` is an array as long as the ids, not zero where a token bears loss.
    """
    mask: Column = F.lit(None).cast("array<int>") if loss_col is None else F.col(f"`{loss_col}`").cast("array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, out, part = Packer(limits, cut, pool), None, 0
        for batch in batches:
            out = out or _Emitter(packer, batch.schema.types[1], id_col, with_ids)
            part = batch.column(0)[0].as_py() if batch.num_rows else part
            keys = batch.column(1).to_pylist()
            for key, ids, bears in zip(keys, batch.column(2), batch.column(3)):
                if ids.is_valid:
                    x = ids.values.to_numpy(zero_copy_only=False).astype(np.int32)
                    m = bears.values.fill_null(0).to_numpy(zero_copy_only=False) != 0 if bears.is_valid else None
                    packer.add(Example(key, x, m, 0, len(x)))
            done = out.batch(part)
            if done is not None:
                yield done
        packer.run(0)
        done = out.batch(part) if out else None
        if done is not None:
            yield done

    given = examples.select(F.spark_partition_id().alias("part"), F.col(f"`{id_col}`"), F.col(f"`{ids_col}`").cast("array<int>").alias("ids"),
                            mask.alias("bears"))
    return given.mapInArrow(run, _schema(examples, id_col, with_ids))


# -- texts -----------------------------------------------------------------------------------------------------------


def load_tokenizer(spark: SparkSession, path: str):
    """Broadcast the tokenizer file at ``path`` (read by the driver; its size bounds the broadcast)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


class _Grown:
    """An array that is appended to."""

    def __init__(self, kind):
        self.n, self.held = 0, np.zeros(1 << 14, kind)

    def add(self, values: np.ndarray) -> None:
        while self.n + len(values) > len(self.held):
            self.held = np.concatenate((self.held, np.zeros_like(self.held)))
        self.held[self.n:self.n + len(values)] = values
        self.n += len(values)

    @property
    def all(self) -> np.ndarray:
        return self.held[:self.n]


class Units:
    """Ids of texts by a `tokenizers` tokenizer, each distinct unit encoded once.

    Units are found by hash in two sorted tables (all, and the latest, which are merged
    now and then); their bytes are compared, so an equal hash decides nothing.
    """

    LATEST = 1 << 15

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"    # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self._forget()

    def _forget(self) -> None:
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.tables = [none, none]                 # sorted hashes and numbers of units: all, and the latest
        self.bytes, self.start, self.size = _Grown(np.uint8), _Grown(np.int64), _Grown(np.int64)
        self.ids, self.first, self.count = _Grown(np.int32), _Grown(np.int64), _Grown(np.int64)

    def _encode(self, units: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([u.decode("utf-8") for u in units], add_special_tokens=False)]

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the units with these hashes, -1 for new ones."""
        out = np.full(len(h), -1)
        for known, number in self.tables:
            if len(known):
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                hit = known[at] == h
                out[hit] = number[at[hit]]
        return out

    def _learn(self, units: list[bytes], h: np.ndarray) -> np.ndarray:
        """Take up units, given in the order of their hashes."""
        found = self._encode(units)
        count, size = (np.array([len(x) for x in xs], np.int64) for xs in (found, units))
        number = self.first.n + np.arange(len(units))
        self.first.add(self.ids.n + np.cumsum(count) - count)
        self.start.add(self.bytes.n + np.cumsum(size) - size)
        self.ids.add(np.fromiter(itertools.chain.from_iterable(found), np.int32, int(count.sum())))
        self.bytes.add(np.frombuffer(b"".join(units), np.uint8))
        self.count.add(count)
        self.size.add(size)
        self.tables[1] = self._merged(self.tables[1], (h, number))
        if len(self.tables[1][0]) > self.LATEST:
            self.tables = [self._merged(*self.tables), (h[:0], number[:0])]
        return number

    @staticmethod
    def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        h = np.concatenate((a[0], b[0]))
        order = np.argsort(h, kind="stable")
        return h[order], np.concatenate((a[1], b[1]))[order]

    def encode(self, buf: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        """Ids of all texts of a section, which have ``off[-1]`` bytes together."""
        rows = len(off) - 1
        start, row = tn.units(buf, off)
        if not len(start):
            return [np.zeros(0, np.int32)] * rows
        if self.first.n > UNITS:
            self._forget()
        end = np.append(start[1:], len(buf))
        h, sample, code = np.unique(tn.Hasher(buf)(start, end), return_index=True, return_inverse=True)
        at = self._find(h)
        new = np.flatnonzero(at < 0)
        if len(new):
            data = buf.tobytes()
            at[new] = self._learn([data[a:b] for a, b in zip(start[sample[new]].tolist(), end[sample[new]].tolist())], h[new])
        unit, size = at[code], end - start
        first, count = self.first.all[unit], self.count.all[unit]
        other = self._unlike(buf, start, size, unit)
        ids = self.ids.all[tn.ragged(first, count)]
        if len(other):                             # units with the hash of another one
            parts = np.split(ids, np.cumsum(count)[:-1])
            for k in other:
                parts[k] = np.array(self._encode([buf[start[k]:end[k]].tobytes()])[0], np.int32)
                count[k] = len(parts[k])
            ids = np.concatenate(parts)
        per_row = np.bincount(row, weights=count, minlength=rows).astype(np.int64)
        return np.split(ids, np.cumsum(per_row)[:-1])

    def _unlike(self, buf: np.ndarray, start: np.ndarray, size: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """Where the bytes are not those of the unit found."""
        fits = self.size.all[unit] == size
        length = np.where(fits, size, 0)
        same = buf[tn.ragged(start, length)] == self.bytes.all[tn.ragged(self.start.all[unit], length)]
        if fits.all() and same.all():
            return np.zeros(0, np.int64)
        wrong = np.bincount(np.repeat(np.arange(len(size)), length)[~same], minlength=len(size)) > 0
        return np.flatnonzero(wrong | ~fits)


_units: dict[int, Units] = {}


def _units_of(shared) -> Units:
    """The encoder of this worker process, built once for a tokenizer."""
    key = hash(shared.value)
    if key not in _units:
        _units.clear()
        _units[key] = Units(shared.value)
    return _units[key]


def text_ids(column: pa.Array, units: Units, closing: int | None = CLOSING) -> Iterator[np.ndarray]:
    """Ids of every text of a column, one after the other, each with the closing id."""
    end = np.array([] if closing is None else [closing], np.int32)
    buf, off = tn.text_buffers(column)
    for lo, hi in tn.pieces(off, SECTION):
        if hi - lo == 1:
            held = [units.encode(buf[a:b], np.array([0, b - a]))[0] for a, b in tn.sections(buf, int(off[lo]), int(off[hi]), SECTION)]
            yield np.concatenate([*held, end])
        else:
            for ids in units.encode(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]):
                yield np.concatenate((ids, end))


def tokenise(df: DataFrame, tokenizer, id_col: str = "doc_id", text_col: str = "text", closing: int | None = CLOSING) -> DataFrame:
    """(id, ids array<int>) for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _units_of(tokenizer)
        for batch in batches:
            ids = list(text_ids(batch.column(1), units, closing))
            if ids:
                ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))],
                    names=[id_col, "ids"])

    schema = T.StructType([df.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(run, schema)


def pack_texts(docs: DataFrame, tokenizer, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits(),
               closing: int = CLOSING, pool: int = POOL, with_ids: bool = True) -> DataFrame:
    """Pieces of all texts, tokenised and packed in one pass; every token bears loss. Columns as in :func:`pack_examples`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, out, part = Packer(limits, True, pool), None, 0
        units = _units_of(tokenizer)
        for batch in batches:
            out = out or _Emitter(packer, batch.schema.types[1], id_col, with_ids)
            part = batch.column(0)[0].as_py() if batch.num_rows else part
            keys = batch.column(1).to_pylist()
            for k, ids in enumerate(text_ids(batch.column(2), units, closing)):
                packer.add(Example(keys[k], ids, None, 0, len(ids)))
                if len(packer.closed) >= pool:
                    yield out.batch(part)
            done = out.batch(part)
            if done is not None:
                yield done
        packer.run(0)
        done = out.batch(part) if out else None
        if done is not None:
            yield done

    given = docs.select(F.spark_partition_id().alias("part"), F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("_text"))
    return given.mapInArrow(run, _schema(docs, id_col, with_ids))


def sequences(pieces: DataFrame, tokens: int = Limits.tokens) -> DataFrame:
    """(sequence_id, ids, lengths, padding): whole sequences from pieces with ids; each has at most ``tokens`` ids unless an example was longer."""
    held = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    n = F.aggregate("p", F.lit(0), lambda a, x: a + F.size(x["ids"]))
    free = F.when(n.bitwiseAND(n - 1) == 0, F.lit(0)).otherwise(F.greatest(F.lit(0), F.lit(tokens) - n))
    return held.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"),
                       F.transform("p", lambda x: F.size(x["ids"])).alias("lengths"), free.alias("padding"))
