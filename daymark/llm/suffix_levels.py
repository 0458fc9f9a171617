"""Removal of repeated byte strings with a logarithmic family of suffix arrays.

The index holds sparse suffix arrays: of every window of ``LENGTH`` bytes the suffix at its
least seed (by seed hash, leftmost on ties) is kept, so equal windows always keep suffixes that
stand at the same place in them. Only equality of long beginnings matters here, hence suffixes
are ordered by the hash of their seed and then by the hash of the stretch that they stand for,
not by their letters. A new batch gets such an array as a level of rank 0; two levels of equal
rank are merged into one of the next rank, so n batches leave at most log2(n) + 1 levels. A
batch is not scanned against the levels when it is added: matches are found once, at the end, by
grouping the suffixes of all levels by their hashes and joining the texts with what is repeated.
Stretches that are equal as a whole need no more; where only a part of a stretch is repeated,
its bytes are compared window by window.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .store import written

LENGTH = 200
SEED = 32
#: Positions fit in the low bits of a sort key; longer rows are cut into overlapping pieces.
PLACE_BITS = 22
#: Above this many different stretches around one seed, windows are compared by Spark.
CROWD = 20_000

ENTRIES = "h long, sig long, doc_id long, k long, n long, at long, run int, d int"


def _runs(data: np.ndarray, starts: np.ndarray, length: int, seed: int):
    """Runs of windows with one seed: first window, count, place of the seed, seed hash, stretch hash."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    total = K.running(data)
    down = K.powers("down", len(data) - seed + 1)
    seeds = K.mix((total[seed:] - total[:-seed]) * down)
    low = np.uint64((1 << PLACE_BITS) - 1)
    keys = (seeds & ~low) | np.arange(len(seeds), dtype=np.uint64)
    wide = length - seed + 1
    blocks = -(-len(keys) // wide)
    padded = np.full(blocks * wide, np.uint64(2**64 - 1))
    padded[: len(keys)] = keys
    grid = padded.reshape(blocks, wide)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(data) - length + 1
    least = np.minimum(backward[:count], forward[wide - 1 : wide - 1 + count])
    step = np.zeros(len(data) + 2, np.int32)
    long_enough = np.diff(starts) >= length
    np.add.at(step, starts[:-1][long_enough], 1)
    np.add.at(step, starts[1:][long_enough] - length + 1, -1)
    valid = np.flatnonzero(np.cumsum(step)[:count] > 0)
    if not len(valid):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    place = (least[valid] & low).astype(np.int64)
    new = np.ones(len(valid) + 1, bool)
    new[1:-1] = (place[1:] != place[:-1]) | (np.diff(valid) != 1)
    edges = np.flatnonzero(new)
    first, run = valid[edges[:-1]], np.diff(edges)
    place = place[edges[:-1]]
    stretch = K.span(total, first, first + run - 1 + length)
    stretch = K.mix(stretch + (place - first).astype(np.uint64) * K.WORD_VALUES[0] + run.astype(np.uint64) * K.WORD_VALUES[1])
    return first, run, place, seeds[place], stretch


def _pieces(texts, length):
    """Slices in which every row fits; rows above the place limit come in overlapping pieces."""
    most = 1 << PLACE_BITS
    for first, last, data, starts in K.text_slices(texts, most >> 1):
        if len(data) <= most:
            yield first, last, data, starts, 0
        else:
            for at in range(0, len(data) - length + 1, most - length + 1):
                piece = data[at : at + most]
                yield first, last, piece, np.array([0, len(piece)]), at


def _keys(texts) -> np.ndarray:
    """A 64-bit name of each row's text; it is used together with the length."""
    return np.array([int.from_bytes(hashlib.blake2b(x or b"", digest_size=8).digest(), "little", signed=True)
                     for x in texts.cast(pa.binary()).to_pylist()], np.int64)


def _counted(batches, length, seed):
    for batch in batches:
        for _, _, data, starts, _ in _pieces(batch.column(0), length):
            *_, h, sig = _runs(data, starts, length, seed)
            if len(h):
                order = np.lexsort((sig, h))
                h, sig = h[order], sig[order]
                new = np.ones(len(h) + 1, bool)
                new[1:-1] = (h[1:] != h[:-1]) | (sig[1:] != sig[:-1])
                at = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(K.signed(h[at[:-1]])), pa.array(K.signed(sig[at[:-1]])), pa.array(np.diff(at))],
                    ["h", "sig", "copies"],
                )


def _located(batches, length, seed):
    for batch in batches:
        names = _keys(batch.column(1))
        sizes = np.diff(K.packed(batch.column(1))[1])
        for first, _, data, starts, shift in _pieces(batch.column(1), length):
            at, run, place, h, sig = _runs(data, starts, length, seed)
            if len(at):
                row = np.searchsorted(starts, at, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(K.signed(h)), pa.array(K.signed(sig)), batch.column(0).take(pa.array(first + row)), pa.array(names[first + row]),
                        pa.array(sizes[first + row]), pa.array(at - starts[row] + shift),
                        pa.array(run.astype(np.int32)), pa.array((place - at).astype(np.int32)),
                    ],
                    ["h", "sig", "doc_id", "k", "n", "at", "run", "d"],
                )


class SuffixLevels:
    """The index family: (rank, table) of each level, largest first.

    A level has one row per suffix stretch: ``h`` (seed), ``sig`` (stretch), how many
    ``copies`` the level's batches hold, and per seed ``sigs`` and ``total``.
    """

    def __init__(self, length: int = LENGTH, seed: int = SEED):
        if not 0 < seed <= length:
            raise ValueError("the seed must fit in the window")
        self.length, self.seed, self.levels = length, seed, []

    def _level(self, counted: DataFrame) -> DataFrame:
        one = counted.repartition("h").groupBy("h", "sig").agg(F.sum("copies").alias("copies"))
        seed = Window.partitionBy("h")
        return written(
            one.select("h", "sig", "copies", F.count("*").over(seed).alias("sigs"), F.sum("copies").over(seed).alias("total"))
            .sortWithinPartitions("h", "sig"),
            "level",
        )

    def add(self, texts: DataFrame) -> None:
        """Give a batch (one column of text) its suffix array and merge equal levels."""
        counted = texts.mapInArrow(partial(_counted, length=self.length, seed=self.seed), "h long, sig long, copies long")
        self.levels.append((0, self._level(counted)))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            rank, newer = self.levels.pop()
            _, older = self.levels.pop()
            self.levels.append((rank + 1, self._level(older.union(newer).select("h", "sig", "copies"))))

    def repeated(self) -> DataFrame:
        """(h, sig, copies, sigs) of all seeds that the levels together hold more than once."""
        tables = [t for _, t in self.levels]
        whole = tables[0]
        if len(tables) > 1:
            for t in tables[1:]:
                whole = whole.union(t)
            whole = self._level(whole.select("h", "sig", "copies"))
        return whole.where("total > 1").select("h", "sig", "copies", "sigs")


def _cut(batches, length):
    """The bytes of each listed stretch of a text."""
    for batch in batches:
        k, n, blobs = (batch.column(i).to_pylist() for i in range(3))
        spans = batch.column(3).to_pylist()
        out = []
        for name, size, blob, parts in zip(k, n, blobs, spans, strict=True):
            text = _unpacked(blob, size)
            for p in parts:
                at = p["at"]
                out.append((p["h"], p["d"], p["copies"], p["sigs"], name, size, at, text[at : at + p["run"] - 1 + length]))
        if out:
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()], strict=True)],
                ["h", "d", "copies", "sigs", "k", "n", "at", "bytes"],
            )


def _windows(stretches, length):
    """(stretch, offset, name) of all windows of some stretches."""
    data = np.frombuffer(b"".join(stretches), np.uint8)
    sizes = np.array([len(s) for s in stretches])
    counts = sizes - length + 1
    which = np.repeat(np.arange(len(sizes)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start = (np.cumsum(sizes) - sizes)[which] + offset
    return which, offset, K.span(K.running(data), start, start + length)


def _compared(batches, length):
    """Per seed: the windows of lone stretches that also stand in another stretch, as ranges."""
    key, held = None, []

    def flush():
        seen = {}
        for d, copies, k, n, at, blob in held:
            seen[(k, n, at)] = (d, copies, blob)
        if len(seen) < 2:
            return []
        places, spans = list(seen), list(seen.values())
        which, offset, name = _windows([s[2] for s in spans], length)
        d = np.array([s[0] for s in spans])
        full = K.mix(name + (d[which] - offset).astype(np.uint64) * K.WORD_VALUES[2])
        _, back, count = np.unique(full, return_inverse=True, return_counts=True)
        lone = np.array([s[1] == 1 for s in spans])
        hit = np.flatnonzero((count[back] > 1) & lone[which])
        if not len(hit):
            return []
        new = np.ones(len(hit) + 1, bool)
        new[1:-1] = (which[hit][1:] != which[hit][:-1]) | (offset[hit][1:] != offset[hit][:-1] + 1)
        edge = np.flatnonzero(new)
        return [
            (*places[which[hit[a]]][:2], places[which[hit[a]]][2] + int(offset[hit[a]]),
             places[which[hit[a]]][2] + int(offset[hit[b - 1]]) + length)
            for a, b in zip(edge[:-1], edge[1:], strict=True)
        ]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["k", "n", "s", "e"])

    for batch in batches:
        for h, *rest in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
            if h != key and held:
                if rows := flush():
                    yield out(rows)
                held = []
            key = h
            if not held or held[-1][2:5] != rest[2:5]:
                held.append(rest)
    if held and (rows := flush()):
        yield out(rows)


def _spread(batches, length):
    """One row per window of a stretch, for seeds with very many stretches."""
    for batch in batches:
        h, d, copies, k, n, at, blobs = (batch.column(i).to_pylist() for i in range(7))
        for i in range(len(h)):
            _, offset, name = _windows([blobs[i]], length)
            full = K.mix(name + (d[i] - offset).astype(np.uint64) * K.WORD_VALUES[2])
            size = len(offset)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, h[i])), pa.array(K.signed(full)), pa.array(np.full(size, copies[i])),
                 pa.array(np.full(size, k[i])), pa.array(np.full(size, n[i])), pa.array(at[i] + offset)],
                ["h", "w", "copies", "k", "n", "s"],
            )


def _packed(batches):
    for batch in batches:
        names = _keys(batch.column(1))
        texts = [x or b"" for x in batch.column(1).cast(pa.binary()).to_pylist()]
        codec = pa.Codec("zstd", 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(names), pa.array([len(x) for x in texts], pa.int64()),
             pa.array([codec.compress(x, asbytes=True) for x in texts], pa.binary())],
            ["doc_id", "k", "n", "blob"],
        )


def _unpacked(blob: bytes, size: int) -> bytes:
    return pa.Codec("zstd").decompress(blob, size, asbytes=True) if size else b""


def _kept(batches):
    """Counts and the hash of what is left of each text without its ranges."""
    for batch in batches:
        doc, n, blobs, ranges = (batch.column(i).to_pylist() for i in range(4))
        removed, spans, hashes = [], [], []
        for size, blob, parts in zip(n, blobs, ranges, strict=True):
            text, at, cut, count, hashed = _unpacked(blob, size), 0, 0, 0, hashlib.sha256()
            end = -1
            for p in sorted((p["s"], p["e"]) for p in parts or ()):
                if p[0] > end:
                    count += 1
                    hashed.update(text[at : p[0]])
                    cut += p[1] - p[0]
                elif p[1] > end:
                    cut += p[1] - end
                end = at = max(end, p[1])
            hashed.update(text[at:])
            removed.append(cut)
            spans.append(count)
            hashes.append(hashed.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(hashes)],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def repeated_ranges(docs: DataFrame, packed: DataFrame, index: SuffixLevels, crowd: int = CROWD) -> DataFrame:
    """(k, n, s, e): byte ranges, per text name and length, that the index holds elsewhere too."""
    length = index.length
    found = docs.mapInArrow(partial(_located, length=length, seed=index.seed), ENTRIES).join(index.repeated(), ["h", "sig"])
    # Of equal texts one row is enough from here on.
    found = written(
        found.groupBy("h", "sig", "k", "n", "at", "run", "d", "copies", "sigs").agg(F.min("doc_id").alias("doc_id")), "found"
    )
    whole = found.where("copies > 1").select("k", "n", F.col("at").alias("s"), F.expr(f"at + run - 1 + {length}").alias("e"))
    place = F.struct("k", "n", "doc_id", "at", "run", "d")
    one = found.where("sigs > 1").groupBy("h", "sig", "copies", "sigs").agg(F.min(place).alias("p")).select("h", "copies", "sigs", "p.*")
    asked = one.groupBy(F.col("k").alias("k1"), F.col("n").alias("n1"), F.col("doc_id").alias("d1")).agg(
        F.collect_list(F.struct("h", "d", "copies", "sigs", "at", "run")).alias("spans")
    )
    source = packed.join(asked, F.expr("k = k1 AND n = n1 AND doc_id <=> d1")).select("k", "n", "blob", "spans")
    cut = written(
        source.mapInArrow(
            partial(_cut, length=length),
            "h long, d int, copies long, sigs long, k long, n long, at long, bytes binary",
        ),
        "stretches",
    )
    columns = ["h", "d", "copies", "k", "n", "at", "bytes"]
    few = cut.where(F.col("sigs") <= crowd).select(columns).repartition("h").sortWithinPartitions("h", "k", "n", "at")
    few = few.mapInArrow(partial(_compared, length=length), "k long, n long, s long, e long")
    many = cut.where(F.col("sigs") > crowd).select(columns)
    many = many.mapInArrow(partial(_spread, length=length), "h long, w long, copies long, k long, n long, s long").distinct()
    twice = many.groupBy("h", "w").agg(F.count("*").alias("c")).where("c > 1").select("h", "w")
    many = many.where("copies = 1").join(twice, ["h", "w"]).select("k", "n", "s", F.expr(f"s + {length}").alias("e"))
    return whole.union(few).union(many).distinct()


def without_repeats(
    docs: DataFrame, length: int = LENGTH, seed: int = SEED, batches: int = 2, crowd: int = CROWD
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Every byte covered by a string of ``length`` bytes that also starts anywhere else in the
    rows, judged on the input, is removed. The rows enter the index in ``batches`` batches;
    their number does not change the result.

    Null texts are empty. Equal texts are documents of their own, so each makes the other
    repeated; repeated rows and rows with equal or null doc_id are returned as they come. Very
    long texts are cut into pieces that overlap by a window. Ties between equal seeds of a window
    go to the leftmost and never change the result. An empty table gives an empty result. Other columns are ignored.
    """
    index = SuffixLevels(length, seed)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for b in range(batches):
        index.add(docs.where(part == b).select("text"))
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _packed, "doc_id long, k long, n long, blob binary"
    )
    ranges = repeated_ranges(docs.select(F.col("doc_id").cast("long"), "text"), packed, index, crowd)
    lists = ranges.groupBy("k", "n").agg(F.collect_list(F.struct("s", "e")).alias("ranges"))
    joined = packed.join(lists, ["k", "n"], "left").select("doc_id", "n", "blob", "ranges")
    return joined.mapInArrow(
        _kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
