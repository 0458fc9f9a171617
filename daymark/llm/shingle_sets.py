"""Word-shingle sets of documents as Arrow stages."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .store import tidy

#: Two sums over differently mixed hashes name a set with 128 bits.
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def _named(rows, hashed, count):
    bounds = np.searchsorted(rows, np.arange(count + 1))
    size = np.diff(bounds)
    first = K.mix(K.sums(rows, hashed, count) + size.astype(np.uint64))
    second = K.mix(K.sums(rows, K.mix(hashed ^ _SECOND), count) ^ _SECOND)
    return bounds, size, first, second


def _sets(batches, size, tokens):
    for batch in batches:
        ids = batch.column(0)
        for first, last, data, starts in K.text_slices(batch.column(1)):
            rows, hashed = K.shingles(data, starts, size)
            bounds, sizes, a, b = _named(rows, hashed, last - first)
            columns = [ids[first:last], pa.array(sizes.astype(np.int64)), pa.array(K.signed(a)), pa.array(K.signed(b))]
            if tokens:
                columns.append(K.long_lists(hashed, bounds))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "a", "b", "tokens"][: len(columns)])


def sets(docs: DataFrame, size: int, tokens: bool = False) -> DataFrame:
    """doc_id, n (distinct shingles), a and b (128 bits that name the set), maybe the hashes."""
    schema = "doc_id long, n long, a long, b long" + ", tokens array<long>" * tokens
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(partial(_sets, size=size, tokens=tokens)), schema)


ENTRY = "bucket int, slice long, kind int, codes binary, owners binary"


def _entries(batches, size, buckets):
    """Per slice of rows: one row per bucket with its hashes, and one with the slice's set names.

    A hash that only one row of the slice holds comes with that row's place; one that several
    hold comes once, without a place.
    """
    part, count = TaskContext.get().partitionId(), 0
    for batch in batches:
        for first, last, data, starts in K.text_slices(batch.column(0), 1 << 22):
            rows, hashed = K.shingles(data, starts, size)
            if not len(hashed):
                continue
            _, _, names, _ = _named(rows, hashed, last - first)
            order = np.argsort(hashed)
            rows, hashed = rows[order], hashed[order]
            new = np.ones(len(hashed) + 1, bool)
            new[1:-1] = hashed[1:] != hashed[:-1]
            where = np.flatnonzero(new[:-1])
            owner = np.where(new[1:][where], rows[where] + 1, 0).astype(np.uint32)
            high = hashed[where] >> np.uint64(32)
            bucket = (high * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            code = (hashed[where] >> np.uint64(8)).astype(np.uint32)
            order = np.lexsort((owner, bucket))
            owner, code = owner[order], code[order]
            bounds = np.searchsorted(bucket, np.arange(buckets + 1))
            content = int(K.mix(np.bitwise_xor.reduce(K.mix(names), keepdims=True) + np.uint64(part * 1_000_003 + count))[0])
            count += 1
            some = np.flatnonzero(np.diff(bounds))
            kinds = [0] * len(some) + [1]
            codes = [code[bounds[k] : bounds[k + 1]].tobytes() for k in some] + [names.tobytes()]
            owners = [owner[bounds[k] : bounds[k + 1]].tobytes() for k in some] + [b""]
            ids = np.full(len(kinds), content, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*some.tolist(), content % buckets], pa.int32()), pa.array(K.signed(ids)), pa.array(kinds, pa.int32()),
                 pa.array(codes, pa.binary()), pa.array(owners, pa.binary())],
                ["bucket", "slice", "kind", "codes", "owners"],
            )


REPLY = "slice long, kind int, places binary, counts binary"


def _alone(table: pa.Table) -> pa.Table:
    """Per slice: at which places how many hashes of this bucket stand that no other place has."""
    slices, kinds, first, second = [], [], [], []
    codes, owners, ids = [], [], []
    columns = (table.column(c).to_pylist() for c in ("slice", "kind", "codes", "owners"))
    for number, kind, code, owner in zip(*columns, strict=True):
        if kind:
            slices.append(number)
            kinds.append(1)
            first.append(code)
            second.append(b"")
        else:
            codes.append(np.frombuffer(code, np.uint32))
            owners.append(np.frombuffer(owner, np.uint32))
            ids.append(number)
    if codes:
        which = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        code, owner = np.concatenate(codes), np.concatenate(owners)
        order = np.argsort(code, kind="stable")
        code = code[order]
        new = np.ones(len(code) + 1, bool)
        new[1:-1] = code[1:] != code[:-1]
        single = np.sort(order[new[:-1] & new[1:]])
        single = single[owner[single] > 0]
        which, owner = which[single], owner[single]
        bounds = np.searchsorted(which, np.arange(len(codes) + 1))
        for k in np.flatnonzero(np.diff(bounds)):
            place, count = np.unique(owner[bounds[k] : bounds[k + 1]], return_counts=True)
            slices.append(ids[k])
            kinds.append(0)
            first.append(place.tobytes())
            second.append(count.astype(np.uint16).tobytes() if count.max() < 65536 else count.astype(np.uint32).tobytes())
    return pa.table({
        "slice": pa.array(slices, pa.int64()), "kind": pa.array(kinds, pa.int32()),
        "places": pa.array(first, pa.binary()), "counts": pa.array(second, pa.binary()),
    })


def _summed(table: pa.Table) -> pa.Table:
    """(node, alone) of the sets of one slice."""
    names, places, counts = None, [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
    for kind, place, count in zip(*(table.column(c).to_pylist() for c in ("kind", "places", "counts")), strict=True):
        if kind:
            names = np.frombuffer(place, np.uint64)
        else:
            places.append(np.frombuffer(place, np.uint32))
            counts.append(np.frombuffer(count, np.uint16 if 2 * len(count) == len(place) else np.uint32))
    if names is None:
        names = np.zeros(0, np.uint64)
    total = np.bincount(np.concatenate(places), np.concatenate(counts), len(names) + 1).astype(np.int64)[1 : len(names) + 1]
    some = np.flatnonzero(total)
    return pa.table({"node": K.signed(names[some]), "alone": total[some]})


def alone_counts(docs: DataFrame, size: int, buckets: int) -> DataFrame:
    """(node, alone): per set, how many of its hashes stand in no other row of the corpus.

    Every row takes part. A hash leaves a slice of rows once, however many rows of the slice
    hold it, so a common shingle costs one entry per slice. Its bucket compares 32 more bits;
    a chance agreement only makes ``alone`` smaller, and so does a slice that is made again
    after a loss from rows in another order. Sets in several rows have nothing alone.
    """
    sent = docs.select("text").mapInArrow(tidy(partial(_entries, size=size, buckets=buckets)), ENTRY)
    replies = sent.groupBy("bucket").applyInArrow(_alone, REPLY)
    counted = replies.groupBy("slice").applyInArrow(_summed, "node long, alone long")
    return counted.groupBy("node").agg(F.min("alone").alias("alone"))
