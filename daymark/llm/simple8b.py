"""Simple-8b: integers packed into 64-bit words, in blocks that decode side by side.

The top four bits of a word select how many values it holds and of how many bits:

========  ===================================================
selector  content of the other 60 bits
========  ===================================================
0         escape: the next word is one value of up to 64 bits
1         120 zeros
2..15     60 x 1, 30 x 2, 20 x 3, 15 x 4, 12 x 5, 10 x 6,
          8 x 7, 7 x 8, 6 x 10, 5 x 12, 4 x 15, 3 x 20,
          2 x 30, 1 x 60 bits, first value lowest
========  ===================================================

Every ``block`` values start a new word, whose index is kept, so all blocks are encoded and
decoded in step with each other by array operations. The last word of a block may have room
for more values than the block has left; they are zero and never read.

A segment is a byte string: magic ``S8B1``, block size (u32), number of documents, values and
words (u64 each), doc_id of each document (i64), its number of values (u64), the first word of
each block (u32), the words (u64); all little-endian.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 256
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
MAGIC = b"S8B1"
HEAD = struct.Struct("<4sIQQQ")


def _selectors(values: np.ndarray, block: int) -> np.ndarray:
    """For every position the selector that holds most values from there to its block's end.

    ``widest`` is, per position, the widest need among the next values, as many as the selector
    holds; windows grow from selector to selector. Places behind a block's end need nothing.
    """
    n = len(values)
    blocks, longest, most = -(-n // block), int(COUNTS.max()), int(values.max())
    need = np.zeros(blocks * block, np.uint8)
    for width in WIDTHS[1:]:
        if most < 1 << int(width):
            break
        need[:n] += values >= np.uint64(1 << int(width))
    least = int(need[:n].min())
    widest = np.zeros((blocks, block + longest), np.uint8)
    widest[:, :block] = need.reshape(blocks, block)
    chosen, window = np.zeros((blocks, block), np.int8), 1
    for s in range(15, least, -1):
        further, window = int(COUNTS[s]) - window, int(COUNTS[s])
        if further:
            widest[:, :-further] = np.maximum(widest[:, :-further], widest[:, further:])
        chosen[widest[:, :block] < s] = s
    return chosen.ravel()[:n]


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block) of unsigned 64-bit values."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    chosen = _selectors(values, block)
    starts = np.arange(0, n, block)
    ends = np.minimum(starts + block, n)
    at, steps = starts.copy(), []
    while True:
        live = at < ends
        if not live.any():
            break
        steps.append(at[live])
        at[live] += COUNTS[chosen[at[live]]]
    at = np.sort(np.concatenate(steps))
    selector = chosen[at]
    size = np.where(selector == 0, 2, 1)
    target = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    words[target] = selector.astype(np.uint64) << np.uint64(60)
    limit = np.minimum((at // block + 1) * block, n)
    escaped = selector == 0
    words[target[escaped] + 1] = values[at[escaped]]
    for s in range(2, 16):
        mine = np.flatnonzero(selector == s)
        for k in range(COUNTS[s]):
            mine = mine[at[mine] + k < limit[mine]]
            if not len(mine):
                break
            words[target[mine]] |= values[at[mine] + k] << np.uint64(k * int(WIDTHS[s]))
    return words, target[np.searchsorted(at, starts)].astype(np.uint32)


def decode(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` values of ``encode``; all blocks advance one word at a time."""
    out = np.zeros(n, np.uint64)
    at = np.arange(0, n, block)
    ends = np.minimum(at + block, n)
    word = offsets.astype(np.int64)
    while len(at):
        selector = (words[word] >> np.uint64(60)).astype(np.int64)
        escaped = selector == 0
        out[at[escaped]] = words[word[escaped] + 1]
        for s in np.unique(selector):
            if s < 2:
                continue
            mine = np.flatnonzero(selector == s)
            width = int(WIDTHS[s])
            data, first, limit = words[word[mine]], at[mine], ends[mine]
            for k in range(COUNTS[s]):
                inside = first + k < limit
                if not inside.any():
                    break
                out[first[inside] + k] = (data[inside] >> np.uint64(k * width)) & np.uint64((1 << width) - 1)
        at = at + COUNTS[selector]
        word = word + 1 + escaped
        live = at < ends
        at, ends, word = at[live], ends[live], word[live]
    return out


def segment(doc_ids: np.ndarray, counts: np.ndarray, values: np.ndarray, block: int = BLOCK) -> bytes:
    """The bytes of one segment; ``values`` holds the documents' values one after the other."""
    words, offsets = encode(values, block)
    head = HEAD.pack(MAGIC, block, len(doc_ids), len(values), len(words))
    parts = (doc_ids.astype("<i8"), counts.astype("<u8"), offsets.astype("<u4"), words.astype("<u8"))
    return head + b"".join(p.tobytes() for p in parts)


def read_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, counts, values) of a segment."""
    if len(data) < HEAD.size or data[:4] != MAGIC:
        raise ValueError("not a Simple-8b segment")
    _, block, docs, n, size = HEAD.unpack_from(data)
    blocks = -(-n // block)
    if len(data) != HEAD.size + 16 * docs + 4 * blocks + 8 * size:
        raise ValueError("the segment is cut off")
    at = HEAD.size
    doc_ids = np.frombuffer(data, "<i8", docs, at)
    counts = np.frombuffer(data, "<u8", docs, at + 8 * docs)
    offsets = np.frombuffer(data, "<u4", blocks, at + 16 * docs)
    words = np.frombuffer(data[at + 16 * docs + 4 * blocks :], "<u8", size)
    return doc_ids, counts.astype(np.int64), decode(words, offsets, n, block)
