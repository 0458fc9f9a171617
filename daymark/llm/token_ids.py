"""Token ids of documents, written as Simple-8b segments and read back."""

from __future__ import annotations

import os
import zlib
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daymark.session import new_path

from . import simple8b
from .store import tidy

#: Ids after which a segment is closed; a document is never split.
SEGMENT_IDS = 1 << 19
#: Id that ends each document.
END = 2
#: Bytes of words and ids that a Python worker remembers between batches; above them it begins anew.
REMEMBERED = 48 << 20
#: Bytes of text that are encoded in one step; a longer text is a step of its own.
STEP = 8 << 20
#: Words whose ids are looked up at once.
WORDS = 1 << 17
SCHEMA = "part int, seq int, docs long, ids long, data binary"

_words: dict = {}


class WordTable:
    """Words with their ids: word ``k`` has ``sizes[k]`` ids from ``starts[k]`` on in ``ids``.

    It is kept as Arrow and array columns, a few bytes a word more than its content.
    """

    def __init__(self):
        self.words = pa.array([], pa.string())
        self.ids, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    @property
    def nbytes(self) -> int:
        return self.words.nbytes + self.ids.nbytes + self.sizes.nbytes

    def add(self, words: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.words = pa.concat_arrays([self.words, words])
        self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])

    def places(self, words: pa.Array) -> np.ndarray:
        """The number of each word, -1 where it is not known."""
        return pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)

    def gathered(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words ``rows`` one after the other, how many each has)."""
        starts, sizes, found = np.cumsum(self.sizes) - self.sizes, self.sizes[rows], [np.zeros(0, np.uint32)]
        for k in range(0, len(rows), WORDS):
            some = sizes[k : k + WORDS]
            ends = np.cumsum(some)
            found.append(self.ids[np.repeat(starts[rows[k : k + WORDS]] - (ends - some), some) + np.arange(ends[-1])])
        return np.concatenate(found), sizes


class WordTokenizer:
    """Ids of whole texts from the ids of their words.

    For tokenizers that drop white space, do not tell capitals from small letters, encode each
    stretch of letters and each stretch of marks for itself, and end a stretch with an id whose
    token says so (``</w>``): the ids of a text are those of its words in turn, and the ids of a
    word of plain letters with marks behind them are those of both stretches. Words are cut at
    ASCII white space only. New stretches are encoded many in one call and told apart by the ids
    that end them; all other words are encoded one by one.
    """

    # Letters of Latin scripts that have one small letter each and are no compositions.
    LETTERS = "[A-Za-zÀ-ÖØ-öø-įı-ňŊ-ž]+"
    MARKS = r"[!-/:-@\[-`{-~]"
    WORD = f"^(?P<letters>{LETTERS})(?P<marks>{MARKS}*)$"
    STRETCH = f"^(?:{LETTERS}|{MARKS}+)$"
    MARK = "</w>"

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.name = zlib.crc32(definition.encode())
        size = self.tokenizer.get_vocab_size()
        self.last = np.array([(self.tokenizer.id_to_token(i) or "").endswith(self.MARK) for i in range(size)])

    def _encode(self, texts):
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order in which the words were encoded, their ids in it, how many each has)."""
        order, ids, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        single = pc.match_substring_regex(words, self.STRETCH).to_numpy(zero_copy_only=False)
        stretches, rest = np.flatnonzero(single), [np.flatnonzero(~single)]
        for k in range(0, len(stretches), 5_000):
            part = stretches[k : k + 5_000]
            found = np.array(self._encode([" ".join(words.take(pa.array(part)).to_pylist())])[0].ids, np.uint32)
            ends = np.flatnonzero(self.last[found]) + 1
            if len(ends) != len(part):
                rest.append(part)
                continue
            order.append(part)
            ids.append(found)
            sizes.append(np.diff(ends, prepend=0))
        alone = np.concatenate(rest)
        for k in range(0, len(alone), 5_000):
            part = alone[k : k + 5_000]
            found = [e.ids for e in self._encode(words.take(pa.array(part)).to_pylist())]
            order.append(part)
            sizes.append(np.array([len(f) for f in found], np.int64))
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32, int(sizes[-1].sum())))
        return np.concatenate(order), np.concatenate(ids), np.concatenate(sizes)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id; how many each text has)."""
        split = pc.ascii_split_whitespace(texts.cast(pa.string()).fill_null(""))
        coded = split.flatten().dictionary_encode()
        # Every word is a head and a tail: letters and marks, or the whole word and nothing.
        forms = pc.extract_regex(coded.dictionary, self.WORD)
        plain = forms.is_valid()
        heads = pc.if_else(plain, pc.utf8_lower(pc.struct_field(forms, "letters")), coded.dictionary)
        tails = pc.if_else(plain, pc.struct_field(forms, "marks"), "")
        pieces = pa.concat_arrays([heads, tails]).dictionary_encode()
        known = _words.setdefault(self.name, WordTable())
        if known.nbytes > REMEMBERED:
            known = _words[self.name] = WordTable()
        places = known.places(pieces.dictionary)
        new = np.flatnonzero(places < 0)
        words = pieces.dictionary.take(pa.array(new))
        order, ids, sizes = self.encoded(words)
        places[new[order]] = len(known.words) + np.arange(len(order))
        known.add(words.take(pa.array(order)), ids, sizes)
        both = places[pieces.indices.to_numpy()].reshape(2, -1).T
        ids, sizes = known.gathered(both[coded.indices.to_numpy()].ravel())
        # The words of text i end at edges[i + 1]; its end id follows their ids.
        edges = 2 * (split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py())
        before = np.concatenate([[0], np.cumsum(sizes)])[edges]
        return np.insert(ids, before[1:], np.uint32(END)), np.diff(before) + 1


def write_ids(docs: DataFrame, path: str, tokenizer: str, segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of ``docs`` (doc_id, text) to ``path`` in ascending doc_id order.

    ``tokenizer`` is the path of the tokenizer's file on the driver; its content goes to the
    executors. ``path`` gets rows (part, seq, docs, ids, data), each with a segment as ``data``.
    They go through Spark's writer, so a lost executor leaves no half-written files.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text())

    def encoded(batches):
        part, seq, made = TaskContext.get().partitionId(), 0, None
        held, held_counts, held_ids, size = [], [], [], 0

        def close():
            doc_ids, counts = np.concatenate(held_ids), np.concatenate(held_counts)
            data = simple8b.segment(doc_ids, counts, np.concatenate(held))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(doc_ids)], pa.int64()),
                 pa.array([int(counts.sum())], pa.int64()), pa.array([data], pa.binary())],
                ["part", "seq", "docs", "ids", "data"],
            )

        for batch in batches:
            made = made or WordTokenizer(shared.value)
            doc_ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = batch.column(1)
            edges = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            step, first = min(STEP, 4 * segment_ids), 0
            while first < len(texts):
                done = edges[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(edges, done + step, "right")))
                ids, counts = made.ids(texts.slice(first, last - first))
                held.append(ids)
                held_counts.append(counts)
                held_ids.append(doc_ids[first:last])
                size += len(ids)
                first = last
                if size >= segment_ids:
                    yield close()
                    held, held_counts, held_ids, size, seq = [], [], [], 0, seq + 1
        if held:
            yield close()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(tidy(encoded), SCHEMA).write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str, listed: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32, and ``ids`` if ``listed``.

    ``start`` counts the ids of all documents before it. It comes from running totals of the
    segments within a part and of the parts, of which there are as many as write tasks.
    """
    stored = spark.read.schema(SCHEMA).parquet(path)
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored.groupBy("part").agg(F.sum("ids").alias("all"))
    before = F.sum("all").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    starts = stored.select("part", "seq", F.coalesce(F.sum("ids").over(within), F.lit(0)).alias("local")).join(parts, "part")
    joined = stored.join(starts, ["part", "seq"]).select((F.col("base") + F.col("local")).alias("base"), "data")

    def decoded(batches):
        for batch in batches:
            for base, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc_ids, counts, values = simple8b.read_segment(data)
                values = values.astype("<u4")
                edges = np.concatenate([[0], np.cumsum(counts)])
                raw = memoryview(values).cast("B") if len(values) else b""
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                columns = [pa.array(doc_ids), pa.array(base + edges[:-1]), pa.array(counts), pa.array(sums, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if listed:
                    columns.append(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * listed
    return joined.mapInArrow(tidy(decoded), schema)


def token_ids(docs: DataFrame, tokenizer: str, segment_ids: int = SEGMENT_IDS, listed: bool = False) -> DataFrame:
    """Encode ``docs`` (doc_id, text), write the files to the shared folder and read them back.

    Null and empty texts have the end id only. Rows without a doc_id have no place in the order
    and are left out. Repeated doc_ids stay next to each other, in no fixed order if their texts
    differ. Very long texts make a segment of their own size. An empty table gives an empty
    result. Other columns are ignored.
    """
    path = new_path(docs.sparkSession, "token-ids")
    write_ids(docs, path, tokenizer, segment_ids)
    return read_ids(docs.sparkSession, path, listed)
