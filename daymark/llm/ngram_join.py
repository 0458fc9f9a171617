"""N-gram Jaccard join by prefix trees.

Sets are ordered by one global order, rarest shingle first, and stored in path-compressed
tries. A trie is walked once for many sets that are looked up: documents with equal beginnings
share the overlaps counted so far, and a set leaves a subtree as soon as its overlap plus the
shorter remainder cannot reach what the threshold asks for. All links are found and counted per
document; of the pairs only a spanning forest is written.
"""

from __future__ import annotations

import itertools
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shingle_sets import alone_counts, sets
from .store import tidy, written

#: Tokens that one trie holds at most, unless a single set has more.
TRIE_TOKENS = 2_000_000


class Trie:
    """Ordered integer sets in a path-compressed tree, held in arrays.

    ``tokens`` has all sets behind each other, set k at ``starts[k]:starts[k + 1]`` in rising
    order. Node 0 is the root. A node has its parent, its depth in tokens, the set ``owner``
    that its edge is read from, its children, the sets that end there, and the longest sequence
    and the least full size of the sets below it.
    """

    def __init__(self, tokens: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.tokens, self.starts = tokens, starts
        # Big-endian bytes compare as the sequences do.
        names = [tokens[i:j].astype(">u4").tobytes() for i, j in itertools.pairwise(starts)]
        order = sorted(range(len(names)), key=names.__getitem__)
        self.parent, self.depth, self.owner, self.ends = [-1], [0], [0], [[]]
        stack, before = [0], tokens[:0]
        for k in order:
            own = tokens[starts[k] : starts[k + 1]]
            most = min(len(before), len(own))
            other = np.flatnonzero(before[:most] != own[:most])
            same, last = int(other[0]) if len(other) else most, -1
            while self.depth[stack[-1]] > same:
                last = stack.pop()
            if self.depth[stack[-1]] < same:
                upper = self._node(stack[-1], same, k)
                self.parent[last] = upper
                stack.append(upper)
            if len(own) > same:
                stack.append(self._node(stack[-1], len(own), k))
            self.ends[stack[-1]].append(k)
            before = own
        self.children = [[] for _ in self.parent]
        self.longest, self.shortest = [0] * len(self.parent), [1 << 60] * len(self.parent)
        for v in sorted(range(len(self.parent)), key=self.depth.__getitem__, reverse=True):
            if self.ends[v]:
                self.longest[v] = max(self.longest[v], self.depth[v])
                self.shortest[v] = min(self.shortest[v], *(int(sizes[k]) for k in self.ends[v]))
            if v:
                up = self.parent[v]
                self.children[up].append(v)
                self.longest[up] = max(self.longest[up], self.longest[v])
                self.shortest[up] = min(self.shortest[up], self.shortest[v])

    def _node(self, parent: int, depth: int, owner: int) -> int:
        self.parent.append(parent)
        self.depth.append(depth)
        self.owner.append(owner)
        self.ends.append([])
        return len(self.parent) - 1

    def edge(self, v: int) -> np.ndarray:
        at = self.starts[self.owner[v]]
        return self.tokens[at + self.depth[self.parent[v]] : at + self.depth[v]]


class Probes:
    """Sets to be looked up together: which of them hold a token, and what is left behind one."""

    def __init__(self, tokens: np.ndarray, starts: np.ndarray, vocabulary: int):
        self.lengths = np.diff(starts)
        self.count, self.starts, self.vocabulary = len(self.lengths), starts[:-1], vocabulary
        who = np.repeat(np.arange(self.count), self.lengths)
        self.keys = who * np.int64(vocabulary) + tokens
        held = np.bincount(tokens, minlength=vocabulary)
        # Of a token that most sets hold, those without it are listed instead.
        self.dense = 2 * held > self.count
        sparse = who[np.argsort(tokens, kind="stable")]
        self.size, self.at = held.copy(), np.cumsum(held) - held
        lists, dense = [sparse], np.flatnonzero(self.dense)
        place = np.cumsum(self.dense) - 1
        common = self.dense[tokens]
        row, col = place[tokens[common]], who[common]
        order = np.argsort(row, kind="stable")
        row, col = row[order], col[order]
        at_once = max(1, (1 << 22) // max(1, self.count))
        for first in range(0, len(dense), at_once):
            some = slice(*np.searchsorted(row, [first, first + at_once]))
            without = np.ones((min(at_once, len(dense) - first), self.count), bool)
            without[row[some] - first, col[some]] = False
            lists.append(np.nonzero(without)[1])
        self.size[dense] = self.count - held[dense]
        self.at[dense] = len(sparse) + np.cumsum(self.size[dense]) - self.size[dense]
        self.lists = np.concatenate(lists)

    def _listed(self, tokens: np.ndarray) -> np.ndarray:
        """How often each set is on the lists of these tokens."""
        size = self.size[tokens]
        shift = np.repeat(self.at[tokens] - np.cumsum(size) + size, size)
        return np.bincount(self.lists[shift + np.arange(len(shift))], minlength=self.count)

    def hits(self, edge: np.ndarray) -> np.ndarray:
        """How many tokens of an edge each set holds."""
        dense = self.dense[edge]
        many = edge[dense]
        return self._listed(edge[~dense]) + len(many) - self._listed(many)

    def left(self, who: np.ndarray, token: int) -> np.ndarray:
        """How many tokens of the sets ``who`` are not before ``token``."""
        passed = np.searchsorted(self.keys, who * np.int64(self.vocabulary) + token) - self.starts[who]
        return self.lengths[who] - passed


def needed(n, m, share: int):
    """Least overlap of sets of n and m items whose Jaccard similarity is share / 100 or more."""
    return -(-share * (n + m) // (100 + share))


def trie_links(probes, sets, share: int):
    """(k, which): for each of the ``sets`` the probes that link with it, if any.

    Both come as (tokens, starts, sizes): ordered tokens behind each other, and full sizes. The
    tree of the sets is walked once for all probes. A probe's overlap with a beginning is shared
    by all sets below it, and a probe leaves a subtree as soon as its overlap plus the shorter
    remainder cannot reach what the threshold asks for.
    """
    tokens, starts, sizes = sets
    if len(starts) < 2 or len(probes[1]) < 2:
        return
    asked = Probes(probes[0], probes[1], int(max(tokens.max(), probes[0].max())) + 1)
    n = probes[2]
    tree = Trie(tokens, starts, sizes)
    stack = [(v, np.arange(asked.count), np.zeros(asked.count, np.int64)) for v in tree.children[0]]
    while stack:
        v, alive, overlap = stack.pop()
        edge = tree.edge(v)
        most = np.minimum(tree.longest[v] - tree.depth[tree.parent[v]], asked.left(alive, edge[0]))
        stays = overlap + most >= needed(n[alive], tree.shortest[v], share)
        alive, overlap = alive[stays], overlap[stays]
        if not len(alive):
            continue
        overlap = overlap + asked.hits(edge)[alive]
        for k in tree.ends[v]:
            which = alive[overlap >= needed(n[alive], sizes[k], share)]
            if len(which):
                yield k, which
        stack.extend((child, alive, overlap) for child in tree.children[v])


def _ranked(f: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The place of each (f, t) among the distinct ones."""
    order = np.lexsort((t, f))
    new = np.ones(len(order), bool)
    new[1:] = (f[order][1:] != f[order][:-1]) | (t[order][1:] != t[order][:-1])
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new) - 1
    return ranks


def joined_sets(tokens, starts, sizes, copies, probe, looked, share):
    """(links, counts) of the sets ``probe`` with the sets ``looked`` (the same or others).

    ``links`` is a spanning forest of all links, ``counts`` has for each set the ``copies`` of
    the sets that it links with: all links are counted, none is written as a pair.
    """

    def part(which):
        lengths = np.diff(starts)[which]
        begins = np.concatenate([[0], np.cumsum(lengths)])
        return tokens[np.repeat(starts[which] - begins[:-1], lengths) + np.arange(begins[-1])], begins, sizes[which]

    counts, label, links = np.zeros(len(sizes), np.int64), np.arange(len(sizes)), []
    same = probe is looked
    for k, which in trie_links(part(probe), part(looked), share):
        y, others = looked[k], probe[which]
        if same:
            others = others[others != y]
        counts[others] += copies[y]
        if not same:
            counts[y] += copies[others].sum()
        foreign = others[label[others] != label[y]]
        if len(foreign):
            merged, first = np.unique(label[foreign], return_index=True)
            links.extend((y, x) for x in foreign[first])
            label[np.isin(label, merged)] = label[y]
    return links, counts


def _joined(batches, share):
    """Of each run of rows with the same (block, i, j): links (u, v, null) and counts (u, null, links)."""
    key, held = None, []

    def flush():
        node, sizes, copies, own = (np.array(x, np.int64) for x in list(zip(*held, strict=True))[:4])
        f, t = (np.concatenate([x[k] for x in held]) for k in (4, 5))
        starts = np.concatenate([[0], np.cumsum([len(x[4]) for x in held])])
        every = np.arange(len(node))
        probe, looked = (every, every) if key[1] == key[2] else (every[own == key[1]], every[own == key[2]])
        links, counts = joined_sets(_ranked(f, t), starts, sizes, copies, probe, looked, share)
        some = np.flatnonzero(counts)
        u = np.concatenate([node[[a for a, _ in links]], node[some]]) if links else node[some]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(u, pa.int64()),
                pa.array([int(node[b]) for _, b in links] + [None] * len(some), pa.int64()),
                pa.array([None] * len(links) + counts[some].tolist(), pa.int64()),
            ],
            ["u", "v", "links"],
        )

    for batch in batches:
        blocks, i, j, node, n, copies, own = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(7))
        lists = [(batch.column(k).values.to_numpy(), batch.column(k).offsets.to_numpy()) for k in (7, 8)]
        for r in range(batch.num_rows):
            this = (blocks[r], i[r], j[r])
            if this != key and held:
                if len(held) > 1:
                    yield flush()
                held = []
            key = this
            f, t = (v[o[r] : o[r + 1]].copy() for v, o in lists)
            held.append((node[r], n[r], copies[r], own[r], f, t))
    if len(held) > 1:
        yield flush()


def set_links(rows: DataFrame, docs: DataFrame, size: int, share: int, buckets: int, trie_tokens: int) -> DataFrame:
    """(u, v, links) over the names ``a`` of sets: links that connect all that are linked, with
    null ``links``, and, with null ``v``, how many rows of other sets a set links with. A set's
    ``links`` may come in several parts."""
    classes = rows.where("n > 0").groupBy("a", "n").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    alone = alone_counts(docs, size, buckets)
    # A linked set shares all but this many of its shingles with its partner.
    classes = classes.join(alone, F.col("a") == F.col("node"), "left").where(
        F.expr(f"coalesce(alone, 0) * 100 <= n * {100 - share}")
    )
    kept = written(classes.select("doc_id", F.col("a").alias("node"), "n", "copies"), "classes")
    # The same join at every size: the ids kept grow with the corpus, so they are never sent to all.
    text = docs.select(F.col("doc_id").cast("long"), "text").join(kept.select("doc_id").hint("merge"), "doc_id", "left_semi")
    named = sets(text, size, tokens=True).select(F.col("a").alias("node"), "n", F.explode("tokens").alias("token"))
    tokens = written(named, "tokens")
    shared = tokens.groupBy("token").agg(F.count("*").alias("f")).where("f > 1")
    held = tokens.join(shared, "token").groupBy("node", "n").agg(
        F.array_sort(F.collect_set(F.struct("f", "token"))).alias("held")
    )
    # Rare shingles come first in the order; those that only one set has need not be stored.
    held = held.where(F.size("held") * 100 >= F.col("n") * share)
    held = written(
        held.select("node", "n", F.col("held.f").alias("f"), F.col("held.token").alias("token")), "held"
    )
    prefix = F.expr(f"size(token) - CAST(ceil(n * {share} / 100.0) AS INT) + 1")
    first = held.select("node", F.explode(F.slice("token", F.lit(1), prefix)).alias("token"))
    star = first.groupBy("token").agg(F.min("node").alias("u"), F.count("*").alias("c")).where("c > 1")
    near = first.join(star, "token").where("u <> node").select("u", F.col("node").alias("v"))
    blocks = components(near)
    inside = held.join(blocks, "node").join(kept.select("node", "copies"), "node")
    total = blocks.join(held.select("node", F.size("token").alias("k")), "node").groupBy("root").agg(
        F.expr(f"CAST(ceil(sum(k) / {trie_tokens}.0) AS INT)").alias("parts")
    )
    inside = inside.join(total, "root").withColumn("own", F.expr("CAST(pmod(xxhash64(node), parts) AS INT)"))
    # A block of several parts is joined part against part, each pair of parts in one place.
    inside = inside.withColumn(
        "other", F.explode(F.when(F.col("parts") > 1, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.lit(0))))
    )
    inside = inside.select(
        F.col("root").alias("block"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "node", "n", "copies", "own", "f", "token",
    )
    dealt = inside.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j")
    return written(dealt.mapInArrow(tidy(partial(_joined, share=share)), "u long, v long, links long"), "set_links")


def ngram_components(
    docs: DataFrame, size: int = 5, share: int = 75, buckets: int | None = None, trie_tokens: int = TRIE_TOKENS
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, n_links.

    Two documents are linked when the Jaccard similarity of their sets of distinct word
    shingles is ``share`` percent or more, by exact counts; ``component_id`` is the least
    doc_id that can be reached, ``n_links`` the number of other rows that the row itself links
    with. Documents with equal sets form one class, which is joined once and counted with all
    its rows.

    Null and empty texts have the empty set and link with nothing. Texts are read whole, at any
    length. Rows with a null doc_id are
    returned with a null component_id unless other rows have their set. Repeated rows are
    returned as often as they come; a doc_id that comes with several texts names each of their
    sets, and its rows with equal sets link with each other. Ties do not arise: neither
    components nor counts depend on any order. An empty table gives an
    empty result. Other columns are ignored.
    """
    if buckets is None:
        buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = written(sets(docs, size), "sets")
    links = set_links(rows, docs, size, share, buckets, trie_tokens)
    roots = components(links.where("v IS NOT NULL").select("u", "v"))
    counted = links.where("v IS NULL").groupBy(F.col("u").alias("a")).agg(F.sum("links").alias("links"))
    least = rows.where("n > 0").groupBy("a").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    joined = least.join(roots, least.a == roots.node, "left").select(
        "a", "least", "copies", F.coalesce("root", "a").alias("root")
    )
    reached = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    n_links = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    known = joined.join(reached, "root").join(counted, "a", "left").select("a", "component_id", n_links)
    some = rows.where("n > 0").join(known, "a").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links")
    none = rows.where("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")
    )
    return some.union(none)
