"""Ranked lexical search by branch and bound over a frequency-ordered prefix tree of documents.

For a block of items, documents are cut down to the terms those items have: a document is a vector of terms
with their counts, its length and its id. Terms are ordered by how many documents have them, most frequent
first, so that documents share the beginnings of their vectors and become paths of a tree. A node stands
for a run of documents; it keeps, for each term below it, the largest count, and the smallest length penalty
m. Both together bound the score of all documents below it for any item. Each item walks the tree depth first,
best child first, and leaves out whatever cannot reach the 50 best found so far; what is left is scored exactly,
in 64-bit integers. Small neighbouring branches are kept together in one leaf, so a leaf is worth a vector
operation.

As Spark jobs: one pass over the texts writes the vectors (no text moves); document frequencies are counted with
a map-side combine; each task builds trees of a bounded number of entries from its own vectors and sends at most
`k` rows an item on. First a fixed share of the documents is searched alone. The k-th best of those is a bound
that holds for all documents, so in the search of all of them a task sends only rows that may still be among the
k best: about k times the inverse share in all for an item, however many tasks there are. Equal vectors are
one entry of a tree with its k smallest ids, so groups of copies cost nothing.

The items are the query set, taken in blocks of a bounded number of items and terms; what the driver holds and
broadcasts is one block.

Results in odd cases: a null text, and one without terms, matches nothing and counts in no statistic (its
item has no rows); rows repeated are documents of their own, equal scores are ordered by id, a null id after
all others; items are told apart by their row, so a repeated item id gives each of its rows; with no
documents or no items there are no rows. Texts are read whole. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.frames import materialise
from freshet.operators.sizing import scan_tasks

K = 50
# Items searched at a time and their terms, entries of a tree, documents of a leaf.
BLOCK_ITEMS = 2_000
BLOCK_TERMS = 20_000
TREE_ENTRIES = 1_000_000
LEAF_DOCS = 32
# Documents searched by a task.
TASK_DOCS = 16_384
# One document in this many is searched first.
AHEAD = 64
NO_ID = 2**63 - 1

# Everything but ASCII letters, digits and the bytes of other characters separates; only A-Z is lower-cased.
_TABLE = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in UTF-8, in order."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Items:
    """A block of items: the terms that any of them has, and each item's, by their place in `vocabulary`."""

    vocabulary: list[bytes]
    ids: list[object]
    terms: list[np.ndarray]


def item_blocks(
    items: Iterable[tuple[object, set[bytes]]], most_terms: int = BLOCK_TERMS, most_items: int = BLOCK_ITEMS
) -> Iterator[Items]:
    """Consecutive items, so many that they have no more terms between them than asked for, or a single one."""
    ids, own, known = [], [], set()
    for item_id, found in items:
        if ids and (len(known | found) > most_terms or len(ids) == most_items):
            yield _block(ids, own, known)
            ids, own, known = [], [], set()
        ids.append(item_id)
        own.append(found)
        known |= found
    if known:
        yield _block(ids, own, known)


def _block(ids: list[object], own: list[set[bytes]], known: set[bytes]) -> Items:
    vocabulary = sorted(known)
    place = {t: i for i, t in enumerate(vocabulary)}
    return Items(vocabulary, ids, [np.array(sorted(map(place.__getitem__, found)), np.int64) for found in own])


@dataclass
class Corpus:
    """What scores depend on: N, L, and by place in the vocabulary each term's weight and rank (0: in most
    documents)."""

    n_docs: int
    n_terms: int
    weights: np.ndarray
    ranks: np.ndarray

    def penalty(self, n: np.ndarray) -> np.ndarray:
        return 50 + (50 * n * self.n_docs) // self.n_terms


def saturated(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


@dataclass
class Best:
    """The k best of an item: by score, then by smaller id. `floor` is one that they must be as good as."""

    k: int
    floor: tuple[int, int] = (1, -NO_ID)
    heap: list[tuple[int, int]] = field(default_factory=list)

    @property
    def bar(self) -> int:
        """No document of a lower score can get in."""
        return max(self.heap[0][0], self.floor[0]) if len(self.heap) == self.k else self.floor[0]

    def offer(self, score: int, doc_id: int) -> None:
        entry = (score, -doc_id)
        if entry < self.floor:
            return
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)


class Tree:
    """Documents as paths of terms. Nodes are numbered so that the children of each follow one another; the
    entries of node i, (term, bound on what one unit of its weight gives), are a range of two flat arrays. A leaf
    has a range of documents, whose entries are held the same way but exact."""

    def __init__(self, docs: list[tuple[np.ndarray, np.ndarray, int, list[int]]], corpus: Corpus, leaf_docs: int = LEAF_DOCS):
        """`docs`: ranks in ascending order, counts, length and ids of each different vector."""
        docs = sorted(docs, key=lambda d: d[0].astype(">u4").tobytes())
        self.ids = [d[3] for d in docs]
        self.at = np.concatenate(([0], np.cumsum([len(d[0]) for d in docs]))).astype(np.int64)
        self.terms = np.concatenate([d[0] for d in docs]).astype(np.int64)
        self.counts = np.concatenate([d[1] for d in docs]).astype(np.int64)
        self.m = corpus.penalty(np.array([d[2] for d in docs], np.int64))
        self.gains = saturated(self.counts, np.repeat(self.m, np.diff(self.at)))
        self.leaf_docs = leaf_docs
        # Per node: its documents, its first child and the one behind its last (none for a leaf).
        self.spans, self.children = [(0, len(docs))], [(0, 0)]
        self._branch()
        self._bounds()

    def _shared(self, low: int, high: int) -> int:
        """How many first terms the documents of a range share: those that its first and last do."""
        a, b = (self.terms[self.at[i] : self.at[i + 1]] for i in (low, high - 1))
        n = min(len(a), len(b))
        differ = np.nonzero(a[:n] != b[:n])[0]
        return int(differ[0]) if len(differ) else n

    def _branch(self) -> None:
        """Split every range of more than a leaf's documents by the first term in which they differ; neighbours of
        few documents stay together."""
        node = 0
        while node < len(self.spans):
            low, high = self.spans[node]
            depth = self._shared(low, high)
            starts = self.at[low:high] + depth
            inside = starts < self.at[low + 1 : high + 1]
            term = np.where(inside, self.terms[np.minimum(starts, len(self.terms) - 1)], -1)
            cuts = [low, *(low + 1 + np.nonzero(np.diff(term))[0]).tolist(), high]
            if high - low > self.leaf_docs and len(cuts) > 2:
                groups, first = [], cuts[0]
                for end, after in zip(cuts[1:], [*cuts[2:], None], strict=True):
                    if after is None or after - first > self.leaf_docs:
                        groups.append((first, end))
                        first = end
                self.children[node] = (len(self.spans), len(self.spans) + len(groups))
                self.spans += groups
                self.children += [(0, 0)] * len(groups)
            node += 1

    def _bounds(self) -> None:
        """From the leaves up: the largest count of each term and the smallest m of each node."""
        largest: list[tuple[np.ndarray, np.ndarray]] = [()] * len(self.spans)
        least = np.zeros(len(self.spans), np.int64)
        for node in reversed(range(len(self.spans))):
            (low, high), (first, last) = self.spans[node], self.children[node]
            if first == last:
                found, counts = self.terms[self.at[low] : self.at[high]], self.counts[self.at[low] : self.at[high]]
            else:
                found, counts = (np.concatenate([largest[i][j] for i in range(first, last)]) for j in (0, 1))
            order = np.argsort(found, kind="stable")
            found, counts = found[order], counts[order]
            heads = np.nonzero(np.diff(found, prepend=-1))[0]
            largest[node] = found[heads], np.maximum.reduceat(counts, heads)
            least[node] = self.m[low:high].min()
        self.node_at = np.concatenate(([0], np.cumsum([len(t) for t, _ in largest]))).astype(np.int64)
        self.node_terms = np.concatenate([t for t, _ in largest])
        self.node_gains = saturated(np.concatenate([c for _, c in largest]), np.repeat(least, np.diff(self.node_at)))

    def search(self, weights: np.ndarray, best: Best) -> int:
        """Offer all documents that may be among the best for an item, given as a weight for each rank. Returns how many
        documents were scored."""
        stack, scored = [(NO_ID, 0)], 0
        while stack:
            bound, node = stack.pop()
            if bound < best.bar:
                continue
            first, last = self.children[node]
            if first < last:
                bounds = _sums(weights, self.node_terms, self.node_gains, self.node_at, first, last)
                order = np.argsort(bounds, kind="stable")
                bar = best.bar
                stack += [(int(bounds[i]), first + int(i)) for i in order if bounds[i] >= bar]
                continue
            low, high = self.spans[node]
            scores = _sums(weights, self.terms, self.gains, self.at, low, high)
            scored += high - low
            for i in np.nonzero(scores >= best.bar)[0]:
                for doc_id in self.ids[low + i]:
                    best.offer(int(scores[i]), doc_id)
        return scored


def _sums(weights: np.ndarray, terms: np.ndarray, gains: np.ndarray, at: np.ndarray, low: int, high: int) -> np.ndarray:
    """For rows low to high of entries terms[at[i]:at[i + 1]]: the sum of weight times gain. No row is empty."""
    a, b = at[low], at[high]
    return np.add.reduceat(weights[terms[a:b]] * gains[a:b], at[low:high] - a)


def vectors(docs: DataFrame, vocabulary: list[bytes], text: str, id_col: str) -> DataFrame:
    """`doc_id`, `n` (terms of the whole text), `terms` (places in the vocabulary) and `tfs` of every row with a term."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        for batch in batches:
            ids, lengths, found, counts = [], [], [], []
            for doc_id, t in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                words = terms(t.as_py())
                if words:
                    own = Counter(filter(place.__contains__, words))
                    ids.append(doc_id.as_py())
                    lengths.append(len(words))
                    found.append([place[w] for w in own])
                    counts.append(list(own.values()))
            columns = [
                pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()),
                pa.array(found, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(each, "doc_id long, n long, terms array<int>, tfs array<int>")


def statistics(rows: DataFrame, size: int) -> Corpus:
    """N, L and the document frequencies, over all vectors; one row per term of the block comes to the driver."""
    total = rows.agg(F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_terms")).first()
    df = np.zeros(size, np.int64)
    counts = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    for term, n in counts.collect():
        df[term] = n
    weights = np.array([weight(int(n), total["n_docs"]) for n in df], np.int64)
    ranks = np.empty(size, np.int64)
    ranks[np.argsort(-df, kind="stable")] = np.arange(size)
    return Corpus(total["n_docs"], total["n_terms"], weights, ranks)


def _searched(rows: DataFrame, items: Items, corpus: Corpus, k: int, floors: dict[int, tuple[int, int]], tree_entries: int) -> DataFrame:
    """Per task and item the k best rows that are as good as the item's floor: `item`, `doc_id`, `score`."""
    shared = rows.sparkSession.sparkContext.broadcast((items, corpus, floors))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, corpus, floors = shared.value
        best = [Best(k, floors.get(i, (1, -NO_ID))) for i in range(len(items.ids))]
        same: dict[bytes, tuple[np.ndarray, np.ndarray, int, list[int]]] = {}
        entries = 0

        def flush() -> None:
            if same:
                tree = Tree([(r, c, n, [-i for i in ids]) for r, c, n, ids in same.values()], corpus)
                weights = np.zeros(len(items.vocabulary), np.int64)
                for own, found in zip(items.terms, best, strict=True):
                    weights[corpus.ranks[own]] = corpus.weights[own]
                    tree.search(weights, found)
                    weights[corpus.ranks[own]] = 0
            same.clear()

        for batch in batches:
            lists, tfs = batch.column("terms"), batch.column("tfs")
            at, tf_at, counts = lists.offsets.to_numpy(), tfs.offsets.to_numpy(), tfs.values.to_numpy()
            ranks = corpus.ranks[lists.values.to_numpy()]
            for i, (doc_id, n) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("n").to_pylist(), strict=True)):
                a, b = at[i], at[i + 1]
                if a == b:
                    continue
                order = np.argsort(ranks[a:b])
                own, tf = ranks[a:b][order], counts[tf_at[i] : tf_at[i + 1]][order]
                key = n.to_bytes(8) + own.astype(np.int32).tobytes() + tf.astype(np.int32).tobytes()
                known = same.get(key)
                if known is None:
                    known = same[key] = (own, tf, n, [])
                    entries += b - a
                # The k smallest ids, negative in a heap.
                doc_id = -(NO_ID if doc_id is None else doc_id)
                if len(known[3]) < k:
                    heapq.heappush(known[3], doc_id)
                else:
                    heapq.heappushpop(known[3], doc_id)
                if entries >= tree_entries:
                    flush()
                    entries = 0
        flush()
        for item, found in enumerate(best):
            if found.heap:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item] * len(found.heap), pa.int64()),
                        pa.array([None if -i == NO_ID else -i for _, i in found.heap], pa.int64()),
                        pa.array([s for s, _ in found.heap], pa.int64()),
                    ],
                    ["item", "doc_id", "score"],
                )

    return rows.mapInArrow(each, "item long, doc_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item, ranked. Each task keeps its own k before the shuffle."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    text: str = "text",
    id_col: str = "doc_id",
    item_col: str = "item_id",
    block_terms: int = BLOCK_TERMS,
    tree_entries: int = TREE_ENTRIES,
    ahead: int = AHEAD,
) -> DataFrame:
    """`item_id`, `rank`, `doc_id` and `score` of each item's k best documents; the module says how. Ids of documents
    are whole numbers."""
    spark = docs.sparkSession
    kind = items.schema[item_col].dataType.simpleString()
    given = items.select(F.col(item_col).alias("item_id"), F.col(text).alias("text")).toLocalIterator()
    ranked = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in item_blocks(((r["item_id"], set(terms(r["text"]))) for r in given), block_terms):
        rows = materialise(vectors(docs, block.vocabulary, text, id_col), "search-vectors")
        corpus = statistics(rows, len(block.vocabulary))
        if not corpus.n_docs:
            break
        tasks = -(-corpus.n_docs // TASK_DOCS)
        if scan_tasks(rows) < tasks:
            # Vectors are small in bytes for the work they make.
            rows = rows.repartition(tasks)
        first = rows.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(ahead)) == 0)
        last = _top(_searched(first, block, corpus, k, {}, tree_entries), k).filter(F.col("rank") == k)
        floors = {r["item"]: (r["score"], -(NO_ID if r["doc_id"] is None else r["doc_id"])) for r in last.collect()}
        found = _top(_searched(rows, block, corpus, k, floors, tree_entries), k)
        ids = spark.createDataFrame(list(enumerate(block.ids)), f"item long, item_id {kind}")
        ranked = ranked.unionAll(found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"))
    return ranked
