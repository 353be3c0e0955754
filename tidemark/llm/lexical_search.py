"""The documents that rank highest for each item, found by a dual tree.

Each document is a vector with one coordinate per term, what that term adds to
its score; an item is the set of its terms.  Documents in a batch form a tree,
and so do all items: a node of documents holds the highest value of each
coordinate below it, a node of items the terms of all items below it.  The sum
of the one over the terms of the other is a bound for every pair below the two
nodes.  Where it stays under the weakest kth score of the node's items, the
whole batch of pairs is left out; otherwise the walk goes on, through the items
first, then through the documents, down to exact scores.  A bound equal to the
kth score is followed, as a smaller id may win the tie: no pair is lost.

1. Distinct item texts are dealt to blocks of about ``BLOCK_BYTES``, so what is
   sent to the workers is bounded; blocks are worked on one after another, with
   the same statistics of the corpus.
2. One pass over the documents gives each one's length and the occurrences of
   the block's terms, stored; document frequencies are counted from it.
3. About ``PILOT_DOCUMENTS`` documents are searched first.  The kth score of an
   item among them is not above its kth score among all, so it is a floor that
   lets the search of all documents leave out most batches and emit few rows.
4. Every task keeps k documents per item, and Spark ranks what the tasks found.

Scores are 64-bit integers: a term's weight is ``floor(1000 ln((2N+2)/(2df+1)))``
and adds ``weight * (10^9 tf div (1000 tf + 8m))`` with ``m = 10 + 90 n N div L``,
where N documents have a term, L is the number of all their terms, n that of the
document.

Null and empty texts, and texts without a term, match nothing, so items of that
kind have no rows.  Each row of the items is ranked, also where a text or an id
repeats; repeated documents are ranked each; a document without an id comes
after those with equal scores; an empty table gives an empty result.  Other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import lean, stored

K = 10
#: Bytes of item texts whose index is sent to the workers at once.
BLOCK_BYTES = 8 << 20
PILOT_DOCUMENTS = 20_000
#: Documents in a tree, in a leaf of it, and below a node of the next levels.
TREE, LEAF, FAN = 1024, 16, 4
#: Most coordinates of the documents in one tree.
CELLS = 1 << 22

# Letters A-Z in lower case; ASCII characters but letters and digits separate terms.
_FOLD = bytes(
    code + 32 if 65 <= code <= 90 else code if 48 <= code <= 57 or 97 <= code <= 122 or code > 127 else 32 for code in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


class Items:
    """A block of item texts: their terms, and which terms each of them has."""

    def __init__(self, texts: list[str]):
        found = [(hashlib.md5(text.encode()).hexdigest(), sorted(set(terms_of(text)))) for text in texts]
        found = [each for each in found if each[1]]
        self.digests = [digest for digest, _ in found]
        self.number = {term: at for at, term in enumerate(sorted({term for _, terms in found for term in terms}))}
        self.terms = [np.array([self.number[term] for term in terms]) for _, terms in found]

    def vector(self, text: str | None) -> tuple[int, list[int], list[int]]:
        """(terms with repeats, numbers of the known ones, their occurrences)."""
        words = terms_of(text)
        seen = Counter(filter(lambda at: at is not None, map(self.number.get, words)))
        return len(words), list(seen), list(seen.values())


class ItemTree:
    """Items in an order that puts those with common frequent terms side by side;
    ``nodes`` are (first, end, terms, children), the root last."""

    def __init__(self, terms: list[np.ndarray], frequency: np.ndarray):
        rank = np.empty(len(frequency), np.int64)
        rank[np.argsort(-frequency, kind="stable")] = np.arange(len(frequency))
        self.order = sorted(range(len(terms)), key=lambda at: sorted(rank[terms[at]].tolist()))
        self.nodes: list[tuple[int, int, np.ndarray, list[int]]] = [(at, at + 1, terms[item], []) for at, item in enumerate(self.order)]
        level = list(range(len(self.nodes)))
        while len(level) > 1:
            above = []
            for at in range(0, len(level), FAN):
                children = level[at : at + FAN]
                union = np.unique(np.concatenate([self.nodes[child][2] for child in children]))
                self.nodes.append((self.nodes[children[0]][0], self.nodes[children[-1]][1], union, children))
                above.append(len(self.nodes) - 1)
            level = above


class DocumentTree:
    """Coordinates of a batch of documents, and their maxima level by level."""

    def __init__(self, ids: list[int | None], rows: np.ndarray, terms: np.ndarray, values: np.ndarray, width: int):
        """``rows`` ascends: document, term and value of each coordinate."""
        size = len(ids)
        self.present, columns = np.unique(terms, return_inverse=True)
        self.column = np.full(width + 1, -1)
        self.column[self.present] = np.arange(len(self.present))
        # Documents with the same leading term lie together.
        leading = np.full(size, width)
        by_value = np.lexsort((values, rows))
        last = np.append(np.flatnonzero(np.diff(rows[by_value])), len(rows) - 1) if len(rows) else np.zeros(0, np.int64)
        leading[rows[by_value[last]]] = terms[by_value[last]]
        order = np.argsort(leading, kind="stable")
        self.ids = [ids[at] for at in order]
        place = np.empty(size, np.int64)
        place[order] = np.arange(size)
        leaves = -(-size // LEAF)
        grid = np.zeros((leaves * LEAF, len(self.present)), np.int64)
        grid[place[rows], columns] = values
        self.size, self.levels = size, [grid]
        fan = LEAF
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            missing = -len(below) % fan
            if missing:
                below = np.concatenate([below, np.zeros((missing, below.shape[1]), np.int64)])
            self.levels.append(below.reshape(len(below) // fan, fan, -1).max(axis=1))
            fan = FAN

    def columns(self, terms: np.ndarray) -> np.ndarray:
        found = self.column[terms]
        return found[found >= 0]

    def below(self, nodes: np.ndarray, level: int) -> np.ndarray:
        """The nodes of level ``level - 1`` below nodes of ``level``."""
        fan = LEAF if level == 1 else FAN
        children = (nodes[:, None] * fan + np.arange(fan)).ravel()
        return children[children < (self.size if level == 1 else len(self.levels[level - 1]))]


class Search:
    """The best k documents of each item among all those shown."""

    def __init__(self, tree: ItemTree, width: int, k: int, floor: np.ndarray):
        self.tree, self.width, self.k = tree, width, k
        self.floor = np.maximum(floor[tree.order], 1)
        self.kth = self.floor.copy()
        self.best: list[list[tuple[int, bool, int]]] = [[] for _ in tree.order]  # (-score, no id, id), best first

    def show(self, ids: list[int | None], rows: np.ndarray, terms: np.ndarray, values: np.ndarray) -> None:
        if not len(rows) or not self.tree.nodes:
            return
        if len(ids) > 1 and (len(ids) > TREE or len(ids) * min(self.width, len(rows)) > CELLS and len(ids) * len(np.unique(terms)) > CELLS):
            middle = len(ids) // 2
            cut = np.searchsorted(rows, middle)
            self.show(ids[:middle], rows[:cut], terms[:cut], values[:cut])
            self.show(ids[middle:], rows[cut:] - middle, terms[cut:], values[cut:])
            return
        docs = DocumentTree(ids, rows, terms, values, self.width)
        top = len(docs.levels) - 1
        waiting = [(len(self.tree.nodes) - 1, top, np.arange(len(docs.levels[top])))]
        while waiting:
            node, level, places = waiting.pop()
            first, end, own, children = self.tree.nodes[node]
            columns = docs.columns(own)
            if not len(columns):
                continue
            bounds = docs.levels[level][np.ix_(places, columns)].sum(axis=1)
            near = bounds >= self.kth[first:end].min()
            if not near.any():
                continue
            places = places[near]
            if level == 0:  # documents themselves: the bounds are scores
                self._take(first, [docs.ids[at] for at in places], bounds[near])
            elif children:
                waiting += [(child, level, places) for child in children]
            else:
                waiting.append((node, level - 1, docs.below(places, level)))

    def _take(self, item: int, ids: list[int | None], scores: np.ndarray) -> None:
        found = [(-score, each is None, each or 0) for score, each in zip(scores.tolist(), ids)]
        self.best[item] = sorted(self.best[item] + found)[: self.k]
        if len(self.best[item]) == self.k:
            self.kth[item] = max(self.floor[item], -self.best[item][-1][0])

    def found(self) -> Iterator[tuple[int, int | None, int]]:
        """(item, id, score)"""
        for at, item in enumerate(self.tree.order):
            for negative, missing, each in self.best[at]:
                yield item, None if missing else each, -negative


def weights_of(frequency: np.ndarray, documents: int) -> np.ndarray:
    """The weight of each term, by the documents that have it."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * seen + 1))) for seen in frequency.tolist()], np.int64)


def _values(weights: np.ndarray, terms: np.ndarray, seen: np.ndarray, lengths: list[int], documents: int, total: int) -> np.ndarray:
    """What each occurrence count adds, given the length of its document."""
    slow = {n: 10 + 90 * n * documents // total for n in set(lengths)}
    m = np.array([slow[n] for n in lengths], np.int64)
    return weights[terms] * (1_000_000_000 * seen // (1000 * seen + 8 * m))


def _vectors(docs: DataFrame, items, key: str, text: str) -> DataFrame:
    """(doc_id, n, terms, seen): length and known terms of every document with a term."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = items.value
        for batch in batches:
            rows = [(at, *known.vector(each)) for at, each in enumerate(batch.column(1).to_pylist())]
            rows = [row for row in rows if row[1]]
            at, n, terms, seen = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())),
                    pa.array(n, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(seen, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "terms", "seen"],
            )

    chosen = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(lean(run), f"doc_id {kind}, n bigint, terms array<int>, seen array<bigint>")


def _searched(vectors: DataFrame, shared, k: int) -> DataFrame:
    """(item, doc_id, score): the best k of each task, and of all tasks together.
    ``shared``: (terms of each item, document frequencies, documents, total, floors)."""
    kind = vectors.schema["doc_id"].dataType
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, frequency, documents, total, floor = shared.value
        weights = weights_of(frequency, documents)
        search = Search(ItemTree(items, frequency), len(frequency), k, floor)
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            terms, seen = lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy()
            lengths = np.repeat(batch.column(1).to_numpy(), sizes).tolist()
            rows = np.repeat(np.arange(batch.num_rows), sizes)
            values = _values(weights, terms, seen, lengths, documents, total)
            search.show(batch.column(0).to_pylist(), rows, terms, values)
        found = list(search.found())
        item, ids, score = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, arrow), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())])
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = vectors.where(F.size("terms") > 0).select("doc_id", "n", "terms", "seen").mapInArrow(lean(run), schema)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(docs: DataFrame, texts: list[str], key: str, text: str, k: int) -> DataFrame:
    """(digest, doc_id, score, rank) for one block of item texts, stored."""
    context = docs.sparkSession.sparkContext
    items = Items(texts)
    known = context.broadcast(items)
    vectors = stored(_vectors(docs, known, key, text))
    known.destroy()
    documents, total = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = np.zeros(len(items.number), np.int64)
    for term, seen in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[term] = seen  # one row for each term of the block at most
    floor = np.zeros(len(items.terms), np.int64)
    parts = documents // PILOT_DOCUMENTS
    if parts > 1:
        pilot = context.broadcast((items.terms, frequency, documents, total, floor))
        few = _searched(vectors.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(parts)) == 0), pilot, k)
        for item, score in few.where(F.col("rank") == k).select("item", "score").collect():
            floor[item] = score  # one row for each item of the block at most
        pilot.destroy()
    shared = context.broadcast((items.terms, frequency, documents, total, floor))
    digests = docs.sparkSession.createDataFrame(list(enumerate(items.digests)), "item int, digest string")
    result = stored(_searched(vectors, shared, k).join(digests, "item").select("digest", "doc_id", "score", "rank"))
    shared.destroy()
    return result


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    k: int = K,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents of each
    item row, fewer where fewer score above 0.  Runs jobs for each block."""
    spark = docs.sparkSession
    distinct = items.select(F.col(item_text).alias("text")).where(F.length("text") > 0).distinct()
    size = distinct.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    found = None
    for block in range(blocks):
        mine = distinct.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        texts = sorted(row.text for row in mine.collect())  # bounded: about BLOCK_BYTES
        ranked = _block(docs, texts, key, text, k)
        found = ranked if found is None else found.unionByName(ranked)
    named = items.select(F.col(item_key).alias("item_id"), F.md5(F.col(item_text).cast("binary")).alias("digest"))
    return named.join(found, "digest").select("item_id", "rank", "doc_id", "score")


def sql(k: int = K) -> str:
    """The same in DuckDB SQL over ``documents`` and ``benchmark`` (unique ids)."""

    def terms(table: str, key: str) -> str:
        lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return f"SELECT {key}, unnest(regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM {table}"

    return f"""
WITH words AS ({terms("documents", "doc_id")}),
item_terms AS (SELECT DISTINCT item_id, term FROM ({terms("benchmark", "item_id")})),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS N_docs, sum(n)::BIGINT AS L FROM lengths),
seen AS (SELECT doc_id, term, count(*) AS tf FROM words SEMI JOIN item_terms USING (term) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * N_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM seen GROUP BY term), totals
),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * N_docs) // L))))::BIGINT AS score
  FROM item_terms JOIN seen USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= {k}"""
