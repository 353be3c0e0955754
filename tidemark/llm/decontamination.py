"""Training documents that hold benchmark items.

An inverted index of the items is sent to the workers, and every passage of
every document queries it: windows of ``2 * stride`` words, a stride apart, the
stride being at least the longest item, so that an item quoted anywhere lies
whole in one window.  Scores are BM25, divided by the score an item has with
itself; all items at ``LEAST_SCORE`` or above are retrieved.

Retrieval is block-max WAND over blocks of ``POSTINGS`` items, the same for all
terms.  A passage is first held against the sum of its terms' highest weights.
Terms that cannot reach the limit together need not be looked up: only blocks
of the others can hold a hit.  Those are held against their terms' highest
weights in the block, and where that still reaches the limit, the terms' lists
are walked by pivots.  No item at the limit is missed.  Retrieved items are then verified: the question (all but the
last sentence) and the answer (the last sentence) must both be in the passage,
each by its share of word n-grams.

The index is bounded: items are dealt to blocks of about ``MOST_WORDS`` words,
each an index of its own, and every document is held against every block.  What
scores rest on (number of items, mean and greatest length, items holding a word)
is counted in Spark over all items, so that scores do not depend on the blocks.
Of several blocks the workers hold one at a time: what was found is stored, then
the next block is sent.

Null and empty texts and items without a word match nothing; an item that
occurs twice under different ids is found under both, one without an id under a
null; repeated rows are judged each; an empty table on either side gives an
empty result.  Columns of the
documents pass through, whatever their names.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import lean, passing_tables, stored

#: BM25's usual parameters.
K1, B = 1.2, 0.75
LEAST_SCORE = 0.5
#: Share of n-grams of the question and of the answer that a passage must hold.
LEAST_OVERLAP = 0.6
NGRAM = 3
SHORTEST_STRIDE = 64
#: Items per block.
POSTINGS = 4
#: Words of benchmark items per index.
MOST_WORDS = 4_000_000

LEAKS = "array<struct<item_id:bigint,score:double,question:double,answer:double>>"
_LEAK = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())]))
_BREAKS = bytes(ord(" ") if chr(code) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else code for code in range(256))
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str) -> list[bytes]:
    """Words in lower case, ASCII punctuation taken as white space."""
    return text.lower().encode().translate(_BREAKS).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """An item's last sentence is its answer; of a single sentence, the last third."""
    sentences = [words for words in map(words_of, _SENTENCE.split(text)) if words]
    if len(sentences) > 1:
        return [word for words in sentences[:-1] for word in words], sentences[-1]
    words = sentences[0] if sentences else []
    cut = len(words) - max(1, len(words) // 3)
    return (words[:cut], words[cut:]) if cut else (words, words)


def ngrams(words: list[bytes], size: int = NGRAM) -> set[tuple[bytes, ...]]:
    size = min(size, len(words))
    return {tuple(words[at : at + size]) for at in range(len(words) - size + 1)} if words else set()


class Benchmark(NamedTuple):
    """What scores rest on: items with a word, their mean and greatest number of
    words, and how many hold each word (of a block's words at least)."""

    items: int
    mean: float
    longest: int
    seen: dict[bytes, int]

    @classmethod
    def of(cls, items: list[tuple[int | None, str]]) -> Benchmark:
        words = [each for _, text in items if (each := words_of(text))]
        lengths = [len(each) for each in words]
        seen = Counter(word for each in words for word in set(each))
        return cls(len(words), sum(lengths) / max(1, len(words)), max(lengths, default=0), seen)


class ItemIndex:
    """Normalised BM25 weights by term, in blocks with their highest weight."""

    def __init__(self, items: list[tuple[int | None, str]], least_score: float, whole: Benchmark | None = None):
        whole = whole or Benchmark.of(items)
        items = sorted(items, key=lambda item: (item[0] is not None, item[0] or 0, item[1]))
        counted = [(item_id, text, Counter(words_of(text))) for item_id, text in items]
        counted = [each for each in counted if each[2]]
        self.ids = [item_id for item_id, _, _ in counted]
        self.parts = [question_and_answer(text) for _, text, _ in counted]
        lengths = [sum(words.values()) for _, _, words in counted]
        found = sorted({word for _, _, words in counted for word in words})
        rarity = {word: math.log(1 + (whole.items - whole.seen[word] + 0.5) / (whole.seen[word] + 0.5)) for word in found}
        self.terms = {word: number for number, word in enumerate(found)}
        self.items_of: list[list[int]] = [[] for _ in self.terms]
        self.weights_of: list[list[float]] = [[] for _ in self.terms]
        for item, (_, _, words) in enumerate(counted):
            slow = K1 * (1 - B + B * lengths[item] / whole.mean)
            weights = {word: rarity[word] * seen * (K1 + 1) / (seen + slow) for word, seen in words.items()}
            own = sum(weights.values())
            for word, weight in weights.items():
                self.items_of[self.terms[word]].append(item)
                self.weights_of[self.terms[word]].append(weight / own)
        self.highest = [max(weights) for weights in self.weights_of]
        self.block_highest: list[dict[int, float]] = []
        for items_of, weights_of in zip(self.items_of, self.weights_of):
            blocks: dict[int, float] = {}
            for item, weight in zip(items_of, weights_of):
                blocks[item // POSTINGS] = max(weight, blocks.get(item // POSTINGS, 0.0))
            self.block_highest.append(blocks)
        self.stride = max(SHORTEST_STRIDE, whole.longest)
        self.least = least_score - 1e-9  # sums differ in their last digits

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """(item, score) of all items that reach the limit with these distinct
        terms, given by rising highest weight."""
        reach, sums = 0.0, []
        for term in terms:
            reach += self.highest[term]
            sums.append(reach)
        first = bisect_left(sums, self.least)  # terms before this one cannot reach the limit together
        bounds: dict[int, float] = {}
        for term in terms[first:]:
            for block, weight in self.block_highest[term].items():
                bounds[block] = bounds.get(block, 0.0) + weight
        found = []
        for block, bound in bounds.items():
            for at in range(first - 1, -1, -1):
                if bound + sums[at] < self.least:
                    break
                bound += self.block_highest[terms[at]].get(block, 0.0)
            else:
                if bound >= self.least:
                    found += self._walk(terms, block)
        return found

    def _walk(self, terms: list[int], block: int) -> list[tuple[int, float]]:
        """WAND within a block: lists ordered by their next item, scored at the
        pivot, the first item that the lists up to it can bring to the limit."""
        found, end, cursors = [], (block + 1) * POSTINGS, []
        for term in terms:
            if block in self.block_highest[term]:
                place = bisect_left(self.items_of[term], block * POSTINGS)
                cursors.append([self.items_of[term][place], place, term])
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for item, _, term in cursors:
                bound += self.block_highest[term][block]
                if bound >= self.least:
                    pivot = item
                    break
            if pivot is None:
                return found
            if cursors[0][0] == pivot:
                score = sum(self.weights_of[term][place] for item, place, term in cursors if item == pivot)
                if score >= self.least:
                    found.append((pivot, score))
                pivot += 1
            for cursor in cursors:
                items = self.items_of[cursor[2]]
                while cursor[1] < len(items) and items[cursor[1]] < pivot:
                    cursor[1] += 1
                cursor[0] = items[cursor[1]] if cursor[1] < len(items) else end
            cursors = [cursor for cursor in cursors if cursor[0] < end]
        return found

    def passages(self, words: list[bytes]) -> Iterator[tuple[int, int, list[int]]]:
        """(start, end, distinct terms by rising weight) of the windows whose
        terms' highest weights reach the limit."""
        known = [(at, term) for at, term in enumerate(map(self.terms.get, words)) if term is not None]
        places, terms = [at for at, _ in known], [term for _, term in known]
        for start in range(0, max(1, len(words) - self.stride), self.stride):
            end = min(start + 2 * self.stride, len(words))
            distinct = set(terms[bisect_left(places, start) : bisect_left(places, end)])
            if sum(map(self.highest.__getitem__, distinct)) >= self.least:
                yield start, end, sorted(distinct, key=self.highest.__getitem__)

    def leaks(self, text: str | None, least_overlap: float) -> list[dict]:
        """The verified items of a text, each by its best passage."""
        best: dict[int, dict] = {}
        words = words_of(text) if text else []
        for start, end, terms in self.passages(words) if words else ():
            for item, score in self.search(terms):
                passage = words[start:end]
                question, answer = (
                    len(own & ngrams(passage, min(NGRAM, len(part)))) / len(own)
                    for part in self.parts[item]
                    for own in [ngrams(part)]
                )
                if min(question, answer) >= least_overlap and score > best.get(item, {"score": 0.0})["score"]:
                    best[item] = {"item_id": self.ids[item], "score": score, "question": question, "answer": answer}
        return [best[item] for item in sorted(best)]


def _counted(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    """(item_id, text, n_words, words): items that hold a word, with their distinct words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(each) for each in batch.column("text").to_pylist()]
            added = [pa.array(map(len, words), pa.int64()), pa.array([sorted(set(each)) for each in words], pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=["item_id", "text", "n_words", "words"])

    items = benchmark.select(F.col(key).cast("bigint").alias("item_id"), F.col(text).alias("text")).where("text IS NOT NULL")
    schema = "item_id bigint, text string, n_words bigint, words array<binary>"
    return items.mapInArrow(lean(run), schema).where("n_words > 0")


def item_blocks(
    benchmark: DataFrame, key: str, text: str
) -> tuple[int, Iterator[tuple[list[tuple[int | None, str]], Benchmark]]]:
    """(number of blocks, blocks): the items in blocks of about ``MOST_WORDS`` words, made one at a time as they
    are asked for, each with the statistics of the whole benchmark."""
    items = stored(_counted(benchmark, key, text))
    total = items.agg(F.count(F.lit(1)).alias("items"), F.sum("n_words").alias("words"), F.max("n_words").alias("longest")).first()
    blocks = max(1, -(-(total.words or 0) // MOST_WORDS))
    placed = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int"))
    seen = placed.select("block", F.explode("words").alias("word")).groupBy("word")
    seen = stored(seen.agg(F.count(F.lit(1)).alias("seen"), F.collect_set("block").alias("blocks")))
    mean = (total.words or 0) / max(1, total.items)

    def made() -> Iterator[tuple[list[tuple[int | None, str]], Benchmark]]:
        for block in range(blocks):  # bounded: about MOST_WORDS words each
            mine = [tuple(row) for row in placed.where(F.col("block") == block).select("item_id", "text").collect()]
            words = seen.where(F.array_contains("blocks", block)).select("word", "seen").collect()
            yield mine, Benchmark(total.items, mean, total.longest or 0, {bytes(row.word): row.seen for row in words})

    return blocks, made()


def with_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    column: str = "leaks",
    least_score: float = LEAST_SCORE,
    least_overlap: float = LEAST_OVERLAP,
) -> DataFrame:
    """``docs`` plus ``column``: the verified items of each text, one per item, with score and overlaps."""
    names = [name for name in docs.columns if name != column]
    fields = [field for field in docs.schema.fields if field.name != column]
    schema = T.StructType([*fields, T.StructField(column, T._parse_datatype_string(LEAKS))])

    def searched(rows: DataFrame, items: list, whole: Benchmark) -> tuple[DataFrame, Broadcast]:
        shared = docs.sparkSession.sparkContext.broadcast(ItemIndex(items, least_score, whole))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                before = batch.column(column).to_pylist()
                found = [index.leaks(each, least_overlap) for each in batch.column(text).to_pylist()]
                both = pa.array([(old or []) + new for old, new in zip(before, found)], _LEAK)
                yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in names), both], names=[*names, column])

        return rows.mapInArrow(lean(run), schema), shared

    rows = docs.select(*names).withColumn(column, F.lit(None).cast(LEAKS))
    with passing_tables(docs.sparkSession) as keep:
        blocks, made = item_blocks(benchmark, item_key, item_text)
        for number, (items, whole) in enumerate(made, start=1):
            rows, shared = searched(rows, items, whole)
            if blocks > 1:
                rows = (keep if number == blocks else stored)(rows)
                shared.destroy()
    return rows


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, score, question, answer), one row per leaked item of a document."""
    found = with_leaks(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), benchmark)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` less the documents that hold an item."""
    column = "_leaks"
    return with_leaks(docs, benchmark, text, column=column).where(F.size(column) == 0).drop(column)
