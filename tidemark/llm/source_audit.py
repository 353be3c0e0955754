"""How the sources of a language differ in their words.

Terms are counted per language and source.  Inside a task a batch of texts is
one array of bytes: terms of up to 16 bytes become one or two unsigned 64-bit
words, in buckets by length, each bucket is radix sorted by 16-bit digits and
its runs are counted; longer terms form buckets by size that are sorted as byte
strings.  Spark adds the counts up, keyed by the same packed words.

A language keeps the terms of at least ``LEAST_DOCUMENTS`` of its documents.  A
term's share in a group is ``1 + floor(10^9 (count + 5) / (N + 5 V))``: N counts
the group's kept terms, V is the number of terms the language keeps.  Two
reports come out:

* ``pair``: for each group, every other source of its language, by the sum of
  the absolute differences of their shares.  Only terms that occur in one of the
  two are looked at, the others differ by the same amount each.  Terms are dealt
  to blocks and sources to tiles, so a task holds ``CELLS`` shares at most.
* ``term``: for each group, its terms whose share exceeds the language's, by the
  difference, the ``TOP_TERMS`` largest.

All arithmetic is on whole numbers.  Null texts, languages and sources are read
as empty ones; groups without terms are compared as well; repeated rows count
each, as different documents; a language with no kept term has differences of 0;
an empty table gives an empty result.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import lean, lean_group, stored

LEAST_DOCUMENTS = 30
SMOOTHING, SCALE = 5, 1_000_000_000
TOP_TERMS = 50
#: Bytes of text that are counted at once; a longer text is counted alone.
PIECE_BYTES = 8 << 20
#: Sources in a tile, and shares that a task of the comparison holds.
TILE, CELLS = 256, 1 << 15

TERM = ["hi", "lo", "tail"]
COUNTS = "lang string, source string, hi bigint, lo bigint, tail binary, n bigint, docs bigint"

# A-Z in lower case, other ASCII characters but letters 0; bytes of longer characters stay.
_FOLD = np.array([code + 32 if 65 <= code <= 90 else code if 97 <= code <= 122 or code > 127 else 0 for code in range(256)], np.uint8)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an array of strings without nulls."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(folded bytes with 8 zeros behind them, starts, lengths) of all terms."""
    folded = np.zeros(len(data) + 8, np.uint8)
    folded[: len(data)] = _FOLD[data]
    inside = folded != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1]
    begins[firsts] = inside[firsts]  # a term does not reach over the end of a text
    ends = inside[:-1] & (~inside[1:] | begins[1:])
    starts = np.flatnonzero(begins)
    return folded, starts, np.flatnonzero(ends) + 1 - starts


def radix_order(group: np.ndarray, words: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """The stable order by (last word, …, first word, group): 16 bits a pass from
    the least on, each pass a counting sort.  ``words``: (values, bytes in use)."""
    order = np.argsort(group, kind="stable")
    for word, size in words:
        for shift in range(0, 8 * size, 16):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            order = order[np.argsort(digit[order], kind="stable")]
    return order


def _runs(order: np.ndarray, keys: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of each run's first entry, entries, different documents) in an order
    in which equal keys are adjacent and their documents ascend."""
    fresh = np.ones(len(order), bool)
    fresh[1:] = False
    for key in keys:
        ordered = key[order]
        fresh[1:] |= ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(fresh)
    ordered = doc[order]
    fresh[1:] |= ordered[1:] != ordered[:-1]
    return order[starts], np.diff(np.append(starts, len(order))), np.add.reduceat(fresh.astype(np.int64), starts)


def count_piece(texts: pa.Array, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes] | None, np.ndarray, np.ndarray]]:
    """(group, hi, lo, long terms, entries, documents) of each bucket of a piece."""
    data, offsets = _bytes_of(texts)
    folded, starts, lengths = _terms(data, offsets)
    doc = (np.searchsorted(offsets, starts, side="right") - 1).astype(np.int32)
    window = np.ndarray((len(folded) - 7,), ">u8", folded, strides=(1,))  # eight bytes from each place on
    for least, most in ((1, 2), (3, 4), (5, 6), (7, 8), (9, 10), (11, 12), (13, 14), (15, 16)):
        mine = np.flatnonzero((lengths >= least) & (lengths <= most))
        if not len(mine):
            continue
        start, length, documents = starts[mine], lengths[mine], doc[mine]
        # The last eight bytes are one word, what stands before them is another.
        over = np.maximum(length - 8, 0)
        cut = np.where(over > 0, 8 - over, 8 - length).astype(np.uint64) * np.uint64(8)
        first = window[start].astype(np.uint64) >> cut
        if most <= 8:
            hi, lo = np.zeros(len(mine), np.uint64), first
            words = [(lo, most)]
        else:
            hi, lo = first, window[start + over].astype(np.uint64)
            words = [(lo, 8), (hi, most - 8)]
        groups = group[documents]
        at, entries, seen = _runs(radix_order(groups, words), [groups, *(word for word, _ in words)], documents)
        yield groups[at], hi[at].view(np.int64), lo[at].view(np.int64), None, entries, seen
    raw = None
    most, longest = 16, int(lengths.max(initial=0))
    while most < longest:
        least, most = most + 1, 2 * most
        mine = np.flatnonzero((lengths >= least) & (lengths <= most))
        if not len(mine):
            continue
        raw = folded.tobytes() if raw is None else raw
        groups, documents = group[doc[mine]], doc[mine]
        terms = np.array([raw[start : start + length] for start, length in zip(starts[mine].tolist(), lengths[mine].tolist())], "S")
        order = np.argsort(groups, kind="stable")
        order = order[np.argsort(terms[order], kind="stable")]
        at, entries, seen = _runs(order, [groups, terms], documents)
        none = np.zeros(len(at), np.int64)
        yield groups[at], none, none, terms[at].tolist(), entries, seen


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > PIECE_BYTES:
            yield batch.slice(first, row - first)
            first, held = row, 0
        held += size
    if first < batch.num_rows:
        yield batch.slice(first)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "hi", "lo", "tail", "n", "docs"]
    for batch in batches:
        for piece in _pieces(batch):
            lang, source = (piece.column(at).dictionary_encode() for at in (0, 1))
            both = lang.indices.to_numpy() * np.int64(len(source.dictionary)) + source.indices.to_numpy()
            pairs, group = np.unique(both, return_inverse=True)  # no more groups than rows of a batch
            langs = lang.dictionary.take(pa.array(pairs // len(source.dictionary)))
            sources = source.dictionary.take(pa.array(pairs % len(source.dictionary)))
            for groups, hi, lo, tail, entries, seen in count_piece(piece.column(2), group.astype(np.uint16)):
                at = pa.array(groups.astype(np.int64))
                tails = pa.array(tail or [b""] * len(groups), pa.binary())
                yield pa.RecordBatch.from_arrays([langs.take(at), sources.take(at), pa.array(hi), pa.array(lo), tails, pa.array(entries), pa.array(seen)], names=names)


def _plain(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    named = {"lang": lang, "source": source, "text": text}
    return docs.select(*[F.coalesce(F.col(column), F.lit("")).alias(name) for name, column in named.items()])


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, hi, lo, tail, n, docs): occurrences and documents of each term in each group."""
    counted = _plain(docs, text, lang, source).mapInArrow(lean(_count), COUNTS)
    return counted.groupBy("lang", "source", *TERM).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """Counts of the terms that their language keeps, plus the language's count
    (``total``) and a mark at one row of each of a language's terms (``first``)."""
    term = Window.partitionBy("lang", *TERM)  # at most a row for each source of the language
    known = counts.select(
        "lang",
        "source",
        *TERM,
        "n",
        F.sum("docs").over(term).alias("documents"),
        F.sum("n").over(term).alias("total"),
        (F.col("source") == F.min("source").over(term)).alias("first"),
    )
    return known.where(F.col("documents") >= least_documents).drop("documents")


def group_sizes(docs: DataFrame, kept: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, n_terms, lang_terms, vocabulary, sources, place): a row for
    every group of the documents; place numbers a language's sources from 0 on."""
    groups = _plain(docs, text, lang, source).select("lang", "source").distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_terms"), F.sum(F.col("first").cast("long")).alias("firsts"))
    language = Window.partitionBy("lang")  # one row for each source

    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("long"))

    return groups.join(own, ["lang", "source"], "left").select(
        "lang",
        "source",
        zero("n_terms").alias("n_terms"),
        F.sum(zero("n_terms")).over(language).alias("lang_terms"),
        F.sum(zero("firsts")).over(language).alias("vocabulary"),
        F.count(F.lit(1)).over(language).alias("sources"),
        (F.row_number().over(language.orderBy("source")) - 1).cast("long").alias("place"),
    )


def _share(count: str, size: str) -> Column:
    return F.expr(
        f"1L + ((CAST({count} AS DECIMAL(20, 0)) + {SMOOTHING}) * {SCALE} div nullif({size} + {SMOOTHING} * vocabulary, 0))"
    )


def _differences(tile_size: int, table: pa.Table) -> pa.Table:
    """For one block of terms and two tiles of sources: what the terms add to the
    difference of each two sources, beyond that of terms which neither has."""
    lang, one, other = (table.column(name)[0].as_py() for name in ("lang", "one", "other"))
    is_base = table.column("is_base")
    # Apart, since base rows have no term: numpy gets whole numbers beside nulls as floats, in which words of eight bytes run together.
    known, terms = table.filter(is_base).sort_by("place"), table.filter(pc.invert(is_base))
    places, base = (known.column(name).to_numpy() for name in ("place", "share"))
    place, share, hi, lo = (terms.column(name).to_numpy() for name in ("place", "share", "hi", "lo"))
    tail = terms.column("tail").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    keys = [tail, lo, hi]
    order = np.lexsort(keys)
    fresh = np.zeros(len(order), np.int64)
    for key in keys:
        fresh[1:] |= key[order][1:] != key[order][:-1]
    shares = np.repeat(base[:, None], (fresh.sum() + 1) if len(order) else 0, axis=1)
    shares[np.searchsorted(places, place[order]), np.cumsum(fresh)] = share[order]
    tile = places // tile_size
    rows = np.flatnonzero(tile == other)
    lows, highs, sums = [], [], []
    for row in np.flatnonzero(tile == one):
        against = rows[rows > row]
        lows.append(np.full(len(against), places[row]))
        highs.append(places[against])
        plain = np.abs(base[against] - base[row])
        sums.append(np.abs(shares[against] - shares[row]).sum(axis=1) - plain * shares.shape[1])
    low, high, total = (np.concatenate([*each, np.zeros(0, np.int64)]).astype(np.int64) for each in (lows, highs, sums))
    return pa.table({"lang": pa.array([lang] * len(low), pa.string()), "low": low, "high": high, "added": total})


def pair_differences(kept: DataFrame, groups: DataFrame, tile: int = TILE, cells: int = CELLS) -> DataFrame:
    """(lang, source, item, value) for each group and each other source of its
    language, compared in tiles of ``tile`` sources and about ``cells`` shares."""
    blocks = F.expr(f"greatest(1L, cast(ceil(vocabulary * least(sources, {2 * tile}L) / {cells}D) AS BIGINT))")
    base = groups.withColumn("blocks", blocks).withColumn("base", _share("0", "n_terms"))
    tiles = F.expr(f"sequence(0L, (sources - 1) div {tile})")
    own_tile = F.expr(f"place div {tile}")

    def dealt(rows: DataFrame, block: Column, share: Column, is_base: bool, term: list[Column]) -> DataFrame:
        """Every row to the pairs of tiles that its source is in."""
        spread = rows.select(
            "lang",
            "place",
            block.alias("block"),
            share.alias("share"),
            F.explode(tiles).alias("tile"),
            own_tile.alias("own"),
            F.lit(is_base).alias("is_base"),
            *term,
        )
        pair = [F.least("own", "tile").alias("one"), F.greatest("own", "tile").alias("other")]
        return spread.select("lang", "block", *pair, "place", "share", "is_base", *TERM)

    no_term = [F.lit(None).cast(kind).alias(name) for name, kind in zip(TERM, ("long", "long", "binary"))]
    # A language without a vocabulary has no shares; all differences are 0.
    numbered = base.withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
    sources = dealt(numbered, F.col("block"), F.coalesce("base", F.lit(0).cast("long")), True, no_term)
    terms = dealt(
        kept.join(base, ["lang", "source"]), F.expr("pmod(xxhash64(hi, lo, tail), blocks)"), _share("n", "n_terms"), False, [F.col(name) for name in TERM]
    )
    added = (
        sources.unionByName(terms)
        .groupBy("lang", "block", "one", "other")
        .applyInArrow(lean_group(partial(_differences, tile)), "lang string, low bigint, high bigint, added bigint")
        .groupBy("lang", "low", "high")
        .agg(F.sum("added").alias("added"))
    )
    names = base.select("lang", "source", "place", "base", "vocabulary")
    low = names.select("lang", F.col("source").alias("low_source"), F.col("place").alias("low"), F.col("base").alias("low_base"), "vocabulary")
    high = names.select("lang", F.col("source").alias("high_source"), F.col("place").alias("high"), F.col("base").alias("high_base"))
    value = F.coalesce(F.col("added") + F.col("vocabulary") * F.abs(F.col("low_base") - F.col("high_base")), F.lit(0).cast("long"))
    pairs = added.join(low, ["lang", "low"]).join(high, ["lang", "high"]).withColumn("value", value)
    both = F.array(
        F.struct(F.col("low_source").alias("source"), F.col("high_source").alias("item")),
        F.struct(F.col("high_source").alias("source"), F.col("low_source").alias("item")),
    )
    return pairs.select("lang", "value", F.inline(both)).select("lang", "source", "item", "value")


def leading_terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each group and each term that it uses more than its language."""
    letters = F.expr(
        "CASE WHEN length(tail) > 0 THEN cast(tail AS string) "
        "ELSE cast(unhex(concat(CASE WHEN hi = 0 THEN '' ELSE hex(hi) END, hex(lo))) AS string) END"
    )
    more = _share("n", "n_terms") - _share("total", "lang_terms")
    return (
        kept.join(groups, ["lang", "source"])
        .select("lang", "source", letters.alias("item"), more.alias("value"))
        .where(F.col("value") > 0)
    )


def divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """Both reports: (lang, source, part, item, value, rank), ranked per group and
    part by falling value, then item.  Runs jobs: counts and groups are stored."""
    kept = stored(kept_terms(term_counts(docs, text, lang, source), least_documents))
    groups = stored(group_sizes(docs, kept, text, lang, source))

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    terms = ranked(leading_terms(kept, groups), "term").where(F.col("rank") <= top_terms)
    return ranked(pair_differences(kept, groups), "pair").unionByName(terms)


def sql(least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS) -> str:
    """The same in DuckDB SQL over ``documents``."""

    def share(count: str, size: str) -> str:
        return f"1 + (({count} + {SMOOTHING})::HUGEINT * {SCALE}) // ({size} + {SMOOTHING} * V)"

    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS number, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
),
terms AS (
  SELECT number, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM texts
),
kept AS (SELECT lang, term, count(*) AS total FROM terms GROUP BY ALL HAVING count(DISTINCT number) >= {least_documents}),
vocabularies AS (SELECT lang, count(*) AS V, sum(total) AS lang_n FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, source, sum(n) AS group_n FROM counts GROUP BY ALL),
groups AS (
  SELECT lang, source, coalesce(group_n, 0) AS group_n, coalesce(V, 0) AS V, coalesce(lang_n, 0) AS lang_n
  FROM (SELECT DISTINCT lang, source FROM texts) LEFT JOIN sizes USING (lang, source) LEFT JOIN vocabularies USING (lang)
),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
    {share("coalesce(n, 0)", "group_n")} AS p, {share("total", "lang_n")} AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
differences AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN differences d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
),
ahead AS (SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT FROM ahead
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {top_terms}"""
