"""Repeated lines: the earliest occurrence stays, the rest go.

Each text is cut into lines (or paragraphs, by another separator).  A unit is
normalised as in SQL (lower case letter by letter, one space between words, all
Unicode spaces off its ends), and its 128-bit digest is grouped over all
documents.  The occurrence with the smallest (document, unit number) is kept;
every other occurrence is removed.  Blank units are kept.  So are those of fewer
than ``least_words`` words between ASCII spaces, which is ``LEAST_WORDS`` unless
given; 1 leaves no unit out, and is what the query uses: a line of Chinese or
Thai is one word, however long.

Only digests are shuffled, and only those met twice come back to the units; the
minimum of a digest is pre-aggregated, and the join that brings it back splits
hot digests.  Offsets are characters of the original text.

Null and empty texts have no units (a null text has no kept text either).
Documents are ranked by id, nulls first, then by a hash of the text; rows equal
in both are one document to the ranking, so that they keep the same units.  An
empty table gives an empty result.  Other columns pass through, whatever their
names, but for ``n_units`` and ``kept_units``, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST_WORDS = 3
#: Unicode's space separators, which SQL's trim takes off.
_SPACES = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
_UNITS = T.ArrayType(T.StructType().add("start", T.LongType()).add("unit", T.StringType()))


def _normal(unit: Column) -> Column:
    # Spark alone lower-cases these two by their place in a word, or to two letters.
    plain = F.replace(F.replace(unit, F.lit("Σ"), F.lit("σ")), F.lit("İ"), F.lit("i"))
    return F.btrim(F.regexp_replace(F.lower(plain), "[\\x20\\x09-\\x0D]+", " "), F.lit(_SPACES))


def units(
    docs: DataFrame, key: str = "doc_id", text: str = "text", separator: str = "\n", least_words: int = LEAST_WORDS
) -> DataFrame:
    """(doc_id, text_hash, unit_no, digest_1, digest_2) of units that count."""
    split = docs.where(F.length(text) > 0).select(
        F.col(key).alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.split(F.col(text), f"\\Q{separator}\\E", -1).alias("parts"),
    )
    rows = split.select("doc_id", "text_hash", F.posexplode("parts").alias("unit_no", "unit"))
    normal = rows.select("doc_id", "text_hash", "unit_no", _normal(F.col("unit")).alias("normal"))
    spaces = F.length("normal") - F.length(F.replace("normal", F.lit(" "), F.lit("")))
    return normal.where((F.col("normal") != "") & (spaces >= least_words - 1)).select(
        "doc_id",
        "text_hash",
        "unit_no",
        F.xxhash64("normal").alias("digest_1"),
        F.xxhash64(F.lit(1), "normal").alias("digest_2"),
    )


def removed_units(
    docs: DataFrame, key: str = "doc_id", text: str = "text", separator: str = "\n", least_words: int = LEAST_WORDS
) -> DataFrame:
    """(doc_id, text_hash, removed): sorted numbers of the units to remove."""
    counted = units(docs, key, text, separator, least_words)
    digest = ["digest_1", "digest_2"]
    place = F.struct("doc_id", "text_hash", "unit_no")
    repeated = counted.groupBy(*digest).agg(F.min(place).alias("kept"), F.max(place).alias("latest")).where("kept != latest")
    later = counted.join(repeated.select(*digest, "kept"), digest).where(place != F.col("kept"))
    return later.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("unit_no")).alias("removed"))


def without_repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", separator: str = "\n", least_words: int = LEAST_WORDS
) -> DataFrame:
    """``docs`` plus ``n_units`` and ``kept_units``: (start, unit) of the units that
    stay, in order, with their character offsets in the original text."""
    clear = docs.drop("kept_units", "n_units")
    removed = removed_units(clear, key, text, separator, least_words)
    same = clear[key].eqNullSafe(removed["doc_id"]) & (F.xxhash64(clear[text]) == removed["text_hash"])
    names, numbers_of = clear.columns, "_removed"
    while numbers_of in map(str.lower, names):
        numbers_of += "_"
    joined = clear.join(removed, same, "left").select(*[clear[name] for name in names], removed["removed"].alias(numbers_of))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, numbers = [], []
            for content, gone in zip(batch.column(text).to_pylist(), batch.column(numbers_of).to_pylist()):
                parts = content.split(separator) if content else []
                gone, rows, at = set(gone or ()), [], 0
                for number, part in enumerate(parts):
                    if number not in gone:
                        rows.append({"start": at, "unit": part})
                    at += len(part) + len(separator)
                kept.append(rows)
                numbers.append(len(parts))
            columns = [batch.column(name) for name in names]
            units_kind = pa.list_(pa.struct([("start", pa.int64()), ("unit", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(numbers, pa.int64()), pa.array(kept, units_kind)], names=[*names, "n_units", "kept_units"]
            )

    schema = T.StructType(clear.schema.fields[:])
    schema.add("n_units", T.LongType()).add("kept_units", _UNITS)
    return joined.mapInArrow(run, schema)


def kept_text(separator: str = "\n") -> Column:
    """The kept units of a row put together again."""
    return F.array_join(F.col("kept_units.unit"), separator)


def sql() -> str:
    """What the query returns, in DuckDB SQL over ``documents`` (unique doc_id)."""
    return f"""
WITH parts AS (
  SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE length(text) > 0
),
units AS (
  SELECT doc_id, i AS unit_no, parts[i] AS unit,
    trim(regexp_replace(lower(parts[i]), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS normal
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM parts)
),
ranked AS (
  SELECT *, normal <> '' AND row_number() OVER (PARTITION BY normal ORDER BY doc_id, unit_no) > 1 AS removed
  FROM units
),
kept AS (
  SELECT doc_id, count(*) AS n_units, count(*) FILTER (removed) AS n_removed,
    coalesce(string_agg(unit, chr(10) ORDER BY unit_no) FILTER (NOT removed), '') AS kept
  FROM ranked GROUP BY doc_id
)
SELECT doc_id, coalesce(n_units, 0)::BIGINT AS n_units, coalesce(n_removed, 0)::BIGINT AS n_removed,
  length(coalesce(kept, ''))::BIGINT AS kept_chars, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)"""
