"""Quality rules: repetition and length, then divergence from language references.

Built from DataFrame functions only; everything about a document is computed
inside its own row, so the only shuffle is the one that adds up the references
(four rows per task).

* Base: word and symbol counts, repeated lines, words in repeated three-word
  windows.  A document fails with fewer than ``LEAST_WORDS`` words, or when more
  than half of its words lie in repeated windows.
* Divergence: a document's histogram of character classes, and that of its
  language's commonest words (with a slot for all other words), are compared to
  the same histograms added up over all documents of that language.  The Jensen-Shannon distance (base 2, from 0
  to 1) must not exceed a limit.  Short documents give noisy histograms, so each
  comparison needs a minimum length and is passed below it.

A document in a language without a reference, or without one at all (null),
passes the divergence rules.  Null and empty texts have no words and fail the
base rule.  Repeated rows are judged each; an empty table gives an empty result.
Columns of the documents pass through, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
#: Characters and words that a histogram needs before it is compared.
LEAST_CHARACTERS = 250
LEAST_COMPARED_WORDS = 100
#: Largest Jensen-Shannon distances of a kept document.
MOST_CLASS_DISTANCE = 0.30
MOST_WORD_DISTANCE = 0.245

# Character classes as members of a regular expression; what is in none of them is the last class ("other").
CHARACTER_CLASSES = {
    "lower": "a-z",
    "space": "\\x20\\x09-\\x0D",
    "upper": "A-Z",
    "digit": "0-9",
    "stop": ".,;:!?'\"()\\-",
    "symbol": "#*$%&|<>+=/\\\\@^_`~\\[\\]{}",
}

# Frequent function words by language.
COMMON_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "ist", "ein"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "with", "on"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un"],
    "fr": ["de", "la", "le", "les", "et", "des", "en", "un", "du", "une", "que", "est"],
}
WORD_SLOTS = 13


def _without(text: Column, characters: str) -> Column:
    """``text`` less all of the given ASCII characters (no letters or digits)."""
    return F.regexp_replace(text, f"[{''.join(f'\\x{ord(each):02x}' for each in characters)}]+", "")


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    (all long) and the histograms ``classes`` and ``common`` (arrays of long)."""
    separators = "\\x20\\x09-\\x0D"
    content = F.col("_text")
    words = F.btrim(content, F.lit(SPACES))
    # Each class is taken out of what the classes before it have left.
    rests = [content]
    staged = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    for name, members in CHARACTER_CLASSES.items():
        staged = staged.withColumn(f"_less_{name}", F.regexp_replace(rests[-1], f"[{members}]+", ""))
        rests.append(F.col(f"_less_{name}"))
    lengths = [F.length(rest) for rest in rests]
    classes = [larger - smaller for larger, smaller in zip(lengths, lengths[1:])] + lengths[-1:]
    space = list(CHARACTER_CLASSES).index("space")
    step_1 = staged.select(
        *docs.columns,
        "_text",
        F.when(words != "", F.split(words, f"[{separators}]+", -1)).otherwise(F.array().cast("array<string>")).alias("_words"),
        F.filter(F.split(content, "\n", -1), lambda line: line.rlike(f"[^{separators}]")).alias("_lines"),
        F.array(*[each.cast("long") for each in classes]).alias("classes"),
        (F.length("_less_stop") - F.length(_without(F.col("_less_stop"), SYMBOLS))).cast("long").alias("n_symbols"),
    )
    # Common words stay, each between two spaces of its own, so that counting one is removing it.
    vocabulary = reduce(
        lambda rest, item: F.when(F.col("lang") == item[0], F.array(*map(F.lit, item[1]))).otherwise(rest),
        COMMON_WORDS.items(),
        F.lit(None).cast("array<string>"),
    )
    every = sorted({word for words in COMMON_WORDS.values() for word in words})
    plain = F.split(F.lower(content), f"[{separators}.,;:!?]+", -1)
    kept = F.concat(F.lit("  "), F.array_join(F.filter(plain, lambda word: word.isin(every)), "  "), F.lit("  "))
    step_2 = step_1.select(
        "*",
        (F.aggregate("classes", F.lit(0).cast("long"), lambda total, n: total + n) - F.col("classes")[space]).alias("word_chars"),
        F.size("_words").cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "CASE WHEN size(_words) >= 4 THEN transform(sequence(1, size(_words) - 2), "
            "i -> xxhash64(_words[i - 1], _words[i], _words[i + 1])) ELSE array() END"
        ).alias("_windows"),
        vocabulary.alias("_vocabulary"),
        kept.alias("_common"),
    ).drop("_words", "_lines", "_text")
    step_3 = step_2.select(
        "*",
        (F.size("_windows") != F.size(F.array_distinct("_windows"))).alias("_repeats"),
        F.expr(
            "transform(_vocabulary, word -> cast((length(_common) - length(replace(_common, concat(' ', word, ' '), '')))"
            " / (length(word) + 2) as bigint))"
        ).alias("_seen"),
    ).drop("_vocabulary", "_common")
    step_3 = step_3.withColumn(
        "common", F.expr("concat(_seen, array(greatest(0L, n_words - aggregate(_seen, 0L, (s, n) -> s + n))))")
    ).drop("_seen")
    # Windows by value, then the places of those that have an equal neighbour.
    step_4 = step_3.withColumn(
        "_sorted",
        F.expr("CASE WHEN _repeats THEN array_sort(transform(_windows, (h, i) -> struct(h, i))) ELSE array() END"),
    ).drop("_windows", "_repeats")
    step_5 = step_4.withColumn(
        "_places",
        F.expr(
            "array_sort(transform(filter(_sorted, (x, i) -> "
            "(i > 0 AND _sorted[greatest(i, 1) - 1].h = x.h) OR "
            "(i < size(_sorted) - 1 AND _sorted[least(i + 1, size(_sorted) - 1)].h = x.h)), x -> x.i))"
        ),
    ).drop("_sorted")
    # A window adds three words, less what the next one covers as well.
    return step_5.withColumn(
        "n_repeat_words",
        F.expr(
            "aggregate(transform(_places, (p, i) -> "
            "least(3, coalesce(_places[least(i + 1, size(_places) - 1)] - p, 3) + CASE WHEN i = size(_places) - 1 THEN 3 ELSE 0 END)),"
            " 0L, (total, n) -> total + n)"
        ),
    ).drop("_places")


def _distance(own: str, reference: str) -> Column:
    """Jensen-Shannon distance of two histograms; null where one is empty."""
    return F.expr(
        f"sqrt(greatest(0.0D, aggregate(zip_with({own}, {reference}, (a, b) -> struct("
        f"a / nullif(aggregate({own}, 0L, (s, n) -> s + n), 0) AS p, b / nullif(aggregate({reference}, 0L, (s, n) -> s + n), 0) AS q)), 0.0D,"
        " (s, x) -> s + CASE WHEN x.p > 0 THEN x.p * log2(2 * x.p / (x.p + x.q)) ELSE CASE WHEN x.p = 0 THEN 0.0D END END"
        " + CASE WHEN x.q > 0 THEN x.q * log2(2 * x.q / (x.p + x.q)) ELSE CASE WHEN x.q = 0 THEN 0.0D END END) / 2))"
    )


def language_references(docs: DataFrame, text: str = "text") -> DataFrame:
    """(lang, reference_classes, reference_common) over all documents: a row per
    language with fixed common words, so at most four."""
    counted = with_counts(docs.where(F.col("lang").isin(*COMMON_WORDS)).select(F.col(text).alias("text"), "lang"))
    sums = {name: [F.sum(F.col(name)[slot]) for slot in range(width)] for name, width in (("classes", len(CHARACTER_CLASSES) + 1), ("common", WORD_SLOTS))}
    return counted.groupBy("lang").agg(*[F.array(*each).alias(f"reference_{name}") for name, each in sums.items()])


ADDED = "n_words word_chars n_symbols n_dup_lines n_repeat_words classes common class_distance word_distance base_failed kept".split()


def _judged(docs: DataFrame, text: str) -> tuple[DataFrame, list[Column]]:
    """The rules' columns beside those of ``docs``, and these under their own names."""
    numbered = [F.col(f"`{name}`").alias(f"_document_{at}") for at, name in enumerate(docs.columns)]
    own = docs.select(*numbered, F.col(text).alias("text"), F.col("lang").alias("lang"))
    compared = (
        with_counts(own)
        .join(F.broadcast(language_references(docs, text)), "lang", "left")
        .withColumn("class_distance", _distance("classes", "reference_classes"))
        .withColumn("word_distance", _distance("common", "reference_common"))
        .withColumn(
            "base_failed",
            (F.col("n_words") < LEAST_WORDS)
            | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")),
        )
    )
    characters = F.expr("aggregate(classes, 0L, (s, n) -> s + n)")
    odd_characters = (characters >= LEAST_CHARACTERS) & (F.col("class_distance") > MOST_CLASS_DISTANCE)
    odd_words = (F.col("n_words") >= LEAST_COMPARED_WORDS) & (F.col("word_distance") > MOST_WORD_DISTANCE)
    verdict = ~F.col("base_failed") & ~F.coalesce(odd_characters, F.lit(False)) & ~F.coalesce(odd_words, F.lit(False))
    named = [F.col(f"_document_{at}").alias(name) for at, name in enumerate(docs.columns)]
    # Filters do not move below a generator: else Spark would push one on the verdict
    # down through the projections and repeat their work wherever a column is used.
    both = F.inline(F.array(F.struct(*ADDED[:-1], verdict.alias(ADDED[-1]))))
    held = [f"_document_{at}" for at in range(len(docs.columns))]
    return compared.select(*held, both), named


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the counts, the histograms, class_distance, word_distance,
    base_failed and kept; a column of ``docs`` with such a name is replaced."""
    rows, named = _judged(docs, text)
    return rows.select(*[column for column, name in zip(named, docs.columns) if name not in ADDED], *ADDED)


def kept_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they are."""
    rows, named = _judged(docs, text)
    return rows.where("kept").select(*named)


def sql() -> str:
    """The same in DuckDB SQL over ``documents`` (unique doc_id)."""
    separators = r"\x20\x09-\x0D"
    members = list(CHARACTER_CLASSES.values())
    less = ", ".join(f"len(regexp_replace(t, '[^{each.replace(chr(39), chr(39) * 2)}]', '', 'g'))" for each in members)
    vocabulary = " ".join(f"WHEN '{lang}' THEN {words!r}" for lang, words in COMMON_WORDS.items())

    def sums(name: str, width: int) -> str:
        return "[" + ", ".join(f"sum({name}[{slot}])" for slot in range(1, width + 1)) + "]"

    def distance(own: str, other: str) -> str:
        p, q = f"({own}[i] / nullif(list_sum({own}), 0))", f"({other}[i] / nullif(list_sum({other}), 0))"
        term = "CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({p} + {q})) ELSE 0 END"
        return (
            f"sqrt(greatest(0, list_sum(list_transform(range(1, len({own}) + 1), lambda i: "
            f"{term.format(a=p, p=p, q=q)} + {term.format(a=q, p=p, q=q)})) / 2))"
        )

    return f"""
WITH texts AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[{separators}]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^{separators}]')) AS lines,
    regexp_split_to_array(lower(coalesce(text, '')), '[{separators}.,;:!?]+') AS plain
  FROM documents
),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM texts)
),
repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM windows WHERE n > 1) GROUP BY doc_id
),
first_counts AS (
  SELECT doc_id, lang, len(words) AS n_words,
    len(regexp_replace(t, '[{separators}]', '', 'g')) AS word_chars,
    len(regexp_replace(t, '[^{SYMBOLS}]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    [{less}] AS known, len(t) AS n_chars,
    list_transform(CASE lang {vocabulary} END, lambda v: len(list_filter(plain, lambda w: w = v))) AS seen
  FROM texts
),
counts AS (
  SELECT *, list_append(known, n_chars - list_sum(known)) AS classes,
    list_append(seen, greatest(0, n_words - list_sum(seen))) AS common
  FROM first_counts
),
refs AS (
  SELECT lang, {sums("classes", len(members) + 1)} AS ref_classes, {sums("common", WORD_SLOTS)} AS ref_common
  FROM counts WHERE seen IS NOT NULL GROUP BY lang
),
judged AS (
  SELECT *, coalesce(n_repeat_words, 0) AS n_rep,
    {distance("classes", "ref_classes")} AS class_distance, {distance("common", "ref_common")} AS word_distance
  FROM counts LEFT JOIN repeated USING (doc_id) LEFT JOIN refs USING (lang)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_rep::BIGINT AS n_repeat_words,
  n_words < {LEAST_WORDS} OR 100 * n_rep > {MOST_REPEATED_PERCENT} * n_words AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_rep > {MOST_REPEATED_PERCENT} * n_words)
    AND NOT coalesce(n_chars >= {LEAST_CHARACTERS} AND class_distance > {MOST_CLASS_DISTANCE}, FALSE)
    AND NOT coalesce(n_words >= {LEAST_COMPARED_WORDS} AND word_distance > {MOST_WORD_DISTANCE}, FALSE) AS kept
FROM judged"""
