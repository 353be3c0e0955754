"""URL verdicts: explicit rules first, then a ratio of two character models.

Rules name a host and the start of a path; a rule fits its host and all
subdomains, and the longest fitting rule wins.  URLs that no rule fits are
judged by smoothed variable-order Markov models, one of accepted and one of
rejected URLs: the mean log-likelihood difference per character against a
threshold calibrated on held-out URLs.

All given URLs are counted (Spark sums partial n-gram counts).  A context is
kept when it was seen ``LEAST_SEEN`` times, at any size of the input, so the models
grow with it.  Up to ``BROADCAST_ROWS`` counts they are sent to every worker; beyond
that Spark joins the counts with the windows of the different URLs.  The scores
are the same but for the order of the additions.

Null URLs and URLs without ``://`` have an empty host and path, fit no rule and
hold nothing to score: they are allowed.  Repeated rows are judged each.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lean, lower_ascii, stored

ORDER = 5
LEAST_SEEN = 4
#: Counts of kept contexts up to which the models are sent to the workers.
BROADCAST_ROWS = 500_000
#: One URL in this many is held out for the threshold.
HELD_OUT = 5
#: Steps of the score (nats per character) that thresholds are tried at.
STEP = 0.01
#: Context characters before the first; the end is counted as a character, too.
EDGE = "\n"
#: Chance of a character never seen.
UNSEEN = 1 / 65536


def host_and_path(url: Column) -> tuple[Column, Column]:
    host = F.coalesce(lower_ascii(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls where none does.

    ``rules`` are (verdict, "host/path").
    """
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda item: len(item[1])):
        site, _, start = text.partition("/")
        fits = ((host == site) | host.endswith(f".{site}")) & path.startswith(f"/{start}")
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def ngram_counts(urls: DataFrame, label: str = "label", text: str = "address") -> DataFrame:
    """(label, context, next, seen) for contexts of up to ``ORDER`` characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for kind, address in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                padded = EDGE * ORDER + address + EDGE
                for at in range(ORDER, len(padded)):
                    for order in range(ORDER + 1):
                        counts[kind, padded[at - order : at], padded[at]] += 1
            kinds, contexts, nexts = zip(*counts) if counts else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(contexts, pa.string()), pa.array(nexts, pa.string()), pa.array(counts.values(), pa.int64())],
                names=["label", "context", "next", "seen"],
            )

    partial = urls.select(F.col(label), F.col(text)).mapInArrow(lean(run), "label string, context string, next string, seen bigint")
    return partial.groupBy("label", "context", "next").agg(F.sum("seen").alias("seen"))


class MarkovModel:
    """Witten-Bell smoothing: a context shares with the next shorter one in
    proportion to how many different characters followed it."""

    def __init__(self, rows: list[tuple[str, str, int]]):
        self.following: dict[str, dict[str, int]] = {}
        for context, character, seen in rows:
            self.following.setdefault(context, {})[character] = seen
        self.totals = {context: sum(seen.values()) for context, seen in self.following.items()}

    def log_likelihood(self, address: str) -> float:
        padded = EDGE * ORDER + address + EDGE
        total = 0.0
        for at in range(ORDER, len(padded)):
            chance = UNSEEN
            for order in range(ORDER + 1):
                context = padded[at - order : at]
                seen = self.following.get(context)
                if seen is None:
                    break
                kinds, rows = len(seen), self.totals[context]
                chance = (seen.get(padded[at], 0) + kinds * chance) / (rows + kinds)
            total += math.log(chance)
        return total


def kept_counts(urls: DataFrame) -> DataFrame:
    """(label, context, next, seen, rows, kinds) of the contexts kept, from (label,
    address) rows: how often a context was seen, and with how many different
    characters after it.  Runs a job."""
    counts = ngram_counts(urls)
    contexts = counts.groupBy("label", "context").agg(F.sum("seen").alias("rows"), F.count("*").alias("kinds"))
    kept = contexts.where((F.col("rows") >= LEAST_SEEN) | (F.col("context") == ""))
    return stored(counts.join(kept, ["label", "context"]).select("label", "context", "next", "seen", "rows", "kinds"))


def models(counts: DataFrame) -> dict[str, MarkovModel]:
    """Models by label of kept counts.  Collects them."""
    rows: dict[str, list] = {}
    for row in counts.select("label", "context", "next", "seen").collect():
        rows.setdefault(row["label"], []).append((row["context"], row["next"], row["seen"]))
    return {label: MarkovModel(each) for label, each in rows.items()}


def scored(urls: DataFrame, accepted: MarkovModel, rejected: MarkovModel, key: str, text: str = "address") -> DataFrame:
    """(key, address, score): mean log-likelihood difference per character, or 0 for nothing to score."""
    shared = urls.sparkSession.sparkContext.broadcast((accepted, rejected))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = shared.value
        known: dict[str, float] = {"": 0.0}
        for batch in batches:
            for address in set(batch.column(1).to_pylist()) - known.keys():
                known[address] = (good.log_likelihood(address) - bad.log_likelihood(address)) / (len(address) + 1)
            scores = pa.array([known[address] for address in batch.column(1).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), scores], names=[key, "address", "score"])
            known = {"": 0.0}

    kind = urls.schema[key].dataType.simpleString()
    return urls.select(key, text).mapInArrow(lean(run), f"`{key}` {kind}, address string, score double")


def window_chances(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(gram, allow, block): both models' chance of the last character of each window.

    Goes up order by order, over different grams, so that a gram meets no more
    longer ones than there are characters.
    """
    labels = ("allow", "block")

    def beside(keys: list[str], names: list[str]) -> DataFrame:
        values = [F.max(F.when(F.col("label") == label, F.col(name))).alias(f"{label}_{name}") for label in labels for name in names]
        return counts.groupBy(*keys).agg(*values)

    contexts, nexts = beside(["context"], ["rows", "kinds"]), beside(["context", "next"], ["seen"])
    chances = None
    for order in range(ORDER + 1):
        grams = windows.select(F.substring("window", ORDER - order + 1, order + 1).alias("gram")).distinct()
        if chances is None:
            grams = grams.select("gram", *[F.lit(UNSEEN).alias(label) for label in labels])
        else:
            grams = grams.withColumn("shorter", F.substring("gram", 2, order)).join(chances.withColumnRenamed("gram", "shorter"), "shorter")
        grams = grams.withColumn("context", F.substring("gram", 1, order)).withColumn("next", F.substring("gram", order + 1, 1))
        long = F.length("context") == order
        met = grams.join(contexts.where(long), "context", "left").join(nexts.where(long), ["context", "next"], "left")
        chance = {
            label: (F.coalesce(f"{label}_seen", F.lit(0)) + F.col(f"{label}_kinds") * F.col(label)) / (F.col(f"{label}_rows") + F.col(f"{label}_kinds"))
            for label in labels
        }
        chances = met.select("gram", *[F.coalesce(chance[label], F.col(label)).alias(label) for label in labels])
    return chances


def joined_scores(urls: DataFrame, counts: DataFrame, key: str, text: str = "address") -> DataFrame:
    """What ``scored`` returns, by joins with the counts instead of models on the workers.  Runs a job."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for address in batch.column(0).to_pylist():
                padded = EDGE * ORDER + address + EDGE
                seen = Counter(padded[at - ORDER : at + 1] for at in range(ORDER, len(padded)))
                rows += [(address, window, times) for window, times in seen.items()]
            columns = zip(*rows) if rows else ((), (), ())
            kinds = (pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(each, kind) for each, kind in zip(columns, kinds)], names=["address", "window", "times"])

    addresses = urls.select(F.col(text).alias("address")).where("address != ''").distinct()
    windows = stored(addresses.mapInArrow(lean(cut), "address string, window string, times bigint"))
    chances = window_chances(windows.select("window").distinct(), counts)
    ratios = chances.select(F.col("gram").alias("window"), (F.log("allow") - F.log("block")).alias("ratio"))
    sums = windows.join(ratios, "window").groupBy("address").agg(F.sum(F.col("times") * F.col("ratio")).alias("total"))
    scores = sums.select("address", (F.col("total") / (F.length("address") + 1)).alias("score"))
    rows = urls.select(key, F.col(text).alias("address")).join(scores, "address", "left")
    return rows.select(key, "address", F.coalesce("score", F.lit(0.0)).alias("score"))


def calibrate(held_out: DataFrame) -> float:
    """The threshold with the best mean of both classes' shares judged rightly,
    from (label, score) rows; the middle one where several are as good."""
    step = F.floor(F.col("score") / STEP).cast("int")
    rows = held_out.groupBy("label", step.alias("step")).count().collect()  # bounded: scores are a few nats at most
    if not rows:
        return 0.0
    seen = {label: Counter({row["step"]: row["count"] for row in rows if row["label"] == label}) for label in ("allow", "block")}
    totals = {label: max(1, sum(each.values())) for label, each in seen.items()}
    lowest, highest = min(row["step"] for row in rows), max(row["step"] for row in rows)
    good, bad, rated = totals["allow"], 0, []
    for cut in range(lowest, highest + 2):  # what is below the cut is blocked
        rated.append((good * totals["block"] + bad * totals["allow"], cut))
        good -= seen["allow"][cut]
        bad += seen["block"][cut]
    best = max(rate for rate, _ in rated)
    cuts = [cut for rate, cut in rated if rate == best]
    return cuts[len(cuts) // 2] * STEP


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, score, verdict) of every row.

    The models learn from the URLs that the rules judge.  Without accepted or
    without rejected ones there is nothing to compare: the rest is allowed.
    """
    host, path = host_and_path(F.col(url))
    judged = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    judged = judged.select("*", rule.alias("rule"), verdict.alias("label"), F.concat("host", "path").alias("address"))
    labelled = judged.where("label IS NOT NULL AND address != ''").select("label", "address")
    held = F.pmod(F.xxhash64("address"), F.lit(HELD_OUT)) == 0
    counts = kept_counts(labelled.where(~held))
    if {row["label"] for row in counts.where("context = ''").select("label").distinct().collect()} != {"allow", "block"}:
        return judged.select(
            "page_id", "host", "path", "rule", F.lit(None).cast("double").alias("score"), F.coalesce("label", F.lit("allow")).alias("verdict")
        )
    if counts.count() <= BROADCAST_ROWS:
        known = models(counts)
        score = partial(scored, accepted=known["allow"], rejected=known["block"])
    else:
        score = partial(joined_scores, counts=counts)
    threshold = calibrate(score(labelled.where(held), key="label"))
    packed = judged.select(F.struct("page_id", "host", "path", "rule", "label").alias("row"), "address")
    verdict = F.coalesce(
        F.col("row.label"),
        F.when((F.col("address") == "") | (F.col("score") >= threshold), "allow").otherwise("block"),
    )
    return score(packed, key="row").select("row.page_id", "row.host", "row.path", "row.rule", "score", verdict.alias("verdict"))
