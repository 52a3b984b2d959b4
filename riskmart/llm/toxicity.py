"""Toxicity by class-conditional Kneser-Ney models with a shared backoff.

Expressions are words and pairs of words, counted in both classes by the texts that hold them, so
that shares can be compared whatever the sizes of the classes and a word of all texts tells nothing.
Beyond what ordinary texts make likely, a toxic text counts only if the expression follows a word it did
not follow before (Kneser-Ney continuation): copies can make an expression more ordinary, never more toxic. With
``n`` the count of an expression in a class, ``N`` the sum and ``T`` the number of its
expressions, ``D`` the discount and ``p`` the backoff that both classes share:

    P(expression | class) = (max(n - D, 0) + D * T * p) / N

For words, the lower order, ``p`` is the Kneser-Ney continuation: the share of a word in the different pairs of both
classes, so that a word of one phrase has little of it however often it stands. Pairs, the highest order, have their
share of the counts. Rare expressions live on ``p`` alone. Where the counts of both classes do not tell them
apart (log-likelihood ratio test, at a level at which one expression of the whole
vocabulary would pass by chance) an expression is left to the backoff in both classes: its
ratio is one. A pair that passes stands for its second word.

A text's evidence is the sum over its words of ``log P(toxic) - log P(ordinary)``, length-normalised
twice: over the whole text, and over its most toxic stretch of ``STRETCH`` words, since a few
words make a long text toxic. A logistic curve fitted on labelled rows that were not counted
turns both (of the stretch the logarithm) into a score.

Counts cover all labelled training rows but those the two-parameter curve is fitted on: a sample of
about ``calibration_rows``, spread by hash, and at most about a fifth of the rows.

Defined results: null and empty texts are scored like a text without evidence. Rows of
``labels`` whose label is neither 0 nor 1 or whose key is null teach nothing; of several labels of a key the
greatest counts. Without spare labels of both classes every score is the share of label 1 (next to 0 or 1).
Repeated rows are scored each for itself. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm.words import alphanumeric, map_texts, sequence_hashes
from riskmart.sources.scratch import keep, temporary

DISCOUNT = 0.75
STRETCH = 32
THRESHOLD = 0.7
MODEL_ENTRIES = 2_000_000  # 24 MB; a larger model is joined instead of sent
CALIBRATION_ROWS = 20_000
CALIBRATION_SHARE = 0.2
COMBINED_WORDS = 2_000_000  # words of texts whose counts a task combines at a time
_START = np.uint64(0x9AE16A3B2F90404F)
WORD, PAIR = 1, 2
COUNTS = ("nt", "no", "tt", "to", "dt", "do")


def _expressions(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a text and of the pairs that end with them."""
    words = alphanumeric(text.lower().encode())
    return words, sequence_hashes(np.concatenate([[_START], words]), 2) if len(words) else words


def counted_pairs(train: DataFrame, text: str) -> DataFrame:
    """``pair``, ``word``, ``nt`` different words before the pair in toxic texts, and texts of both classes.

    ``dt`` toxic and ``no`` ordinary texts hold the pair; of ``wt`` and ``wo`` it is where its word first
    stands, so that their sums over the pairs of a word are the texts that hold the word.
    Rows are combined within tasks, and one shuffle by pair serves both groupings.
    """

    def columns(pairs, words, contexts, texts, firsts) -> pa.RecordBatch:
        # Rows of one word lie together, which the shuffle's compression makes use of.
        order = np.argsort(words, kind="stable")
        arrays = [x[order].astype(np.int64) for x in (pairs, words, contexts, texts, firsts)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["pair", "word", "context", "texts", "firsts"])

    def combined(of_toxic: list[tuple], of_ordinary: list[tuple]) -> Iterator[pa.RecordBatch]:
        if of_toxic:
            pairs, words, contexts, texts, firsts = (np.concatenate(x) for x in zip(*of_toxic, strict=True))
            contexts = sequence_hashes_of(pairs, contexts)
            contexts, first, group = np.unique(contexts, return_index=True, return_inverse=True)
            sums = (np.bincount(group, x, len(first)) for x in (texts, firsts))
            yield columns(pairs[first], words[first], contexts, *sums)
        if of_ordinary:
            pairs, words, firsts = (np.concatenate(x) for x in zip(*of_ordinary, strict=True))
            pairs, first, group, n = np.unique(pairs, return_index=True, return_inverse=True, return_counts=True)
            yield columns(pairs, words[first], np.zeros(len(first)), n, np.bincount(group, firsts, len(first)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_toxic, of_ordinary, held = [], [], 0
        for batch in batches:
            for value, toxic in zip(batch.column(text), batch.column("toxic").to_pylist(), strict=True):
                words, pairs = _expressions(value.as_py() or "")
                held += len(words)
                new_word = _first_places(words)
                if toxic:
                    before = np.concatenate([[_START, _START], words])[: len(words)]
                    of_toxic.append((pairs, words, before, _first_places(pairs), new_word))
                else:
                    pairs, first = np.unique(pairs, return_index=True)
                    of_ordinary.append((pairs, words[first], new_word[first]))
                if held >= COMBINED_WORDS:
                    yield from combined(of_toxic, of_ordinary)
                    of_toxic, of_ordinary, held = [], [], 0
        yield from combined(of_toxic, of_ordinary)

    schema = "pair long, word long, context long, texts long, firsts long"
    rows = train.select(text, "toxic").mapInArrow(run, schema)
    sums = [F.sum(c).alias(c) for c in ("texts", "firsts")]
    by_context = rows.repartition("pair").groupBy("pair", "word", "context").agg(*sums)
    toxic = F.col("context") != 0

    def of(condition: Column, count: str) -> Column:
        return F.sum(F.when(condition, F.col(count)).otherwise(0))

    return by_context.groupBy("pair", "word").agg(
        F.count_if(toxic).alias("nt"),
        of(~toxic, "texts").alias("no"),
        of(toxic, "texts").alias("dt"),
        of(toxic, "firsts").alias("wt"),
        of(~toxic, "firsts").alias("wo"),
    )


def _first_places(values: np.ndarray) -> np.ndarray:
    """Whether a value stands at its first place."""
    first = np.zeros(len(values), bool)
    first[np.unique(values, return_index=True)[1]] = True
    return first


def sequence_hashes_of(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One hash of two at the same place, never 0."""
    both = np.empty(2 * len(first), np.uint64)
    both[::2], both[1::2] = first, second
    return np.maximum(sequence_hashes(both, 2)[::2], np.uint64(1)) if len(first) else both


def expression_counts(train: DataFrame, text: str) -> DataFrame:
    """``level``, ``gram`` and counts of both classes; level 0 holds sums over all pairs.

    ``nt`` and ``no`` count words by the words before them and pairs as ``counted_pairs``; ``dt`` and ``do`` count texts.
    """
    pairs = counted_pairs(train, text)
    in_toxic, in_ordinary = (F.col("nt") > 0).cast("long"), (F.col("no") > 0).cast("long")

    def row(level: int, gram: Column, *counts: Column) -> Column:
        names = COUNTS
        return F.struct(F.lit(level).alias("level"), gram.alias("gram"), *[c.alias(n) for c, n in zip(counts, names, strict=True)])

    zero = F.lit(0).cast("long")
    rows = F.array(
        row(0, zero, F.col("nt"), F.col("no"), in_toxic, in_ordinary, F.col("dt"), F.col("no")),
        row(WORD, F.col("word"), in_toxic, in_ordinary, zero, zero, F.col("wt"), F.col("wo")),
        row(PAIR, F.col("pair"), F.col("nt"), F.col("no"), zero, zero, F.col("dt"), F.col("no")),
    )
    # A pair of few texts only adds to the sums. If one class is rare enough (share below about 1.9 % at a million
    # pairs), three counts in it would pass the test: such pairs are left to their words.
    each = pairs.select(F.explode(rows).alias("r")).select("r.*").where("level <> 2 OR nt + no > 3")
    return each.groupBy("level", "gram").agg(*[F.sum(c).alias(c) for c in COUNTS])


def _comparable(counts: DataFrame, total: dict) -> DataFrame:
    """Counts by texts; ``nt`` beyond what ``no`` makes likely is bounded by the number of different words before.

    ``before`` is the number of different words before in either class (of pairs: not known in the ordinary one).
    """
    likely = F.col("do") * (total["nt"] / total["no"])
    before = F.when(F.col("level") == WORD, F.col("nt") + F.col("no")).alias("before")
    return counts.select("level", "gram", F.least("dt", F.greatest("nt", likely)).alias("nt"), F.col("do").alias("no"), before)


def _ratios(counts: DataFrame, level: int, total: dict, types: dict, pairs: int | None = None) -> DataFrame:
    """The log ratio of every expression of a level that tells the classes apart.

    With ``pairs``, the different pairs of both classes, the backoff is the continuation ``before / pairs``.
    """
    everything = total["nt"] + total["no"]
    vocabulary = max(types["nt"] + types["no"], 3)
    limit = 2 * math.log(vocabulary) - math.log(math.log(vocabulary)) - math.log(math.pi)
    both = F.col("nt") + F.col("no")
    backoff = both / everything if pairs is None else F.col("before") / max(pairs, 1)
    log = {}
    fit = F.lit(0.0)
    for c in ("nt", "no"):
        expected = both * (total[c] / everything)
        fit += F.when(F.col(c) > 0, 2 * F.col(c) * F.log(F.col(c) / expected)).otherwise(0.0)
        held = F.greatest(F.col(c) - F.lit(DISCOUNT), F.lit(0.0))
        log[c] = F.log((held + DISCOUNT * types[c] * backoff) / total[c])
    return counts.where((F.col("level") == level) & (fit > limit)).select("gram", (log["nt"] - log["no"]).alias("ratio"))


def learn(train: DataFrame, text: str = "text") -> DataFrame:
    """``gram`` and ``ratio`` of all telling expressions; ``train`` has ``toxic`` 0 or 1 for each text."""
    counts = keep(expression_counts(train, text), "counts")
    sums = counts.where(f"level = {WORD}").agg(
        *[F.sum(c).alias(c) for c in ("nt", "no", "dt", "do")],
        *[F.count_if(F.col(c) > 0).alias(n) for c, n in (("dt", "tt"), ("do", "to"))],
    )
    words = sums.first()
    pairs = counts.where("level = 0").select("dt", "do", "tt", "to").first()
    if not words["dt"] or not words["do"]:
        return counts.where("false").select("gram", F.lit(0.0).alias("ratio"))
    of = [({"nt": r["dt"], "no": r["do"]}, {"nt": r["tt"], "no": r["to"]}) for r in (words, pairs)]
    continuations = {WORD: words["nt"] + words["no"], PAIR: None}
    parts = [
        _ratios(_comparable(counts, total), level, total, types, continuations[level])
        for level, (total, types) in zip((WORD, PAIR), of, strict=True)
    ]
    return parts[0].union(parts[1])


def evidence(words: np.ndarray, word_ratio: np.ndarray, pair_ratio: np.ndarray) -> tuple[int, float, float]:
    """Number of words, mean ratio of the text and of its most toxic stretch; NaN is no ratio."""
    n = len(words)
    if not n:
        return 0, 0.0, 0.0
    ratio = np.nan_to_num(np.where(np.isnan(pair_ratio), word_ratio, pair_ratio), nan=0.0)
    total = np.concatenate([[0.0], np.cumsum(ratio)])
    width = min(STRETCH, n)
    return n, float(total[-1] / n), float((total[width:] - total[:-width]).max() / STRETCH)


def _look_up(grams: np.ndarray, ratios: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(grams):
        return np.full(len(wanted), np.nan)
    place = np.minimum(np.searchsorted(grams, wanted), len(grams) - 1)
    return np.where(grams[place] == wanted, ratios[place], np.nan)


EVIDENCE = "n_words long, mean_ratio double, peak_ratio double"


def weigh(docs: DataFrame, model: DataFrame, keys: list[str], text: str = "text", most: int = MODEL_ENTRIES) -> DataFrame:
    """``keys`` and the evidence of every whole text.

    A model of at most ``most`` expressions is sent to the executors and texts are not shuffled.
    A larger one is joined with the expressions of the texts, which then meet by row.
    """
    if model.count() <= most:
        rows = model.orderBy("gram").toPandas()
        sent = docs.sparkSession.sparkContext.broadcast(
            (rows["gram"].to_numpy(np.int64), rows["ratio"].to_numpy(np.float64))
        )

        def start():
            grams, ratios = sent.value

            def work(value: str) -> tuple:
                words, pairs = _expressions(value)
                found = (_look_up(grams, ratios, x.astype(np.int64)) for x in (words, pairs))
                return evidence(words, *found)

            return work

        return map_texts(docs, EVIDENCE, start, keys, text)

    rows = keep(docs.select(*keys, text).withColumn("__text_row", F.monotonically_increasing_id()), "texts")
    schema = "at int, level int, gram long"

    def grams_of(value: str):
        words, pairs = _expressions(value)
        for level, grams in ((WORD, words), (PAIR, pairs)):
            yield from ((i, level, g) for i, g in enumerate(grams.astype(np.int64).tolist()))

    each = map_texts(rows, schema, lambda: grams_of, ["__text_row"], text, many=True).join(model, "gram")
    hits = each.groupBy("__text_row").agg(F.collect_list(F.struct("at", "level", "ratio")).alias("hits"))
    sizes = map_texts(rows, "n_words long", lambda: lambda v: (len(alphanumeric(v.lower().encode())),), ["__text_row", *keys], text)
    joined = sizes.join(hits, "__text_row", "left").select(*keys, "n_words", "hits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for n, hits_of in zip(batch.column("n_words").to_pylist(), batch.column("hits").to_pylist(), strict=True):
                ratio = np.full((3, n), np.nan)
                for hit in hits_of or ():
                    ratio[hit["level"], hit["at"]] = hit["ratio"]
                made.append(evidence(ratio[0], ratio[WORD], ratio[PAIR]))
            columns = list(zip(*made, strict=True)) or [(), (), ()]
            types = (pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keys] + [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=[*keys, "n_words", "mean_ratio", "peak_ratio"],
            )

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keys)
    return joined.mapInArrow(run, f"{fields}, {EVIDENCE}")


def fit_curve(features: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic curve, by Newton's method with a slight ridge."""
    scale = features.std(axis=0)
    scale[scale == 0] = 1.0
    x = np.column_stack([features / scale, np.ones(len(features))])
    ridge = np.diag([0.01, 0.01, 1e-6])
    weights = np.zeros(3)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - labels) + ridge @ weights
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, gradient)
        weights -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return weights[:2] / scale, float(weights[2])


def strength(peak: Column) -> Column:
    """The peak as the curve takes it: ten telling words are not ten times surer than one."""
    return F.log1p(F.greatest(peak * STRETCH, F.lit(0.0)))


def is_held_out(key: str) -> Column:
    """Rows that never teach."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@contextmanager
def early_filter(spark: SparkSession):
    """Let Spark filter the texts by a Bloom filter of the labelled keys before it shuffles them.

    Spark itself drops the filter where the labels are too many for one; results do not depend on it.
    """
    name = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "0")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@dataclass
class Scorer:
    """What was learned: the telling expressions and the curve over a text's evidence."""

    model: DataFrame
    weights: tuple[float, float]
    intercept: float
    most_entries: int = MODEL_ENTRIES

    def score(self, docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
        """``keys`` with ``score``, ``predicted`` and the evidence of every whole text."""
        weighed = weigh(docs, self.model, keys, text, self.most_entries)
        line = F.col("mean_ratio") * self.weights[0] + strength(F.col("peak_ratio")) * self.weights[1] + self.intercept
        scored = weighed.withColumn("score", 1 / (1 + F.exp(-line)))
        return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def learn_scorer(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    label: str = "toxic",
    text: str = "text",
    calibration_rows: int = CALIBRATION_ROWS,
    most_entries: int = MODEL_ENTRIES,
) -> Scorer:
    """Fit the curve on about ``calibration_rows`` of the labelled training rows (at most a fifth), count all others."""
    read = docs.select(F.col(key).alias("__key"), F.col(text).alias("text")).where(~is_held_out("__key"))
    with temporary(), early_filter(docs.sparkSession):
        taught = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~is_held_out(key))
        taught = keep(taught.groupBy(F.col(key).alias("__key")).agg(F.max(label).cast("int").alias("toxic")), "taught")
        share = min(calibration_rows / max(taught.count(), 1), CALIBRATION_SHARE)
        calibrates = F.pmod(F.xxhash64("__key", F.lit(7)), F.lit(1 << 20)) < int(share * (1 << 20))
        train = read.where(~calibrates).join(taught.where(~calibrates).hint("merge"), "__key").select("text", "toxic")
        model = keep(learn(train), "model", lasting=True)

        sample = read.where(calibrates).join(taught.where(calibrates).hint("merge"), "__key")
        known = weigh(sample, model, ["toxic"], "text", most_entries)
        known = known.select("toxic", "mean_ratio", strength(F.col("peak_ratio")).alias("strength")).toPandas()
    positives = int(known["toxic"].sum()) if len(known) else 0
    if 0 < positives < len(known):
        features = known[["mean_ratio", "strength"]].to_numpy(float)
        weights, intercept = fit_curve(features, known["toxic"].to_numpy(float))
        return Scorer(model, (float(weights[0]), float(weights[1])), intercept, most_entries)
    prior = min(max(positives / max(len(known), 1), 1e-12), 1 - 1e-12)
    return Scorer(model, (0.0, 0.0), math.log(prior / (1 - prior)), most_entries)


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic", text: str = "text", **options) -> DataFrame:
    """For each row: ``key``, ``held_out``, ``score``, ``predicted``, and the evidence behind them."""
    scorer = learn_scorer(docs, labels, key, label, text, **options)
    scored = scorer.score(docs.select(F.col(key).alias("__key"), text), ["__key"], text)
    return scored.select(
        F.col("__key").alias(key), is_held_out("__key").alias("held_out"), "score", "predicted", "n_words", "mean_ratio", "peak_ratio"
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns as they are, and no shuffle of them."""
    scorer = learn_scorer(docs, labels, key, label, text, **options)
    rows = docs.select(F.struct(*docs.columns).alias("__doc"), F.col(text).alias("__value"))
    return scorer.score(rows, ["__doc"], "__value").where("predicted = 0").select("__doc.*")
