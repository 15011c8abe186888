"""Toxicity by maximum-scoring segments of token log-odds with Dirichlet priors, calibrated by extreme values."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable
from .near_dedup import near_groups

#: Rows of one label that are linked by so many hundredths of common shingles of so many words are copies that teach once.
ALIKE, WIDTH = 80, 5
#: At most about so many labelled rows teach the model; a larger set is thinned by a hash of the id.
MOST_LABELLED = 200_000
#: Beginnings of these lengths are tokens beside the whole word, so inflected forms share what is learned.
BEGINNINGS = range(4, 10)
#: Prior count of a token in either class; the least z-score in each half of the training rows, and the least log-odds
#: in all of them, of a token that speaks for toxicity.
PRIOR, LEAST_Z, LEAST_LOG_ODDS = 0.5, 2.2, 2.0
#: A token that begins with such a one has log-odds of its own from this count on.
LEAST_COUNT = 3
#: Segments expected fewer times than this in a clean text of the same length are passages.
MOST_EXPECTED = 1.0

#: Counts of documents by half and label.
COUNTS = ("clean_a", "toxic_a", "clean_b", "toxic_b")
EDGES = ".,;:!?\"'()[]{}%*&$#|-_"


@dataclass
class Model:
    """log_odds: of tokens, beginnings marked by "^"; background: of any other token; k: of the extreme-value law."""

    log_odds: dict[str, float]
    background: float
    k: float
    intercept: float = -2.0
    slope: float = 1.0


def segments(scores: list[tuple[int, float]], background: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) in one left-to-right scan.

    ``scores`` has the positions that differ from the background, ascending. Every segment kept has the cumulative sum
    before it and at its end; a new one joins those that it can only gain from.
    """
    # First, last, the sums before and at the end, and the last segment before it whose left sum is smaller. Between
    # the two all left sums are larger, so a search by these links passes no segment twice and the scan is linear.
    kept: list[tuple[int, int, float, float, int]] = []
    total, at = 0.0, 0
    for i, s in scores:
        total += background * (i - at)
        at = i + 1
        if s <= 0:
            total += s
            continue
        first, last, left, right = i, i, total, total + s
        total = right
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= left:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= right:
                kept.append((first, last, left, right, j))
                break
            first, _, left, _, before = kept[j]
            del kept[j:]
            j = before
    return [(a, b, r - le) for a, b, le, r, _ in kept]


def tokens_of(word: str) -> list[str]:
    """The word and its beginnings, the longest first."""
    return [word, *(f"^{word[:n]}" for n in reversed(BEGINNINGS) if len(word) >= n)]


def text_words(text: str | None) -> list[str]:
    return [w.strip(EDGES) for w in (text or "").lower().split()]


def passages(model: Model, text: str | None, memo: dict[str, float | None]) -> tuple[list[tuple[int, int, float, float]], float]:
    """The toxic passages of a text (first word, last word, score, expected number in clean text) and their joint score.

    The joint score is the sum over passages of what their score is above that of one expected segment.
    """
    found = text_words(text)
    hits = []
    for i, w in enumerate(found):
        s = memo.get(w, 0)
        if s == 0:
            s = memo[w] = next((model.log_odds[t] for t in tokens_of(w) if t in model.log_odds), None)
        if s is not None:
            hits.append((i, s))
    if len(memo) > 100_000:
        memo.clear()
    if not hits:
        return [], 0.0
    level = math.log(model.k * len(found))
    out = [(a, b, s, math.exp(level - s)) for a, b, s in segments(hits, model.background) if s - level > -math.log(MOST_EXPECTED)]
    return out, sum(s - level for _, _, s, _ in out)


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents with each word, by label and half; each task adds up what it reads."""
    counts = [Counter() for _ in COUNTS]
    for pdf in batches:
        for text, toxic, half in zip(pdf["text"], pdf["toxic"], pdf["half"], strict=True):
            counts[2 * half + toxic].update(set(text_words(text)))
    every = list(set().union(*counts))
    for i in range(0, len(every), 100_000):
        some = every[i : i + 100_000]
        yield pd.DataFrame({"word": some} | {name: [c[w] for w in some] for name, c in zip(COUNTS, counts, strict=True)})


def labelled_rows(docs: DataFrame, labels: DataFrame, teaches: Column, id_col: str, text_col: str) -> DataFrame:
    """(text, toxic, half, key) of the labelled rows that may teach; their labels are bounded in number, so they are
    broadcast. key: of the label, in the order of ids."""
    marks = labels.select(F.col(id_col).alias("__id"), F.col("toxic").cast("int").alias("__toxic")).filter(
        "__id IS NOT NULL AND __toxic IN (0, 1)"
    )
    n = marks.count()
    if n > MOST_LABELLED:
        marks = marks.filter(F.pmod(F.xxhash64("__id"), F.lit(1_000_000)) < int(980_000 * MOST_LABELLED / n))
    # An id may have two labels, so each label has a key of its own.
    marks = durable(marks.orderBy("__id", "__toxic")).withColumn("__key", F.monotonically_increasing_id())
    return docs.filter(teaches).join(F.broadcast(marks), F.col(id_col) == F.col("__id")).select(
        F.col(text_col).alias("text"),
        F.col("__toxic").alias("toxic"),
        F.pmod(F.xxhash64("__id"), F.lit(2)).cast("int").alias("half"),
        F.col("__key").alias("key"),
    )


def without_copies(rows: DataFrame) -> DataFrame:
    """``rows`` with the least key of each group of near copies of one label: else a text that has thousands of copies
    would make all its words speak for its label. Groups are linked by the similarity of full shingle sets, so no row
    goes that isn't as similar as ALIKE to another of its group."""
    # With its label before each word, a text has no shingle in common with texts of the other label.
    marked = F.regexp_replace("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.concat(F.col("toxic").cast("string"), F.lit("$1")))
    groups, _ = near_groups(rows.select("key", marked.alias("text")), WIDTH, ALIKE, "key")
    copies = durable(groups.filter("NOT kept").select(F.col("doc_id").alias("__copy")).distinct())
    # Not more than the labelled rows, which are bounded.
    return rows.join(F.broadcast(copies), F.col("key") == F.col("__copy"), "left_anti")


def fit(rows: DataFrame) -> Model:
    """The model of (text, toxic, half) rows.

    A token's log-odds compare the documents with it in both classes, with a Dirichlet prior on each class. A token speaks
    for toxicity if its z-score is high in both halves of the rows, which chance seldom repeats. Tokens that begin with a chosen beginning
    keep log-odds of their own. The background is the log-odds of meeting none of them, so scores fall on clean text.
    K of the law E = K * length * exp(-score) is that which gives clean training texts the number of segments they
    have. A logistic curve over joint scores, from counts in bins, gives probabilities.
    """
    sums = [F.sum(c).alias(c) for c in COUNTS]
    words = rows.mapInPandas(_counts, "word string, " + ", ".join(f"{c} long" for c in COUNTS)).groupBy("word").agg(*sums)
    forms = F.array(
        F.col("word"),
        *(F.when(F.length("word") >= n, F.concat(F.lit("^"), F.substring("word", 1, n))) for n in BEGINNINGS),
    )
    counted = (
        words.filter("word <> ''")
        .select(F.explode(forms).alias("token"), *COUNTS)
        .filter("token IS NOT NULL")
        .groupBy("token")
        .agg(*sums)
        .withColumn("clean", F.col("clean_a") + F.col("clean_b"))
        .withColumn("toxic", F.col("toxic_a") + F.col("toxic_b"))
    )
    counted = durable(counted.filter(F.col("clean") + F.col("toxic") >= LEAST_COUNT))
    size = {(r.half, r.toxic): r["count"] for r in rows.groupBy("half", "toxic").count().collect()}  # at most 4 rows

    def compared(toxic: str, clean: str, n1: int, n0: int) -> tuple[Column, Column]:
        """Log-odds and z-score."""
        p1 = (F.col(toxic) + PRIOR) / (n1 + 1 + 2 * PRIOR)
        p0 = (F.col(clean) + PRIOR) / (n0 + 1 + 2 * PRIOR)
        log_odds = F.log(p1) - F.log(p0)
        return log_odds, log_odds / F.sqrt(1 / (F.col(toxic) + PRIOR) + 1 / (F.col(clean) + PRIOR))

    n = [[size.get((half, toxic), 0) for toxic in (0, 1)] for half in (0, 1)]
    z_a = compared("toxic_a", "clean_a", n[0][1], n[0][0])[1]
    z_b = compared("toxic_b", "clean_b", n[1][1], n[1][0])[1]
    log_odds = compared("toxic", "clean", n[0][1] + n[1][1], n[0][0] + n[1][0])[0]
    counted = counted.withColumn("log_odds", log_odds).withColumn("z", F.least(z_a, z_b))
    chosen = counted.filter((F.col("z") >= LEAST_Z) & (F.col("log_odds") >= LEAST_LOG_ODDS)).select("token", "log_odds")
    # From at most MOST_LABELLED texts, so the model is bounded.
    table = {r.token: r.log_odds for r in chosen.collect()}
    starts = sorted({len(t) - 1 for t in table if t.startswith("^")})
    if starts:
        plain = F.regexp_replace("token", r"^\^", "")
        family = F.array(*(F.concat(F.lit("^"), F.substring(plain, 1, n)) for n in starts))
        heads = chosen.filter("token LIKE '^%'").select(F.col("token").alias("head"))
        kin = counted.select("token", "log_odds", F.explode(family).alias("head")).join(F.broadcast(heads), "head", "left_semi")
        table |= {r.token: r.log_odds for r in kin.select("token", "log_odds").distinct().collect()}

    share = table.copy()

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Positive positions and all positions, by label."""
        out, memo = np.zeros((2, 2), np.int64), {}
        for pdf in batches:
            for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
                found = text_words(text)
                out[toxic, 1] += len(found)
                for w in found:
                    if w not in memo:
                        memo[w] = next((share[t] for t in tokens_of(w) if t in share), 0.0) > 0
                    out[toxic, 0] += memo[w]
                if len(memo) > 100_000:
                    memo.clear()
        yield pd.DataFrame({"toxic": [0, 1], "hits": out[:, 0], "all": out[:, 1]})

    met = {r.toxic: (r.h, r.a) for r in rows.mapInPandas(hits, "toxic int, hits long, all long").groupBy("toxic").agg(F.sum("hits").alias("h"), F.sum("all").alias("a")).collect()}
    h0, a0 = met.get(0, (0, 0))
    h1, a1 = met.get(1, (0, 0))
    rate1, rate0 = (h1 + 0.5) / (a1 + 100.0), (h0 + 0.5) / (a0 + 100.0)
    background = min(-1e-4, math.log((1 - min(rate1, 0.5)) / (1 - min(rate0, 0.5))))
    positive = [v for v in table.values() if v > 0]
    least = min(positive) if positive else 1.0
    model = Model(table, background, (h0 + 0.5) * math.exp(least) / (a0 + 100.0))

    def joint(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict = {}
        for pdf in batches:
            x = [passages(model, t, memo)[1] for t in pdf["text"]]
            yield pd.DataFrame({"bin": np.minimum(np.ceil(np.array(x, float) * 4), 400).astype(int), "toxic": pdf["toxic"]})

    bins = rows.mapInPandas(joint, "bin int, toxic int").groupBy("bin", "toxic").count().collect()  # at most 802 rows
    x = np.array([r.bin / 4 for r in bins], float)
    y = np.array([r.toxic for r in bins], float)
    n = np.array([r["count"] for r in bins], float)
    model.intercept, model.slope = _logistic(x, y, n)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic curve by Newton's method, with a weak prior that keeps both finite."""
    b = np.array([-1.0, 0.5])
    design = np.stack([np.ones_like(x), np.minimum(x, 40)])
    for _ in range(100 if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(b @ design, -30, 30)))
        gradient = design @ (n * (y - p)) - 0.05 * b
        hessian = (design * (n * p * (1 - p))) @ design.T + 0.05 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        b = b + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(max(b[1], 0.0))


PASSAGES = "score double, passages array<struct<first:int,last:int,score:double,expected:double>>"


def toxicity(model: Model, text: Column) -> Column:
    """A struct of the probability that a text is toxic and its toxic passages, by word positions."""

    @F.pandas_udf(PASSAGES)
    def score(texts: pd.Series) -> pd.DataFrame:
        memo: dict = {}
        p, spans = [], []
        for t in texts:
            found, x = passages(model, t, memo)
            p.append(1 / (1 + math.exp(-max(-30.0, min(30.0, model.intercept + model.slope * min(x, 40))))))
            spans.append([{"first": a, "last": b, "score": s, "expected": e} for a, b, s, e in found])
        return pd.DataFrame({"score": p, "passages": spans})

    return score(text)


def held_out(id_col: Column, folds: int) -> Column:
    """Whether a row is left out of training: crc32 of its id as text, modulo ``folds``, is 0; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(folds)) == 0, F.lit(False))


def fit_labelled(docs: DataFrame, labels: DataFrame, folds: int = 5, id_col: str = "doc_id", text_col: str = "text") -> Model:
    return fit(without_copies(labelled_rows(docs, labels, ~held_out(F.col(id_col), folds), id_col, text_col)))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, folds: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row of ``docs`` with its toxicity, learned from labelled rows outside the held-out fold.

    Whole texts are scored where they are; nothing but word counts of labelled rows is shuffled.

    Defined results: a null or empty text has no passage and the probability of such a text; a null id isn't held out;
    repeated rows are each scored; without labels the score is a constant below 0.5; an empty table gives no rows;
    labels with null id or null mark teach nothing; other columns are ignored.

    Returns doc_id, held_out, score, predicted, passages.
    """
    model = fit_labelled(docs, labels, folds, id_col, text_col)
    scored = docs.select(F.col(id_col).alias("doc_id"), toxicity(model, F.col(text_col)).alias("t"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), folds).alias("held_out"),
        F.col("t.score").alias("score"),
        (F.col("t.score") >= 0.5).cast("int").alias("predicted"),
        F.col("t.passages").alias("passages"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, with their columns."""
    model = fit_labelled(docs, labels, id_col=id_col, text_col=text_col)
    return docs.filter(toxicity(model, F.col(text_col)).score < 0.5)
