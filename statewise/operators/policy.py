"""A move classifier: fit, scores, masked choice among candidates, loss and accuracy."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, NaiveBayes
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statewise.functions import games as g


def masked_policy(scored: DataFrame, key: str = "_id") -> DataFrame:
    """For each key the best of its candidates and its probability among them.

    ``scored`` has a row for each candidate: ordinal, choice, logit. The first of equal scores wins; candidates with
    the same score index all count below the line. Two aggregates, which combine before the shuffle; the first gives
    the greatest score, so no exponent overflows.
    """
    best = scored.groupBy(key).agg(
        F.min_by("choice", F.struct((-F.col("logit")).alias("s"), "ordinal")).alias("move"), F.max("logit").alias("top")
    )
    return (
        scored.select(key, "logit")
        .join(best, key)
        .groupBy(key)
        .agg(F.max("move").alias("move"), (1 / F.sum(F.exp(F.col("logit") - F.col("top")))).alias("confidence"))
    )


def candidate_scores(candidates: DataFrame, scores: DataFrame, key: str = "_id", index: str = "index") -> DataFrame:
    """Each candidate with its element of its key's array ``scores``; the array is never exploded."""
    return candidates.join(scores.select(key, "scores"), key).withColumn(
        "logit", F.try_element_at("scores", F.col(index) + 1)
    ).drop("scores")


def eval_metrics(scored: DataFrame, scores: str = "scores", target: str = "target") -> DataFrame:
    """Mean cross-entropy and accuracy in percent over rows with an array of scores and a target index."""
    top = F.array_max(scores)
    rows = scored.select(
        (
            F.log(F.aggregate(scores, F.lit(0.0).cast("double"), lambda s, x: s + F.exp(x - top)))
            + top
            - F.element_at(scores, F.col(target) + 1)
        ).alias("loss"),
        (F.array_position(scores, top) - 1 == F.col(target)).cast("int").alias("hit"),
    )
    return rows.agg(
        F.count("*").alias("n"), F.avg("loss").alias("mean_loss"), (F.avg("hit") * 100).alias("accuracy_percent")
    )


def fit_policy(rows: DataFrame, features: str = "features", target: str = "target", iterations: int = 20) -> LogisticRegressionModel:
    """Multinomial logistic regression of an array column on a class index; Spark adds up gradients over partitions."""
    ready = rows.select(array_to_vector(F.col(features).cast("array<double>")).alias("features"), F.col(target).cast("double").alias("label"))
    return LogisticRegression(maxIter=iterations, family="multinomial").fit(ready)


def score_policy(model: LogisticRegressionModel, rows: DataFrame, features: str = "features") -> DataFrame:
    """``rows`` with the array ``scores``: one logit for each class."""
    ready = rows.withColumn("__features", array_to_vector(F.col(features).cast("array<double>")))
    model = model.copy().setFeaturesCol("__features")
    return model.transform(ready).withColumn("scores", vector_to_array("rawPrediction")).drop(
        "__features", "rawPrediction", "probability", "prediction"
    )


def save_policy(model: LogisticRegressionModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_policy(path: str) -> LogisticRegressionModel:
    return LogisticRegressionModel.load(path)


# --- boards -------------------------------------------------------------------------------------------------------

#: Numbers that describe a board, of which at most 64 are 1.
BOARD_SIZE = len(g.PIECES) * 64
BOARD, TARGET = "packed_board", "target_move"
MODEL = "target_move int, bias double, weights array<double>"


class BoardPolicy(NamedTuple):
    """A fitted classifier of boards: one row of ``table`` for each target that was seen."""

    table: DataFrame
    vectors: CountVectorizerModel
    labels: DataFrame
    model: object


def observed_targets(rows: DataFrame, target: str = TARGET) -> DataFrame:
    """The targets that occur, numbered 0.. in their order: of 4096 possible moves some never do."""
    # One row for each distinct target, which are bounded by the move index.
    return rows.select(target).filter(F.col(target).isNotNull()).distinct().withColumn("label", (F.row_number().over(Window.orderBy(target)) - 1).cast("double"))


def fit_boards(rows: DataFrame, kind: str = "softmax", iterations: int = 20) -> BoardPolicy:
    """A classifier of ``rows`` (packed_board, target_move) among the targets that occur.

    A board enters as a sparse vector of the squares that are set, 32 numbers or fewer in place of 768. ``softmax``
    is a multinomial regression, whose passes add up gradients over partitions; ``bayes`` counts squares in one pass,
    for tables that are read once. Rows without a board or target are left out.
    """
    spark = rows.sparkSession
    vectors = _vectors(spark)
    if kind == "softmax":
        labels = observed_targets(rows).cache()
        ready = vectors.transform(_named_squares(rows.filter(f"{BOARD} IS NOT NULL").join(F.broadcast(labels), TARGET)))
        model = LogisticRegression(maxIter=iterations, family="multinomial").fit(ready)
        weights, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    elif kind == "bayes":
        counts = square_counts(rows).cache()
        labels = observed_targets(counts).cache()
        # To the classifier a target's boards are one with all their squares, and empty ones up to their number.
        weighed = lambda weight, squares: F.struct(weight.cast("double").alias("weight"), squares.cast("array<double>").alias("squares"))
        parts = F.array(weighed(F.lit(1), F.col("squares")), weighed(F.col("n") - 1, F.array_repeat(F.lit(0), BOARD_SIZE)))
        ready = counts.join(F.broadcast(labels), TARGET).select("label", F.explode(parts).alias("p")).select("label", "p.weight", array_to_vector("p.squares").alias("features"))
        model = NaiveBayes(modelType="multinomial", weightCol="weight").fit(ready)
        weights, bias = model.theta.toArray(), model.pi.toArray()
    else:
        raise ValueError(f"kind is softmax or bayes, not {kind}")
    names = [r[TARGET] for r in labels.orderBy("label").collect()]  # at most 4096 numbers
    # The model is at most 4096 rows of 768 numbers, and the driver holds it anyway.
    table = pa.table([pa.array(names, pa.int32()), pa.array(bias), pa.array(list(weights), pa.list_(pa.float64()))], names=["target_move", "bias", "weights"])
    return BoardPolicy(spark.createDataFrame(table, MODEL), vectors, labels, model)


def square_counts(rows: DataFrame) -> DataFrame:
    """target_move, n (its boards) and squares: for each of the 768 numbers, how many of these boards have it set.

    A task counts its rows batch by batch and hands on one row for each target, so what is shuffled does not grow with
    the rows. Rows without a board or target are left out.
    """
    size, _digits = BOARD_SIZE, g.board_digits()

    def batch(targets, counts):
        numbers = np.array(counts, np.int64).reshape(-1, size + 1)
        squares = pa.ListArray.from_arrays(pa.array(np.arange(0, numbers.shape[0] * size + 1, size, dtype=np.int32)), pa.array(numbers[:, 1:].ravel()))
        return pa.RecordBatch.from_arrays([pa.array(targets, pa.int32()), pa.array(numbers[:, 0]), squares], ["target_move", "n", "squares"])

    def count(batches):
        held = {}
        for given in batches:
            boards, targets = given.column(0), given.column(1).to_numpy(zero_copy_only=False)
            found, at = np.unique(targets, return_inverse=True)
            digits = _digits(boards)
            row, square = np.nonzero(digits)
            place = at[row] * (size + 1) + 1 + (digits[row, square].astype(np.int64) - 1) * 64 + square
            counts = np.bincount(place, minlength=len(found) * (size + 1)).reshape(-1, size + 1)
            counts[:, 0] = np.bincount(at, minlength=len(found))
            for target, some in zip(found.tolist(), counts, strict=True):
                if target in held:
                    held[target] += some
                else:
                    held[target] = some.copy()
        if held:
            yield batch(list(held), list(held.values()))

    def added(parts: pa.Table) -> pa.Table:
        numbers = np.column_stack([parts.column("n").to_numpy(), np.stack(parts.column("squares").to_numpy())])
        return pa.Table.from_batches([batch(parts.column("target_move").to_pylist()[:1], numbers.sum(axis=0))])

    schema = "target_move int, n long, squares array<long>"
    known = rows.select(BOARD, F.col(TARGET).cast("int").alias(TARGET)).filter(f"{BOARD} IS NOT NULL AND {TARGET} IS NOT NULL")
    return known.mapInArrow(count, schema).groupBy(TARGET).applyInArrow(added, schema)


def _vectors(spark: SparkSession) -> CountVectorizerModel:
    return CountVectorizerModel.from_vocabulary([str(i) for i in range(BOARD_SIZE)], "__squares", "features").setBinary(True)


def _named_squares(rows: DataFrame) -> DataFrame:
    return rows.withColumn("__squares", F.transform(g.set_squares(F.col(BOARD)), lambda i: i.cast("string")))


def _by_square(table: DataFrame):
    """A model's targets in their order, their biases, and their weights by [square, digit of the square] (0 if empty).

    It is at most 4096 rows of 768 numbers, and travels with the functions that use it.
    """
    rows = table.orderBy(TARGET).collect()
    weights = np.zeros((64, len(g.DIGITS), len(rows)))
    weights[:, 1:] = np.array([r.weights for r in rows], float).reshape(len(rows), len(g.PIECES), 64).transpose(2, 1, 0)
    return np.array([r[TARGET] for r in rows], np.int64), np.array([r.bias for r in rows], float), weights


def predict_boards(fitted: BoardPolicy, rows: DataFrame, most: int = 256) -> DataFrame:
    """``rows`` with predicted_move, and loss (of the row's own target; null if it was never seen).

    All targets are scored, once for each board of a batch and ``most`` boards at a time. The first of equal targets wins.
    """
    names, bias, weights = _by_square(fitted.table)
    _digits = g.board_digits()

    @F.arrow_udf("predicted_move int, share double")
    def predict(boards: pa.Array, targets: pa.Array) -> pa.Array:
        there = np.flatnonzero(boards.is_valid().to_numpy(zero_copy_only=False))
        digits = _digits(boards)
        _, first, at = np.unique((digits[:, ::2] << 4 | digits[:, 1::2]).view("S32").ravel(), return_index=True, return_inverse=True)
        order = np.argsort(at, kind="stable")
        asked = targets.fill_null(-1).to_numpy(zero_copy_only=False)[there]
        label = np.minimum(np.searchsorted(names, asked), len(names) - 1)
        known = names[label] == asked
        moves, shares = np.zeros(len(boards), np.int32), np.zeros(len(boards))
        for begin in range(0, len(first), most):
            some = digits[first[begin : begin + most]]
            scores = np.zeros((len(some), len(names)))
            for square in range(64):
                row = np.flatnonzero(some[:, square])
                scores[row] += weights[square, some[row, square]]
            scores += bias
            best = scores.argmax(axis=1)
            scores = np.exp(scores - scores[np.arange(len(some)), best][:, None])
            total = scores.sum(axis=1)
            low, high = np.searchsorted(at[order], [begin, begin + len(some)])
            mine = order[low:high]
            own = at[mine] - begin
            moves[there[mine]] = names[best[own]]
            shares[there[mine]] = scores[own, label[mine]] / total[own]
        unseen = np.ones(len(boards), bool)
        unseen[there[known]] = False
        absent = np.ones(len(boards), bool)
        absent[there] = False
        return pa.StructArray.from_arrays([pa.array(moves, mask=absent), pa.array(shares, mask=unseen)], ["predicted_move", "share"])

    scored = rows.withColumn("__p", predict(F.col(BOARD), F.col(TARGET).cast("int")))
    return scored.select(*rows.columns, (-F.log("__p.share")).alias("loss"), F.col("__p.predicted_move").alias("predicted_move"))


def accuracy(predicted: DataFrame) -> DataFrame:
    """Rows, mean loss and percent of rows whose target was predicted."""
    hit = F.coalesce(F.col("predicted_move") == F.col(TARGET), F.lit(False)).cast("int")
    return predicted.agg(F.count("*").alias("n"), F.avg("loss").alias("mean_loss"), (F.avg(hit) * 100).alias("accuracy_percent"))


def save_model(table: DataFrame, path: str) -> None:
    """A model as a Parquet table of one row a target."""
    table.coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> DataFrame | None:
    """The model saved at ``path``, None if there is nothing."""
    try:
        return spark.read.schema(MODEL).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def board_policy(model: DataFrame | None, candidates: DataFrame, key: str = "_id") -> DataFrame | None:
    """The best of each key's candidates and its probability among them; None without a model.

    ``candidates`` has key, ordinal, choice, packed_board and target_move. A candidate's score is its target's bias and
    the weights of the squares that are set, so only targets that are candidates are scored, where they stand and in
    batches: only the masked choice shuffles. The model has at most 4096 rows and travels with the job. Targets that the
    model has never seen are no candidates; a key with no others has no answer.
    """
    if model is None:
        return None
    names, bias, weights = _by_square(model)
    _digits = g.board_digits()

    @F.arrow_udf("double")
    def score(boards: pa.Array, targets: pa.Array) -> pa.Array:
        asked = targets.fill_null(-1).to_numpy(zero_copy_only=False)
        label = np.minimum(np.searchsorted(names, asked), len(names) - 1)
        known = (names[label] == asked) & boards.is_valid().to_numpy(zero_copy_only=False)
        digits, label = _digits(boards.filter(pa.array(known))), label[known]
        scores = np.zeros(len(label))
        for square in range(64):
            scores += weights[square, digits[:, square], label]
        out = np.zeros(len(asked))
        out[known] = bias[label] + scores
        return pa.array(out, mask=~known)

    logit = score(F.col(BOARD), F.col(TARGET).cast("int")) if len(names) else F.lit(None).cast("double")
    scored = candidates.select(key, "ordinal", "choice", logit.alias("logit"))
    return masked_policy(scored.filter("logit IS NOT NULL"), key)
