"""Language-model scores by a weighted backoff automaton over the whole corpus' n-gram counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, hash_words
from .exchange import (
    REQUEST,
    answers,
    buckets_for,
    by_block,
    cut,
    grow,
    reply_of,
    request_batch,
    requests,
    shrunk,
    with_block,
)
from .fingerprints import mix64
from .toxicity import held_out

#: Bytes of a key: single tokens are told apart by 64 bits, pairs by 48.
WIDTHS = {1: 8, 2: 6}
#: Added to every token's count in the base model.
ADD = 0.1
#: Weight of the lower order: a state that was left n times gives it BACKOFF / (n + BACKOFF).
BACKOFF = 500.0
#: The token after the last word; no word holds a line feed.
END_MARK = b"\n"
END = np.uint64(xxhash.xxh3_64_intdigest(END_MARK))


def block_tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each with its end, and the number of tokens of each text."""
    words, lengths = [], np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        before = len(words)
        words += text.lower().split()
        words.append(END_MARK)
        lengths[i] = len(words) - before
    return hash_words(words), lengths


def pairs_of(tokens: np.ndarray) -> np.ndarray:
    """A key for each token with the one before it. Every text ends with the end token, so texts begin after one."""
    before = np.concatenate([END[None], tokens[:-1]])
    return cut(mix64(mix64(before) + tokens), WIDTHS[2])


def _ask(buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Requests of each block: its distinct tokens and pairs with their counts in training texts."""

        def block_requests(block: int, texts: list, trains: list) -> pa.RecordBatch:
            tokens, lengths = block_tokens([(t or "").encode("utf-8", "surrogatepass") for t in texts])
            weight = np.repeat(np.array(trains, bool), lengths)
            rows = []
            for kind, keys in ((1, tokens), (2, pairs_of(tokens))):
                distinct, index = np.unique(keys, return_inverse=True)
                counts = np.bincount(index, weight, len(distinct))
                rows += requests(block, kind, distinct, counts, WIDTHS[kind], buckets)
            return request_batch(rows)

        yield from by_block(batches, block_requests)

    return ask


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(train_tokens: int, vocabulary: int):
    def score(docs: pa.Table, replies: pa.Table) -> pa.Table:
        """The automaton restricted to a block: a state for each token seen, an arc for each pair seen in training.

        From state h a known pair (h, w) has an arc of weight log10((c(hw) + B p(w)) / (c(h) + B)) to state w. Any other
        token takes the failure arc of weight log10(B / (c(h) + B)) to the root and the root's arc log10 p(w). Each
        text starts in the state of the end token, and the sums run along its tokens.
        """
        tokens, lengths = block_tokens([grow(t) for t in docs.column("packed").to_pylist()])
        distinct, state = np.unique(tokens, return_inverse=True)
        pairs, arc = np.unique(pairs_of(tokens), return_inverse=True)
        count, pair_count = reply_of(replies, 1, len(distinct)), reply_of(replies, 2, len(pairs))
        root = np.log10((count + ADD) / (train_tokens + ADD * (vocabulary + 1)))
        failure = np.log10(BACKOFF / (count + BACKOFF))
        start = np.searchsorted(distinct, END)
        before = np.concatenate([[start], state[:-1]]).astype(np.int64)
        base = root[state]
        with np.errstate(divide="ignore"):
            known = np.log10((pair_count[arc] + BACKOFF * 10**base) / (count[before] + BACKOFF))
        step = np.where(pair_count[arc] > 0, known, failure[before] + base)
        at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        n = len(lengths)
        return pa.table(
            [
                docs.column("doc_id"),
                docs.column("held_out"),
                pa.array(lengths),
                pa.array(np.add.reduceat((count > 0)[state].astype(np.int64), at)),
                pa.array(np.full(n, train_tokens)),
                pa.array(np.add.reduceat(base, at)),
                pa.array(np.add.reduceat(step, at)),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return score


def score_corpus(docs: DataFrame, folds: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its log10 probability under a model learned from all rows outside the held-out fold.

    Counts of all tokens and pairs of all training texts are exact sums over the corpus (exchange.py); no token is dropped or capped, and no table of them is held in
    one place. The score's smoothing needs only c(hw), c(h) and the base model: p(w|h) = (c(hw) + B p(w)) / (c(h) + B),
    which adds up to 1 over all tokens.

    Defined results: a null text counts as empty and has one token, the end; a null id isn't held out; repeated rows
    all count; an empty table gives no rows; other columns are ignored.
    """
    rows = with_block(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(text_col).alias("text"),
            held_out(F.col(id_col), folds).alias("held_out"),
        )
    )
    buckets = buckets_for(docs.count())
    asked = rows.select("block", "text", (~F.col("held_out")).alias("trains")).mapInArrow(_ask(buckets), REQUEST)
    replies = durable(answers(asked, WIDTHS))
    train_tokens, vocabulary = (
        replies.filter("block = -1 AND kind = 1").agg(F.sum("total"), F.sum("distinct")).first()
    )
    return (
        shrunk(rows)
        .groupBy("block")
        .cogroup(replies.filter("block >= 0").groupBy("block"))
        .applyInArrow(_score(train_tokens or 0, vocabulary or 0), SCORED)
    )
