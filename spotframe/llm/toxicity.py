"""Toxicity scores from averaged subword embeddings and a linear softmax, trained jointly."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CACHE_WORDS, STEP_BYTES, mixed, ranges, steps, two_columns, window_hashes

# Character n-grams of a word with its marked ends.
SHORTEST, LONGEST = 3, 6
BUCKETS = 1 << 17
DIMENSIONS = 8
# Consecutive words that are averaged together, each different one once; a text has the score of its most toxic window.
WINDOW = 128

# Words whose n-grams are cut side by side.
STEP_WORDS = 8_192

# The most labelled rows that training reads, and the most characters of one of them.
TRAIN_ROWS = 8_000
TRAIN_CHARS = 20_000

EPOCHS = 12
BATCH = 256
RATE = 0.3
SEED = 7

EDGES = ".,;:!?\"'()[]{}|*#%$&-_/\\<>=+~`^"


def words_of(text: str) -> list[str]:
    return text.lower().split()


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word's n-grams and of the word itself, one word after the other, and their number per word."""
    parts = [_subwords(words[k : k + STEP_WORDS]) for k in range(0, len(words), STEP_WORDS)]
    return np.concatenate([b for b, _ in parts]), np.concatenate([n for _, n in parts])


def _subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    marked = [f"<{w.strip(EDGES)}>" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    sizes = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    ends = np.cumsum(sizes)
    word, at = np.repeat(np.arange(len(words)), sizes), np.arange(len(codes))
    left = np.repeat(ends, sizes) - at
    hashes, owners = [], []
    for n in range(SHORTEST, LONGEST + 1):
        if len(codes) >= n:
            fits = left[: len(codes) - n + 1] >= n
            hashes.append(window_hashes(codes, n)[fits] + np.uint64(n))
            owners.append(word[: len(codes) - n + 1][fits])
    power = np.cumprod(np.full(int(sizes.max(initial=1)), 0x9E3779B97F4A7C15, dtype=np.uint64))
    place = at - np.repeat(ends - sizes, sizes)
    hashes.append(np.add.reduceat(codes * power[place], ends - sizes))
    owners.append(np.arange(len(words)))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    buckets = (mixed(np.concatenate(hashes)[order]) % np.uint64(BUCKETS)).astype(np.int32)
    return buckets, np.bincount(owner, minlength=len(words)).astype(np.int32)


@dataclass
class Model:
    """What scoring needs of the embeddings and the softmax: one number per bucket, and the bias."""

    weights: np.ndarray
    bias: float


class Bags:
    """Sum of weights and number of subwords for the words that a task meets, by number of the word."""

    def __init__(self, model: Model):
        self.model = model
        self.number: dict[str, int] = {}
        self.sums, self.counts = np.empty(0), np.empty(0)

    def of(self, words: list[str]) -> np.ndarray:
        """Numbers of the words; new words are taken up together."""
        if len(self.number) > CACHE_WORDS:
            self.__init__(self.model)
        new = list(set(words).difference(self.number))
        if new:
            buckets, sizes = subwords(new)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
            sums = np.add.reduceat(self.model.weights[buckets].astype(np.float64), np.cumsum(sizes) - sizes)
            self.sums, self.counts = np.concatenate([self.sums, sums]), np.concatenate([self.counts, sizes])
        return np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words))


def window_means(ids: np.ndarray, lengths: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean weight of the subwords in every window of every text, and the number of windows per text.

    ``ids`` are the words of all texts one after the other. Windows hold WINDOW words and start every half of one; the last ends with the
    text. Every word is read where it stands; in a window, a word that stands there several times counts once.
    """
    half = WINDOW // 2
    n_windows = np.maximum(-(-lengths // half) - 1, 1)
    text = np.repeat(np.arange(len(lengths)), lengths)
    begin = np.cumsum(lengths) - lengths
    place = np.arange(len(ids)) - begin[text]
    # Where the word stood last in the same text.
    order = np.lexsort((ids, text))
    again = (ids[order[1:]] == ids[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    before = np.full(len(ids), -1)
    before[order[1:][again]] = place[order[:-1][again]]
    base = np.cumsum(n_windows) - n_windows
    total, number = np.zeros(int(n_windows.sum())), np.zeros(int(n_windows.sum()))
    own = place // half
    # A word is in the window that starts with its half, and in the one before.
    for window in (own, own - 1):
        inside = (window >= 0) & (window < n_windows[text]) & (before < window * half)
        at = (base[text] + window)[inside]
        total += np.bincount(at, sums[ids[inside]], len(total))
        number += np.bincount(at, counts[ids[inside]], len(total))
    return total / np.maximum(number, 1), n_windows


def score_texts(texts: list[str], bags: Bags) -> np.ndarray:
    """Probability of the toxic class per text: that of its most toxic window."""
    words = [words_of(text) for text in texts]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ids = bags.of(list(chain.from_iterable(words)))
    means, n_windows = window_means(ids, lengths, bags.sums, bags.counts)
    out = np.maximum.reduceat(means, np.cumsum(n_windows) - n_windows) + bags.model.bias
    return 1.0 / (1.0 + np.exp(-np.clip(out, -50, 50)))


def train(texts: list[str], labels: list[int], seed: int = SEED) -> Model:
    """Embeddings and softmax fitted together by gradient steps on the texts' windows.

    The window that the model finds most toxic so far stands for its text, as in scoring: so words around an insult are not
    learned as insults, and a clean text shows what looks worst in it. Without both classes the score is the share of ones.
    """
    y_all = np.array(labels, dtype=np.int64)
    share = float(y_all.mean()) if len(y_all) else 0.0
    prior = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS, dtype=np.float32), prior)
    number: dict[str, int] = {}
    docs = []
    for text in texts:
        docs.append(np.array([number.setdefault(w, len(number)) for w in words_of(text) or [""]], dtype=np.int32))
    flat, size = subwords(list(number))
    del number
    size = size.astype(np.int64)
    begin = np.cumsum(size) - size
    rng = np.random.default_rng(seed)
    table = (rng.random((BUCKETS, DIMENSIONS)) - 0.5).astype(np.float32) / DIMENSIONS
    soft = (rng.random((DIMENSIONS, 2)) - 0.5).astype(np.float32)
    bias = np.array([0.0, prior], dtype=np.float64)
    g_table, g_soft, g_bias = np.full((BUCKETS, DIMENSIONS), 1e-8), np.full((DIMENSIONS, 2), 1e-8), np.full(2, 1e-8)
    for epoch in range(EPOCHS):
        slope = table @ (soft[:, 1] - soft[:, 0])
        per_word = np.add.reduceat(slope[flat], begin).astype(np.float64)
        order = rng.permutation(len(docs))
        for i in range(0, len(order), BATCH):
            part = order[i : i + BATCH]
            chosen, y = [docs[k] for k in part], y_all[part]
            lengths = np.array([len(w) for w in chosen])
            means, n_windows = window_means(np.concatenate(chosen), lengths, per_word, size)
            windows = []
            for words, own in zip(chosen, np.split(means, np.cumsum(n_windows)[:-1]), strict=True):
                at = int(np.argmax(own)) if epoch else int(rng.integers(len(own)))
                start = at * (WINDOW // 2)
                windows.append(np.unique(words[start : start + WINDOW]))
            words = np.concatenate(windows)
            lengths = np.array([len(w) for w in windows])
            owner_of_word = np.repeat(np.arange(len(windows)), lengths)
            index = flat[ranges(begin[words], size[words])]
            owner = np.repeat(owner_of_word, size[words])
            counts = np.bincount(owner, minlength=len(windows))
            mean = np.add.reduceat(table[index], np.cumsum(counts) - counts, axis=0) / counts[:, None]
            logits = mean @ soft + bias
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(axis=1, keepdims=True)
            error = p
            error[np.arange(len(y)), y] -= 1
            error /= len(y)
            d_soft, d_bias, d_mean = mean.T @ error, error.sum(axis=0), (error @ soft.T) / counts[:, None]
            touched, where = np.unique(index, return_inverse=True)
            d_table = np.stack([np.bincount(where, d_mean[owner, d], len(touched)) for d in range(DIMENSIONS)], axis=1)
            g_table[touched] += d_table**2
            table[touched] -= RATE * d_table / np.sqrt(g_table[touched])
            g_soft += d_soft**2
            soft -= (RATE * d_soft / np.sqrt(g_soft)).astype(np.float32)
            g_bias += d_bias**2
            bias -= 0.1 * RATE * d_bias / np.sqrt(g_bias)
    return Model((table @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that training never reads: a quarter, by a checksum of the id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows: int = TRAIN_ROWS,
    chars: int = TRAIN_CHARS,
) -> Model:
    """A model from at most ``rows`` labelled rows outside the held-out quarter, of at most ``chars`` characters each.

    The rows are those with the smallest hash of their id, so the sample is the same in every run. Only texts and labels
    reach the driver, and only texts are inputs. Null ids, texts and labels are not drawn; an id that repeats gives each
    of its rows.
    """
    drawn = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isNotNull() & ~held_out("_id"))
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(rows)
    )
    texts = two_columns(docs, id_col, text_col).where(F.char_length("_text") <= chars)
    # At most ``rows`` labels, so the broadcast is bounded, and so is what is collected.
    found = texts.join(F.broadcast(drawn), "_id").select("_id", "_text", "_label")
    table = found.orderBy(F.xxhash64("_id"), "_id", "_text", "_label").limit(rows).toArrow()
    return train(table.column("_text").to_pylist(), table.column("_label").to_pylist())


def score(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Every row with ``score``, 0 to 1, higher for texts that are likelier toxic; all other columns stay.

    Without ``keep_text`` the text column goes, so that texts need not come back from the Python workers.

    A null text counts as empty and has the score of the bias alone; rows are independent of each other; an empty
    table gives no rows; a column called ``score`` is replaced.
    """
    rest = [c for c in docs.columns if c not in (text_col, "score")]
    rows = docs.select(F.col(text_col).cast("string").alias("_text"), F.struct(F.lit(0).alias("_"), *rest).alias("_rest"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags = Bags(shared.value)
        for batch in steps(batches, limit=STEP_BYTES):
            found = score_texts(pc.fill_null(batch.column("_text"), "").to_pylist(), bags)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(found)], [*names, "score"])

    names = ["_text", "_rest"] if keep_text else ["_rest"]
    found = rows.mapInArrow(work, rows.select(*names, F.lit(0.0).alias("score")).schema)
    kept = [c for c in docs.columns if c != "score" and (keep_text or c != text_col)]
    return found.select(*[F.col("_text").alias(c) if c == text_col else F.col("_rest")[c].alias(c) for c in kept], "score")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows that score below the threshold, all columns as they were."""
    plain = docs.select(*[F.col(c).alias(f"_score_{c}" if c == "score" else c) for c in docs.columns])
    found = score(plain, fit(docs, labels, id_col, text_col), text_col).where(F.col("score") < threshold).drop("score")
    return found.select(*[F.col(f"_score_{c}" if c == "score" else c).alias(c) for c in docs.columns])
