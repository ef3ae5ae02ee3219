"""Ranked lexical search for many items at once, with what items share computed once.

The terms of a block of items are mined for sets that several items hold: elements (a term and how often an item repeats it)
with the same items form the leaves, and pairs of nodes that several items hold next to each other become inner nodes, until
none repeats. So the items share a DAG whose nodes are sums of scores. One pass over the documents counts the items' terms;
a second one materialises, for a slice of documents, the accumulators of every node once, adds them up along the DAG to
those of the items, and keeps the best documents of each item.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.storage import stable
from .common import ALNUM_TABLE, raw_texts, ranges, steps, two_columns

TOP = 10
# Characters of items whose terms and nodes travel to the executors at a time; more items take more passes.
BLOCK_CHARS = 4 << 20
# Documents whose accumulators a task holds at a time.
SLICE = 1_024
# Parts of an item's candidates that are ranked before all of them are.
SALTS = 64


class Dag(NamedTuple):
    """Nodes in an order in which both parents of a node come before it.

    ``leaves`` are lists of (term, repeats); the node after the last leaf is ``pairs[0]``, made of two earlier nodes.
    ``items`` are lists of nodes that add up to an item.
    """

    leaves: list[list[tuple[int, int]]]
    pairs: list[tuple[int, int]]
    items: list[list[int]]


def mine(items: list[dict[int, int]]) -> Dag:
    """The DAG of items, each given as its terms with their repeats."""
    held: dict[tuple[int, int], list[int]] = defaultdict(list)
    for at, terms in enumerate(items):
        for element in sorted(terms.items()):
            held[element].append(at)
    groups: dict[tuple[int, ...], list[tuple[int, int]]] = defaultdict(list)
    for element, where in held.items():
        groups[tuple(where)].append(element)
    # Sets that many items hold come first, so that items agree on how they begin.
    order = sorted(groups, key=lambda where: (-len(where), where))
    rows: list[list[int]] = [[] for _ in items]
    for node, where in enumerate(order):
        for at in where:
            rows[at].append(node)
    leaves, pairs = [groups[where] for where in order], []
    while True:
        seen = Counter(pair for row in rows for pair in zip(row, row[1:], strict=False))
        named: dict[tuple[int, int], int] = {}
        # Pairs of one round don't overlap, so that each counts as often as it was seen.
        busy: set[int] = set()
        for pair, n in sorted(seen.items(), key=lambda x: (-x[1], x[0])):
            if n > 1 and not busy & set(pair):
                busy |= set(pair)
                named[pair] = len(leaves) + len(pairs)
                pairs.append(pair)
        if not named:
            return Dag(leaves, pairs, rows)
        for at, row in enumerate(rows):
            new, i = [], 0
            while i < len(row):
                node = named.get(tuple(row[i : i + 2]))
                new.append(row[i] if node is None else node)
                i += 1 if node is None else 2
            rows[at] = new


def _terms(text: bytes) -> list[bytes]:
    return text.translate(ALNUM_TABLE).split()


def _counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document its length ``_n`` in terms and those of the vocabulary with their frequencies."""
    kind = docs.schema["_id"].dataType
    known = vocabulary.keys()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            sizes, terms, counts = [], [], []
            for text in raw_texts(batch):
                words = _terms(text)
                found = Counter(words)
                common = sorted((vocabulary[w], found[w]) for w in known & found.keys())
                sizes.append(len(words))
                terms.append([t for t, _ in common])
                counts.append([n for _, n in common])
            columns = [
                batch.column("_id"),
                pa.array(sizes, pa.int64()),
                pa.array(terms, pa.list_(pa.int32())),
                pa.array(counts, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_n", "_terms", "_tf"])

    return docs.mapInArrow(run, f"_id {kind.simpleString()}, _n long, _terms array<int>, _tf array<long>")


def _accumulators(dag: Dag, terms: np.ndarray, docs: np.ndarray, values: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Scores of the documents of a slice per item; every node of the DAG is added up once."""
    order = np.argsort(terms, kind="stable")
    terms, docs, values = terms[order], docs[order], values[order]
    nodes: list[np.ndarray] = []
    for leaf in dag.leaves:
        sums = np.zeros(size, dtype=np.int64)
        wanted = np.array([t for t, _ in leaf])
        start, stop = np.searchsorted(terms, wanted), np.searchsorted(terms, wanted, "right")
        at = ranges(start, stop - start)
        repeats = np.repeat(np.array([n for _, n in leaf], dtype=np.int64), stop - start)
        np.add.at(sums, docs[at], values[at] * repeats)
        nodes.append(sums)
    for a, b in dag.pairs:
        nodes.append(nodes[a] + nodes[b])
    for item, row in enumerate(dag.items):
        if row:
            yield item, sum((nodes[k] for k in row[1:]), nodes[row[0]])


def _ranked(counted: DataFrame, dag: Dag, weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """The best documents per item in each task: (_item, _id, _score)."""
    kind = counted.schema["_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = defaultdict(list)
        least: dict[int, int] = defaultdict(lambda: 1)
        id_type = pa.null()
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                id_type = batch.column("_id").type
                ids, size = batch.column("_id").to_pylist(), batch.num_rows
                length = batch.column("_n").to_numpy()
                lists, tf = batch.column("_terms"), batch.column("_tf").flatten().to_numpy()
                docs = np.repeat(np.arange(size), lists.value_lengths().to_numpy())
                terms = lists.flatten().to_numpy()
                m = 25 + (75 * length * n_docs) // n_terms
                values = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[docs]))
                for item, scores in _accumulators(dag, terms, docs, values, size):
                    hits = np.flatnonzero(scores >= least[item])
                    if not len(hits):
                        continue
                    rows = best[item] + [(-int(scores[k]), ids[k] is None, ids[k]) for k in hits]
                    # Null ids come last and are not compared.
                    rows.sort(key=lambda r: (r[0], r[1], 0 if r[1] else r[2]))
                    best[item] = rows[:top]
                    if len(rows) >= top:
                        least[item] = -rows[top - 1][0]
        out = [(item, i, -score) for item, rows in best.items() for score, _, i in rows]
        if out:
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), id_type, pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["_item", "_id", "_score"])

    return counted.mapInArrow(run, f"_item int, _id {kind.simpleString()}, _score long")


def _block(docs: DataFrame, items: list[tuple], schema: str, top: int) -> DataFrame:
    """Ranks of all documents for a block of items (id, texts)."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    counts = []
    for _, texts in items:
        found = Counter(w for text in texts for w in _terms(text.encode()))
        counts.append({vocabulary.setdefault(w, len(vocabulary)): n for w, n in found.items()})
    counted = stable(_counted(docs, vocabulary))
    total = counted.where("_n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("_n").alias("terms")).first()
    # At most one number for each term of the block.
    df = dict(counted.select(F.explode("_terms").alias("t")).groupBy("t").count().collect())
    n = total["docs"]
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(vocabulary))]
    found = _ranked(
        counted.where(F.size("_terms") > 0), mine(counts), np.array(weights, dtype=np.int64), n, total["terms"] or 1, top
    )
    by_score = [F.col("_score").desc(), F.col("_id").asc_nulls_last()]
    salt = F.pmod(F.xxhash64("_id"), F.lit(SALTS))
    some = Window.partitionBy("_item", salt).orderBy(*by_score)
    every = Window.partitionBy("_item").orderBy(*by_score)
    first = found.withColumn("_k", F.row_number().over(some)).where(F.col("_k") <= top)
    ranked = first.withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(items)], f"_item int, _name {schema}")
    return ranked.join(F.broadcast(names), "_item").select("_name", "rank", "_id", "_score")


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The ``top`` documents of each item by score: (``item_col``, rank, ``id_col``, score); only scores above 0.

    Terms are runs of digits, ASCII letters and characters beyond ASCII, A-Z lower-cased. A term weighs
    floor(1000 ln((2N + 2) / (2 df + 1))), counted over all documents with a term; a document's score adds
    weight * (10^9 tf div (1000 tf + 8 m)) over the item's terms, repeats included, with m = 25 + 75 n N div L. Equal scores
    come by ascending id, a null id last.

    Every row of ``docs`` is a document of its own, also where ids repeat. Rows of ``items`` with the same id (null is one) are one item.
    Null and empty texts have no terms; an item without terms or hits gives no rows, nor does an empty table on
    either side. Other columns are ignored.
    """
    texts = two_columns(docs, id_col, text_col)
    wanted = items.select(F.col(item_col).alias("_name"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("_text"))
    kind = wanted.schema["_name"].dataType.simpleString()
    chars = wanted.agg(F.sum(F.char_length("_text"))).first()[0] or 0
    n_blocks = math.ceil(chars / block_chars) or 1
    dealt = wanted.withColumn("_block", F.pmod(F.xxhash64(F.col("_name").cast("string"), F.lit("block")), F.lit(n_blocks)))
    out = None
    for number in range(n_blocks):
        rows = dealt.where(F.col("_block") == number).select("_name", "_text").collect()
        joined: dict[object, list[str]] = defaultdict(list)
        for name, text in rows:
            joined[name].append(text)
        part = sorted(joined.items(), key=lambda r: (r[0] is None, 0 if r[0] is None else r[0]))
        found = stable(_block(texts, part, kind, top))
        out = found if out is None else out.unionByName(found)
    return out.select(
        F.col("_name").alias(item_col), "rank", F.col("_id").alias(id_col), F.col("_score").alias("score")
    )
