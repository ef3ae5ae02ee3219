"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, union-find."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import stable
from .common import LOWER_TABLE, MIX1, WordHashes, list_column, mixed, raw_texts, steps, window_hashes
from .components import components

SHINGLE = 5
# A link has 100 * intersection >= PERCENT * union.
PERCENT = 80
# A pair at the limit shares no band with probability (1 - 0.8 ** ROWS) ** BANDS = 2e-6.
BANDS, ROWS = 44, 6
# Elements of the sets of one block; a task compares two blocks.
BLOCK_ELEMENTS = 1 << 20

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes], hashes: WordHashes, width: int) -> list[np.ndarray]:
    """Distinct 64-bit hashes of every text's shingles, ascending."""
    words = [t.translate(LOWER_TABLE).split() for t in texts]
    sizes = [len(w) for w in words]
    flat = hashes.of([w for own in words for w in own])
    out, at = [], 0
    for n in sizes:
        own = flat[at : at + n]
        at += n
        # A sequence that is too short for a shingle counts whole, and never equals a shingle.
        short = 0 < n < width
        values = window_hashes(own, n if short else width) if n else own
        out.append(np.unique(mixed(values ^ np.uint64(int(GOLDEN) * n % (1 << 64)) if short else values)))
    return out


def super_minhash(elements: np.ndarray, owner: np.ndarray, n_sets: int, size: int) -> np.ndarray:
    """SuperMinHash signatures (sets x size) of sets given as elements with the number of their set.

    Every element owns a random permutation of the positions and offers to the position of rank j the value j + r_j, r_j
    being uniform in [0, 1). A signature keeps the least offer per position. Ranks are dealt level by level to all
    elements at once; a set stops as soon as all its positions have values below the next rank, since no later offer can be
    lower. Values have the rank in the upper and r in the lower 32 bits.
    """
    least = np.full((n_sets, size), np.iinfo(np.uint64).max, dtype=np.uint64)
    picks: list[np.ndarray] = []
    for rank in range(size):
        x = mixed(elements + np.uint64(int(GOLDEN) * (rank + 1) % (1 << 64)))
        fraction = x >> np.uint64(32)
        pick = rank + ((x & np.uint64(0xFFFFFFFF)) * np.uint64(size - rank) >> np.uint64(32)).astype(np.int64)
        # Where the pick's place came from in the swaps of the earlier ranks.
        position = pick.copy()
        for i in range(rank - 1, -1, -1):
            position[position == picks[i]] = i
        np.minimum.at(least.reshape(-1), owner * size + position, np.uint64(rank << 32) | fraction)
        open_set = least.max(axis=1) >= np.uint64((rank + 1) << 32)
        going = open_set[owner]
        if not going.any():
            break
        picks.append(pick)
        if not going.all():
            elements, owner = elements[going], owner[going]
            picks = [p[going] for p in picks]
    return least


def _band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), 1))
    parts = signatures.reshape(len(signatures), bands, rows)
    for row in range(rows):
        keys = mixed(keys * MIX1 ^ parts[:, :, row])
    return keys.view(np.int64)


def _names(sets: list[np.ndarray]) -> list[bytes | None]:
    """A 128-bit name of the whole set; none for an empty one."""
    out: list[bytes | None] = []
    for own in sets:
        if len(own):
            total = int(mixed(own).sum(dtype=np.uint64))
            other = int(np.bitwise_xor.reduce(mixed(own + GOLDEN)))
            out.append(total.to_bytes(8, "big") + (other ^ len(own)).to_bytes(8, "big"))
        else:
            out.append(None)
    return out


def _sketch(batches: Iterable[pa.RecordBatch], width: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in steps(batches):
        sets = shingle_sets(raw_texts(batch), hashes, width)
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        signatures = super_minhash(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets), bands * rows)
        keys = _band_keys(signatures, bands, rows)
        lists = [k if n else k[:0] for k, n in zip(keys, sizes, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_id"),
                batch.column("_key"),
                pa.array(sizes),
                pa.array(_names(sets), type=pa.binary()),
                list_column(lists, pa.int64()),
            ],
            ["_id", "_key", "n", "node", "bands"],
        )


def _sets(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in steps(batches):
        sets = shingle_sets(raw_texts(batch), hashes, width)
        values = list_column([s.view(np.int64) for s in sets], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(_names(sets), type=pa.binary()), values], ["node", "elements"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    a = sets.select(F.col("node").alias("a"), F.col("elements").alias("_a"))
    b = sets.select(F.col("node").alias("b"), F.col("elements").alias("_b"))
    shared = F.size(F.array_intersect("_a", "_b")).cast("long")
    joined = pairs.join(a, "a").join(b, "b").withColumn("_shared", shared)
    union = F.size("_a") + F.size("_b") - F.col("_shared")
    return joined.where(100 * F.col("_shared") >= percent * union).select("a", "b")


def _linked_in_blocks(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between nodes of different components that share a band.

    The nodes of a band are dealt to blocks of about BLOCK_ELEMENTS, and a task gets two blocks with their sets. It compares all
    their pairs and returns the links that connect something new, so rows in and out grow with nodes, not with pairs.
    """
    blocks = F.ceil(F.col("members") * F.col("mean_n") / F.lit(BLOCK_ELEMENTS)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")
    dealt = (
        rest.withColumn("_blocks", blocks)
        .withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .select("band", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), "_own", "node", "root")
    )

    def compare(rows: pa.Table) -> pa.Table:
        nodes, roots = rows.column("node").to_pylist(), rows.column("root").to_pylist()
        elements = rows.column("elements").combine_chunks()
        sizes = np.diff(elements.offsets.to_numpy())
        values, where = np.unique(elements.flatten().to_numpy(), return_inverse=True)
        # An element of one set only is in no intersection.
        often = np.bincount(where, minlength=len(values)) > 1
        place = np.cumsum(often) - 1
        bits = np.zeros((len(nodes), max(1, int(often.sum()) + 63 >> 6)), dtype=np.uint64)
        row, at = np.repeat(np.arange(len(nodes)), sizes)[often[where]], place[where[often[where]]]
        np.bitwise_or.at(bits, (row, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
        number = {r: k for k, r in enumerate(dict.fromkeys(roots))}
        component = np.array([number[r] for r in roots])
        block = rows.column("_own").to_numpy()
        a_out, b_out = [], []
        for k in range(len(nodes)):
            # With one block every pair comes once; with two, pairs inside a block are left to the task of that block.
            partner = np.flatnonzero(component[k + 1 :] != component[k]) + k + 1
            if block.min() != block.max():
                partner = partner[block[partner] != block[k]]
            if not len(partner):
                continue
            shared = np.bitwise_count(bits[partner] & bits[k]).sum(axis=1, dtype=np.int64)
            for m in partner[100 * shared >= percent * (sizes[partner] + sizes[k] - shared)].tolist():
                if component[m] != component[k]:
                    a_out.append(min(nodes[k], nodes[m]))
                    b_out.append(max(nodes[k], nodes[m]))
                    component[component == component[m]] = component[k]
        return pa.table([pa.array(a_out, type=pa.binary()), pa.array(b_out, type=pa.binary())], names=["a", "b"])

    return dealt.join(sets, "node").groupBy("band", "i", "j").applyInArrow(compare, "a binary, b binary").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Groups of linked rows: ``id_col``, ``n_shingles``, ``component_id``, ``kept``.

    Words stand between ASCII white space, A-Z lower-cased. A row's set has the distinct shingles of ``shingle`` words,
    as 64-bit hashes; a shorter text counts whole; a text without words has the empty set and no link. Rows are linked
    when 100 * intersection >= percent * union. ``component_id`` is the smallest id that links reach.

    Rows with the same set are one node from the start. Nodes that share a band are candidates. Of a band's nodes, first
    all are compared with the smallest one, which settles a group of copies in one comparison each. While a band still
    has nodes in different components, growing random parts of them (finally all) are compared with those of the other
    components. So no group is expanded into pairs that links already connect, and no candidate is left out.

    A null text has no words; a null id is never the smallest unless all are null; rows that repeat an id and a text
    share their result; an empty table gives no rows; other columns are ignored.
    """
    return _grouped(docs, id_col, text_col, shingle, percent, bands, rows).select(
        F.col("_id").alias(id_col), "n_shingles", "component_id", "kept"
    )


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, bands: int, rows: int) -> DataFrame:
    """Rows (_id, _key, n_shingles, component_id, kept); _key is a hash of the text."""
    table = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_key"), F.col(text_col).cast("string").alias("_text"))
    kind = table.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, _key long, n long, node binary, bands array<long>"
    sketch = stable(table.mapInArrow(lambda b: _sketch(b, shingle, bands, rows), schema))
    place = F.struct("_id", "_key")
    nodes = stable(
        sketch.where("n > 0").groupBy("node").agg(F.min(place).alias("_place"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    )
    offered = nodes.select("node", "n", F.explode("bands").alias("band"))
    least = F.min(F.struct("node", "n"))
    hubs = offered.groupBy("band").agg(least.alias("_hub"), F.count(F.lit(1)).alias("members"), F.avg("n").alias("mean_n")).where("members > 1")
    shared = stable(offered.join(hubs, "band"))

    def near(n: str, m: str):
        # Sets of one size ratio only can be similar enough.
        return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (F.col(n) > 0)

    first = (
        shared.where(F.col("node") != F.col("_hub.node"))
        .select(F.col("_hub.node").alias("a"), F.col("node").alias("b"), F.col("_hub.n").alias("_n"), F.col("n").alias("_m"))
        .where(near("_n", "_m"))
        .select("a", "b")
        .distinct()
    )
    candidates = shared.select("node").distinct()
    places = nodes.join(candidates, "node", "left_semi").select(F.col("_place._id").alias("_i"), F.col("_place._key").alias("_k"))
    same = F.col("_id").eqNullSafe(F.col("_i")) & F.col("_key").eqNullSafe(F.col("_k"))
    chosen = table.join(places, same, "left_semi").select("_text")
    sets = stable(chosen.mapInArrow(lambda b: _sets(b, shingle), "node binary, elements array<long>").dropDuplicates(["node"]))

    links = stable(_verified(first, sets, percent))
    found = components(links)
    known = shared.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # The smallest node has been compared with all others.
    others = known.where(F.col("node") != F.col("_hub.node")).select("band", "node", "root", "members", "mean_n")
    open_bands = others.groupBy("band").agg(F.min("root").alias("_low"), F.max("root").alias("_high"))
    open_bands = open_bands.where(F.col("_low") != F.col("_high")).select("band")
    rest = stable(others.join(open_bands, "band"))
    if not rest.isEmpty():
        links = stable(links.unionByName(_linked_in_blocks(rest, sets, percent)))
        found = components(links)

    roots = sketch.join(found, "node", "left").select("_id", "_key", "n", F.coalesce("root", "node").alias("root"))
    roots = stable(roots)
    # Written, so that Spark may split the rows of a large component in the join.
    smallest = stable(roots.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("_id").alias("component_id")))
    many = roots.where(F.col("root").isNotNull()).join(smallest, "root")
    empty = roots.where(F.col("root").isNull()).withColumn("component_id", F.col("_id"))
    return many.unionByName(empty.select(*many.columns)).select(
        "_id", "_key", F.col("n").alias("n_shingles"), "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def without_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """The smallest id of every group and all rows without a link, all columns as they were."""
    kept = _grouped(docs, id_col, text_col, shingle, percent, bands, rows).where("kept")
    kept = kept.select(F.col("_id").alias("_kept"), F.col("_key").alias("_kept_key"))
    same = F.col(id_col).eqNullSafe(F.col("_kept")) & (F.xxhash64(F.col(text_col)) == F.col("_kept_key"))
    return docs.join(kept, same, "left_semi")
