"""Ranked search, chat formatting and hard negatives against plain versions of their definitions."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotframe.llm import chat, hard_negatives, queries, ranked_search

from .plain import TABLE, same


def ranks(rows, items, top):
    """Score of every item and document by the definition, in Python's whole numbers."""
    words = [(t or "").encode().translate(TABLE).split() for _, t in rows]
    n, total = sum(1 for w in words if w), sum(map(len, words))
    df = Counter(x for w in words for x in set(w))
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, Counter()).update((text or "").encode().translate(TABLE).split())
    out = []
    for item, terms in wanted.items():
        found = []
        for (i, _), w in zip(rows, words, strict=True):
            tf = Counter(w)
            score = 0
            for x, q in terms.items():
                if tf[x]:
                    m = 100 - 75 + (75 * len(w) * n) // total
                    score += q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((10**9 * tf[x]) // (1000 * tf[x] + 8 * m))
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda r: (r[0], r[1], 0 if r[1] else r[2]))
        out += [(item, k, i, -s) for k, (s, _, i) in enumerate(found[:top], 1)]
    return out


def asked(corpus):
    texts = [t for _, t in corpus if t and len(t) > 200][:8]
    items = [(k, t[: 150 + 20 * k]) for k, t in enumerate(texts)]
    # Shared parts, a repeated row, an item in two rows, and items without terms.
    items += [(20, texts[0][:90] + " " + texts[1][:90]), (21, texts[0][:90] + " " + texts[1][:120]), (22, texts[0][:90])]
    return [*items, items[0], (3, "same one"), (30, None), (31, " . "), (None, texts[2][:80]), (32, "É É É straße nowhere")]


@pytest.mark.parametrize("top, block_chars", [(10, ranked_search.BLOCK_CHARS), (3, 500)])
def test_ranks_equal_the_definition(spark, docs, corpus, top, block_chars):
    items = asked(corpus)
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, doc_id long, rank string")
    found = ranked_search.search(docs, table, top=top, block_chars=block_chars)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    same(map(tuple, found.collect()), ranks(corpus, items, top))


def test_shared_sets_are_computed_once():
    rng = random.Random(3)
    shared = [{t: 1 for t in rng.sample(range(50, 80), 6)} for _ in range(4)]
    items = [{t: rng.choice([1, 1, 2]) for t in rng.sample(range(50), 9)} for _ in range(30)]
    items = [{**a, **shared[k % 4], **shared[(k + 1) % 4]} for k, a in enumerate(items)] + [{}, {7: 3}]
    dag = ranked_search.mine(items)
    sums = [Counter(dict(leaf)) for leaf in dag.leaves]
    for a, b in dag.pairs:
        assert not sums[a].keys() & sums[b].keys()
        sums.append(sums[a] + sums[b])
    assert [dict(sum((sums[k] for k in row), Counter())) for row in dag.items] == [dict(t) for t in items]
    assert dag.pairs
    # No two items hold the same two nodes next to each other.
    pairs = Counter(p for row in dag.items for p in zip(row, row[1:], strict=False))
    assert max(pairs.values()) == 1


def test_search_over_nothing(spark, docs, none):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert ranked_search.search(none, items).count() == 0
    assert ranked_search.search(docs, items.limit(0)).count() == 0
    assert ranked_search.search(docs, spark.createDataFrame([(1, None), (2, "zzzz")], items.schema)).count() == 0


HARD = [
    "", " ", "\n", "plain", "\\", "ends in \\", "### Assistant:", "\\### Assistant: </turn> ok", "</turn>", "\n</turn>\n",
    "\\\\</turn>\\", "### Assistant: a\n</turn>\n### User: b", "### =x: y", "###Assistant:", "### assistant:", "</turn", "日本 ### System: é",
    "a</turn></turn>b", "\\\\\\### User:### User:", "x" * 100_000 + "</turn>", "### User: " * 2_000,
]


@pytest.mark.parametrize("role", ["system", "user", "assistant", "", "User", "tool: x\n</turn>", "=", "é %"])
def test_turns_come_back(role):
    for text in HARD:
        shown, start, stop = chat.render(role, text)
        assert chat.parse(shown) == [(role, text, start, stop)]
        assert chat.unescape(shown[start:stop]) == text
    both = "".join(chat.render(role, t)[0] for t in HARD)
    assert [t[:2] for t in chat.parse(both)] == [(role, t) for t in HARD]


def test_any_text_comes_back():
    rng = random.Random(5)
    parts = ["\\", "\\\\", "### ", "Assistant", ":", "User:", "=", "</turn>", "\n", " ", "a", "</", "turn>", "#"]
    for _ in range(3_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        shown, start, stop = chat.render("user", text)
        assert chat.parse(shown + shown) == [("user", text, start, stop), ("user", text, start + len(shown), stop + len(shown))]
        # What may start or end a turn stands in the text only behind a backslash.
        assert all(m[1] for m in chat.CONTROL.finditer(shown[start:stop]))


@pytest.mark.parametrize("broken", ["x", "### User: a", "### User: a</turn>\n", "### User: a\n</turn>", "### Nobody: a\n</turn>\n", "### User: a ### User: b\n</turn>\n"])
def test_other_texts_are_rejected(broken):
    with pytest.raises(chat.Conflict):
        chat.parse(broken)


def test_conversations_are_read_back(spark):
    rng = random.Random(7)
    roles = ["system", "user", "assistant", "tool", None]
    rows = [(c, t, rng.choice(roles), rng.choice([*HARD, None])) for c in [*range(30), None] for t in range(rng.randint(1, 6))]
    rows += [(100, t, "user", "again") for t in (1, 1, 2)] + [(101, None, "assistant", "b"), (101, 0, "assistant", "c")]
    rows += [(102, t, rng.choice(["user", "assistant"]), f"turn {t}") for t in range(3_000)]
    schema = "conv_id long, turn long, role string, text string, formatted string, loss_start string, n_turns string"
    table = spark.createDataFrame([(*r, "f", "l", "n") for r in rows], schema).repartition(5)
    formatted = chat.format_turns(table)
    assert formatted.columns == ["conv_id", "turn", "formatted", "loss_start", "loss_stop"]
    expected = []
    for conv in {r[0] for r in rows}:
        mine = [(t is not None, t or 0, chat.render(r or "", x or "")[0], r or "", x or "") for c, t, r, x in rows if c == conv]
        mine.sort()
        turns = "".join(f"{r}\n{x}\n" for *_, r, x in mine)
        loss = "".join(x for *_, r, x in mine if r == "assistant")
        digests = [hashlib.sha256(s.encode()).hexdigest() for s in (turns, loss)]
        expected.append((conv, len(mine), digests[0], len(loss), digests[1], sum(len(m[2]) for m in mine)))
    same(map(tuple, chat.read_back(formatted).collect()), expected)
    assert chat.read_back(chat.format_turns(table.limit(0))).count() == 0


def mined(rows, k_pos=5, k_neg=5):
    usable = [(i, x, v) for i, v, x in rows if x is not None and i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    usable = [(i, (x + 1) % 10 if i % 7 == 0 else x, [math.floor(256 * c) for c in v]) for i, x, v in usable]
    asked = {(i, x, tuple(v)) for i, x, v in usable if i % 100 == 0}
    out = []
    for i, x, v in asked:
        scores = [(-sum(a * b for a, b in zip(v, w)), j, y) for j, y, w in usable]
        positives = sorted((s, j) for s, j, y in scores if y == x and j != i)[:k_pos]
        for s, j in positives:
            lower = sorted((t, n) for t, n, y in scores if y != x and 80 * -s <= 100 * -t <= 100 * -s)[:k_neg]
            out += [(i, j, k, n, -s, -t) for k, (t, n) in enumerate(lower, 1)]
    return out


VECTORS = "vec_id long, embedding array<float>, label int, rank string, _score string"


@pytest.mark.parametrize("block_rows, block_anchors", [(2_048, 4_096), (60, 3)])
def test_negatives_equal_the_definition(spark, block_rows, block_anchors):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=24).astype(np.float32).tolist(), int(rng.integers(0, 4))) for k in range(600)]
    for k in range(700, 760):
        # Copies of one vector, so many scores are equal.
        rows.append((k, rows[100][1], k % 3))
    rows += [(900, rows[5][1], None), (901, None, 1), (902, [1.0, None], 1), (903, [float("nan")] * 24, 1), (904, [float("inf")] + [0.0] * 23, 2)]
    rows += [(None, rows[5][1], 1), (1000, rows[0][1], 2), (1000, rows[0][1], 2), (1000, rows[1][1], 3), rows[7], (1100, [0.0] * 24, 1)]
    rows += [(1200, [1.0, 2.0], 1), (1201, [], 1), (1300, [], 2)]
    table = spark.createDataFrame([(*r, "r", "s") for r in rows], VECTORS).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.hard_negatives(
        table, F.col("vec_id") % 100 == 0, label, block_rows=block_rows, block_anchors=block_anchors
    )
    same(map(tuple, found.collect()), mined(rows))


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(k, (rng.normal(size=12) * 30_000).astype(np.float32).tolist(), int(k % 2)) for k in range(300)]
    table = spark.createDataFrame([(*r, "r", "s") for r in rows], VECTORS)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    same(map(tuple, hard_negatives.hard_negatives(table, F.col("vec_id") % 100 == 0, label).collect()), mined(rows))
    with pytest.raises(Exception, match="too large"):
        hard_negatives.hard_negatives(spark.createDataFrame([(0, [1e9], 1, "r", "s")], VECTORS), F.lit(True)).collect()


def test_no_anchors_no_negatives(spark):
    table = spark.createDataFrame([(1, [1.0], 1, "r", "s"), (2, [1.0], 2, "r", "s")], VECTORS)
    assert hard_negatives.hard_negatives(table, F.lit(False)).count() == 0
    assert hard_negatives.hard_negatives(table.limit(0), F.lit(True)).count() == 0


def test_bounds_shrink_the_candidates():
    """An anchor with a few large components reads few dimensions for rows that can't matter."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    v = rng.integers(-3, 4, (500, 64))
    v[:, :8] *= 100
    table = pa.table({"_id": np.arange(500), "_label": np.zeros(500, dtype=np.int64), "_v": pa.array(v.tolist(), pa.list_(pa.int64()))})
    rows = hard_negatives._Rows(table, 64)
    left = []

    def drop(low, high):
        keep = high >= hard_negatives._at_least(low, 5)
        left.append(int(keep.sum()))
        return keep

    rows.scan(v[0].astype(float), np.arange(500), drop)
    assert left[0] < 50 and left == sorted(left, reverse=True) and left[-1] >= 5


@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_chat_format", "op13_hard_negatives"])
def test_new_queries_are_registered_with_sql(name):
    assert name in queries.QUERIES and name in queries.ORACLES
