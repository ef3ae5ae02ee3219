"""Deduplication operators against plain versions of their definitions."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotframe.llm import exact_dedup, line_dedup, minhash, queries, substring_dedup
from spotframe.llm.components import components

from .plain import covered_lines, linked, same


def removed_words(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append(gone)
    return words, out


def digest(words):
    return hashlib.sha256(b" ".join(words)).hexdigest()


@pytest.mark.parametrize("bucket_words", [substring_dedup.BUCKET_WORDS, 400])
def test_repeated_spans_equal_a_plain_count(docs, corpus, bucket_words):
    """With small buckets many minimisers are heavy, so their windows travel singly."""
    found = substring_dedup.repeated_spans(docs, window=35, bucket_words=bucket_words).collect()
    words, gone = removed_words(corpus, 35)
    expected = [
        (i, len(w), len(g), digest([x for k, x in enumerate(w) if k not in g])) for (i, _), w, g in zip(corpus, words, gone, strict=True)
    ]
    got = [
        (r["doc_id"], r["n_words"], sum(s["stop"] - s["start"] for s in r["spans"]), hashlib.sha256(r["kept"].encode()).hexdigest())
        for r in found
    ]
    same(got, expected)
    for r in found:
        spans = [(s["start"], s["stop"]) for s in r["spans"]]
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_repeated_windows_survive_hash_clashes(monkeypatch):
    rng = np.random.default_rng(3)
    word = rng.integers(0, 3, 300).astype(np.int32)
    at = np.arange(300 - 5 + 1)
    seen = Counter(tuple(word[i : i + 5]) for i in at)
    expected = [seen[tuple(word[i : i + 5])] > 1 for i in at]
    monkeypatch.setattr(substring_dedup, "window_hashes", lambda h, w: np.zeros(len(h) - w + 1, dtype=np.uint64))
    assert substring_dedup._repeated(word, at, np.zeros(len(at), dtype=bool), 5).tolist() == expected
    monkeypatch.undo()
    assert substring_dedup._repeated(word, at, np.zeros(len(at), dtype=bool), 5).tolist() == expected


def test_repeated_spans_of_nothing(none):
    assert substring_dedup.repeated_spans(none).collect() == []


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_all_pairs(docs, corpus, width):
    got = [tuple(r) for r in minhash.near_duplicates(docs, shingle=width).collect()]
    same(got, linked(corpus, width, 80))


@pytest.mark.parametrize("block", [minhash.BLOCK_ELEMENTS, 1_000])
def test_chains_and_bands_without_a_common_hub(spark, monkeypatch, block):
    """Neighbours in a chain are similar, its ends are not, and the smallest set is near to none of them."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(200)]
    rows, words = [], list(base)
    for k in range(25):
        rows.append((100 - k, " ".join(words)))
        words[rng.randrange(200)] = f"x{k}"
        words[rng.randrange(200)] = f"y{k}"
    rows += [(k, " ".join(rng.sample(base, 60) + [f"z{k}-{j}" for j in range(60)])) for k in range(40)]
    monkeypatch.setattr(minhash, "BLOCK_ELEMENTS", block)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    # One row per band: bands hold far more than similar sets.
    got = [tuple(r) for r in minhash.near_duplicates(table, shingle=2, bands=48, rows=1).collect()]
    same(got, linked(rows, 2, 80))


def test_signatures_estimate_the_similarity_and_equal_the_plain_algorithm():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (1, 3, 40, 900)]
    sets.append(np.concatenate([sets[3][:600], rng.integers(0, 1 << 63, 300).astype(np.uint64)]))
    size = 160
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    got = minhash.super_minhash(np.concatenate(sets), owner, len(sets), size)

    def plain(elements):
        least = [None] * size
        for e in elements:
            place = list(range(size))
            for j in range(size):
                x = int(minhash.mixed(np.array([int(e) + int(minhash.GOLDEN) * (j + 1) & (2**64 - 1)], dtype=np.uint64))[0])
                k = j + ((x & 0xFFFFFFFF) * (size - j) >> 32)
                place[j], place[k] = place[k], place[j]
                value = j << 32 | x >> 32
                if least[place[j]] is None or value < least[place[j]]:
                    least[place[j]] = value
        return least

    for k in (0, 1, 2):
        assert got[k].tolist() == plain(sets[k])
    shared = np.mean(got[3] == got[4])
    assert abs(shared - 600 / 1200) < 0.12


def test_near_duplicates_of_nothing(none, docs):
    assert minhash.near_duplicates(none).collect() == []
    kept = minhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    expected = minhash.near_duplicates(docs).where("kept").count()
    assert kept.count() == expected


def test_components_of_long_paths_and_stars(spark):
    path = [(k, k + 1) for k in range(200)]
    star = [(1000, k) for k in range(1001, 1100)]
    links = spark.createDataFrame([*path, *star, (2000, 2000)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(links).collect()}
    assert found == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1100), 1000)}


def test_exact_groups(docs, corpus):
    groups = defaultdict(list)
    for i, t in corpus:
        groups[t or ""].append(i)

    def keep(t):
        ids = [i for i in groups[t or ""] if i is not None]
        return max(ids) if ids else None

    expected = [(i, "en", keep(t), len(groups[t or ""]), i == keep(t)) for i, t in corpus]
    same([tuple(r) for r in exact_dedup.exact_groups(docs, carry=("lang",)).collect()], expected)


def test_exact_groups_of_texts_that_differ_late(spark, none):
    long = "x" * 100_000
    rows = [(1, long + "a"), (2, long + "b"), (3, long + "a"), (4, "é"), (5, "ab"), (6, "É")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_groups(table).collect()}
    assert got == {1: (3, 2), 2: (2, 1), 3: (3, 2), 4: (4, 1), 5: (5, 1), 6: (6, 1)}
    assert exact_dedup.exact_groups(none).collect() == []


def test_repeated_lines(spark):
    rng = random.Random(2)
    pool = [f"line {k}" for k in range(12)] + ["", " ", "\r"]
    rows = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 9)))) for k in range(60)]
    rows += [(60, None), (61, ""), (62, "\n\n\n\n"), (63, "a\nb\nc\n" * 400), (7, rows[7][1]), (None, rows[3][1]), (64, "b\nc\na")]
    table = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, lines string").repartition(3)
    # A null id comes first.
    numbered = [(-1 if i is None else i, t) for i, t in rows]
    lines, gone = covered_lines(numbered)
    expected = [(i, len(lines[n]), tuple(sorted(gone[n]))) for (i, _), n in zip(rows, numbered, strict=True)]
    same([(r["doc_id"], len(r["lines"]), tuple(r["removed"])) for r in line_dedup.repeated_lines(table).collect()], expected)
    kept = {(r["doc_id"]): r["text"] for r in line_dedup.without_repeated_lines(table.drop("lines")).collect()}
    assert kept[60] is None and kept[61] == "" and kept[62] == "\n\n\n\n"
    assert kept[63].startswith("a\nb\nc\n")


def test_repeated_lines_of_nothing(none):
    assert line_dedup.repeated_lines(none).collect() == []
    assert line_dedup.without_repeated_lines(none).columns == none.columns


def test_kept_lines(spark):
    table = spark.createDataFrame([(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny"), (3, "a\nb\nc")], "doc_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in line_dedup.without_repeated_lines(table).orderBy(F.col("doc_id")).collect()}
    assert kept == {1: "a\nb\nc\nd", 2: "x\ny"}


def test_line_query_of_a_null_text(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "a\nb"), (4, "a\nb")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["kept_sha256"]) for r in queries.op8_line_dedup(spark, str(tmp_path)).collect()}
    digest = [hashlib.sha256(t).hexdigest() for t in (b"", b"a\nb")]
    assert found == {1: (0, 0, digest[0]), 2: (1, 0, digest[0]), 3: (2, 0, digest[1]), 4: (2, 2, digest[0])}
