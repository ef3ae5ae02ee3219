"""The pipeline on a small folder against its stages done plainly, given the scores of its model."""

import hashlib
import random

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from spotframe.llm import toxicity

from .plain import covered_lines, found_in, linked


def folder(spark, path, empty=False):
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(300)]

    def text(n):
        words = [rng.choice(vocabulary) for _ in range(n)]
        return "\n".join(" ".join(words[i : i + 8]) for i in range(0, n, 8))

    rows, labels, items = [], [], [(0, text(30)), (1, "one two three"), (2, None)]
    for k in range(120):
        body = text(rng.randint(3, 120))
        if k % 6 == 0:
            body = body.replace(" ", " scumbag ", 1 + len(body) // 100)
            labels.append((k, 1, 1))
        elif k % 2:
            labels.append((k, 1, 0))
        if k % 10 == 1 and rows:
            body = rows[-1][1]
        if k % 10 == 3:
            body = rows[-1][1].replace("w1", "v1", 1) + " tail"
        if k % 17 == 5:
            body += "\n" + items[0][1]
        rows.append((k, body, "en", "s", len(body)))
    rows += [(500, None, None, None, None), (501, "", "en", "s", 0), (502, "one two three", "en", "s", 13)]
    if empty:
        rows, labels, items = [], [], []
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), items


def test_stages(spark, tmp_path):
    path, items = folder(spark, tmp_path / "sf")
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    scores = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    rows = [(r["doc_id"], r["text"]) for r in scores if r["score"] < 0.3]
    assert 80 < len(rows) < len(scores)
    lines, gone = covered_lines(rows)
    rows = [
        (i, None if t is None else "\n".join(x for k, x in enumerate(lines[(i, t)]) if k not in gone[(i, t)]))
        for i, t in rows
        if not lines[(i, t)] or len(gone[(i, t)]) < len(lines[(i, t)])
    ]
    kept = {i for i, _, _, stays in linked(rows, 5, 80) if stays}
    rows = [(i, t) for i, t in rows if i in kept]
    clean = {i for i, _, hit, _ in found_in(rows, items) if not hit}
    assert clean < kept
    reference = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    expected = {}
    for i, t in rows:
        if i in clean:
            ids = reference.encode(t or "", add_special_tokens=False).ids
            decoded = reference.decode(ids, skip_special_tokens=False)
            expected[i] = (len(ids), ids, *[hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)])
    found = corpus_pipeline.run(spark, path).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids"], r["ids_sha256"], r["decoded_sha256"]) for r in found} == expected
    assert len(found) == len(expected)


def test_columns_stay_until_the_last_stage(spark, tmp_path):
    path, _ = folder(spark, tmp_path / "sf")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, path)
        assert out.dtypes == docs.dtypes, name
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        wrong = docs.where(F.col("n_chars") != F.char_length("text")).count()
        assert wrong == 0


def test_no_documents(spark, tmp_path):
    path, _ = folder(spark, tmp_path / "sf", empty=True)
    assert corpus_pipeline.run(spark, path).collect() == []


def test_entries():
    names = set(__spark_entry__.queries())
    assert {"pipeline"} | {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names}
    assert set(__spark_entry__.oracle_sql()) <= names
