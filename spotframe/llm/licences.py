"""Licence scan with a positional index of the rare words of licence statements."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import stable

# Share of a statement's weight that has to stand at the right places.
LEAST_SHARE = 0.6

# Words that every text has; the index leaves them out, their places stay.
COMMON = frozenset("a and any are as by for form in is it of or subject terms the this to under use with work".split())


@dataclass(frozen=True)
class Statement:
    """A licence statement: words of a phrase, and the part of them that must stand there whole."""

    label: str
    words: str
    key: str
    base: bool = False

    def postings(self) -> list[tuple[str, int, bool]]:
        """(word, place, whether it is of the key phrase) of the indexed words."""
        words, key = self.words.split(), self.key.split()
        start = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        inside = range(start, start + len(key))
        return [(w, i, i in inside) for i, w in enumerate(words) if i in inside or w not in COMMON]


# The base phrases, and usual wordings of published licences.
STATEMENTS = (
    Statement("mit", "mit license", "mit license", base=True),
    Statement("apache", "apache license", "apache license", base=True),
    Statement("gpl", "general public license", "general public license", base=True),
    Statement("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Statement("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    Statement("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    Statement("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    Statement("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    Statement("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    Statement("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    Statement("mit-release", "released under the mit license", "mit license"),
    Statement(
        "mit-grant",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "permission is hereby granted free of charge",
    ),
    Statement(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        "redistribution and use in source and binary forms",
    ),
    Statement("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    Statement("isc", "permission to use copy modify and or distribute this software", "permission to use copy modify"),
    Statement("unlicense", "free and unencumbered software released into the public domain", "unencumbered software released"),
)

NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def licence_words() -> list[str]:
    return sorted({w for s in STATEMENTS for w, _, _ in s.postings()})


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence statements per row: ``id_col``, ``n_words``, ``matches`` (label, base, start, share; by start).

    Words are runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII. One pass over the texts keeps the
    places of the licence words; their document frequencies over all rows give each word its weight (IDF). A file is
    looked at if it has the rarest key word of some statement. Every licence word then proposes the starts at
    which a statement would have it; a start is a match when its whole key phrase stands there, and words with at least
    LEAST_SHARE of the statement's weight stand at their places.

    Null texts count as empty; rows that repeat an id and a text have the same matches; a null id is an id;
    an empty table gives no rows; other columns are ignored.
    """
    index = [(s.label, s.base, w, i, key) for s in STATEMENTS for w, i, key in s.postings()]
    vocabulary = licence_words()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.split(text, NOT_WORD)
    # An empty string stands before a first separator and after a last one.
    lead = F.when(F.col("_words")[0] == "", 1).otherwise(0)
    tail = F.when((F.size("_words") > 1) & (F.element_at("_words", -1) == ""), 1).otherwise(0)
    small = F.transform("_words", lambda w, i: F.struct((i - F.col("_lead")).alias("i"), F.lower(w).alias("w"), w.alias("raw")))
    # lower() may also turn a character beyond ASCII into a letter, so the words as they stood must be ASCII.
    hits = F.filter(small, lambda x: x["w"].isin(vocabulary) & (F.octet_length(x["raw"]) == F.octet_length(x["w"])) & x["raw"].rlike("^[0-9A-Za-z]+$"))
    found = stable(
        docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_key"), words.alias("_words"))
        .withColumn("_lead", lead)
        .select(
            "_id",
            "_key",
            (F.size("_words") - lead - tail).cast("long").alias("n_words"),
            F.transform(hits, lambda x: F.struct(x["i"].alias("i"), x["w"].alias("w"))).alias("_hits"),
        )
    )
    # At most one row per licence word reaches the driver.
    listed = found.select(F.explode(F.array_distinct("_hits.w")).alias("w")).groupBy("w").count().collect()
    total, files = found.count(), {r["w"]: r["count"] for r in listed}
    idf = {w: math.log((1 + total) / (1 + files.get(w, 0))) + 1 for w in vocabulary}
    keys = {s.label: [w for w, _, key in s.postings() if key] for s in STATEMENTS}
    anchors = sorted({max(ws, key=lambda w: (idf[w], w)) for ws in keys.values()})

    postings = docs.sparkSession.createDataFrame(
        [(label, base, w, i, key, idf[w]) for label, base, w, i, key in index],
        "label string, base boolean, w string, place int, key boolean, weight double",
    )
    whole = docs.sparkSession.createDataFrame(
        [(s.label, sum(idf[w] for w, _, _ in s.postings()), len(keys[s.label])) for s in STATEMENTS],
        "label string, total double, n_key int",
    )
    proposed = (
        found.where(F.arrays_overlap(F.col("_hits.w"), F.array(*map(F.lit, anchors))))
        .select("_id", "_key", F.explode("_hits").alias("_hit"))
        .select("_id", "_key", F.col("_hit.i").alias("_i"), F.col("_hit.w").alias("w"))
        .distinct()
        .join(F.broadcast(postings), "w")
        .groupBy("_id", "_key", "label", "base", (F.col("_i") - F.col("place")).alias("start"))
        .agg(F.sum("weight").alias("_weight"), F.sum(F.col("key").cast("int")).alias("_keys"))
    )
    share = F.least(F.round(F.col("_weight") / F.col("total"), 6), F.lit(1.0))
    matches = (
        proposed.join(F.broadcast(whole), "label")
        .where((F.col("_keys") == F.col("n_key")) & (share >= LEAST_SHARE))
        .groupBy("_id", "_key")
        .agg(F.array_sort(F.collect_list(F.struct(F.col("start").cast("long").alias("start"), "label", "base", share.alias("share")))).alias("_m"))
        .select(F.col("_id").alias("_i"), F.col("_key").alias("_k"), "_m")
    )
    same = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_k"))
    empty = F.array().cast(matches.schema["_m"].dataType)
    return found.join(matches, same, "left").select(
        F.col("_id").alias(id_col), "n_words", F.coalesce("_m", empty).alias("matches")
    )
