"""Extraction, toxicity, archives, tokens, decontamination and licences against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spotframe.llm import bpe, decontamination, html, licences, toxicity, warc

from .plain import found_in, same

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


PAGES = {
    "": "",
    "plain words": "plain words",
    "<p>a &lt;b&gt; &eacute;&#233;&amp;amp;<p>b\n\t c&nbsp;d": "a <b> éé&amp;\nb c d",
    "<script>var x = '<p>no</p>';</script><style>p{}</style><p>yes": "yes",
    "<!-- <p>no</p> --><div>one</div><!-- open": "one",
    "<nav><ul><li><a href=x>Home</a></ul></nav><article><h1>T</h1><p>short<p><b>bold<br>next<p>end</article><footer>c</footer>": (
        "T\nshort\nbold next\nend"
    ),
    "<article><p>text</p><div class='ad'>buy</div><aside>more</aside><form>name <input></form><p>end</p>"
    "<section id=comments><p>nice one</p></section></article>": "text\nend",
    "<body class='search'><div id='content'><header class='entry-header'><h2>T</h2></header><p>one</p></div><div class='sidebar'>s</div>": (
        "T\none"
    ),
    "<div><a href=1>menu</a> <a href=2>more</a></div><p>" + "long " * 40 + "</p><p>short.</p><div><a>x</a></div><div><a>y</a></div>"
    "<div><a>z</a></div>": ("long " * 40).strip() + "\nshort.",
    "<div style='display:none'>no</div><p>x < y and <b>z": "x < y and z",
    "<div" * 3000: "<div" * 3000,
    "<b>" * 3000 + "deep" + "</i>" * 3000: "deep",
}


def test_main_text(spark):
    rows = [(k, "u", page, "old", "x") for k, page in enumerate(PAGES)] + [(None, None, None, None, "x"), (0, "u", "<p>again", "old", "x")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, _id string")
    found = html.extract(table)
    assert found.columns == ["page_id", "url", "_id", "text"]
    expected = [(k, "u", "x", text) for k, text in enumerate(PAGES.values())] + [(None, None, "x", ""), (0, "u", "x", "again")]
    same([tuple(r) for r in found.collect()], expected)
    assert html.extract(table.limit(0)).collect() == []


LONG = "Long words of an article. " * 8


@pytest.mark.parametrize(
    "start, end",
    [
        ("<form id='aspnetForm'><article>", "</article></form>"),
        ("<div class='content-sidebar-wrap'><main>", "</main><div class='sidebar'>s</div></div>"),
        ("<div class='layout has-sidebar'><article>", "</article><div class='sidebar'>s</div></div>"),
        ("<header><form><div class='search'><article>", "</article></div></form></header><p>beside"),
        ("<form>", "</form>"),
        ("<div class='has-sidebar'><div class='content'>", "</div><div class='sidebar'>s</div></div>"),
    ],
)
def test_wrapped_articles_keep_their_text(start, end):
    page = f"<nav><a href=x>Home</a></nav>{start}<h1>T</h1><p>{LONG}</p><div class='ad'>buy</div><p>end</p>{end}<footer>c</footer>"
    assert html.main_text(page) == f"T\n{LONG.strip()}\nend"


def test_articles_beside_the_article_stay_out():
    for start, end in [("<aside>", "</aside>"), ("<nav>", "</nav>"), ("<footer>", "</footer>"), ("<div class='comments-area'>", "</div>")]:
        assert html.main_text(f"<article><p>text</p></article>{start}<article>{LONG}</article>{end}") == "text"


def test_lines_between_surge_and_dive():
    lengths = np.array([5, 0, 0, 0, 40, 60, 3, 0, 0, 50, 0, 0, 0, 2])
    kept = html._between(lengths, 80)
    assert np.flatnonzero(kept).tolist() == [4, 5, 6, 7, 8, 9]


def test_tokens_equal_the_library(spark, docs, corpus, none):
    reference = Tokenizer.from_file(PATH)
    rng = random.Random(4)
    letters = "aAbBé ÉΣσİßſ'sTt'RE12٣½\x85\x1c\xa0　\n\t東京กำ한글ㅎ😀é<|endoftext|>_-.,!ǅⅧª"
    odd = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(400)]
    odd += ["a<|endoftext|>b <|startoftext|><|startoftext|>", "ab" * 3000, "x" * 5000]
    rows = [*corpus, *enumerate(odd, 1000)]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(odd, 1000)), "doc_id long, text string"))
    expected = []
    for i, t in rows:
        ids = reference.encode(t or "", add_special_tokens=False).ids
        expected.append((i, str(ids), reference.decode(ids, skip_special_tokens=False)))
    same([(r["doc_id"], str(r["ids"]), r["decoded"]) for r in bpe.encode_decode(table, PATH).collect()], expected)
    assert bpe.encode_decode(none, PATH).collect() == []


def test_every_character_is_split_as_in_the_library():
    tokenizer, reference = bpe.Tokenizer(PATH), Tokenizer.from_file(PATH)
    every = [chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000]
    for at in range(0, len(every), 20_000):
        texts = [" ".join(f"a{c}1{c}{c}b" for c in every[k : k + 500]) for k in range(at, min(at + 20_000, len(every)), 500)]
        ids, edges = tokenizer.encode(texts)
        for k, found in enumerate(reference.encode_batch(texts, add_special_tokens=False)):
            assert ids[edges[k] : edges[k + 1]].tolist() == found.ids


def test_tokens_survive_a_full_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 5)
    monkeypatch.setattr(bpe, "SYMBOLS", 64)
    tokenizer, reference = bpe.Tokenizer(PATH), Tokenizer.from_file(PATH)
    for text in ["some words of a text, with more", "other words <|endoftext|> here", "some words again", ""]:
        ids, edges = tokenizer.encode([text, text])
        assert ids.tolist() == reference.encode(text, add_special_tokens=False).ids * 2
        assert edges.tolist() == [0, len(ids) // 2, len(ids)]


def test_tokenizer_refuses_other_settings(tmp_path):
    other = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    (tmp_path / "t.json").write_text(other, encoding="utf-8")
    with pytest.raises((ValueError, TypeError, KeyError)):
        bpe.Tokenizer(str(tmp_path / "t.json"))


@pytest.mark.parametrize("block_words", [decontamination.BLOCK_WORDS, 12])
def test_contamination(spark, corpus, none, block_words):
    """A small block makes several passes over the documents."""
    rng = random.Random(9)
    plain = [(i, t) for i, t in corpus if t is None or len(t) < 5000]
    texts = [t for _, t in plain if t and len(t.split()) > 30]
    items = [(k, " ".join(rng.choice(texts).upper().split()[5:20])) for k in range(6)]
    items += [(10, "one"), (11, "one TWO"), (12, None), (13, " .,"), (0, "one two"), (None, "mit"), (14, "same " * 12)]
    plain.append((500, "same " * 40 + "one two"))
    table = spark.createDataFrame([(i, t, 0) for i, t in plain], "doc_id long, text string, spans int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contamination(table, bench, block_words=block_words).collect()
    got = [
        (
            r["doc_id"],
            r["n_words"],
            sum(s["stop"] - s["start"] for s in r["spans"]),
            str(sorted(r["items"], key=lambda x: (x is None, x))),
        )
        for r in found
    ]
    expected = found_in(plain, items)
    same(got, expected)
    clean = decontamination.without_contaminated(table, bench, block_words=block_words)
    assert clean.columns == table.columns
    same([(r["doc_id"],) for r in clean.collect()], [(i,) for i, _, hit, _ in expected if not hit])
    assert decontamination.contamination(none, bench).collect() == []
    assert decontamination.contamination(table, bench.limit(0)).where(F.size("spans") > 0).count() == 0


def test_licences(spark, none):
    texts = {
        1: "Released under the MIT License.",
        2: "Licensed under the Apache License, Version 2.0. mit LICENSE; general public-license",
        3: "This work is licensed under the GNU General Public License, version 3.",
        4: "license mit, mit x license",
        5: "Licensed under CC BY-NC 4.0.",
        6: None,
        7: "",
        8: "...",
        9: "MİT LICENSE and mıt license and mıt",
        10: "mit license " * 5000,
        11: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        12: "The GNU General Public License is long.",
    }
    table = spark.createDataFrame([(i, t, 5, "l") for i, t in texts.items()] + [(1, texts[1], 5, "l")], "doc_id long, text string, n_words int, label string")
    found = licences.scan(table).collect()
    assert len(found) == 13
    labels = {r["doc_id"]: sorted({m["label"] for m in r["matches"]}) for r in found}
    assert labels == {
        1: ["mit", "mit-release"],
        2: ["apache", "apache-2.0", "gpl", "mit"],
        3: ["gpl", "gpl-3.0"],
        4: [],
        5: ["cc-by-nc-4.0"],
        6: [],
        7: [],
        8: [],
        9: [],
        10: ["mit"],
        11: ["mit-grant"],
        12: ["gpl"],
    }
    by_id = {r["doc_id"]: r for r in found}
    assert [m["start"] for m in by_id[10]["matches"]] == list(range(0, 10_000, 2))
    assert [(m["label"], m["start"]) for m in by_id[2]["matches"] if m["base"]] == [("apache", 3), ("mit", 8), ("gpl", 10)]
    assert by_id[8]["n_words"] == 0 and by_id[6]["n_words"] == 0 and by_id[2]["n_words"] == 13
    assert licences.scan(none).collect() == []


def toxic_corpus():
    rng = random.Random(6)
    syllables = ["ba", "ko", "ri", "tem", "ul", "sa", "no", "vi"]
    insults = ["grobnik", "schmutz", "ferdol"]

    def word():
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

    rows, labels = [], []
    for k in range(900):
        words = [word() for _ in range(rng.randint(10, 120))]
        toxic = k % 5 == 0
        if toxic:
            for _ in range(1 + len(words) // 30):
                insult = rng.choice(insults)
                # Held-out rows misspell insults at their ends.
                words[rng.randrange(len(words))] = insult + (rng.choice("xyz") if zlib.crc32(str(k).encode()) % 4 == 2 else "")
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return rows, labels


def test_toxicity_finds_unseen_spellings(spark):
    rows, labels = toxic_corpus()
    extra = [(1000, None), (1001, ""), (1002, "spam " * 30_000), (None, "x"), (5, "second text of an id")]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in rows + extra], "doc_id long, text string, score double").repartition(3)
    marks = spark.createDataFrame([*labels, (None, 1), (2000, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks)
    scores = toxicity.score(docs, model)
    assert scores.columns == ["doc_id", "text", "score"]
    found = {r["doc_id"]: r["score"] for r in scores.collect()}
    assert all(0 <= s <= 1 for s in found.values())
    truth = dict(labels)
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    good = sum((found[i] >= 0.3) == bool(truth[i]) for i in held)
    assert good / len(held) > 0.95
    assert toxicity.without_toxic(docs, marks).columns == docs.columns
    flags = {r["doc_id"]: r["h"] for r in docs.select("doc_id", toxicity.held_out().alias("h")).collect()}
    assert all(flags[i] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in rows)


def plain_score(text, model):
    """Every window of the text in a loop, each word's n-grams one by one."""
    words = text.lower().split()
    half, best = toxicity.WINDOW // 2, None
    for start in range(0, max(len(words) - half, 1), half):
        total, number = 0.0, 0
        for word in set(words[start : start + toxicity.WINDOW]):
            own, _ = toxicity.subwords([word])
            total += sum(float(model.weights[k]) for k in own)
            number += len(own)
        mean = total / max(number, 1)
        best = mean if best is None else max(best, mean)
    return 1 / (1 + np.exp(-(best + model.bias)))


STORY = "<p>" + "Story words that go on for a while, one after the other. " * 4 + "</p>"


@pytest.mark.parametrize(
    "page, expected",
    [
        ('<article><h1>T</h1><p class="share-price">1.20</p><p class="banner-image">A view</p></article>', "T\n1.20\nA view"),
        ('<article><p>One</p><div class="share-buttons">Share</div><p class="ad">Buy</p><span class="ad">x</span></article>', "One"),
        ("<body><h1>Title</h1><article><p>One.</p></article></body>", "Title\nOne."),
        ("<body><h1>Site</h1><div>Line</div><article><p>One.</p></article><h1>More</h1></body>", "One."),
        ("<h1>Title</h1><div class=share>a</div><article><p>One.</p></article>", "Title\nOne."),
        ("<h1>Title</h1>" + "<div class=share>a</div>" * 4 + "<article><p>One.</p></article>", "One."),
        (f"<div><h1>Short title</h1><div>{STORY}</div></div>", "Short title\n" + STORY[3:-4].strip()),
        ('<div class="cookie-notice">' + "We use cookies for this and for that. " * 4 + "</div><div><h1>T</h1><p>A short story.</p></div>", "T\nA short story."),
        ('<div class="comments">' + STORY * 3 + "</div><div><h1>T</h1>" + STORY + "</div>", "T\n" + STORY[3:-4].strip()),
        ('<div class="content-sidebar-wrap">' + STORY + "</div><div>x</div>", STORY[3:-4].strip() + "\nx"),
        ("<form id=f><article><p>One.</p></article></form>", "One."),
        ("<article><p>a</p></article>" + "<div>b</div>" * 3 + "<article><p>c</p></article>", "a\nc"),
    ],
)
def test_elements_raise_and_lower_lines(page, expected):
    assert html.main_text(page) == expected


def plain_surges(lengths, surge):
    """The rule line by line: a line with text is kept if it lies between a surge and the dive after it, or leads up to one."""
    n = len(lengths)
    total = [sum(lengths[i : i + html.WINDOW]) for i in range(n)]
    kept, on = [False] * n, False
    for i in range(n):
        on = total[i] > 0 and (on or (total[i] >= surge and lengths[i] > 0))
        kept[i] = on
    for i in range(n - 1, 0, -1):
        kept[i - 1] |= kept[i] and lengths[i] > 0 and lengths[i - 1] > 0
    return kept


def test_surges_and_dives_equal_the_plain_rule():
    rng = np.random.default_rng(4)
    for _ in range(500):
        lengths = rng.choice([0, 0, 0, 5, 20, 60, 200], size=rng.integers(1, 40))
        if lengths.any():
            surge = min(html.SURGE, int(lengths.max()))
            got = [bool(k) for k in html._between(lengths.astype(np.int64), surge)]
            assert got == plain_surges(lengths.tolist(), surge)


def test_a_very_long_page_of_text():
    words = " ".join(f"w{k}" for k in range(400_000))
    page = "<nav>menu</nav><div><h1>T</h1><p>" + words + "</p>" + "<p>line &amp; more</p>" * 20_000 + "</div><footer>f</footer>"
    assert html.main_text(page) == "T\n" + words + "\nline & more" * 20_000


def test_toxicity_equals_a_loop_over_windows(corpus):
    rng = np.random.default_rng(9)
    model = toxicity.Model(rng.normal(size=toxicity.BUCKETS).astype(np.float32), -0.5)
    texts = [t or "" for _, t in corpus] + ["a " * 64, "b c " * 200, "\u00a0\u2003", "x" * 50_000]
    # An insult late in a long text, whose words stood far apart earlier.
    insult = [f"insult{k}" for k in range(12)]
    calm = [f"calm{k}" for k in range(4_000)]
    for k, word in enumerate(insult):
        calm[300 * k] = word
        model.weights[toxicity.subwords([word])[0]] = 3.0
    texts += [" ".join(calm), " ".join([*calm, *insult * 3])]
    for step in (7, len(texts)):
        bags = toxicity.Bags(model)
        got = np.concatenate([toxicity.score_texts(texts[k : k + step], bags) for k in range(0, len(texts), step)])
        assert np.allclose(got, [plain_score(t, model) for t in texts], atol=1e-12)
    assert got[-1] > got[-2]


def test_subwords_are_the_n_grams_of_a_word():
    words = ["", "ab", "abcdef", "日本語", "a😀b", "ab,", "x" * 3000]
    flat, sizes = toxicity.subwords(words)
    for word, own in zip(words, np.split(flat, np.cumsum(sizes)[:-1]), strict=True):
        marked = f"<{word.rstrip(',')}>"
        grams = [marked[i : i + n] for n in range(3, 7) for i in range(len(marked) - n + 1)]
        assert len(own) == len(grams) + 1
        if len(word) < 10:
            assert len(set(own)) == len({*grams, (marked,)})
    # Equal n-grams of different words share a bucket.
    one, two = (set(toxicity.subwords([w])[0].tolist()) for w in ("stupid", "stuupid"))
    assert 3 <= len(one & two) < len(one)


def test_toxicity_without_labels(spark, none):
    marks = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(none, marks)
    assert toxicity.score(none, model).collect() == []
    assert toxicity.score_texts(["", "words"], toxicity.Bags(model))[0] < 0.5


def test_archives(spark):
    long = "<p>" + "equal payload é " * 20
    pages = [(k, f"http://a/{k}?q=1&x y", f"<html><p>page {k} " + "word " * k) for k in range(60)]
    pages += [(100, None, None), (101, "u", ""), (102, "u\r\nX: y", long), (99, "u", long), (103, "u", long), (104, "u", "short"), (105, "u", "short")]
    pages += [(99, "u2", long), (None, "n", long), (200, "big", "<b>" * 400_000), (201, "end", "a\r\n\r\nWARC/1.1\r\n")]
    table = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string").repartition(3)
    folder = warc.write_archives(table)
    got = []
    for r in warc.read_archives(spark, folder).collect():
        if r["record_type"] == "response":
            assert hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"]
        got.append((r["id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]))
    expected = []
    for i, _, page in pages:
        data = (page or "").encode()
        revisit = page == long and i != 99
        expected.append(
            (None if i is None else str(i), len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", "99" if revisit else None)
        )
    same(got, expected)
    none = warc.write_archives(table.limit(0))
    assert warc.read_archives(spark, none).collect() == []


def test_archive_format_and_broken_archives():
    records = [warc.record_bytes(str(k), "u", b"payload %d " % k * 30, hashlib.sha256(b"payload %d " % k * 30).hexdigest(), None, False) for k in range(200)]
    frames = list(warc.frames_of(records))
    assert len(frames) == 201 and frames[0][:4] == warc.DICTIONARY_FRAME and len(frames[0]) > 8
    archive = b"".join(f + warc.EMPTY_FRAME.encode() for f in frames)
    assert [r["id"] for r in warc.records_of(archive)] == [str(k) for k in range(200)]
    packed = zstandard.compress(frames[0][8:])
    other = warc.DICTIONARY_FRAME + len(packed).to_bytes(4, "little") + packed + b"".join(frames[1:])
    assert sum(1 for _ in warc.records_of(other)) == 200
    wrong = [
        archive[:-20] + b"\x00" * 12,
        archive[: len(frames[0]) + 8 + 30],
        frames[0][:20],
        b"".join(frames[1:]),
        b"no archive",
        zstandard.compress(records[0].replace(b"payload 0", b"payload 1", 1)),
        zstandard.compress(records[0] + b"more"),
        zstandard.compress(records[0][:-10]),
        zstandard.compress(records[0].replace(b"WARC/1.1", b"WARC/0.1")),
        zstandard.compress(records[0].replace(b"WARC-Type", b"WARC-Kind")),
    ]
    for archive in wrong:
        with pytest.raises(warc.BadArchive):
            list(warc.records_of(archive))
    assert list(warc.records_of(b"")) == []
    assert list(warc.records_of(b"".join(warc.frames_of(records[:1]))))[0]["id"] == "0"
