"""Collocations and lexical search against brute force, the language of held-out texts."""

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarmac.llm import collocations, languages, queries, search
from tarmac.llm.cuts import byte_classes, cut

FOLDER = "/root/testdata/sf0.001"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_words_by_bytes():
    texts = [None, "", " ", "a", "a b", "Éa,B  c", ",", "x", "日本 y"]
    classes = byte_classes(blank=collocations.BLANKS, breaks=collocations.BREAKS)
    found = cut(pa.array(["skipped", *texts]).slice(1), classes)
    pieces = [[p.split() for p in re.split("[.,;:!?\n-\r]", low(t).replace(" ", "§"))] for t in texts]
    assert [w.replace(" ", "§") for w in found.words.to_pylist()] == [w for t in pieces for p in t for w in p]
    assert found.text.tolist() == [i for i, t in enumerate(pieces) for p in t for _ in p]
    assert found.first.tolist() == [j == 0 for t in pieces for p in t for j, _ in enumerate(p)]


def brute_phrases(rows, least, share):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", low(text)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    good = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    best = defaultdict(list)
    for p, a in good.items():
        lang, words = p[0], p[1:]
        inside = [
            q for q in good
            if q[0] == lang and len(q) > len(p) and any(q[i : i + len(words)] == words for i in range(1, len(q) - len(words) + 1))
        ]
        if any(100 * good[q] >= share * a for q in inside):
            continue
        cuts = [(f[(lang, *words[:k])], f[(lang, *words[k:])], k) for k in range(1, len(words))]
        score, _, left, right = min((1000 * a * n[lang] // (x * y), k, x, y) for x, y, k in cuts)
        best[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return [
        (lang, i, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, found in best.items() for i, (score, a, phrase, left, right) in enumerate(sorted(found), 1)
    ]


PHRASES = [
    ("New york city is big. New York, city; new york city", "en", 1), ("the new york city of the north", "en", 2),
    ("the new york city of the north", "en", 2), ("é ü é ü é ü", "de", 3), ("É é ü é", None, 4), (None, "en", 5), ("", "en", 6),
    ("a a a a a a a", None, 7), ("a " * 3000, "long", 8), ("b\ta b  a\nb", "x", 9),
]


@pytest.mark.parametrize("several", [False, True])
@pytest.mark.parametrize("least,share", [(1, 100), (3, 60)])
def test_phrases(spark, monkeypatch, several, least, share):
    if several:
        monkeypatch.setattr(collocations, "MOST_PHRASES", 3)
    docs = spark.createDataFrame(PHRASES, "text string, lang string, words long").repartition(3)
    found = [tuple(r) for r in collocations.collocations(docs, least, 1000, share).collect()]
    expected = brute_phrases([r[:2] for r in PHRASES], least, share)
    assert sorted(found) == sorted(expected) and found
    if not several:
        assert sorted(tuple(r) for r in collocations.collocations(docs, least, 2, share).collect()) == sorted(r for r in expected if r[1] <= 2)


@pytest.mark.parametrize("limits", [{"MOST_HELD": 300}, {"MOST_PHRASES": 9, "MOST_WORDS": 7}])
def test_phrases_in_parts_and_words_of_one_hash(spark, monkeypatch, limits):
    assert zlib.crc32(b"plumless") == zlib.crc32(b"buckeroo")
    for name, most in limits.items():
        monkeypatch.setattr(collocations, name, most)
    rows = [r[:2] for r in PHRASES] + [("plumless buckeroo city buckeroo plumless city, plumless buckeroo", lang) for lang in ("en", "x", "en")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    found = [tuple(r) for r in collocations.collocations(docs, 2, 1000, 80).collect()]
    assert sorted(found) == sorted(brute_phrases(rows, 2, 80)) and found


def test_rare_pairs_of_frequent_words_cost_no_more_readings(spark, monkeypatch):
    """The texts are read once a level, also where most pairs of frequent words are too rare to be phrases and many more than a trie holds."""
    draw = np.random.default_rng(5)
    texts = [" ".join(f"w{w}" for w in draw.integers(0, 1500, 3000)) for _ in range(100)]
    writes = []
    stored = collocations.stored

    def counting(rows):
        writes.append(rows.columns)
        assert len(writes) <= 20
        return stored(rows)

    monkeypatch.setattr(collocations, "stored", counting)
    monkeypatch.setattr(collocations, "MOST_PHRASES", 2000)
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").repartition(4)
    found = collocations.collocations(docs, 4, 1000).collect()
    assert len(writes) <= 8
    pairs = Counter(p for t in texts for p in zip(t.split(), t.split()[1:]))
    assert {r.phrase: r.a for r in found} == {" ".join(p): n for p, n in pairs.items() if n >= 4} and found


def test_no_phrases(spark, no_docs):
    assert collocations.collocations(no_docs).collect() == []
    assert collocations.collocations(spark.createDataFrame([("a b", "en")], "text string, lang string"), 2).collect() == []


def test_tries_against_sets():
    draw = np.random.default_rng(3)
    phrases = sorted({tuple(f"w{int(w)}" for w in draw.zipf(1.3, 3) % 300) for _ in range(3000)})
    langs = [["x", "y"][len(p[0]) % 2] for p in phrases]
    trie = collocations.double_array(langs, [list(p) for p in phrases])
    words = [f"w{i}" for i in range(310)]
    codes = (draw.zipf(1.3, 20_000) % 310).astype(np.int32)
    codes[::50] = -1
    for lang in ("x", "y", "z"):
        known = {p for p, name in zip(phrases, langs) if name == lang}
        at, state = trie.walk(collocations.Chunk(lang, pa.array(words), np.zeros(0, np.uint32), codes))
        texts = [("" if c < 0 else words[c]) for c in codes]
        wanted = [i for i in range(len(codes) - 2) if tuple(texts[i : i + 3]) in known]
        assert at.tolist() == wanted
        assert [phrases[i] for i in trie.leaf[state]] == [tuple(texts[i : i + 3]) for i in wanted]


def brute_search(docs, items, k):
    terms = lambda t: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low(t))
    counts = [(i, Counter(terms(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in counts]
    n_docs, total = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in counts for t in c)
    rows = []
    asked = defaultdict(set)
    for i, t in items:
        asked[i].update(terms(t))
    for item, words in asked.items():
        scores = []
        for (doc, c), n in zip(counts, lengths):
            m = 10 + (90 * n * n_docs) // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in words if t in c
            )
            if score > 0:
                scores.append((-score, doc))
        rows += [(item, rank, doc, -s) for rank, (s, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(rows)


@pytest.mark.parametrize("kind", ["odd", "given", "drawn", "blocks", "none"])
def test_search(spark, odd_docs, no_docs, monkeypatch, kind):
    items = spark.createDataFrame(
        [(1, "One TWO eleven"), (2, None), (3, ""), (4, "é w5 w17, a"), (5, "absent"), (6, "short more"), (6, "mail"), (6, "mail"), (None, "a")],
        "item_id long, text string",
    )
    k = 3
    if kind == "given":
        docs, items, k = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark")), None, 10
        docs, items = docs
    elif kind in ("drawn", "blocks"):
        if kind == "blocks":
            monkeypatch.setattr(search, "QUERIES", 2)
            monkeypatch.setattr(search, "BLOCK_BYTES", 200)
        draw = np.random.default_rng(1)
        texts = [" ".join(f"t{int(x)}" for x in draw.zipf(1.4, draw.integers(1, 30)) % 60) for _ in range(400)]
        docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:40] * 5)], "doc_id long, text string").repartition(5)
        items = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:30])], "item_id long, text string")
    else:
        docs = odd_docs if kind == "odd" else no_docs
    found = sorted(tuple(r) for r in search.searched(docs, items, k).collect())
    plain = lambda df, c: [tuple(r) for r in df.select(c, "text").collect() if r[0] is not None]
    assert found == brute_search(plain(docs, "doc_id"), plain(items, "item_id"), k)
    assert bool(found) == (kind != "none")


def test_language_of_held_out_texts(spark):
    rows = queries.queries()["op12_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    both = rows.join(docs, "doc_id").collect()
    assert len(both) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in both)
    judged = [r.lang == r.lang_pred for r in both if r.held_out and r.lang_pred != "und"]
    assert sum(judged) > 0.99 * len(judged) > 0


def test_languages_of_odd_texts(spark, odd_docs, no_docs):
    model = languages.learned(odd_docs)
    rows = languages.predicted(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.row.text or ""))
        assert r.row.row is None or r.row.row in ("x", "y", "")
    assert languages.predicted(no_docs, model).count() == 0
    assert languages.learned(no_docs) is None
    assert {(r.lang_pred, r.score) for r in languages.predicted(odd_docs, None).collect()} == {("und", 0.0)}


def brute_n_grams(text):
    plain = re.sub(" +", " ", "".join(c.lower() if c.isalpha() else " " for c in text)).strip()
    plain = f" {plain} " if plain else ""
    return Counter(plain[i : i + n] for n in range(1, 5) for i in range(len(plain) - n + 1) if plain[i : i + n] != " ")


def test_all_n_grams_are_met_once(monkeypatch):
    monkeypatch.setattr(languages, "CHARACTERS", 7)
    table = languages.letters()
    texts = ["", "...", "a", "The cat, the hat!", "ÄÖ 12 ñandú" * 9, None, "x" * 50]
    number = Counter()
    for run in languages.letter_runs(pa.array(texts), table):
        found, of = run.n_grams(1 << 17)
        number.update(zip(of.tolist(), found.tolist()))
    for i, text in enumerate(texts):
        expected = brute_n_grams(text or "")
        mine = sorted(n for (j, _), n in number.items() if j == i)
        assert sum(mine) == sum(expected.values()) and len(mine) <= len(expected) <= len(mine) + 2
    assert languages.bucket_number(4) == 1 << 17 and languages.bucket_number(100_000) == 64


@pytest.mark.parametrize("name", ["op11_collocations", "op13_lexical_search"])
def test_queries_equal_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark"):
        duck.execute(f"create view {t} as select * from read_parquet('/root/testdata/sf0.01/{t}.parquet')")
    expected = duck.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    found = queries.queries()[name](spark, "/root/testdata/sf0.01").select(*columns).collect()
    assert sorted(map(tuple, found)) == sorted(expected.fetchall()) and found


def test_a_hot_document_group_is_ranked_by_id(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same text here").alias("text")).repartition(7)
    items = spark.createDataFrame([(1, "text")], "item_id long, text string")
    found = search.searched(docs.unionAll(spark.createDataFrame([(9000, "other")], docs.schema)), items)
    # The term is in all documents but one, so its weight is small but not zero.
    assert [r.id for r in found.orderBy("rank").collect()] in (list(range(10)), [])
