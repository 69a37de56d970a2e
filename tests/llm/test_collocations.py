"""Collocations against plain counting, and the fingerprints' rare paths."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from barworks.llm import collocations as C
from barworks.llm import queries

from helpers import CLASHES, EDGES, SF, ascii_lower


def pieces(text):
    return [re.findall(rb"[^\x20\x09]+", p) for p in re.split(rb"[.,;:!?\x0A-\x0D]", ascii_lower(text))]


def brute(rows, least, lead=2000):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            f.update((lang, *words[i:i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    often = {p: a for p, a in f.items() if a >= least}
    longer = Counter()
    for p, a in often.items():
        for k in range(2, len(p) - 1):
            for i in range(1, len(p) - k + 1):
                longer[(p[0], *p[i:i + k])] = max(a, longer[(p[0], *p[i:i + k])])
    out = {}
    for p, a in often.items():
        if len(p) < 3 or longer[p] >= a:
            continue
        lang, words = p[0], p[1:]
        score, _, l, r = min((1000 * a * n[lang] // (f[(lang, *words[:k])] * f[(lang, *words[k:])]), k,
                              f[(lang, *words[:k])], f[(lang, *words[k:])]) for k in range(1, len(words)))
        out.setdefault(lang, []).append((-score, -a, b" ".join(words), l, r, n[lang]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, m, -s) for lang, found in out.items()
                  for i, (s, a, p, l, r, m) in enumerate(sorted(found)[:lead]))


def table(spark, rows):
    df = spark.createDataFrame(rows, "lang string, text string")
    extra = dict.fromkeys(("phrase", "k", "left", "part", "f", "within", *CLASHES))
    return df.select("*", *(F.lit("x").alias(c) for c in extra))


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_the_table_and_its_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    got = rows_of(C.collocations(docs, least=5))
    assert got == brute(rows, 5) and len(got) > 50
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    query = queries.op13_phrase_collocations(spark, SF)
    rel = con.execute(queries.ORACLES["op13_phrase_collocations"])
    assert query.columns == [d[0] for d in rel.description]
    assert rows_of(query) == sorted(rel.fetchall()) == brute(rows, 100)


def sentences(seed, n=300):
    random.seed(seed)
    words = ["a", "b", "Cc", "é", "x\x00y", "\x1c", "the", "of", " ", "1"]
    stock = [" ".join(random.choices(words, k=random.randint(1, 9))) for _ in range(12)]
    return [(random.choice(["en", None, "und", "fr", ""]),
             random.choice([". ", "\n", "  ", ";;", "\t"]).join(random.choices(stock, k=random.randint(0, 9))))
            for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_texts(spark, seed):
    rows = sentences(seed) + [("en", t) for _, t in EDGES]
    assert rows_of(C.collocations(table(spark, rows), least=7, lead=40)) == brute(rows, 7, 40)


def test_texts_cut_into_many_blocks(spark, monkeypatch):
    """Phrases across the cuts of a long text are counted, once."""
    monkeypatch.setattr(C, "BLOCK", 300)
    rows = [(lang, " ".join(t for _, t in sentences(s, 60))) for s, lang in [(4, "en"), (5, None), (6, "en")]]
    rows.append(("en", "z" * 2000 + " a b c " + "z" * 2000))
    assert rows_of(C.collocations(table(spark, rows), least=5)) == brute(rows, 5)


def test_a_text_of_many_megabytes(spark):
    random.seed(9)
    long = " ".join(random.choice(["alpha beta gamma", "delta", "epsilon zeta.", f"w{random.randint(0, 99999)}"])
                    for _ in range(900_000)) + " " + "q" * (9 << 20)
    assert len(long) > 2 * C.BLOCK
    rows = [("en", long), ("en", "alpha beta gamma delta")]
    assert rows_of(C.collocations(table(spark, rows), least=1000)) == brute(rows, 1000)


def test_colliding_fingerprints(spark, monkeypatch):
    """With three bits left of every fingerprint the counts are still exact."""
    rows = sentences(7)
    exact = C.mix64
    monkeypatch.setattr(C, "mix64", lambda x: exact(x) & np.uint64(7) if x.ndim and len(x) != 256 else exact(x))
    docs = table(spark, rows)
    assert rows_of(C.collocations(docs, least=20)) == brute(rows, 20)


def test_empty(spark):
    assert C.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
    assert C.collocations(table(spark, [(None, None), ("en", ""), ("en", "  ")])).collect() == []


def test_products_beyond_64_bits(spark, monkeypatch):
    """Counts whose products need more than 64 bits."""
    big = 3 * 10 ** 12
    rows = [("en", "", 0, 10 ** 14), ("en", "a", 1, big), ("en", "b", 1, big - 1), ("en", "a b", 2, big - 2)]
    found = spark.createDataFrame(rows, "lang string, phrase string, words int, n long")
    monkeypatch.setattr(C, "frequent_phrases", lambda docs, least: found)
    got = C.collocations(None).collect()
    assert [tuple(r) for r in got] == [("en", 1, "a b", big - 2, big, big - 1, 10 ** 14,
                                        1000 * (big - 2) * 10 ** 14 // (big * (big - 1)))]


def test_polynomials_of_words():
    random.seed(10)
    words = list({bytes(random.choices(range(97, 103), k=random.choice([1, 2, 5, 70]))) for _ in range(300)})
    a, b = C.word_prints(words), C.word_prints(words, chunk=16)
    assert a.tolist() == b.tolist() and len(set(a.tolist())) == len(words)
