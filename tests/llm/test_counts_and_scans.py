"""Token counts, exact dedup and license scan against libraries and brute force."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from barworks.llm import exact_dedup as X
from barworks.llm import license_scan as L
from barworks.llm import queries as Q
from barworks.llm import token_counts as T
from barworks.llm._util import documents

from helpers import EDGES, SF, frame


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(Q.vocabulary(Q.WORD_BPE))


TEXTS = ["", " ", "ΑΣ ΣΑΣ ΟΔΟΣ", "İstanbul", "a\x1cb \x1d", "a\xa0b\x85c", "<|endoftext|>x<|startoftext|>", "a<|endoftext|",
         "éa ́x", "don't we'll I'M", "日本語 1234 ٣٤", "😀😀 x̂y", "x" * 5000, "<|STARTOFTEXT|>", "﻿abc"]


def test_token_counts_equal_the_library(spark):
    rows = EDGES + [(100 + i, t) for i, t in enumerate(TEXTS)]
    lib = library()
    got = T.token_counts(frame(spark, rows), Q.vocabulary(Q.WORD_BPE)).collect()
    want = []
    for d, t in rows:
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), n, n > 2048))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_token_counts_of_the_table(spark):
    lib = library()
    want = {r["doc_id"]: len(lib.encode(r["text"] or "", add_special_tokens=False).ids) for r in documents(spark, SF).collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in Q.op2_token_counts(spark, SF).collect()} == want


def test_table_of_words_is_bounded():
    c = T.PairCounter(Q.vocabulary(Q.WORD_BPE), kept=3)
    assert c.count("a b c d e f g h") == 8 and len(c.runs) <= 3 and len(c.known) <= 3


def brute_groups(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0D]+", " ", t or ""), []).append(d)
    out = []
    for text, ids in groups.items():
        keep = min((d for d in ids if d is not None), default=None)
        out += [(d, keep, len(ids), d == keep, hashlib.sha256(text.encode()).hexdigest()) for d in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, weak):
    """A digest with many collisions gives the same groups, as bytes are compared."""
    rows = EDGES + [(1000 + i, f"text {i % 7}") for i in range(60)]
    digest = (lambda c: F.substring(F.md5(c), 1, 1)) if weak else F.md5
    if weak:
        digest = lambda c: F.concat(F.lit("0"), F.substring(F.md5(c), 1, 1))
    got = X.exact_groups(frame(spark, rows), digest).collect()
    assert sorted(map(tuple, got), key=str) == brute_groups(rows)


def test_exact_groups_of_the_table(spark):
    rows = [tuple(r) for r in documents(spark, SF).collect()]
    assert sorted(map(tuple, Q.op3_exact_dedup(spark, SF).collect()), key=str) == brute_groups(rows)


def test_one_hot_text(spark):
    rows = [(i, "same words here" if i % 3 else f"own {i}") for i in range(3000)]
    got = {r["doc_id"]: r for r in X.exact_groups(frame(spark, rows, clash=False)).collect()}
    assert got[2999]["keep_id"] == 1 and got[2999]["group_size"] == 2000 and got[0]["group_size"] == 1


def brute_license(text):
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at, labels = [], set()
    for phrase, label in L.BASE.items():
        p = phrase.split()
        spots = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        at += spots
        labels |= {label} if spots else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


LICENSES = ["Licensed under CC BY-NC 4.0.", "Apache  License; apache\nlicense", "x MIT-License y mit license",
            "cc by cc by cc by", "gnu general public\tlicense gnu general public", "This work is licensed under the GNU "
            "General Public License, version 3.", "released under mit", "Work licensed: GNU public general, under the "
            "license version 3 is this", "éapache license", "apache licenseé", "CC BY cc by"]


def test_license_scan(spark):
    rows = EDGES + [(50 + i, t) for i, t in enumerate(LICENSES)]
    got = L.license_scan(frame(spark, rows)).collect()
    found = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got), key=str)
    assert found == sorted(((d, *brute_license(t)) for d, t in rows), key=str)
    by = {r["doc_id"]: r for r in got}
    assert by[50]["labels"] == "cc-by,cc-by-nc-4.0" and by[55]["labels"] == "gpl"
    assert by[57]["base_labels"] == "" and by[57]["labels"] == "gpl" and by[57]["score"] == 1
    assert by[1]["labels"] == "" and by[1]["score"] == 0.0 and by[2]["n_words"] == 0


def test_license_join_loses_nothing(spark):
    """The filters give what comparing every block with every template gives."""
    import random
    random.seed(4)
    words = sorted({w for t in L.TEMPLATES for w in L._token_set(t)})
    rows = []
    for i in range(150):
        base = L._token_set(random.choice(list(L.TEMPLATES)))
        keep = [w for w in base if random.random() < 0.95] + random.sample(words, random.randint(0, 6))
        random.shuffle(keep)
        rows.append((i, "first line\n" + " ".join(keep) + "\nlast"))
    got = {r["doc_id"]: r for r in L.license_scan(frame(spark, rows, clash=False)).collect()}
    for i, text in rows:
        want, best = set(brute_license(text)[4].split(",")) - {""}, 0.0
        for t, label in L.TEMPLATES.items():
            ts = set(L._token_set(t))
            for line in text.split("\n"):
                part = len(ts & set(line.split())) / len(ts)
                if part >= L.THRESHOLD:
                    want.add(label)
                    best = max(best, part)
        assert got[i]["labels"] == ",".join(sorted(want))
        if not got[i]["base_labels"]:
            assert abs(got[i]["score"] - best) < 1e-12


@pytest.mark.parametrize("run", [lambda d: T.token_counts(d, Q.vocabulary(Q.WORD_BPE)), X.exact_groups, L.license_scan])
def test_empty_table(spark, run):
    assert run(frame(spark, [])).collect() == []


WRAPPED = [("# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software", "mit"),
           ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted", "bsd"),
           ("Redistribution and use\nin source and binary\nforms, with or without\nmodification, are\npermitted", "bsd"),
           ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.", "mpl-2.0")]


@pytest.mark.parametrize("before", [0, 1, 11, 16, 17, 18, 33, 34, 35, 100])
def test_wrapped_statements(spark, before):
    """A statement over several lines is found wherever it starts, and counts once."""
    fill = "\n".join(f"w{i}" for i in range(before))
    rows = [(i, f"{fill}\n{text}\n{fill}") for i, (text, _) in enumerate(WRAPPED)]
    apart = [(i + 10, f"\n{fill} {fill} {fill}\n".join(text.split())) for i, (text, _) in enumerate(WRAPPED)]
    got = {r["doc_id"]: r for r in L.license_scan(frame(spark, rows + (apart if before > 99 else []))).collect()}
    for i, (_, label) in enumerate(WRAPPED):
        assert (got[i]["labels"], got[i]["score"], got[i]["n_matches"]) == (label, 1.0, 1)
        if before > 99:  # words far from each other are no statement
            assert (got[i + 10]["labels"], got[i + 10]["score"], got[i + 10]["n_matches"]) == ("", 0.0, 0)
