import datetime as dt
import os
import random
import re
import sys

import numpy as np
import pytest
from pyspark.sql import types as T

from tallyward.llm import licenses, url_filters
from tallyward.llm.queries import ORACLE_SQL, QUERIES, op5_license_scan

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    import oracle_check

    con = oracle_check.duck(SF)
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    got = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in got.description]
    assert sorted(columns) == sorted(df.columns)
    assert oracle_check.digest(df.columns, rows) == oracle_check.digest(columns, got.fetchall())


DAY = dt.date(2024, 5, 1)
CAPTURES = T.StructType([T.StructField(n, t) for n, t in (("page_id", T.LongType()), ("url", T.StringType()), ("captured_on", T.DateType()), ("key", T.StringType()), ("list", T.StringType()), ("host", T.StringType()))])
ENTRIES = T.StructType([T.StructField(n, t) for n, t in (("list", T.StringType()), ("key", T.StringType()), ("action", T.StringType()), ("day", T.DateType()), ("host", T.StringType()))])


def slow_keys(url):
    m = re.match(url_filters.HOST, url or "")
    if not m:
        return []
    host = m.group(1).lower()
    labels = host.split(".")
    keys = [".".join(labels[-k:]) for k in range(2, len(labels) + 1)] or [host]
    s = re.match(url_filters.SEGMENT, url)
    return keys + ([f"{host}/{s.group(1)}"] if s else [])


def slow_verdict(url, day, entries):
    hits = []
    for level, key in enumerate(slow_keys(url)):
        for name in {e[0] for e in entries}:
            past = [(d, a == "add") for n, k, a, d in entries if n == name and k == key and d is not None and a in ("add", "remove") and day is not None and d <= day]
            if past and max(past)[1]:
                hits.append((level, name))
    block = max((v for v, n in hits if n != "allow"), default=-1)
    allow = max((v for v, n in hits if n == "allow"), default=-1)
    return ("block" if block > allow else "allow"), len(hits), ",".join(sorted({n for _, n in hits}))


def test_captures_see_the_entries_of_their_day(spark):
    rnd = random.Random(4)
    urls = ["http://a.b.example.org/x/1", "https://B.Example.org", "http://example.org/y?q", "ftp://u@example.org:21/x", "no url", None, "", "http://localhost/z", "http://a.b.example.org/y"]
    keys = sorted({k for u in urls for k in slow_keys(u)})
    days = [DAY + dt.timedelta(days=i) for i in range(12)]
    entries = [(rnd.choice(["spam", "adult", "allow"]), rnd.choice(keys), rnd.choice(["add", "remove", "add"]), rnd.choice(days)) for _ in range(90)]
    entries += entries[:5] + [(None, keys[0], "add", DAY), ("spam", None, "add", DAY), ("spam", keys[0], "add", None), ("spam", keys[0], "renew", DAY)]
    captures = [(i, u, d) for i, (u, d) in enumerate([(u, d) for u in urls for d in [*days, None]])] + [(0, urls[0], DAY), (None, urls[1], DAY)]
    c = spark.createDataFrame([(*r, "k", "l", "h") for r in captures], CAPTURES)
    e = spark.createDataFrame([(*r, "h") for r in entries], ENTRIES)
    known = [x for x in entries if None not in x]
    got = sorted((str(r.page_id), str(r.host), str(r.captured_on), r.verdict, r.n_active, r.lists) for r in url_filters.judge(c, e).collect())
    host = lambda u: str((re.match(url_filters.HOST, u or "") or [None, None])[1]).lower() if re.match(url_filters.HOST, u or "") else "None"
    assert got == sorted((str(i), host(u), str(d), *slow_verdict(u, d, known)) for i, u, d in captures)
    assert {r.verdict for r in url_filters.judge(c, spark.createDataFrame([], ENTRIES)).collect()} == {"allow"}
    assert url_filters.judge(spark.createDataFrame([], CAPTURES), e).count() == 0


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}


def slow_base(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = sorted((i, label) for label, p in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def check(rows, texts):
    got = sorted(((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=str)
    assert got == sorted(((str(i), *slow_base(t)) for i, t in texts), key=str)
    for r in rows:
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


def test_op5_against_brute_force(spark):
    check(op5_license_scan(spark, SF).collect(), [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()])


DOCS = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("matches", T.StringType()), ("found", T.StringType()), ("n_words", T.StringType()))])


def test_odd_texts_and_labels_of_the_method(spark):
    texts = [
        (1, None), (2, ""), (3, "MIT License"), (3, "MIT License"), (None, "mit license mit license"), (4, "mit"), (5, "license mit"),
        (6, "the GNU\nGeneral*Public_License. general public"), (7, "Apache\tLicense, Version 2.0 apache license"), (8, "mitlicense mit licensed"),
        (9, "émit license mit\x85license"), (10, "apache license " * 20_000), (11, "x" * 200_000),
        (12, "Redistribution and use in source and binary forms, with or without modification"),
        (13, "Permission is hereby granted, free of charge, to any person obtaining a copy"), (14, "mit"), (15, "license"),
        (16, "Licensed under CC BY-NC 4.0."), (17, "GNU Lesser General Public License"),
    ]
    rows = licenses.license_labels(spark.createDataFrame([(i, t, "m", "f", "n") for i, t in texts], DOCS)).collect()
    check(rows, texts)
    labels = {r.doc_id: r.labels for r in rows}
    assert (labels[12], labels[13], labels[16], labels[17]) == ("bsd", "mit", "cc-by-nc", "gpl,lgpl" if "gpl" in labels[17].split(",") else "lgpl")
    assert labels[7] == "apache,apache-2.0" and labels[6] == "gpl"
    assert licenses.license_labels(spark.createDataFrame([], DOCS)).count() == 0


def slow_scan(texts):
    """Matches of every text by plain loops over its words, and its labels and score."""
    split = [WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for t in texts]
    df = {}
    for words in split:
        for word in set(words):
            df[word] = df.get(word, 0) + 1
    idf = lambda w: float(np.log((len(texts) + 1) / (df.get(w, 0) + 0.5)))
    out = []
    for words in split:
        found = []
        places = {}
        for at, word in enumerate(words):
            places.setdefault(word, []).append(at)
        for base, (label, text, k0, kn) in [(True, t) for t in licenses.BASE] + [(False, t) for t in licenses.TEMPLATES]:
            t = text.split()
            if not all(df.get(x, 0) for x in t[k0 : k0 + kn]):
                continue
            rare = []
            for at in range(0, len(t), licenses.SEGMENT):
                here = [i for i in range(at, min(at + licenses.SEGMENT, len(t))) if df.get(t[i], 0)]
                rare += sorted(here, key=lambda i: (-idf(t[i]), i))[: licenses.RARE_WORDS]
            rare = range(len(t)) if base else rare
            need, slack = (len(t), 0) if base else (min(licenses.AGREE, len(rare)), licenses.SLACK)
            weight = [max(idf(x), 1e-6) for x in t]
            for begin in [p - k0 for p in places.get(t[k0], ()) if words[p : p + kn] == t[k0 : k0 + kn]]:
                agree = sum(any(0 <= begin + s + i < len(words) and words[begin + s + i] == t[i] for s in range(-slack, slack + 1)) for i in rare)
                if agree < need:
                    continue
                covered, span = set(), []
                for s in range(-slack, slack + 1):
                    on = [i for i in range(len(t)) if 0 <= begin + s + i < len(words) and words[begin + s + i] == t[i]]
                    if s:
                        on = [i for i in on if any(set(range(j, j + licenses.RUN)) <= set(on) for j in range(i - licenses.RUN + 1, i + 1))]
                    covered |= set(on)
                    span += [begin + s + i for i in on]
                found.append((label, base, begin + k0, min(span), max(span), round(sum(weight[i] for i in covered) / sum(weight), 9)))
        out.append(sorted(found))
    return out


def scanned(df):
    return {r.doc_id: sorted((*tuple(m)[:5], round(m.coverage, 9)) for m in r.matches) for r in licenses.scan(df).collect()}


def edited(text, rnd, drop, add):
    words = [w for w in text.split() if rnd.random() > drop]
    for _ in range(add):
        words.insert(rnd.randrange(len(words)), f"extra{rnd.randrange(100)}")
    return " ".join(words)


def license_texts():
    rnd = random.Random(8)
    filler = lambda n: " ".join(f"word{rnd.randrange(400)}" for _ in range(n))
    whole = [t for _, t, _, _ in licenses.TEMPLATES if len(t.split()) > 60]
    texts = [f"{filler(40)} {t} {filler(30)}" for t in whole]
    texts += [f"{filler(20)} {edited(t, rnd, 0.03, 3)} {filler(20)}" for t in whole for _ in range(3)]
    texts += [" ".join(t.split()[i : i + 45]) for t in whole for i in (0, 20, 40)]
    texts += [filler(300), "", None, "mit license " * 50, whole[0] + " " + whole[0], "the software is provided as is " * 40]
    return texts


def test_labels_score_and_spans_against_plain_loops(spark):
    texts = license_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got, expected = scanned(df), slow_scan(texts)
    assert [got[i] for i in range(len(texts))] == expected
    rows = {r.doc_id: r for r in licenses.license_labels(df).collect()}
    for i, found in enumerate(expected):
        assert rows[i].labels == ",".join(sorted({m[0] for m in found})) and rows[i].score == pytest.approx(max((m[5] for m in found), default=0))


def test_op5_labels_against_plain_loops_over_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    expected = {d.doc_id: found for d, found in zip(docs, slow_scan([d.text for d in docs]))}
    rows = op5_license_scan(spark, SF).collect()
    assert {r.doc_id: r.labels for r in rows} == {i: ",".join(sorted({m[0] for m in found})) for i, found in expected.items()}
    assert all(r.score == pytest.approx(max((m[5] for m in expected[r.doc_id]), default=0)) for r in rows)


def test_an_edited_licence_is_found_and_postings_decide(spark, monkeypatch):
    label, text, k0, kn = next(t for t in licenses.TEMPLATES if t[0] == "mit" and len(t[1].split()) > 100)
    words = text.split()
    line = words[:20] + ["a", "changed", "line", "stands", "here", "now"] + words[26:]  # six words in place of others
    gap = words[:20] + words[24:]  # four words left out before the key phrase
    key = " ".join(words[k0 : k0 + kn])
    texts = [text, " ".join(line), " ".join(gap), " ".join(words[k0 - 20 : k0 + 20]), "words of no licence at all"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {i: [m for m in own if m[0] == label and m[2] >= k0 - 10 - i * 60 and not m[1]] for i, own in scanned(df).items()}
    best = {i: max(own, key=lambda m: m[5], default=None) for i, own in found.items()}
    assert best[0][3:] == (0, len(words) - 1, 1.0)
    assert best[1][3:5] == (0, len(words) - 1) and best[1][5] > 0.9
    assert best[2][3:5] == (0, len(gap) - 1) and best[2][5] > 0.9
    assert best[3][5] > 0.05 and best[4] is None
    # the indexed words decide what is found
    sizes = []
    for n in (0, 1, 3):
        monkeypatch.setattr(licenses, "RARE_WORDS", n)
        sizes.append(sum(not m[1] for own in scanned(df).values() for m in own))
    assert sizes[0] == 0 < sizes[2] and sizes[1] <= sizes[2]


def test_postings_that_do_not_agree_on_a_place_find_nothing(spark):
    """The key phrase with the template's rare words around it, but in other places."""
    label, text, k0, kn = next(t for t in licenses.TEMPLATES if t[0] == "zlib")
    words = text.split()
    rnd = random.Random(5)
    rest = words[:k0] + words[k0 + kn :]
    rnd.shuffle(rest)
    scattered = " ".join(rest[:50] + ["x"] * 30 + words[k0 : k0 + 2] + ["y"] * 20 + rest[50:])
    df = spark.createDataFrame([(0, text), (1, scattered)], "doc_id long, text string")
    got = scanned(df)
    assert [m[0] for m in got[0] if m[0] == label] == [label] and not [m for m in got[1] if m[0] == label]
