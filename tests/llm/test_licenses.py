"""License scans against a scan word by word, and on texts with words added or left out."""

import re

from pyspark.sql import functions as F

from posterion.llm import licenses, queries
from posterion.llm.licenses import PASSAGES, PHRASES, Template

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))


def base_places(text):
    w, out = words(text), []
    for t in PHRASES:
        p = t.text.split()
        out += [(i, i + len(p) - 1, t.label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return sorted(out)


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, row string")


def test_base_equals_a_plain_scan(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op11_diagonal_license_scan"](spark, data).collect()}
    seen = 0
    for r in docs.collect():
        places, g = base_places(r.text), got[r.doc_id]
        seen += bool(places)
        assert (g.n_words, g.n_base) == (len(words(r.text)), len(places))
        assert (g.first_word, g.last_word) == ((min(p[0] for p in places), max(p[0] for p in places)) if places else (None, None))
        assert g.base_labels == ",".join(sorted({p[2] for p in places}))
        assert set(filter(None, g.base_labels.split(","))) <= set(g.labels.split(",")) and 0 <= g.score <= 1
    assert seen and len(got) == docs.count()


def test_odd_documents(spark):
    texts = [None, "", " \n", "MIT license", "mit license mit-license, the MIT\nLicense x", "mit", "general general public license public license",
             "İmit license", "mıt license", "mit license " * 3000, "license mit license apache license"]
    got = sorted(licenses.labelled(frame(spark, texts + ["MIT license"])).collect())
    for r, t in zip(got, texts + ["MIT license"]):
        assert [(p["first"], p["last"], p["label"]) for p in r.places] == base_places(t), t
        assert r.n_words == len(words(t))
    assert len(got[9].places) == 3000
    assert licenses.labelled(frame(spark, []).filter("false")).count() == 0
    same = spark.createDataFrame([(None, "apache license"), (None, "apache license"), (7, "x"), (7, "x")], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.base_labels) for r in licenses.labelled(same).collect()) == [(False, ""), (False, ""), (True, "apache"), (True, "apache")]


def test_spans_with_words_added_and_left_out(spark):
    passage = next(t for t in PASSAGES if t.label == "mit-text").text.split()
    noise = [f"w{i}" for i in range(400)]
    added = passage[:20] + ["extra", "words"] + passage[20:]
    left = passage[:10] + passage[13:30] + passage[31:]
    some = passage[:12]
    apart = [w for pair in zip(passage, noise) for w in pair]
    texts = [noise[:50] + x + noise[50:80] for x in (passage, added, left, some, apart, [])] + [noise[:5] + passage + noise[:200] + added]
    got = [r.spans for r in sorted(licenses.scanned(frame(spark, [" ".join(t) for t in texts])).collect())]
    one = lambda i: [s for s in got[i] if s["label"] == "mit-text"]      # noqa: E731
    assert [(s["first"], s["last"], s["score"]) for s in one(0)] == [(50, 50 + len(passage) - 1, 1.0)]
    assert [(s["first"], s["last"], s["score"]) for s in one(1)] == [(50, 50 + len(added) - 1, 1.0)]
    assert len(one(2)) == 1 and 0.8 < one(2)[0]["score"] < 1
    assert not one(3) and not one(4) and not got[5]
    assert [s["first"] for s in one(6)] == [5, 205 + len(passage)]


def test_diagonals_vote_for_every_pair_of_places(spark):
    templates = (Template("a", "a b a b", True), Template("b", "a b"), Template("one", "z"))
    texts = ["a b a b a b", "b a", "a b z", "z z"]
    got = sorted((r.doc_id, r.template, r.diagonal, r.votes) for r in
                 licenses.diagonals(frame(spark, texts), templates).filter("template is not null").collect())
    expected = {}
    for d, t in enumerate(texts):
        w = t.split()
        for i, m in enumerate(templates):
            p, k = m.text.split(), licenses.width(len(m.text.split()))
            for x in range(len(w) - k + 1):
                for y in range(len(p) - k + 1):
                    if w[x:x + k] == p[y:y + k]:
                        expected[d, i, x - y] = expected.get((d, i, x - y), 0) + 1
    assert got == sorted((*k, v) for k, v in expected.items())


def test_statements_of_the_given_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    marked = licenses.labelled(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    for r in marked:
        labels = r.labels.split(",")
        assert ("cc-by-nc-4.0" in labels) == ("Licensed under CC BY-NC 4.0" in (r.text or "")), r.doc_id
        assert ("mit-statement" in labels) == ("Released under the MIT License" in (r.text or "")), r.doc_id
        if not re.search("licen[sc]e", (r.text or "").lower()):
            assert r.labels == "" and r.score == 0
