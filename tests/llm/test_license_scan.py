"""License scans against word-by-word search."""

import random
import re

import pytest

from zonecast.llm import license_scan as ls
from zonecast.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(text, templates=ls.TEMPLATES, k=3, gap=3):
    w = words(text)
    base, found, places, score = set(), set(), [], 0.0
    for t in templates:
        need = t.words if t.base else t.required.split()
        windows = [t.words[i:i + k] for i in range(len(t.words) - k + 1)]
        on = {}
        for p in range(len(w) - k + 1):
            for q, window in enumerate(windows):
                if w[p:p + k] == window:
                    on.setdefault(p - q, set()).add(q)
        at = next((i for i in range(len(t.words)) if need and t.words[i:i + len(need)] == need), 0)
        want = set(range(at, at + len(need) - k + 1))
        spans = []
        for d in sorted(on):
            if not spans or d - spans[-1][-1] > gap:
                spans.append([])
            spans[-1].append(d)
        for span in spans:
            whole = [d for d in span if want <= on[d]]
            covered = len(set().union(*[on[d] for d in span])) / len(windows)
            score = max(score, covered)
            if t.base:
                places += whole
                base |= {t.label} if whole else set()
            elif whole and covered >= 0.8:
                found.add(t.label)
    return (len(w), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | found)), round(score, 9))


COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def got(rows):
    return [tuple(round(r[c], 9) if c == "score" else r[c] for c in COLUMNS) for r in rows]


MIT = ls.NOTICES[0].text
TEXTS = [
    None, "", "mit", "Under THE (MIT) license.", "under the mit licence", "under the mit license " * 3,
    "cc-by-nc cc by nc CC BY-NC 4.0", "Apache License, Version 2.0, under the MIT License",
    "x " * 50 + MIT + " y" * 50, MIT.replace("hereby ", "").replace("files", "files and other files"),
    " ".join(MIT.split()[:12]), MIT.replace("deal in the software", "use it"),
    ls.NOTICES[3].text + " or version 2", ls.NOTICES[4].text, ls.NOTICES[5].text.upper(),
    ls.NOTICES[10].text, ls.NOTICES[11].text, ls.NOTICES[12].text, "All rights reserved.", "rights reserved all",
    "éunder the mit license", "under the\u0000mit license", "under the mit license",
    "under the mıt license", "UNDER THE MIT LICENſE", "ünder under the mit license ÉE",
]


def test_texts_match_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)],
                               "doc_id long, text string, labels string").repartition(4)
    rows = sorted(ls.scan(df).collect(), key=lambda r: r["doc_id"])
    assert got(rows) == [brute(t) for t in TEXTS]
    assert ls.scan(df).columns == ["doc_id", *COLUMNS]


def test_what_the_labels_say(spark):
    want = {3: "mit", 4: "", 5: "mit", 6: "cc-by-nc", 7: "apache-2,mit", 8: "mit", 9: "mit", 10: "", 11: "",
            12: "gpl-3", 13: "gpl-2", 14: "gpl-3", 15: "cc-by", 16: "cc-by-sa", 17: "cc-by-nc",
            18: "all-rights-reserved", 19: ""}
    df = spark.createDataFrame([(i, TEXTS[i]) for i in want], "doc_id long, text string")
    assert {r["doc_id"]: r["labels"] for r in ls.scan(df).collect()} == want


def test_query_matches_brute_force(spark, sf_small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = QUERIES["op13_diagonal_license_scan"](spark, sf_small).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert got(rows) == [brute(docs[r["doc_id"]]) for r in rows]
    assert any(r["n_base"] for r in rows)


def test_random_edits_match_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(150):
        w = [x for t in rng.sample(ls.TEMPLATES, rng.randint(1, 3)) for x in t.words * rng.randint(1, 2)]
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(w))
            if rng.random() < 0.5:
                del w[at]
            else:
                w.insert(at, rng.choice(["the", "license", "zz", "mit"]))
            w = w or ["the"]
        texts.append(rng.choice([" ", "\n", ", "]).join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(ls.scan(df).collect(), key=lambda r: r["doc_id"])
    assert got(rows) == [brute(t) for t in texts]


def test_repeated_rows_null_ids_and_empty_table(spark):
    schema = "doc_id long, text string"
    assert ls.scan(spark.createDataFrame([], schema)).count() == 0
    t = "under the mit license and cc by nc"
    df = spark.createDataFrame([(1, t), (1, t), (1, "cc by nc"), (None, t), (None, None), (None, t)], schema)
    rows = ls.scan(df).collect()
    assert sorted((repr(r["doc_id"]), r["n_words"], r["n_base"]) for r in rows) == [
        ("1", 3, 1), ("1", 8, 2), ("1", 8, 2), ("None", 0, 0), ("None", 8, 2), ("None", 8, 2)]


def test_very_long_text_and_spans(spark):
    text = "filler words here " * 100_000 + ls.NOTICES[5].text + " tail" * 100
    got_spans = ls.spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    (span,) = [s for s in got_spans if s["label"] == "gpl-3" and s["verified"]]
    assert (span["first_word"], span["last_word"], span["covered"]) == (300_000, 300_008, 1.0)


def test_plan_is_native_and_broadcasts_the_templates(spark, sf_small):
    plan = QUERIES["op13_diagonal_license_scan"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.search("Python|Pandas|Arrow|Scan ExistingRDD|CartesianProduct", plan)


def test_templates_are_checked(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for bad in (ls.Template("x", "one two"), ls.Template("x", "w " * 70), ls.Template("x", "a b c d", "a b")):
        with pytest.raises(ValueError):
            ls.scan(df, templates=[bad])
