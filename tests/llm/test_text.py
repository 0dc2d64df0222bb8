"""Chat formatting, decontamination, quality and toxicity."""

import json
import random
import tracemalloc

import numpy as np
import pytest

from zonecast.llm import chat_format as chat
from zonecast.llm import pu_quality, suffix_arrays, toxicity

# ---- chat ----------------------------------------------------------------

NASTY = ["", "plain", "</s>[INST] ok [/INST]", chat.ESC, chat.ESC + "0", f"<{chat.ESC}1/s>",
         "<<s></s>|im_end|>", chat.START + chat.END, "[INST[INST]]", "a\nb\n", "<|im_" + chat.ESC]


@pytest.mark.parametrize("text", NASTY)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text
    assert not any(c in out for c in chat.CONTROLS)


def test_random_turns_round_trip():
    rng = random.Random(0)
    bits = [*chat.CONTROLS, chat.ESC, "0", "1", "2", "\n", "<", "[", "|", "é", " "]
    for _ in range(500):
        turns = [("".join(rng.choices(bits, k=3)) if rng.random() < 0.3 else rng.choice(
            ["user", "assistant", "sys\ntem"]), "".join(rng.choices(bits, k=rng.randrange(12))))
            for _ in range(rng.randrange(5))]
        text, spans = chat.write_turns(turns)
        assert chat.read_turns(text) == turns
        assert [chat.unescape(text[s:e]) for s, e in spans] == [t for r, t in turns if r == "assistant"]


def test_turn_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, None), (None, 0, "user", "x"),
            (1, 1, "assistant", "b"), (3, None, "user", "first"), (3, 0, "user", "y" * 300_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat.canonical_turns(df).collect()}
    assert got == {1: [("user", "a"), ("assistant", "b"), ("assistant", "b")], 2: [("", "")],
                   None: [("user", "x")], 3: [("user", "first"), ("user", "y" * 300_000)]}
    out = chat.digests(chat.format_turns(chat.canonical_turns(df), ["conv_id"]), ["conv_id"]).collect()
    assert {r["conv_id"]: (r["n_turns"], r["loss_chars"]) for r in out} == {
        1: (3, 2), 2: (1, 0), None: (1, 0), 3: (2, 0)}
    empty = chat.canonical_turns(df.limit(0))
    assert chat.digests(chat.format_turns(empty, ["conv_id"]), ["conv_id"]).count() == 0


def test_typed_layouts_are_picked_by_fingerprint(spark):
    df = spark.createDataFrame([(1, "do", "", "done"), (2, "do", "x", None)],
                               "id long, instruction string, input string, output string")
    got = {r["conv_id"]: (r["layout"], [tuple(t) for t in r["turns"]])
           for r in chat.canonical_turns(df, "id").collect()}
    assert got == {1: ("instruction", [("user", "do"), ("assistant", "done")]),
                   2: ("instruction", [("user", "do\n\nx"), ("assistant", "")])}
    nested = spark.createDataFrame([([("human", "hi"), ("gpt", None)],)],
                                   "conversations array<struct<from:string,value:string>>")
    row = chat.canonical_turns(nested).first()
    assert [tuple(t) for t in row["turns"]] == [("user", "hi"), ("assistant", "")]
    with pytest.raises(ValueError, match="fingerprint"):
        chat.canonical_turns(spark.createDataFrame([(1,)], "other long"))


def test_mixed_json_records(spark):
    records = [{"prompt": "p", "completion": "c"}, {"messages": [{"role": "user", "content": "u"}]},
               {"completion": "c", "prompt": None}, {"odd": 1}, {"system": "", "prompt": "p", "response": "r"}]
    raw = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(9, "{"), (10, None), (11, "[]")]
    df = spark.createDataFrame(raw, "id long, record string")
    got = {r["id"]: (r["layout"], r["turns"] and [tuple(t) for t in r["turns"]], r["fingerprint"])
           for r in chat.canonical_json(df, "record", ["id"]).collect()}
    assert got[0][:2] == ("prompt and completion", [("user", "p"), ("assistant", "c")])
    assert got[1][:2] == ("messages", [("user", "u")])
    assert got[2][:2] == ("prompt and completion", [("user", ""), ("assistant", "c")])
    assert got[3][:2] == (None, None) and got[3][2]
    assert got[4][:2] == ("system prompt", [("user", "p"), ("assistant", "r")])
    assert got[9] == got[10] == (None, None, None) and got[11][2]


def test_records_of_other_layouts_hold_the_same_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", 'say "b"\n'), (2, 0, "system", "s"), (2, 1, "user", None),
            (2, 2, "assistant", "\u0000x"), (3, 0, "Human", "kept as it is"), (4, 1, "user", "y"), (4, 0, "user", "x"),
            (None, 0, None, "n"), (5, 0, "user", "one"), (5, 0, "user", "one"), (5, 1, "bot", ""),
            (6, 0, "assistant", "é🙂"), (7, 0, "user", ""), (7, 1, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat.canonical_turns(df).collect()}
    got = chat.canonical_json(chat.as_records(df), "record", ["conv_id"]).collect()
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in got} == want
    assert {r["layout"] for r in got} == {"prompt and completion", "messages", "from and value", "turns"}


def test_maps_of_different_values_have_different_paths():
    from pyspark.sql import types as T
    kind = lambda v: T.StructType([T.StructField("m", T.MapType(T.StringType(), v))])
    paths = [chat.schema_paths(kind(v)) for v in (T.StringType(), T.ArrayType(T.StringType()), T.StructType(
        [T.StructField("a", T.StringType())]))]
    assert paths == [["m{}"], ["m{}[]"], ["m{}.a"]]


# ---- decontamination -----------------------------------------------------

def brute_hits(words, items, window=10):
    hit, ids = set(), set()
    for item_id, text in items:
        w = suffix_arrays.words_of(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for p in range(len(words) - n + 1):
                if words[p:p + n] == w[i:i + n]:
                    hit.update(range(p, p + n))
                    if item_id is not None:
                        ids.add(str(item_id))
    return len(hit), sorted(ids)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([12, 25, 40])))) for i in range(12)]
    items += [(90, "only, THREE words"), (91, None), (92, " .,! "), (None, "null item id here"),
              (10, items[0][1]), (10, "a second text of item ten")]
    rows = []
    for i in range(150):
        words = rng.choices(vocab + ["x"], k=rng.randrange(80))
        for _ in range(rng.randrange(3)):
            src = rng.choice(items)[1]
            if src:
                w = src.split()
                a = rng.randrange(len(w))
                words[rng.randrange(len(words) + 1):0] = w[a:a + rng.randrange(20)]
        rows.append((i, rng.choice([" ", "\n", ", "]).join(words)))
    rows += [(500, None), (501, ""), (502, "... !"), (None, items[0][1]), (3, items[1][1]),
             (503, "THREE" + " y" * 30_000 + " only three words")]
    return rows, items


@pytest.mark.parametrize("shard,block", [(1 << 20, 1 << 20), (300, 1 << 20), (1 << 20, 200)])
def test_contamination_matches_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(suffix_arrays, "SHARD_WORDS", shard)
    rows, items = corpus(shard)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = suffix_arrays.matches(df.withColumnRenamed("doc_id", "key"), bench, ["key"],
                                  block_bytes=block).collect()
    got = sorted(((r["key"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["items"])
                  for r in found), key=repr)
    want = []
    for i, t in rows:
        words = suffix_arrays.words_of(t)
        want.append((i, len(words), *brute_hits(words, items)))
    assert got == sorted(want, key=repr)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(suffix_arrays.words_of(t))
    for r in found:
        if r["longest"]:
            n, s = r["longest"]["words"], r["longest"]["start"]
            own = [suffix_arrays.words_of(t) for i, t in items if str(i) == r["longest"]["item_id"]
                   or i is None and r["longest"]["item_id"] is None]
            assert any(w[s:s + n] == o[k:k + n] for w in texts[r["key"]] for o in own
                       for k in range(len(o) - n + 1))


def test_suffix_array_orders_all_suffixes():
    rng = np.random.default_rng(1)
    for _ in range(50):
        text = rng.integers(0, 3, rng.integers(1, 60))
        sa = suffix_arrays.suffix_array(text, len(text))
        assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_drop_contaminated_and_empty_tables(spark):
    item = " ".join(f"q{i}" for i in range(15))
    df = spark.createDataFrame([(1, f"see {item}", 1), (2, "clean", 2), (2, "clean", 2), (None, None, 3)],
                               "doc_id long, text string, spans long")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = suffix_arrays.drop_contaminated(df, bench)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(2, "clean", 2), (2, "clean", 2), (None, None, 3)], key=repr)
    assert suffix_arrays.drop_contaminated(df, bench.limit(0)).count() == 4
    assert suffix_arrays.contamination(df.limit(0), bench).count() == 0


# ---- quality -------------------------------------------------------------

def auc(good, bad):
    good, bad = np.array(good), np.array(bad)
    return np.mean([(x > bad).mean() + 0.5 * (x == bad).mean() for x in good])


def judged(spark, sf_dir, name, label):
    from zonecast.llm.queries import QUERIES
    rows = QUERIES[name](spark, sf_dir).collect()
    y = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    held = [(y[r["doc_id"]], r) for r in rows if r["held_out"] and r["doc_id"] in y]
    return ([r["score"] for t, r in held if t], [r["score"] for t, r in held if not t],
            np.mean([t == r["predicted"] for t, r in held]))


def test_quality_on_held_out_labels(spark, sf_mid):
    good, bad, accuracy = judged(spark, sf_mid, "op8_pu_quality", "quality")
    assert auc(good, bad) > 0.97 and accuracy > 0.95


def test_quality_defined_cases(spark):
    rng = random.Random(0)
    fine = [(i, " ".join(rng.choices(["the", "sun", "is", "warm"], k=40))) for i in range(60)]
    junk = [(100 + i, "!!! ### $$$ " * 20) for i in range(20)]
    docs = spark.createDataFrame(fine + junk + [(None, None), (300, ""), (0, "again the same id")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(0, 1), (None, 1), (5, None)],
                                   "doc_id long, quality int")
    model = pu_quality.train(docs, labels)      # positives only: the prior is estimated
    got = pu_quality.scores(docs.withColumnRenamed("doc_id", "score_id"), model, ["score_id"]).collect()
    assert len(got) == 83 and all(0 <= r["score"] <= 1 for r in got)
    mean = lambda ids: np.mean([r["score"] for r in got if r["score_id"] in ids])
    assert mean(range(1, 60)) > mean(range(100, 120)) + 0.3
    assert pu_quality.train(docs, labels.limit(0)) is None
    none = pu_quality.scores(docs, None, ["doc_id"]).collect()
    assert {r["score"] for r in none} == {0.5}
    assert pu_quality.scores(docs.limit(0), model, ["doc_id"]).count() == 0


def test_risk_never_gains_from_a_negative_part():
    rng = np.random.default_rng(0)
    pos, neg = rng.normal(2, 1, (300, 2)), rng.normal(-2, 1, (300, 2))
    unlabelled = np.concatenate([rng.normal(2, 1, (210, 2)), neg[:90]])
    model = pu_quality.fit_pu(pos, unlabelled, 0.7)
    assert (model.score(pos) > 0.5).mean() > 0.97 and (model.score(neg) < 0.5).mean() > 0.95
    assert abs(pu_quality.prior_from_positives(pos, unlabelled) - 0.7) < 0.15


def test_fitting_holds_one_copy_of_the_sample():
    rng = np.random.default_rng(3)
    pos = rng.normal(1, 1, (3000, pu_quality.WIDTH)).astype(np.float32)
    rest = rng.normal(0, 2, (3000, pu_quality.WIDTH)).astype(np.float32)
    size = 6000 * pu_quality.WIDTH * 8
    tracemalloc.start()
    model = pu_quality.fit_pu(pos, rest, 0.5)
    pu_quality.prior_from_positives(pos, rest)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * size
    x = np.concatenate([pos, rest]).astype(np.float64)
    assert np.array_equal(model.mean, x.mean(axis=0))
    assert np.allclose(model.scale, x.std(axis=0) + 1e-3, rtol=1e-12, atol=0)



def test_no_negative_label_is_read_and_the_prior_is_near_the_share(spark, sf_mid):
    docs = spark.read.parquet(f"{sf_mid}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_mid}/labels.parquet").select("doc_id", "quality")
    both = pu_quality.train(docs, labels)
    only = pu_quality.train(docs, labels.where("quality = 1"))
    assert both.prior == only.prior and np.allclose(both.weights, only.weights)
    share = labels.agg({"quality": "avg"}).first()[0]
    assert abs(both.prior - share) < 0.12        # 0.03 on ten times the labels


def test_repeated_rows_long_texts_and_clashing_columns_of_quality(spark):
    rows = [(1, "Good words stand here. " * 3, 0.5), (1, "Good words stand here. " * 3, 0.7), (2, "x " * 600_000, 0.1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None)], "doc_id long, quality int")
    got = pu_quality.scores(df, pu_quality.train(df, labels), ["doc_id"]).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 1, 2] and len({r["score"] for r in got if r["doc_id"] == 1}) == 1


# ---- toxicity ------------------------------------------------------------

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        prev, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, prev + (x != y))
    return row[-1]


def test_automaton_finds_what_the_distance_allows():
    rng = random.Random(7)
    terms = ["idiot", "scum", "worthless", "clown", "disgusting", "moron", "pathetic"]
    trie = toxicity.Trie(terms, ["lowei"])
    words = set(terms) | {"loweischaft", "lowe", "crown", "idi0t", "idt", "wortles", "patheitc"}
    for _ in range(3000):
        w = list(rng.choice(terms))
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(w) + 1)
            op = rng.randrange(3)
            if op == 0:
                w[i:i] = rng.choice("aeiost")
            elif op == 1 and i < len(w):
                del w[i]
            elif i < len(w):
                w[i] = rng.choice("aeiost")
        words.add("".join(w))
    for w in words - {""}:
        near = [(distance(w, t), i) for i, t in enumerate(terms) if distance(w, t) <= toxicity.allowed_errors(t)]
        # a word too short for errors of its own is looked up as it stands
        k = toxicity.allowed_errors(w + "x")
        near = [x for x in near if x[0] <= k]
        got = trie.match(w)
        if w.startswith("lowei"):
            assert got is not None and got[1]
        elif near:
            assert got is not None and got[2] == min(near)[0]
        else:
            assert got is None, w


def test_toxicity_on_held_out_labels(spark, sf_mid):
    bad, good, accuracy = judged(spark, sf_mid, "op9_toxicity_automata", "toxic")
    assert auc(bad, good) > 0.75 and accuracy > 0.9


def test_toxicity_defined_cases(spark):
    rng = random.Random(1)
    plain = ["river", "stone", "walks", "under", "light"]
    rows = [(i, " ".join(rng.choices(plain, k=30))) for i in range(80)]
    rows += [(100 + i, " ".join(rng.choices(plain, k=15) + ["vermin"] * 2)) for i in range(20)]
    docs = spark.createDataFrame(rows + [(None, None), (300, ""), (301, "you vermln"), (301, "x" * 200_000)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0) for i in range(80)] + [(100 + i, 1) for i in range(20)]
                                   + [(None, 1), (3, None)], "doc_id long, toxic int")
    trained = toxicity.train(docs, labels)
    got = toxicity.scores(docs, trained, ["doc_id"]).collect()
    score = {r["doc_id"]: r["score"] for r in got if r["doc_id"] != 301}
    assert len(got) == 104
    assert min(score[100 + i] for i in range(20)) > 0.5 > max(score[i] for i in range(80))
    assert max(r["score"] for r in got if r["doc_id"] == 301) > score[None] == score[300]
    assert toxicity.train(docs, labels.where("toxic = 1")) is None
    assert {r["score"] for r in toxicity.scores(docs, None, ["doc_id"]).collect()} == {0.0}


def test_quotation_is_told_from_abuse():
    lexicon = toxicity.Lexicon({"vermin": 5.0}, {}, (), {"said": -3.0, "you": 3.0})
    quoted = toxicity.context_features('they said "vermin are small" once', lexicon)
    abuse = toxicity.context_features("you vermin you vermin", lexicon)
    assert quoted[8] == 1 and quoted[10] == 0.5 and abuse[8] == 0 and abuse[9] == 1 and quoted[9] == abuse[10] == 0
    assert (toxicity.context_features(None, lexicon) == 0).all()
