"""What the toxicity lexicon keeps of the labelled texts, and what it then finds."""

import random

import pytest

from zonecast.llm import toxicity

PLAIN = ["river", "stone", "walks", "under", "light", "garden", "window", "seven"]


def learnt(spark, bad, n_clean=80, each=6):
    """A lexicon trained on clean texts and on `each` toxic texts per word of `bad`."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(PLAIN, k=20)), 0) for i in range(n_clean)]
    rows += [(1000 + i, " ".join(rng.choices(PLAIN, k=12) + [w, f"pad{i}"]), 1)
             for i, w in enumerate(w for w in bad for _ in range(each))]
    rows = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return toxicity.train(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))[0]


def test_misspellings_of_learnt_words_that_have_a_stem(spark):
    lexicon = learnt(spark, ["idiot", "stupid", "worthless"])
    assert lexicon.trie.stems
    for word in ("idot", "1diot", "stpid", "sttupid", "worhless"):
        got = lexicon.find(word)
        assert got is not None and got[1] == 1 and not got[2], word
    assert lexicon.find("stupidly")[2]      # a stem still stands for the words it begins


def test_two_errors_in_long_words(spark):
    assert toxicity.Trie(["disgusting"], []).match("disgutsing") == (0, False, 2)
    lexicon = learnt(spark, ["disgusting", "worthless"])
    for word in ("dsigusting", "w0rthl3ss", "owrthless"):
        got = lexicon.find(word)
        assert got is not None and got[1] == 2 and not got[2], word


def brute(trie, word):
    """Fewest errors of any term that `word` may stand for."""
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            prev, row[0] = row[0], i + 1
            for j, y in enumerate(b):
                prev, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, prev + (x != y))
        return row[-1]
    k = toxicity.allowed_errors(word + "x")
    return min((d for t in trie.terms
                if (d := distance(word, t)) <= min(k, toxicity.allowed_errors(t))), default=None)


def test_pieces_lose_no_match():
    """Few letters, so that errors meet in every way; terms of all lengths."""
    rng = random.Random(3)
    terms = sorted({"".join(rng.choices("abc", k=rng.randrange(3, 15))) for _ in range(30)})
    trie = toxicity.Trie(terms, [])
    hits = [0, 0, 0]
    for _ in range(6000):
        w = list(rng.choice(terms))
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(w) + 1)
            w[i:i + rng.randrange(2)] = rng.choice(["", "a", "b", "c"])
        want, got = brute(trie, "".join(w)), trie.match("".join(w))
        assert (got[2] if got else None) == want, w
        hits[want or 0] += want is not None
    assert min(hits) > 100


def test_a_rare_term_stays_in_a_large_sample(spark):
    """A term of 6 toxic texts among 1,200, in no clean one."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(PLAIN, k=6)) + f" n{i}", 0) for i in range(2400)]
    rows += [(5000 + i, f"vermin m{i} " + ("knave" if i < 6 else ""), 1) for i in range(1200)]
    rows = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = toxicity.train(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))[0]
    assert lexicon.find("vermin")[1] == 0 and lexicon.find("knave")[1] == 0
    assert lexicon.find("river") is None


def test_the_lexicon_has_no_cut(spark, monkeypatch):
    """600 terms, each in three toxic texts, and their stems; a bound that is
    passed is an error."""
    rng = random.Random(5)
    bad = ["".join(rng.choices("bdfgkmprtvz", k=9)) for _ in range(600)]
    rows = [(i, " ".join(rng.choices(PLAIN, k=20)) + f" n{i}", 0) for i in range(80)]
    rows += [(1000 + i, " ".join([f"m{i}", *bad[i // 3 * 150:i // 3 * 150 + 150]]), 1) for i in range(12)]
    rows = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs, labels = rows.select("doc_id", "text"), rows.select("doc_id", "toxic")
    lexicon = toxicity.train(docs, labels)[0]
    assert set(bad) <= set(lexicon.trie.terms) and lexicon.trie.stems
    monkeypatch.setattr(toxicity, "MOST_ENTRIES", 599)
    with pytest.raises(ValueError, match="600 terms"):
        toxicity.train(docs, labels)


def test_all_clean_words_near_a_term_are_exceptions(spark):
    """5,200 clean words, each two letters from the one term."""
    near, term = [], "disgusting"
    for i in range(1, 10):
        for j in range(i + 1, 10):
            near += [term[:i] + a + term[i + 1:j] + b + term[j + 1:]
                     for a in "bcfhjklmopqrv" for b in "bcfhjklmopqrv"]
    near = near[:5200]
    rows = [(i, f"{' '.join(near)} n{i}", 0) for i in range(10)]
    rows += [(100 + i, " ".join(PLAIN) + f" n{i}", 0) for i in range(80)]
    rows += [(1000 + i, f"{term} m{i}", 1) for i in range(20)]
    rows = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = toxicity.train(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))[0]
    assert len(set(near)) == 5200 and lexicon.find("dizgustinz")[1] == 2
    assert not [w for w in near if lexicon.find(w)]


def test_quoted_and_abusive_uses_are_scored_apart_by_the_fitted_model(spark):
    """Two terms; a few clean texts report them, in quotation marks and by a
    verb that the lexicon learns to count against abuse."""
    rng = random.Random(8)
    fill = lambda k: rng.choices(PLAIN, k=k)
    rows = [(i, " ".join([*fill(20), *(["shut", "up"] if i % 8 == 0 else [])]), 0) for i in range(600)]
    rows += [(700 + i, " ".join([*fill(6), "witnesses", "reported", '"', ["vermin", "knave"][i % 2], '"', *fill(6)]), 0)
             for i in range(16)]
    rows += [(1000 + i, " ".join([*fill(6), "shut", "up", rng.choice(["vermin", "knave"]), *fill(6)]), 1) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon, model = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert set(lexicon.trie.terms) >= {"vermin", "knave"}
    assert lexicon.context["shut"] > 1 and lexicon.context["reported"] < -1 and lexicon.context["witnesses"] < -1

    def score(text):
        return model.score(toxicity.context_features(text, lexicon).reshape(1, -1))[0]

    for term in ("vermin", "knave"):
        assert score(f'the river stone, as witnesses reported " {term} " under seven') < 0.5
        assert score(f"the river stone now shut up {term} under seven light") > 0.5


def test_words_that_may_be_chance_are_no_terms(spark):
    """Of 4,000 rare words some stand in toxic texts alone by chance; the two
    that are no chance are kept."""
    rng = random.Random(9)
    rare = ["".join(rng.choices("abcdefgh", k=7)) for _ in range(4000)]
    rows = []
    for i in range(1000):
        y = int(i % 10 == 0)
        rows.append((i, " ".join([*rng.choices(PLAIN, k=10), *rng.choices(rare, k=12), *(["vermin", "xylo"] if y else [])]), y))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))[0]
    assert {"vermin", "xylo"} <= set(lexicon.trie.terms) and len(lexicon.trie.terms) <= 4


def test_clean_words_are_not_derived_from_stems(spark):
    rng = random.Random(10)
    rows = [(i, " ".join([*rng.choices(PLAIN, k=15), *(["vermouth"] if i < 5 else []), f"n{i}"]), 0) for i in range(400)]
    rows += [(1000 + i, " ".join([*rng.choices(PLAIN, k=10), rng.choice(["vermin", "verminous", "vermins"]), f"m{i}"]), 1)
             for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))[0]
    assert "verm" in lexicon.trie.stem_at
    assert lexicon.find("vermouth") is None and lexicon.find("verminish")[2]


def brute_features(text, lexicon):
    """Every word against every entry, every match against every token."""
    import re

    import numpy as np
    tokens = re.findall(r"[^\W_]+|[\"“”„«»]", (text or "").lower())

    def find(w):
        trie = lexicon.trie
        if w in trie.terms:
            return lexicon.term_weight[trie.terms.index(w)], 0, False, trie.terms.index(w)
        if w in lexicon.exceptions:
            return None
        heads = [s for s in sorted(trie.stems, key=len) if w.startswith(s)]
        if heads:
            i = trie.stems.index(heads[0])
            return lexicon.stem_weight[i], 0, True, i
        best = None
        for i, t in enumerate(trie.terms):
            d = brute(toxicity.Trie([t], []), w)
            if d is not None and (best is None or (d, i) < best):
                best = (d, i)
        return best and (lexicon.term_weight[best[1]], best[0], False, best[1])

    found = {w: got for w in set(tokens) - toxicity.QUOTES if (got := find(w)) is not None}
    at = [i for i, w in enumerate(tokens) if w in found]
    if not at:
        return np.zeros(toxicity.N_FEATURES)
    hits = [found[tokens[i]] for i in at]
    near = lambda i: range(max(0, i - toxicity.REACH), min(len(tokens), i + toxicity.REACH + 1))
    is_quote = [t in toxicity.QUOTES for t in tokens]
    quoted = sum(sum(is_quote[:i]) % 2 == 1 and any(is_quote[i:]) for i in at)
    odds = [min(6, max(-6, sum(lexicon.context.get(tokens[j], 0) for j in near(i)))) / 6 for i in at]
    n = len(at)
    return np.array([
        1, np.log1p(sum(h[1] == 0 and not h[2] for h in hits)), np.log1p(sum(h[1] > 0 for h in hits)),
        np.log1p(sum(h[2] for h in hits)), np.log1p(len({h[2:] for h in hits})),
        np.log1p(1000 * n / (len(tokens) - sum(is_quote))), max(h[0] for h in hits) / 5,
        np.log1p(np.mean([sum(j in set(at) for j in near(i)) - 1 for i in at])), quoted / n,
        np.mean([max(o, 0) for o in odds]), np.mean([max(-o, 0) for o in odds])])


def test_whole_scoring_matches_brute_force(spark):
    import numpy as np
    rng = random.Random(11)
    lexicon = toxicity.Lexicon({"vermin": 4.0, "disgusting": 5.5, "oaf": 3.1}, {"verm": 3.3, "gross": 4.4},
                               ["vermilion", "vermint"], {"you": 2.0, "said": -2.5, "stone": 0.7})
    model = toxicity.Logistic(np.zeros(toxicity.N_FEATURES), np.ones(toxicity.N_FEATURES),
                              np.linspace(-1, 1, toxicity.N_FEATURES + 1))
    pool = [*PLAIN, "you", "said", '"', "vermin", "vermn", "vermilion", "vermint", "verming", "disgutsing", "disgusting",
            "dsgustin", "oaf", "oafs", "grossly", "“", "Vermin"]
    texts = [None, "", '"'] + [" ".join(rng.choices(pool, k=rng.randrange(1, 40))) for _ in range(120)]
    texts += [texts[9], texts[9]]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    got = {r["doc_id"]: r["score"] for r in toxicity.scores(df, (lexicon, model), ["doc_id"]).collect()}
    want = {i: float(model.score(brute_features(t, lexicon).reshape(1, -1))[0]) for i, t in enumerate(texts)}
    assert got == pytest.approx(want, abs=1e-9) and len(got) == len(texts)


def test_a_very_long_text_and_the_rate_of_chance():
    lexicon = toxicity.Lexicon({"vermin": 4.0}, {})
    assert toxicity.context_features("river vermin " * 200_000, lexicon)[1] == pytest.approx(12.2, abs=0.1)
    # 100 words of no meaning and 5 that stand in toxic texts only
    assert toxicity.chance_cut([(3, 27, 100), (30, 0, 5)], 0.1) < -60
    assert toxicity.chance_cut([(3, 27, 100)], 0.1) == float("-inf")
