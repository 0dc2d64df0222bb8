"""Token alignment against plain loops over byte offsets."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from zonecast.llm import token_alignment as ta
from zonecast.llm.queries import QUERIES, tokenizer_files


@pytest.fixture(scope="module")
def tok():
    a, b = tokenizer_files()
    return ta.Tokenizers(open(a, "rb").read(), open(b, "rb").read())


def ends(ids, size):
    out, at = [], 0
    for i in ids:
        at += size[i]
        out.append((at, i))
    return out


def brute(tok, texts):
    """Whole texts, one at a time: groups, links and corpus counts."""
    per, counts = [], Counter()
    for text in texts:
        if not text:
            per.append(None)
            continue
        a = tok.a.encode(" " + text, add_special_tokens=False).ids
        b = tok.b.encode(text)
        want = (" " + text).encode()
        if b"".join(tok.a_bytes[i] for i in a) != want or b"".join(tok.b_bytes[i] for i in b) != want:
            per.append(None)
            continue
        a, b = ends(a, tok.a_len), ends(b, tok.b_len)
        both = sorted({e for e, _ in a} & {e for e, _ in b})
        groups = [([i for e, i in a if lo < e <= hi], [i for e, i in b if lo < e <= hi])
                  for lo, hi in zip([0, *both], both)]
        links = [(i, j) for e, i in a for f, j in b if e == f] if len(a) < 400 else [
            (g[0][-1], g[1][-1]) for g in groups]
        counts.update(links)
        per.append((len(a), len(b), groups, links))
    best = defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    out = []
    for p in per:
        if p is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in p[2])
        out.append((p[0], p[1], len(p[2]), len(p[3]), sum(counts[x] == best[x[1]] for x in p[3]),
                    sum(counts[x] for x in p[3]), hashlib.sha256(said.encode()).hexdigest()))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

TEXTS = ["Hello world", "", None, "x ▁ y", "</s><s>[INST] <|endoftext|> <unk> <0x41>", "日本語のテキスト",
         "naïve café – ﬁ ①", "a\x00b\tc\r\n\n  d", "   lead and trail   ", "  wide", "Hello world",
         "🙂🙃 emoji 👩‍👩‍👧", "aaaaaaaaaaaaaaaaaaaaaaaa", "don't we'll I'M", " ", "é" * 50]


def test_edge_texts_match_brute_force(spark, tok):
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(TEXTS)],
                               "doc_id long, text string, n_a int").repartition(3)
    got = ta.alignment(df, ["doc_id"], "text", *tokenizer_files())
    assert got.columns == ["doc_id", *COLUMNS]
    rows = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got.collect()}
    assert [rows[i] for i in range(len(TEXTS))] == brute(tok, TEXTS)


def test_query_matches_brute_force(spark, sf_small, tok):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    got = QUERIES["op12_pointer_jumping_alignment"](spark, sf_small).collect()
    want = brute(tok, [d["text"] for d in docs])
    key = lambda rows: sorted(rows, key=repr)
    assert key((r["doc_id"], *[r[c] for c in COLUMNS]) for r in got) == key(
        (d["doc_id"], *w) for d, w in zip(docs, want))


def test_doubling_finds_the_components():
    rng = random.Random(4)
    for _ in range(200):
        total = rng.randint(1, 60)
        cut = lambda: np.array(sorted({total, *rng.sample(range(1, total + 1), rng.randint(0, total))}))
        a, b = cut(), cut()
        both = sorted(set(a.tolist()) & set(b.tolist()))
        want = [(int(((a > lo) & (a <= hi)).sum()), int(((b > lo) & (b <= hi)).sum()))
                for lo, hi in zip([0, *both], both)]
        assert list(zip(*map(np.ndarray.tolist, ta.group_sizes(a, b)))) == want


def test_a_long_chain_takes_a_logarithm_of_rounds():
    n = 1 << 16                 # no common end but the last: one component
    a = np.concatenate([np.arange(2, 2 * n, 2), [2 * n]])
    b = np.concatenate([np.arange(1, 2 * n, 2), [2 * n]])
    succ, rounds = ta.successors(a, b), 0
    while not np.array_equal(succ, succ[succ]):
        succ, rounds = succ[succ], rounds + 1
    assert rounds <= 18 and len(set(succ.tolist())) == 1
    assert [x.tolist() for x in ta.group_sizes(a, b)] == [[n], [n + 1]]


def test_pieces_give_the_tokens_of_the_whole_text(tok, monkeypatch, sf_small):
    import duckdb
    texts = [t for (t,) in duckdb.connect().execute(
        f"SELECT text FROM '{sf_small}/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    texts += ["a  b   c d" * 30, "x\t y\n z " * 40, "word " * 60, "  a   b" * 30, "I'll don' t " * 20]
    whole = [tok.encode(t) for t in texts]
    assert tok.cuts
    monkeypatch.setattr(ta, "PIECE_CHARS", 7)
    assert [tok.encode(t) for t in texts] == whole
    assert max(len(tok.pieces(t)) for t in texts if t) > 20


def test_very_long_text(spark, tok):
    text = "some words of a long text, and again. " * 40_000        # 1.5 MB
    df = spark.createDataFrame([(1, text), (2, "some words")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in ta.alignment(df, ["doc_id"], "text", *tokenizer_files()).collect()}
    assert rows[1]["n_groups"] == rows[1]["n_links"] > 300_000 and rows[1]["n_best"] <= rows[1]["n_links"]


def test_pairs_are_bounded_by_the_vocabularies(tok):
    assert ta.pair_bound([b"ab", b"b", b"b"], [b"b", b"xab", b"b"]) == 9
    assert ta.pair_bound(tok.a_bytes, tok.b_bytes) < ta.MAX_PAIRS / 8


def test_empty_table_and_null_keys(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert ta.alignment(none, ["doc_id"], "text", *tokenizer_files()).count() == 0
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a b")], "doc_id long, text string")
    rows = ta.alignment(df, ["doc_id"], "text", *tokenizer_files()).collect()
    assert len(rows) == 3 and {r["count_sum"] for r in rows} == {6} and {r["n_best"] for r in rows} == {2}


def test_long_runs_go_to_the_files_own_tokenizer(tok, monkeypatch):
    rng = random.Random(7)
    for _ in range(300):
        text = "".join(rng.choice(["x" * rng.randrange(1, 1100), " " * rng.randrange(1, 1100), "\n", "a b "]) for _ in range(5))
        runs = [len(r) for r in re.findall(r"\S+|\s+", text)]
        assert ta.has_long_run(text) == (max(runs) >= ta.LONG_RUN)
    long = ["q" * 3000, "ab" * 900 + " c", " " * 2500 + "x", "z\n" + "\t" * 1500]
    by_file = [tok.a.encode(" " + t, add_special_tokens=False).ids for t in long]
    assert [tok.encode(t)[0] for t in long] == by_file == [tok._ranks.encode_ordinary(" " + t) for t in long]
