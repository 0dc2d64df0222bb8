"""Alignment of two tokenizers' tokens by pointer jumping.

Both tokenizers cut the same bytes. Every token points to the token that
overlaps it and ends farthest to the right (of the other tokenizer, or itself;
of two that end together the second tokenizer's counts as farther). Doubling,
next = next[next], converges in as many rounds as the logarithm of the longest
chain; the token that a chain ends in lies where both tokenizers end a token,
and names the group of all tokens that lead to it. A task does this for all
texts of a batch at once: each text's bytes follow the last text's, so no chain
leaves its text.

Tokens that end together are linked. How often two ids are linked in the whole
corpus is counted by Spark (a task sends each pair once). Of two tokens that
end together one's bytes are a suffix of the other's, so the number of
distinct pairs is at most `pair_bound` of the vocabularies, whatever the
corpus: that is what makes it right to hand the counts to every task.

Long texts are encoded in pieces, cut before an inner space after a character
that is no white space: neither tokenizer has a token across such a place (for
the second one its vocabulary is checked, and where it has one texts stay
whole), so the tokens are those of the whole text.

Defined cases: null and empty texts, and those that either tokenizer's tokens
do not spell byte by byte (a space before the text counts as part of it), have
no tokens and no groups. Strings of special tokens are plain text. Repeated
rows are aligned, and counted, each. An empty table gives an empty result.
Null keys are carried as they are; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.llm.common import staged

PIECE_CHARS = 1 << 16       # a longer text is encoded in pieces
BATCH_CHARS = 1 << 20       # of text, aligned at once
LONG_RUN = 1000             # characters of one run, from which encoding by ranks gets slow
MAX_PAIRS = 1 << 23         # distinct pairs that a task may hold (12 bytes each)

# The byte values that byte-level vocabularies write as
# themselves; the others are written as characters from 256 on, in order.
PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

# Fixed value: the usual pattern that cuts text into words before the merges.
WORD_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

_CUT = re.compile(r"(?<=\S) (?=.)", re.DOTALL)


def byte_of_char() -> dict[str, int]:
    rest = [b for b in range(256) if b not in PLAIN_BYTES]
    return {**{chr(b): b for b in PLAIN_BYTES}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def has_long_run(text: str) -> bool:
    """Whether `LONG_RUN` characters follow each other without, or of, white
    space. Such a run covers one of the blocks of half that size."""
    half = LONG_RUN // 2
    for at in range(0, len(text) - half + 1, half):
        block = text[at:at + half]
        if " " not in block or block.isspace():
            return bool(re.search(r"\S{%d}|\s{%d}" % (LONG_RUN, LONG_RUN), text))
    return False


class Tokenizers:
    """The two tokenizers, from the contents of their files, and the bytes of
    their tokens by id.

    A vocabulary whose merges are numbered in the order of their ids is encoded
    from ranks, which takes a quarter of the time and gives the same ids; only
    texts with a run of `LONG_RUN` characters without, or of, white space go to
    the file's own tokenizer, whose time does not grow with a run's square."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece

        self._a_file = a_file.decode("utf-8")
        self._a = None
        told = json.loads(self._a_file)
        chars = byte_of_char()
        vocabulary = {**told["model"]["vocab"], **{t["content"]: t["id"] for t in told.get("added_tokens", [])}}
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = (bytes(chars[c] for c in entry) if all(c in chars for c in entry)
                               else entry.encode("utf-8"))
        self._ranks = self._by_rank(told)
        self.b = sentencepiece.SentencePieceProcessor()
        self.b.LoadFromSerializedProto(b_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                        else p.replace("▁", " ").encode("utf-8") for i, p in enumerate(pieces)]
        # a piece with a space after another character could span a cut
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        # ids as text, with what follows them within, and at the end of, a group
        self.a_said = [np.array([b"%d%b" % (i, end) for i in range(len(self.a_bytes))], object) for end in (b",", b"|")]
        self.b_said = [np.array([b"%d%b" % (i, end) for i in range(len(self.b_bytes))], object) for end in (b",", b";")]

    def _by_rank(self, told: dict):
        """An encoder by ranks; None unless the file is a plain byte-level
        vocabulary with the usual pattern and merges in the order of ids."""
        model, before = told["model"], told.get("pre_tokenizer") or {}
        plain = (model.get("type", "BPE") == "BPE" and not told.get("normalizer")
                 and before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
                 and before.get("use_regex", True)
                 and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix",
                                                    "ignore_merges")))
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        made = [model["vocab"].get(x + y, -1) for x, y in pairs]
        if not plain or made != sorted(made) or -1 in made:
            return None
        import tiktoken

        ids = set(model["vocab"].values()) - {t["id"] for t in told.get("added_tokens", [])}
        return tiktoken.Encoding("ranks", pat_str=WORD_PATTERN, special_tokens={},
                                 mergeable_ranks={self.a_bytes[i]: i for i in ids})

    @property
    def a(self):
        """The file's own tokenizer."""
        if self._a is None:
            import tokenizers

            self._a = tokenizers.Tokenizer.from_str(self._a_file)
            self._a.encode_special_tokens = True
            self._a.no_truncation()
            self._a.no_padding()
        return self._a

    def pieces(self, text: str) -> list[str]:
        out, at = [], 0
        while self.cuts and len(text) - at > PIECE_CHARS:
            cut = _CUT.search(text, at + PIECE_CHARS)
            if not cut:
                break
            out.append(text[at:cut.start()])
            at = cut.start()
        return [*out, text[at:]]

    def encode(self, text: str | None) -> tuple[list[int], list[int], int] | None:
        """Ids of both tokenizers and the number of bytes, None without tokens."""
        if not text:
            return None
        try:
            want = b" " + text.encode("utf-8")
        except UnicodeEncodeError:
            return None
        a: list[int] = []
        b: list[int] = []
        spelt = True
        for i, piece in enumerate(self.pieces(text)):
            first = " " + piece if i == 0 else piece
            if self._ranks is None or has_long_run(piece):
                a += self.a.encode(first, add_special_tokens=False).ids
                spelt = False
            else:                   # ranks cut bytes, so they always spell the text
                a += self._ranks.encode_ordinary(first)
            # the second tokenizer adds the space that each further piece starts with
            b += self.b.encode(piece if i == 0 else piece[1:], num_threads=1)
        if b"".join(map(self.b_bytes.__getitem__, b)) != want:
            return None
        if not spelt and b"".join(map(self.a_bytes.__getitem__, a)) != want:
            return None
        return a, b, len(want)


@lru_cache(maxsize=2)
def _load(a_file: bytes, b_file: bytes) -> Tokenizers:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
    return Tokenizers(a_file, b_file)


def pair_bound(a_bytes: Sequence[bytes], b_bytes: Sequence[bytes]) -> int:
    """How many id pairs can end together at most: pairs of ids of which one's
    bytes are a suffix of the other's."""
    def ids(tokens):
        out: dict[bytes, int] = {}
        for t in tokens:
            out[t] = out.get(t, 0) + 1
        return out

    first, second = ids(a_bytes), ids(b_bytes)
    shorter = sum(n * second.get(t[i:], 0) for t, n in first.items() for i in range(len(t)))
    longer = sum(n * first.get(t[i:], 0) for t, n in second.items() for i in range(1, len(t)))
    return shorter + longer


def successors(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """For all tokens, A's and then B's, the farthest-right overlapping token.
    Ends ascend, both lists end together, tokens have one byte at least."""
    n = len(a_end)
    over_b = np.searchsorted(b_end, a_end)          # the B token over A's last byte
    over_a = np.searchsorted(a_end, b_end)
    own = np.arange(len(b_end)) + n
    return np.concatenate([over_b + n, np.where(a_end[over_a] > b_end, over_a, own)])


def terminals(succ: np.ndarray) -> np.ndarray:
    """The token that each token's chain ends in, by successor doubling."""
    while True:
        far = succ[succ]
        if np.array_equal(far, succ):
            return succ
        succ = far


def group_sizes(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of A and of B each group has, groups in text order."""
    label = terminals(successors(a_end, b_end))

    def runs(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # a group's tokens follow each other
        at = np.concatenate([[0], np.flatnonzero(labels[1:] != labels[:-1]) + 1, [len(labels)]])
        return labels[at[:-1]], np.diff(at)

    names, a_sizes = runs(label[:len(a_end)])
    same, b_sizes = runs(label[len(a_end):])
    if not np.array_equal(names, same):
        raise ArithmeticError("a group without tokens of one tokenizer")
    return a_sizes, b_sizes


@dataclass(frozen=True)
class Aligned:
    """The tokens and groups of some texts, one text after the other."""
    a_ids: np.ndarray
    b_ids: np.ndarray
    n_a: np.ndarray         # tokens of each text
    n_b: np.ndarray
    a_sizes: np.ndarray     # tokens of each group
    b_sizes: np.ndarray
    n_groups: np.ndarray    # groups of each text

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids linked: the last tokens of a group end together."""
        return self.a_ids[np.cumsum(self.a_sizes) - 1], self.b_ids[np.cumsum(self.b_sizes) - 1]

    def said(self, tok: Tokenizers) -> list[bytes]:
        """Each text's groups as `a1,a2|b1;a3|b2,b3`."""
        a_to, b_to = np.cumsum(self.a_sizes), np.cumsum(self.b_sizes)
        out = np.empty(len(self.a_ids) + len(self.b_ids), object)
        # a token stands behind its group's A tokens and all earlier groups
        out[np.arange(len(self.a_ids)) + np.repeat(b_to - self.b_sizes, self.a_sizes)] = tok.a_said[0][self.a_ids]
        out[np.arange(len(self.b_ids)) + np.repeat(a_to, self.b_sizes)] = tok.b_said[0][self.b_ids]
        a_last, b_last = self.links()
        out[a_to - 1 + b_to - self.b_sizes] = tok.a_said[1][a_last]
        out[a_to + b_to - 1] = tok.b_said[1][b_last]
        at = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])
        pieces = out.tolist()
        return [b"".join(pieces[x:y])[:-1] for x, y in zip(at, at[1:])]


def align_texts(tok: Tokenizers, texts: Sequence[str | None]) -> Aligned:
    none = np.zeros(0, np.int64)
    a_ids, b_ids, ends = [none], [none], [0]
    for text in texts:
        a, b, size = tok.encode(text) or (none, none, 0)
        a_ids.append(np.array(a, np.int64))
        b_ids.append(np.array(b, np.int64))
        ends.append(ends[-1] + size)
    n_a, n_b = [len(x) for x in a_ids[1:]], [len(x) for x in b_ids[1:]]
    a_all, b_all = np.concatenate(a_ids), np.concatenate(b_ids)
    a_end, b_end = np.cumsum(tok.a_len[a_all]), np.cumsum(tok.b_len[b_all])
    a_sizes, b_sizes = group_sizes(a_end, b_end) if len(a_all) else (none, none)
    # groups of each text: those whose last token ends within it
    group_end = a_end[np.cumsum(a_sizes) - 1] if len(a_sizes) else none
    n_groups = np.diff(np.searchsorted(group_end, np.array(ends), side="right"))
    return Aligned(a_all, b_all, np.array(n_a, np.int64), np.array(n_b, np.int64), a_sizes, b_sizes, n_groups)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _each_text(docs: DataFrame, keys: Sequence[str], text: str, a_path: str, b_path: str,
               fields: list[T.StructField],
               columns: Callable[[Tokenizers, Aligned], list[pa.Array]]) -> DataFrame:
    """The keys of `docs` and the columns made of their texts. The files are
    read here; their contents go to the tasks."""
    with open(a_path, "rb") as f, open(b_path, "rb") as g:
        files = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))
    rows = docs.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`").alias("_zc_text"))
    out = T.StructType([*rows.schema.fields[:-1], *fields])

    def task(batches):
        tok = _load(*files.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            start = 0
            while start < batch.num_rows:       # a bounded amount of text at once
                part, size = [], 0
                while start + len(part) < batch.num_rows and (not part or size < BATCH_CHARS):
                    part.append(texts[start + len(part)].as_py())
                    size += len(part[-1] or "")
                own = [c.slice(start, len(part)) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*own, *columns(tok, align_texts(tok, part))], names=out.names)
                start += len(part)

    return rows.mapInArrow(task, out)


def _ints(name: str) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.IntegerType()))


def align(docs: DataFrame, keys: Sequence[str], text: str, a_path: str, b_path: str) -> DataFrame:
    """One row per row of `docs`: its keys, a_ids and b_ids (the tokens of both
    tokenizers in order), a_sizes and b_sizes (how many of each the groups
    hold, in order)."""
    def columns(tok: Tokenizers, got: Aligned) -> list[pa.Array]:
        return [_lists(got.a_ids, got.n_a), _lists(got.b_ids, got.n_b),
                _lists(got.a_sizes, got.n_groups), _lists(got.b_sizes, got.n_groups)]

    return _each_text(docs, keys, text, a_path, b_path,
                      [_ints(c) for c in ("a_ids", "b_ids", "a_sizes", "b_sizes")], columns)


def linked(docs: DataFrame, keys: Sequence[str], text: str, a_path: str, b_path: str) -> DataFrame:
    """One row per row of `docs`: its keys, n_a, n_b, n_groups, groups_sha256
    and its links, a_link and b_link (the ids that end together, in order)."""
    def columns(tok: Tokenizers, got: Aligned) -> list[pa.Array]:
        digests = [hashlib.sha256(x).hexdigest() if x else "" for x in got.said(tok)]
        a, b = got.links()
        return [pa.array(got.n_a), pa.array(got.n_b), pa.array(got.n_groups.astype(np.int64)),
                pa.array(digests, pa.string()), _lists(a, got.n_groups), _lists(b, got.n_groups)]

    return _each_text(docs, keys, text, a_path, b_path, [
        *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups")],
        T.StructField("groups_sha256", T.StringType()), _ints("a_link"), _ints("b_link")], columns)


def _codes(batch: pa.RecordBatch) -> np.ndarray:
    """a << 32 | b of all links of a batch, one row's after the other."""
    a, b = (np.asarray(batch.column(c).flatten()).astype(np.int64) for c in ("a_link", "b_link"))
    return a << 32 | b


def _slices(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut into parts of about `most` links."""
    for batch in batches:
        ends = np.cumsum(np.asarray(batch.column("a_link").value_lengths()).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most)))
            yield batch.slice(start, stop - start)
            start = stop


def link_counts(links: DataFrame) -> DataFrame:
    """(a_id, b_id, n): how often two ids are linked in all rows."""
    def task(batches):
        for batch in _slices(batches):
            code, n = np.unique(_codes(batch), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array((code >> 32).astype(np.int32)),
                                              pa.array((code & 0xFFFFFFFF).astype(np.int32)),
                                              pa.array(n.astype(np.int64))], ["a_id", "b_id", "n"])

    return (links.select("a_link", "b_link").mapInArrow(task, "a_id int, b_id int, n long")
            .groupBy("a_id", "b_id").agg(F.sum("n").alias("n")))


def link_table(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (a_id << 32 | b_id) ascending, their counts, and whether a count
    is the highest of its B id. As many rows as `pair_bound` allows at most."""
    got = counts.limit(MAX_PAIRS + 1).toArrow()
    if got.num_rows > MAX_PAIRS:
        raise ValueError(f"more than {MAX_PAIRS} linked pairs")
    a, b, n = (np.asarray(got.column(c).combine_chunks()).astype(np.int64) for c in ("a_id", "b_id", "n"))
    code = a << 32 | b
    order = np.argsort(code)
    code, b, n = code[order], b[order], n[order]
    most = np.zeros(b.max(initial=-1) + 1, np.int64)
    np.maximum.at(most, b, n)
    return code, n, n == most[b]


def measured(links: DataFrame, keys: Sequence[str], counts: DataFrame) -> DataFrame:
    """Per row of `linked` its keys, n_a, n_b, n_groups, n_links, n_best (links
    whose count is their B id's highest), count_sum (of its links' counts) and
    groups_sha256."""
    rows = links.select(*[F.col(f"`{k}`") for k in keys], "n_a", "n_b", "n_groups", "groups_sha256",
                        "a_link", "b_link")
    out = T.StructType([*rows.schema.fields[:-3],
                        *[T.StructField(c, T.LongType()) for c in ("n_links", "n_best", "count_sum")],
                        T.StructField("groups_sha256", T.StringType())])
    table = links.sparkSession.sparkContext.broadcast(link_table(counts))

    def task(batches):
        code, count, best = table.value
        for batch in _slices(batches):
            place = np.searchsorted(code, _codes(batch))
            n = np.asarray(batch.column("a_link").value_lengths()).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(n)])
            sums = np.concatenate([[0], np.cumsum(count[place])])
            bests = np.concatenate([[0], np.cumsum(best[place].astype(np.int64))])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], pa.array(n), pa.array(np.diff(bests[at])), pa.array(np.diff(sums[at])),
                 batch.column(batch.num_columns - 3)], names=out.names)

    return rows.mapInArrow(task, out)


def alignment(docs: DataFrame, keys: Sequence[str], text: str, a_path: str, b_path: str) -> DataFrame:
    """`linked` written once, its links counted, and measured."""
    links = staged(linked(docs, keys, text, a_path, b_path), "linked", "zstd")
    return measured(links, keys, staged(link_counts(links), "link-counts"))
