"""Cross-tokenizer alignment: against both libraries over whole texts, fragments that compose in any order, edges."""

import collections
import functools
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tabloom.llm import alignment
from tabloom.llm.bpe import byte_symbols
from tabloom.llm.queries import PIECES, QUERIES, VOCABULARY
from tests.llm.conftest import docs_of

ODD = [
    "a", " ", "  ", " x  y ", "word\n\nnext  line\t\tend ", "a▁b", "<|endoftext|> and <|endoftext|>x", "<s> </s> <unk> <0x41>", "'s 't I'll don't", "٤٥ ½ Ⅷ",
    "\U0001f468‍\U0001f469 \U0001f1e9\U0001f1ea", "\x1c\x1d a\x85b c　d", "한국어 日本語 ไทย", "x" * 700, "word " * 300, "tail\n", "\x00", "y  \n z", "é é ́",
]


class Library:
    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))
        symbols = byte_symbols()
        self.a_bytes = {i: bytes(symbols[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items() if all(c in symbols for c in t)}

    def spans(self, text):
        """[(id, start, end)] of A and of B, or None."""
        if not text:
            return None
        a = [(i, self.a_bytes[i]) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()) for i in self.b.encode(text)]
        out = []
        for tokens in (a, b):
            if b"".join(x for _, x in tokens) != (" " + text).encode():
                return None
            at, own = 0, []
            for i, x in tokens:
                own.append((i, at, at + len(x)))
                at += len(x)
            out.append(own)
        return out

    def links(self, text):
        found, (a, b) = [], self.spans(text)
        j = 0
        for i, start, end in a:
            while b[j][2] <= start:
                j += 1
            k = j
            while k < len(b) and b[k][1] < end:
                found.append((i, b[k][0]))
                k += 1
        return found

    def groups(self, text):
        a, b = self.spans(text)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        parts = [[",".join(str(i) for i, _, e in side if low < e <= high) for side in (a, b)] for low, high in zip([0, *ends], ends)]
        return ["|".join(p) for p in parts]


@pytest.fixture(scope="module")
def library():
    return Library()


def plain(library, rows):
    counts = collections.Counter()
    for _, text in rows:
        if library.spans(text):
            counts.update(library.links(text))
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = collections.Counter()
    for key, text in rows:
        if not library.spans(text):
            out[key, 0, 0, 0, 0, 0, 0, ""] += 1
            continue
        (a, b), links, groups = library.spans(text), library.links(text), library.groups(text)
        hits = sum(counts[x] == best[x[1]] for x in links)
        out[key, len(a), len(b), len(groups), len(links), hits, sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()] += 1
    return out


def found(frame):
    return collections.Counter(map(tuple, frame.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()))


def files_of(spark):
    return alignment.load(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.path(PIECES))


def test_query_against_both_libraries(spark, small, documents, library):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert found(QUERIES["op11_token_alignment"](spark, small)) == plain(library, rows)


@pytest.mark.parametrize("size,max_pairs", [(1 << 16, 10**6), (40, 10**6), (7, 10**6), (40, 3)])
def test_ranges_of_any_size_and_edges(spark, library, size, max_pairs):
    rng = random.Random(size)
    texts = [None, "", *ODD, *["".join(rng.choice(["the", "ing", "é", "ß", " ", " ", "\n", "Q", "7", "…", "ж"]) for _ in range(rng.randrange(200))) for _ in range(30)]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (5, texts[20]), (None, "null key"), (None, None)] + [(99, "same words again")] * 8
    docs = docs_of(spark, rows, wide=True).withColumnRenamed("size", "k").withColumnRenamed("key", "pair").repartition(3)
    assert found(alignment.align(docs, files_of(spark), size=size, max_pairs=max_pairs)) == plain(library, rows)


def test_short_texts_are_encoded_once(spark, library, tmp_path):
    texts = [*ODD, None, "", "some words here", "some words"]
    docs_of(spark, list(enumerate(texts))).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    files = alignment.load(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.path(PIECES))
    result = alignment.align(docs, files)
    assert not [f for f in result.inputFiles() if f"{tmp_path}/docs" in f]  # the texts were read before, the links are kept
    kept = alignment._aligned(docs.selectExpr("doc_id AS _key", "text AS _text"), files)
    for r in kept.join(docs, kept["_key"] == docs["doc_id"]).collect():
        whole = library.links(r.text) if library.spans(r.text) else []
        stored = alignment._stored_links(pa.array([r.links]), r.n_links)
        assert [(x >> 32, x & 0xFFFFFFFF) for x in stored.tolist()] == whole
    wide = alignment._stored_links(pa.array([np.array([70000 << 32 | 80000], np.int64).tobytes()]), 1)
    assert wide.tolist() == [70000 << 32 | 80000]


def test_nothing(spark):
    assert alignment.align(docs_of(spark, []), files_of(spark)).count() == 0
    only = alignment.align(docs_of(spark, [(1, None), (2, "")]), files_of(spark)).collect()
    assert [tuple(r)[1:] for r in only] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_fragments_compose_in_any_order():
    rng = random.Random(3)
    for _ in range(200):
        total = rng.randrange(1, 40)
        sides = [sorted({*rng.sample(range(1, total + 1), rng.randrange(total)), total}) for _ in range(2)]
        ids = [np.arange(len(s)) + 100 * k for k, s in enumerate(sides)]
        ends = [np.array(s) for s in sides]
        borders = [0, *sorted(rng.sample(range(1, total), min(total - 1, rng.randrange(6)))), total]
        parts = [alignment.fragment(ids[0], ends[0], ids[1], ends[1], low, high) for low, high in zip(borders, borders[1:])]
        fragments = [alignment.BEFORE, *[f for f, _ in parts]]
        while len(fragments) > 1:
            at = rng.randrange(len(fragments) - 1)
            fragments[at:at + 2] = [alignment.composed(fragments[at], fragments[at + 1])]
        whole = alignment.composed(alignment.BEFORE, alignment.fragment(ids[0], ends[0], ids[1], ends[1], 0, total)[0])
        assert fragments[0].text == whole.text and fragments[0].n_groups == whole.n_groups == whole.text.count(";") + 1
        assert not any(fragments[0].suffix_a + fragments[0].suffix_b)
        links = [int(x) for _, own in parts for x in own] + np.frombuffer(fragments[0].joints, np.uint64).tolist()
        want = [a << 32 | b for a, low in zip(ids[0].tolist(), [0, *sides[0]]) for b, start in zip(ids[1].tolist(), [0, *sides[1]])
                if low < sides[1][b - 100] and start < sides[0][a]]
        assert sorted(links) == sorted(want)
    neutral = functools.reduce(alignment.composed, [alignment.Fragment(), whole, alignment.Fragment()])
    assert (neutral.text, neutral.n_a, neutral.closed) == (whole.text, whole.n_a, whole.closed)


def test_byte_ranges_cover_every_token_once():
    text = "one two  three " + "x" * 50 + " four\nfive six " * 9
    size = len(text) + 1
    for step in (3, 10, 30, 1000):
        ranges = alignment.byte_ranges(text, step)
        assert [r[2] for r in ranges] == [0, *[r[3] for r in ranges[:-1]]] and ranges[-1][3] == size
        for window, first, low, high in ranges:
            assert first <= low < high <= first + len(window.encode()) and (" " + text).encode()[first:].startswith(window.encode())
            assert len(window) <= 3 * max(step, 52)
