"""Packing: the plan against packing one by one, ids against the library, every piece in its place, edges."""

import collections
import random
import zlib
from array import array

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tabloom.llm import packing
from tabloom.llm.queries import QUERIES, WORDS
from tests.llm.conftest import docs_of

ODD = [
    "Don't  STOP<|endoftext|>nowé é ́x ́", "İstanbul ΣΟΣ ßẞ", "a\x1cb\x1d c\x85d e f", "12345 a1b2 ٤٥ ½",
    "\U0001f468‍\U0001f469‍\U0001f467 \U0001f1e9\U0001f1ea ok", "<|startoftext|> x <|startoftext|", "\t\n\r\x0b\x0c", "we'll they've I'm 'S 'LL", "한가 가", "\x00a\x00 b", "...!!! ,, --- ''",
]


def one_by_one(sizes, capacity):
    """Fill of each sequence."""
    left = sorted(sizes, reverse=True)
    large, small, fills = [s for s in left if 3 * s > capacity], [s for s in left if 3 * s <= capacity], []
    while large:
        size = large.pop(0)
        beside = next((s for s in large if size + s <= capacity), 0)
        if beside:
            large.remove(beside)
        fills.append(size + beside)
    for s in small:
        room = [f for f in fills if f + s <= capacity]
        if room:
            fills.remove(max(room))
        fills.append(max(room, default=0) + s)
    return fills


def library(texts, end=1):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(WORDS))
    return [[*e.ids, end] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(rows, ids, capacity):
    """Pieces are the documents' ids, in order; sequences are numbered from 0, without gaps and not overfull."""
    want, got, used = collections.Counter(), collections.Counter(), collections.defaultdict(list)
    for doc, own in ids:
        for piece, start in enumerate(range(0, len(own), capacity)):
            part = array("I", own[start:start + capacity])
            want[doc, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    for r in rows:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        used[r.sequence_id].append((r.offset, r.length))
    assert got == want
    assert sorted(used) == list(range(len(used)))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(one_by_one([r.length for r in rows], capacity)) == sorted(sum(n for _, n in v) for v in used.values())
    return len(used)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_packing_one_by_one(seed):
    rng = random.Random(seed)
    capacity = rng.choice([3, 10, 97, 1000])
    sizes = [min(capacity, 1 + int(capacity * rng.random() ** rng.choice([1, 3]))) for _ in range(rng.randrange(150))]
    plan = packing.Plan(collections.Counter(sizes), capacity)
    assert plan.sequences == len(one_by_one(sizes, capacity))
    with pytest.raises(ValueError):
        packing.Plan({capacity + 1: 1}, capacity)


def test_plan_grows_with_the_capacity_only():
    rng = random.Random(3)
    plan = packing.Plan({s: rng.randrange(1, 10**9) for s in range(1, 4097)})
    assert len(plan.entries) < 20_000


def test_query_packs_all_documents(spark, small, documents):
    rows = QUERIES["op12_best_fit_packing"](spark, small).collect()
    docs = documents.collect()
    n = check(rows, list(zip([r.doc_id for r in docs], library([r.text for r in docs]))), 4096)
    assert n <= 1.02 * sum(r.length for r in rows) / 4096 + 1


@pytest.mark.parametrize("capacity", [1, 7, 64])
def test_edges(spark, capacity):
    texts = [None, "", " ", *ODD, "word " * 500, "x" * 3000, *["same words again here"] * 9]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null id")] * 2 + [(0, None), (3, ODD[0])]
    docs = docs_of(spark, rows, wide=True).withColumnRenamed("size", "length").withColumnRenamed("at", "sequence_id")
    tokenizer = packing.load(spark, public_tokenizers.path(WORDS))
    cut = packing.pieces(docs, tokenizer, capacity=capacity, keep_ids=True)
    packed = packing.pack(cut, capacity)
    found = packed.collect()
    ids = list(zip([r[0] for r in rows], library([r[1] for r in rows])))
    check(found, ids, capacity)
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for r in found:
        at = 4 * r.offset
        assert bytes(whole[r.sequence_id].ids[at:at + 4 * r.length]) == bytes(r.ids)
    assert sum(len(r.ids) for r in whole.values()) == 4 * sum(len(own) for _, own in ids)


def test_nothing_and_names(spark):
    tokenizer = packing.load(spark, public_tokenizers.path(WORDS))
    assert packing.pack(packing.pieces(docs_of(spark, []), tokenizer)).count() == 0
    with pytest.raises(ValueError):
        packing.pieces(docs_of(spark, []).withColumnRenamed("doc_id", "piece"), tokenizer, key="piece")


def test_words_are_remembered_in_bounded_tables(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 50)
    with open(public_tokenizers.path(WORDS), encoding="utf-8") as f:
        own = packing.WordIds(f.read())
    rng = random.Random(1)
    for _ in range(20):
        texts = [" ".join(rng.choice(["ab", "Cd", "éf", "g,h"]) * rng.randrange(1, 5) for _ in range(40)) for _ in range(5)] + ODD
        ids, cuts = own.encode(pa.array([*texts, None]))
        assert [ids[i:j].tolist() for i, j in zip(cuts, cuts[1:])] == [i[:-1] for i in library([*texts, None])]
        assert len(own.young) < 50 + 250
