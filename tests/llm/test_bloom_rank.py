"""Lexical ranking: against a plain scorer, bounds that are never too low, several rounds of items, edges."""

import collections
import math
import random
import re

import numpy as np
import pytest

from tabloom.llm import bloom_rank
from tabloom.llm.queries import QUERIES
from tests.llm.conftest import docs_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top=10):
    """Every score of every pair, in Python integers."""
    bags = [(i, collections.Counter(words(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(b.total() for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = {}
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 10 + 90 * b.total() * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in set(words(text)) if b[t])
            if s > 0:
                scores.append((-s, (i is not None, i), i))
        out[item] = [(i, -s) for s, _, i in sorted(scores)[:top]]
    return {k: v for k, v in out.items() if v}


def found(frame):
    out = collections.defaultdict(list)
    for r in sorted(frame.collect(), key=lambda r: (str(r.item_id), r["rank"])):
        out[r.item_id].append((r.doc_id, r.score))
        assert r["rank"] == len(out[r.item_id])
    return dict(out)


def corpus(rng, n):
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    docs = [(i, ", ".join(rng.choices(vocabulary, weights, k=int(3 + 200 * rng.random() ** 4)))) for i in range(n)]
    docs += [(5000 + i, docs[3][1]) for i in range(n // 3)]  # a third are copies: ties
    docs += [(9000, "w1 " * 70_000), (9001, None), (9002, ""), (9003, "?! \x00\x7f"), (9004, " ".join(f"u{i}" for i in range(9000)))]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 30)))) for i in range(40)]
    items += [(100, docs[3][1]), (101, None), (102, "..."), (103, "never seen"), (104, docs[5][1] + " w1 W1"), (105, "u17 U17 w1")]
    return docs, items


@pytest.mark.parametrize("rounds", [4_000_000, 900])
def test_best_documents_are_exact(spark, rounds, monkeypatch):
    monkeypatch.setattr(bloom_rank, "ROUND_CHARS", rounds)
    docs, items = corpus(random.Random(5), 300)
    rng = random.Random(1)
    rng.shuffle(docs)
    table = docs_of(spark, docs, wide=True).repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string").crossJoin(spark.range(1).withColumnRenamed("id", "doc_id"))
    assert found(bloom_rank.search(table, asked)) == plain(docs, items)


def test_repeated_rows_and_null_keys(spark):
    docs = [(1, "a b c"), (1, "a b c"), (1, "a"), (None, "a b"), (2, "b z"), (3, "q r s t u v"), (3, None)]
    items = [(7, "a b"), (7, "a b"), (None, "z"), (8, "A-B_c")]
    got = found(bloom_rank.search(docs_of(spark, docs), spark.createDataFrame(items, "item_id long, text string"), top=3))
    assert got == plain(docs, dict(items).items(), top=3)


def test_nothing(spark):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert bloom_rank.search(docs_of(spark, []), items).count() == 0
    assert bloom_rank.search(docs_of(spark, [(1, None)]), items).count() == 0
    assert bloom_rank.search(docs_of(spark, [(1, "a")]), items.limit(0)).count() == 0


def test_bounds_are_never_too_low_and_mostly_near():
    rng = random.Random(2)
    docs, items = corpus(rng, 200)
    bags = [collections.Counter(bloom_rank.terms(t)) for _, t in docs if words(t)]
    asked = bloom_rank.Asked.of(items)
    df = collections.Counter(asked.vocabulary[t] for b in bags for t in b if t in asked.vocabulary)
    asked = asked.counted(len(bags), sum(b.total() for b in bags), df)
    entries = [(bloom_rank.hashed(b), bloom_rank.levels(np.array(list(b.values())))) for b in bags]
    for size_class in (9, 14):
        slices = np.frombuffer(bloom_rank.sliced_bits(entries, size_class), np.uint8).reshape(bloom_rank.width_of(size_class), -1)
        sizes = np.array([b.total() for b in bags])
        spread = np.array([asked.spread(int(s)) for s in sizes])
        near = []
        for item, bound in bloom_rank.upper_bounds(slices, sizes, spread, list(asked.groups())):
            exact = np.array([asked.score(item, b, b.total()) for b in bags])
            assert (bound >= exact).all()
            near += list(bound[exact > 0] / exact[exact > 0])
        assert np.median(near) < 1.2


def test_levels():
    assert bloom_rank.levels(np.array([1, 2, 3, 4, 5, 8, 9, 65536, 10**6])).tolist() == [0, 1, 2, 2, 3, 3, 4, 16, 16]


def test_query_against_the_plain_scorer(spark, small, documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert found(QUERIES["op13_bloom_ranking"](spark, small)) == plain(docs, items)
