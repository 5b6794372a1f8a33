"""The pipeline: every stage's effect, against the plain rule each stage follows."""

import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import docs_of
from tests.llm.test_dedup import brute_lines, brute_near
from tests.llm.test_texts import check_mix
from tabloom.llm import lines, mixing
from tabloom.llm.common import kept


def test_stages_take_effect_in_turn(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names, held = docs.columns, {r.doc_id: r for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "source_mix", "bpe"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = kept(stage(spark, docs, small), f"test-{name}")
        rows = docs.collect()
        if name != "bpe":
            assert docs.columns == names
        if name == "language_id":
            assert all(re.search(r"[^\W\d_]", r.text) for r in rows)
            assert len(rows) > 0.98 * len(held)
        if name == "line_dedup":
            plain = [(r.doc_id, r.text, r.lang, r.source) for r in before.collect()]
            want = brute_lines(plain, lines.MIN_SITES)
            assert sorted(((r.doc_id, r.text) for r in rows), key=str) == sorted(((i, t) for i, t, _, _ in want), key=str)
        if name == "near_dedup":
            want = brute_near([(r.doc_id, r.text) for r in before.collect()], 5, 80)
            assert sorted(r.doc_id for r in rows) == sorted(i for i, v in want.items() if v[2])
        if name == "source_mix":
            plain = [(r.doc_id, r.text, r.lang, r.source) for r in before.collect()]
            report = mixing.mix_report(before).collect()
            check_mix(plain, report)
            times = {r.doc_id: r.taken // r.size for r in report if r.size}
            counted = {}
            for r in rows:
                counted[r.doc_id] = counted.get(r.doc_id, 0) + 1
            assert counted == {i: n for i, n in times.items() if n}
        if name == "bpe":
            library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
            assert all(r.round_trip and r.n_tokens == len(library.encode(r.text, add_special_tokens=False).ids) for r in rows)


def test_run_equals_the_stages(spark, small):
    found = corpus_pipeline.run(spark, small)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_tokens", "ids", "round_trip"]
    assert found.count() > 0


def test_stages_on_odd_tables(spark):
    rows = [(1, None, "en", "a"), (2, "", "en", None), (None, "some text", None, "b"), (3, "some text", "en", "b"), (3, "some text", "en", "b"), (4, "%% 12", "xx", "c")]
    for made in (rows, []):
        docs = docs_of(spark, made, wide=True)
        for name, stage in corpus_pipeline.STAGES:
            docs = kept(stage(spark, docs, ""), f"odd-{name}")
    assert docs.count() == 0
