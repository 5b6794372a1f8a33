"""Mixing, language identification, page texts, tokens: brute force, the public library, planted cases, edges."""

import collections
import hashlib
import random
import re
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabloom.llm import bpe, language, mixing, pages, token_counts
from tabloom.llm.queries import QUERIES, VOCABULARY
from tests.llm.conftest import docs_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# mixing

def shared_out(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by dealing again and again what capped sources leave."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, total = {}, share * sum(sizes.values())
    while True:
        left, heavy = total - sum(capped.values()), sum(w for s, w in weight.items() if s not in capped)
        aims = {s: left * weight[s] / heavy for s in order if s not in capped}
        over = {s: most * sizes[s] for s, a in aims.items() if a > most * sizes[s]}
        if not over:
            return {**aims, **capped}
        capped.update(over)


def check_mix(rows, found):
    size = {i: len(WORD.findall(t or "")) for i, t, *_ in rows}
    sizes, source = collections.Counter(), {r[0]: r[3] for r in rows}
    for r in rows:
        sizes[r[3]] += size[r[0]]
    aims, taken, largest = shared_out(sizes), collections.Counter(), collections.Counter()
    assert len(found) == len(rows)
    for r in found:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], sizes[s])
        assert r.target == pytest.approx(aims[s], abs=1e-6)
        assert r.taken in {0, r.size, 2 * r.size}
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in sizes:
        assert abs(taken[s] - aims[s]) <= largest[s] / 2 + 1e-6


def test_mix_comes_near_its_targets(documents):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in documents.collect()]
    check_mix(rows, mixing.mix_report(documents).collect())


def test_mix_with_uneven_sources_and_edges(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(0, 40))), None, rng.choice(["b", "b", "b", "b", "Z", "é", None, "a", "tiny"])) for i in range(900)]
    rows += [(2000, None, None, "b"), (2001, "", None, None), (2002, "\t \n", None, "empty"), (2003, "v " * 30_000, None, "long")]
    docs = docs_of(spark, rows, wide=True)
    first = sorted(map(tuple, mixing.mix_report(docs).collect()))
    check_mix(rows, mixing.mix_report(docs).collect())
    assert first == sorted(map(tuple, mixing.mix_report(docs.repartition(5)).collect()))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    times = collections.Counter(r.doc_id for r in mixed.collect())
    assert all(times[r[0]] * r[1] == r[4] for r in first)


def test_mix_of_nothing_and_of_repeated_rows(spark):
    assert mixing.mix_report(docs_of(spark, [])).count() == 0
    assert mixing.mix(docs_of(spark, [(1, None, None, "a"), (2, " ", None, None)])).count() >= 0
    rows = [(1, "same words here", None, "a")] * 4 + [(None, "null key", None, None)] * 2
    found = mixing.mix_report(docs_of(spark, rows)).collect()
    assert len(found) == 6 and len({(r.doc_id, r.taken) for r in found}) == 2


def test_larger_budgets_contain_smaller_ones(documents):
    def times(share):
        cut = mixing.cuts(mixing.measure(documents), share=share)
        return {r.doc_id: r.times for r in mixing.mixed(documents.select("doc_id", "text", "source"), cut).collect()}

    small, large = times(0.6), times(1.4)
    assert all(small[i] <= large[i] for i in small) and small != large


def test_mix_stays_native(documents):
    assert "Python" not in mixing.mix_report(documents)._jdf.queryExecution().executedPlan().toString()


# languages

def test_held_out_documents_are_identified(spark, small):
    found = {r.doc_id: r for r in QUERIES["op4_language_id"](spark, small).collect()}
    rows = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(found) == len(rows)
    for r in rows:
        assert found[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= found[r.doc_id].score <= 1
    out = [r for r in rows if found[r.doc_id].held_out]
    assert np.mean([found[r.doc_id].lang_pred == r.lang for r in out]) > 0.97


def test_held_out_labels_are_not_learned(spark, documents):
    spoiled = documents.withColumn("lang", F.when(language.held_out("doc_id"), "xx").otherwise(F.col("lang")))
    a = {(r.doc_id, r.lang_pred, r.score) for r in language.identify(documents).collect()}
    assert a == {(r.doc_id, r.lang_pred, r.score) for r in language.identify(spoiled).collect()}


def test_language_edges(spark, documents):
    model = language.fit(documents)
    odd = docs_of(spark, [(1, None), (2, ""), (3, "12 %% !!"), (4, "the and of " * 30_000), (None, "the and of that"), (4, "the and of that"), (5, "字")], wide=True)
    found = language.predict(odd, model)
    assert found.columns == [*[c for c in odd.columns if c != "score"], "lang_pred", "score"]
    got = [(r.doc_id, r.lang_pred, r.score) for r in found.collect()]
    assert [g[1:] for g in got[:3]] == [("und", 0.0)] * 3
    assert got[3][1] == got[4][1] == "en" and got[6][1] in model.languages
    none = language.identify(docs_of(spark, [(1, "text", None), (2, "more", None)]))
    assert [(r.lang_pred, r.score) for r in none.collect()] == [("und", 0.0)] * 2
    assert language.identify(docs_of(spark, [])).count() == 0
    one = language.identify(docs_of(spark, [(i, "text here", "aa") for i in range(9)]))
    assert {r.lang_pred for r in one.collect()} == {"aa"}


def test_copies_are_drawn_once_and_held_back_together(spark):
    """Labels by chance: what is held back cannot be known, unless a copy of it was learned from."""
    rng = random.Random(5)
    made = [("".join(rng.choices("abcdefghijklmnop", k=40)), rng.choice(["aa", "bb"])) for _ in range(60)]
    docs = docs_of(spark, [(20 * i + k, *r) for i, r in enumerate(made) for k in range(20)])
    model = language.fit(docs)
    assert model.temperature > 1 and sum(model.rows.values()) == 1200
    rows = docs.selectExpr("lang AS label", "text")
    got = collections.Counter((r.label, r.text) for r in language.drawn(rows, {"aa": 30, "bb": 30}, 100, 1).collect())
    assert set(got.values()) == {1} and set(got) == {(label, text) for text, label in made}


def test_temperature_and_sparsity():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(4000, 3))
    labels = np.array([rng.choice(3, p=p) for p in language.softmax(logits)])
    assert language.temperature(logits * 4, labels) == pytest.approx(4, rel=0.15)
    rows = []
    for _ in range(600):
        y = int(rng.integers(2))
        rows.append((np.array([y, 2 + int(rng.integers(50))]), np.array([1.0, 0.3]), y))
    weights = language.ftrl(rows, 60, 2, l1=1.0)
    assert weights[0, 0] > weights[0, 1] and weights[1, 1] > weights[1, 0]
    assert (weights[2:60] == 0).mean() > 0.8  # what says nothing gets no weight


# pages

def pages_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "t") for r in rows], "page_id long, url string, html string, key int, host string")


def texts(frame):
    return {r.page_id: r.text for r in pages.extract(frame).collect()}


def test_longest_common_lines():
    rng = random.Random(3)
    for _ in range(800):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(15))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        for cells in (pages.CELLS, 6):
            found = pages.common_lines(a, b, cells)
            rest = iter(b)
            assert len(found) == table[-1][-1] and found == sorted(set(found)) and all(a[i] in rest for i in found)


def test_lines_shared_with_the_nearest_page_go(spark):
    def page(i, body):
        return f"<html><body><div>Site name</div><div>Section {'a' if i < 4 else 'b'}</div>{body}<div>All rights &copy; us</div></body></html>"

    rows = [(i, f"http://h.example/{'a' if i < 4 else 'b'}/{i}.html", page(i, f"<p>Own text\n {i}</p><p>More of {i}</p>")) for i in range(8)]
    assert texts(pages_of(spark, rows)) == {i: f"Own text {i}\nMore of {i}" for i in range(8)}


def test_shared_lines_inside_a_marked_article_go(spark):
    def page(menu, body):
        return f"<nav>{menu}</nav><article><h1>Title {body}</h1><div class='x7'>Read our other papers</div><p>Own text of {body}, a few words long</p></article>"

    rows = [(i, f"http://h.example/{i}", page(f"menu {i}", i)) for i in range(4)]
    rows += [(10 + i, f"http://copies.example/{i}", page(f"menu {i}", "all")) for i in range(2)]  # copies but for the menu
    found = texts(pages_of(spark, rows))
    assert [found[i] for i in range(4)] == [f"Title {i}\nOwn text of {i}, a few words long" for i in range(4)]
    assert found[10] == found[11] == "Title all\nRead our other papers\nOwn text of all, a few words long"


def test_copies_are_compared_with_the_next_page_that_differs(spark):
    def page(body):
        return f"<div>Menu of the site</div>{body}<div>All about us</div>"

    long = "".join(f"<p>Paragraph {i} of a text that stands in several pages of this host</p>" for i in range(9))
    plain = "\n".join(f"Paragraph {i} of a text that stands in several pages of this host" for i in range(9))
    rows = [(i, f"http://same.example/{i}", page(long)) for i in range(5)] + [(5, "http://same.example/z", page("<p>Another</p>"))]
    rows += [(10 + i, f"http://near.example/{i}", page(f"{long}<p>Version {i}</p>")) for i in range(5)] + [(15, "http://near.example/z", page("<p>Another</p>"))]
    rows += [(20 + i, f"http://only.example/{i}", page(f"{long}<p>Version {i}</p>")) for i in range(3)]
    found = texts(pages_of(spark, rows))
    assert all(found[i] == plain for i in range(5)) and found[5] == found[15] == "Another"
    assert all(found[10 + i] == f"{plain}\nVersion {i}" for i in range(5))
    assert all(found[20 + i] == f"Menu of the site\n{plain}\nVersion {i}\nAll about us" for i in range(3))


def test_pages_of_one_host_over_many_ranges(spark):
    rows = [(i, f"http://big.example/x/{i:04d}", f"<div>Menu of all</div><p>Only {i}</p>") for i in range(60)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert texts(pages_of(spark, rows)) == {i: f"Only {i}" for i in range(60)}
        hashed = pages._hashed(pages_of(spark, rows))
        assert pages.neighbours(hashed).count() == 2 * 60 - 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_parts_that_are_not_the_article(spark):
    html = """<!DOCTYPE html><html lang=en><head><title>T</title><style>p{}</style></head><body class="home sidebar-right">
    <header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav><div class="cookie-notice">Accept</div>
    <div id="sidebarLeft">Side</div><!-- no <p>text</p> --><script>var a="<p>x</p>";</script>
    <article class="post"><header><h1>Head&shy;ing &amp; more</h1></header><p>First &eacute;&#233;&#xe9;<b>bold</b>
      line<p>Second <i>one</i><div class="ad-box">Buy</div><ul><li>item 1<li>item 2</ul><form><input><label>Mail</label></form>
      <table><tr><td>cell a</td><td>cell b</td></tr></table>last &lt;tag&gt;
      <section id="comments"><article>Reader says</article></section></article>
    <aside>Aside</aside><footer>Foot</footer></body></html>"""
    want = "Head­ing & more\nFirst éééboldline\nSecond one\nitem 1\nitem 2\ncell a\ncell b\nlast <tag>"
    assert texts(pages_of(spark, [(1, "http://h/1", html)]))[1] == want.replace("boldline", "bold line")


def test_elements_left_open():
    html = "<html><head><title>T</title><meta charset=utf-8><body><ul class=menu><li>m</ul><article><ul><li class=ad>buy<li>kept</ul><p>one<p><b>two<p>three"
    lines = pages.text_lines(html)
    assert pages.main_text(lines, ()) == "kept\none\ntwo\nthree"
    assert [t for t, _ in pages.text_lines("a <script>var x='</p>';b</script>c<!-- d --><p>e &lt; &#102;&nbsp;g &zzz;")] == ["a c", "e < f g &zzz;"]
    inner = "<article><p>keep <span class=ad>buy</span>this<svg><text>no</text></svg> <select><option>x</select>too</p></article>"
    assert pages.main_text(pages.text_lines(inner), ()) == "keep this too"
    table = "<article><table><tr><td>a<td class=ad>b<tr><td>c</table><dl><dt>d<dd>e<dt>f</dl>"
    assert pages.main_text(pages.text_lines(table), ()) == "a\nc\nd\ne\nf"


def test_copies_and_edges_of_pages(spark):
    same = "<article><p>One &amp; two</p></article>"
    bare = "<p>only text</p><p>more</p>"
    rows = [
        (1, "http://h/1", same), (2, "http://h/2", same), (3, None, bare), (4, "no url at all", bare), (5, "http://alone/x", bare),
        (6, "http://h/6", None), (7, None, None), (8, "http://h/8", ""), (None, "http://h/9", same), (1, "http://h/1", same),
        (10, "http://copy/a", bare), (11, "http://copy/b", bare), (12, "http://cut/1", "<article><p>cut &am"), (13, "http://h/z", "<p>" + "word " * 100_000),
        (14, "http://h/nest", "<div>" * 3000 + "deep" + "</div>" * 10),
    ]
    frame = pages_of(spark, rows)
    found = pages.extract(frame)
    assert found.columns == ["page_id", "url", "key", "host", "text", "n_chars"]
    got = collections.defaultdict(list)
    for r in found.collect():
        assert r.n_chars == len(r.text)
        got[r.page_id].append(r.text)
    assert got[1] == ["One & two"] * 2 and got[2] == got[None] == ["One & two"]
    assert got[3] == got[4] == got[5] == got[10] == got[11] == ["only text\nmore"]
    assert got[6] == got[7] == got[8] == [""] and got[12] == ["cut &am"] and len(got[13][0]) == 499_999 and got[14] == ["deep"]
    assert pages.extract(pages_of(spark, [])).count() == 0


def test_articles_of_the_table(spark, small):
    for r in QUERIES["op6_page_differencing"](spark, small).collect():
        assert r.text and "track(" not in r.text and "©" not in r.text


# tokens

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


@pytest.fixture(scope="module")
def tokenizer(spark):
    return bpe.load(spark, public_tokenizers.path(VOCABULARY))


def test_encoding_equals_the_library(tokenizer, library, documents):
    automaton = bpe.Automaton(tokenizer[1].value)
    rng = random.Random(11)
    pieces = ["a", "b", "the", "ing", " ", "  ", "\n", " \n", "\t", "\r\n", "\xa0", "\x1c", "\x85", "᠎", "​", "é", "ß", "İ", "漢字", "🙂", "1", "²",
              "٣", "'s", "'re", "'", "’", "...", "-----", "<|endoftext|>", "<|", "aaaaaaa", "\x00", "́", "ª", "﻿", "        ", "_", "nd", ".", "?!"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(16))) for _ in range(4000)]
    texts += [r.text for r in documents.limit(60).collect()] + ["x" * 20_000, "the" * 9000, " " * 9000, "ab " * 9000]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        got = automaton.encode(text)
        assert array("I", got).tolist() == want, repr(text)
        assert bpe.decode_ids(tokenizer[1].value, got) == library.decode(want, skip_special_tokens=False)


def test_small_automaton_against_merging_by_hand():
    symbols = {b: s for s, b in bpe.byte_symbols().items()}
    rng = random.Random(0)
    for _ in range(60):
        known, merges = [symbols[b] for b in range(256)], []
        parts = ["a", "b", "c"]
        while len(merges) < 12:
            a, b = rng.choice(parts), rng.choice(parts)
            if a + b not in known:
                merges.append([a, b])
                known.append(a + b)
                parts.append(a + b)
        spec = {"model": {"vocab": {t: i for i, t in enumerate(known)}, "merges": merges}, "added_tokens": []}
        automaton = bpe.Automaton(bpe.Tables(spec))
        for _ in range(60):
            word = [rng.choice("abc") for _ in range(rng.randrange(1, 14))]
            want = list(word)
            for a, b in merges:
                at = 0
                while at < len(want) - 1:
                    if want[at] == a and want[at + 1] == b:
                        want[at:at + 2] = [a + b]
                    at += 1
            assert array("I", automaton._word("".join(word))).tolist() == [known.index(t) for t in want]


def test_encode_and_decode_tables(spark, tokenizer, library):
    rows = [(1, "Hello <|endoftext|> world"), (2, None), (3, ""), (None, "é" * 50_000), (1, "Hello"), (5, " lead and trail ")]
    docs = docs_of(spark, rows, wide=True)
    encoded = bpe.encode(docs, tokenizer)
    assert encoded.columns == [*[c for c in docs.columns if c != "n_tokens"], "n_tokens", "ids"]
    back = bpe.decode(encoded, tokenizer).collect()
    for (_, text), r in zip(rows, back):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert (array("I", r.ids).tolist(), r.n_tokens, r.decoded) == (ids, len(ids), text or "")
    assert bpe.encode(docs_of(spark, []), tokenizer).count() == 0


def test_bpe_query_digests(spark, small, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = QUERIES["op7_bpe"](spark, small).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_token_counts_for_every_limit(spark, tokenizer, library, documents):
    odd = docs_of(spark, [(1, None), (2, ""), (None, "a b c"), (4, "w " * 30_000)], wide=True).select(documents.columns)
    docs = documents.unionByName(odd)
    sizes = sorted(len(library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect())
    summed = token_counts.token_counts(docs, tokenizer).cache()
    rows = {r.n_tokens: r for r in summed.collect()}
    assert sorted(rows) == sorted(set(sizes))
    for n, r in rows.items():
        upto = [s for s in sizes if s <= n]
        assert (r.n_docs, r.docs_upto, r.tokens_upto, r.docs_over) == (sizes.count(n), len(upto), sum(upto), len(sizes) - len(upto))
        assert (r.total_docs, r.total_tokens, r.quantile) == (len(sizes), sum(sizes), len(upto) / len(sizes))
        assert r.truncated_total == sum(min(s, n) for s in sizes)
    limits = [0, 1, 7, 100, 511, 512, 4096, 10**9]
    got = {r.context_limit: r.truncated_total for r in token_counts.truncated_totals(summed, limits).collect()}
    assert got == {x: sum(min(s, x) for s in sizes) for x in limits}
    got = {r.share: r.n_tokens for r in token_counts.quantiles(summed, [0.01, 0.5, 0.9, 1.0]).collect()}
    assert got == {q: sizes[max(0, int(np.ceil(len(sizes) * q)) - 1)] for q in (0.01, 0.5, 0.9, 1.0)}


def test_token_counts_of_nothing(spark, tokenizer):
    assert token_counts.token_counts(docs_of(spark, []), tokenizer).count() == 0
