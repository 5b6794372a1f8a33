"""Near-duplicates, components, spans and lines against brute force, and their edge cases."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from tabloom.llm import components as components_module
from tabloom.llm import lines, near_dup, spans
from tabloom.llm.common import kept
from tabloom.llm.components import components
from tests.llm.conftest import docs_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def roots_of(nodes, links):
    root = {i: i for i in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        p, q = find(a), find(b)
        if p != q:
            root[max(p, q)] = min(p, q)
    return {i: find(i) for i in nodes}


def brute_near(rows, width, percent):
    sets = {}
    for i, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()
    links, post = [], collections.defaultdict(list)
    for i in sorted(sets):
        shared = collections.Counter(j for s in sets[i] for j in post[s])
        links += [(i, j) for j, n in shared.items() if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n)]
        for s in sets[i]:
            post[s].append(i)
    root = roots_of(sets, links)
    return {i: (len(sets[i]), root[i], root[i] == i) for i in sets}


def near(docs, width, percent):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs, width, percent).collect()}


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(documents, width, percent):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert near(documents, width, percent) == brute_near(rows, width, percent)


def test_large_family_of_near_copies_in_blocks(spark, monkeypatch):
    """More members than a block: edits of one text, most of them linked only through others."""
    rng = random.Random(7)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(420):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.choice([0, 1, 2, 3, 5, 8, 12])):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    assert near(docs_of(spark, rows), 3, 85) == brute_near(rows, 3, 85)


def test_near_duplicate_edges(spark):
    long = " ".join(f"word{i}" for i in range(40_000))
    rows = [
        (5, "A b C d"), (3, "a B c D"), (9, "é É"), (10, "é É"), (11, "É é"), (12, None), (13, ""), (14, " \t\n"), (15, ""),
        (None, "a b c d"), (None, None), (20, long), (21, long + " end"), (22, "one"), (23, "ONE"), (24, "one two"), (3, "a B c D"),
    ]
    found = near_dup.near_duplicates(docs_of(spark, rows, wide=True), 3, 85).collect()
    assert len(found) == len(rows)
    got = {r.doc_id: (r.component_id, r.kept) for r in found if r.doc_id is not None}
    assert got == {
        5: (3, False), 3: (3, True), 9: (9, True), 10: (9, False), 11: (11, True), 12: (12, True), 13: (13, True), 14: (14, True),
        15: (15, True), 20: (20, True), 21: (20, False), 22: (22, True), 23: (22, False), 24: (24, True),
    }
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, True)] * 2
    left = near_dup.deduplicate(docs_of(spark, rows, wide=True), 3, 85)
    assert left.columns == docs_of(spark, [], wide=True).columns
    ids = sorted((r.doc_id for r in left.collect()), key=lambda x: (x is None, x))
    assert ids == [3, 9, 11, 12, 13, 14, 15, 20, 22, 24, None, None]
    assert near_dup.near_duplicates(docs_of(spark, []), 3, 85).count() == 0


def test_index_meets_every_pair_within_the_distance():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 16, (300, near_dup.VALUES)).astype(np.uint16)
    b = a.copy()
    for row in b:
        at = rng.choice(near_dup.VALUES, near_dup.DISTANCE, replace=False)
        row[at] ^= 1
    assert (near_dup.index_keys(a) == near_dup.index_keys(b)).any(axis=1).all()


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    order = list(range(300))
    rng.shuffle(order)
    links = list(zip(order, order[1:])) + [(1000, x) for x in range(1001, 1200)] + [(5000, 5000), (6000, 6001), (6001, 6000)]
    table = spark.createDataFrame([*links, (None, 3), (7, None)], "a long, b long")
    got = {r.node: r.component for r in components(table).collect()}
    assert got == roots_of({x for link in links for x in link}, links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_small_tables_of_links_cost_few_files_and_no_round_to_confirm(spark, monkeypatch):
    files = []

    def counted(df, name, *rows):
        out = kept(df, name, *rows)
        files.append((name, len(out.inputFiles())))
        return out

    monkeypatch.setattr(components_module, "kept", counted)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        star = spark.createDataFrame([(1, x) for x in range(2, 2000)], "a long, b long")
        assert {r.component for r in components(star).collect()} == {1}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [name for name, _ in files].count("small-star") == 1
    assert max(n for _, n in files) <= 2 * spark.sparkContext.defaultParallelism < 97


def brute_spans(rows, words):
    seen, out = {}, {}
    for i, text in sorted(rows):
        found, behind = spans.sentences(text)
        assert "".join(a + b for a, b in zip(found, behind)) == text
        split = [s.lower().split() for s in found]
        ends = set()
        for a in range(len(found)):
            if split[a]:
                for step, at in ((1, range(a, len(found))), (-1, range(a, -1, -1))):
                    total = 0
                    for e in at:
                        total += len(split[e])
                        if total >= words:
                            ends.add((min(a, e), max(a, e)))
                            break
        gone, own = [False] * len(found), set()
        for a, e in sorted(ends):
            run = tuple(map(tuple, filter(None, split[a:e + 1])))
            if run in own or seen.get(run, i) != i:
                gone[a:e + 1] = [True] * (e + 1 - a)
            own.add(run)
        for run in own:
            seen.setdefault(run, i)
        left = "".join(a + b for a, b, g in zip(found, behind, gone) if not g).rstrip() if any(gone) else text
        out[i] = (left, len(found), sum(gone))
    return out


def test_spans_equal_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.text, r.n_sentences, r.n_removed) for r in spans.remove_repeats(documents).collect()}
    assert got == brute_spans(rows, spans.WORDS)
    assert sum(v[2] for v in got.values()) > 0


def sentence(rng, n):
    return " ".join([f"Q{rng.randrange(10**6)}", *[f"w{rng.randrange(10**6)}" for _ in range(n - 1)]]) + "."


def test_planted_passages_go_everywhere_but_in_the_first_document(spark):
    rng = random.Random(5)
    passage = " ".join(sentence(rng, n) for n in (24, 20, 3, 7))
    short = sentence(rng, 30)
    rows = []
    for i in range(30):
        before, after = sentence(rng, 60), sentence(rng, 60)
        middle = passage if i % 3 == 0 else short
        rows.append((i, f"{before[:-1]} {middle} {after}" if i % 2 else f"{before}\n{middle}\n{after}"))
    got = {r.doc_id: r.text for r in spans.remove_repeats(docs_of(spark, rows)).collect()}
    for i, text in rows:
        assert (passage in got[i]) == (i == 0) or i % 3
        if i % 3:
            assert got[i] == text  # fewer than the words of a span: left alone
        assert got[i].startswith(text[:60]) and got[i].endswith(text[-60:])


def test_span_edges(spark):
    rng = random.Random(2)
    body = " ".join(sentence(rng, 20) for _ in range(4))
    rows = [(1, body), (1, body), (2, body), (None, body), (None, None), (3, None), (4, ""), (5, "x " * 60), (6, body + " " + body), (7, "y" * 200_000)]
    found = spans.remove_repeats(docs_of(spark, rows, wide=True))
    assert found.columns == [*docs_of(spark, [], wide=True).columns, "n_sentences", "n_removed"]
    got = collections.defaultdict(list)
    for r in found.collect():
        got[r.doc_id].append((r.text, r.n_removed))
    assert got[1] == [(body, 0)] * 2 and got[2] == [("", 4)] and got[6] == [("", 8)]
    assert sorted(got[None], key=str) == sorted([(body, 0), (None, 0)], key=str)
    assert got[3] == [(None, 0)] and got[4] == [("", 0)] and got[5] == [("x " * 60, 0)] and got[7][0][1] == 0
    assert spans.remove_repeats(docs_of(spark, [])).count() == 0


ENDS = regex.compile(r"""((?<=[.!?…]["'”’)\]]?)\s+|\s*\n\s*|(?<=[\p{Ll}\p{N},;:])\s+(?=\p{Lu}))""")


def test_sentences_of_many_texts_at_once_equal_the_pattern():
    rng = random.Random(3)
    letters = [*" \t\n\r\x0b\x1c\x85\xa0\u2028\u3000.!?…\"'”’)],;:-\0", *"aßéςbΣİAÄЖж1٣Ⅷ漢ǅ😀", " ", " ", ". ", "\ud800"]
    for _ in range(3000):
        texts = ["".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 3, 9, 40]))) for _ in range(rng.randrange(4))]
        parts = [ENDS.split(t) for t in texts]
        whole, starts, ends, firsts = spans.cut(texts)
        got = [whole[a:b] for a, b in zip(starts, ends)]
        assert [got[a:b] for a, b in zip(firsts, firsts[1:])] == [p[0::2] for p in parts]
        assert [spans.sentences(t) for t in texts] == [(p[0::2], [*p[1::2], ""]) for p in parts]
        one_by_one = [list(zip(*map(np.ndarray.tolist, spans.runs([t], 3)[1:]))) for t in texts]
        number, *found = map(np.ndarray.tolist, spans.runs(texts, 3))
        assert [(t, *r) for t, own in enumerate(one_by_one) for r in own] == list(zip(number, *found))


def test_only_texts_with_a_repeat_are_hashed_again(spark, monkeypatch):
    rng = random.Random(9)
    a, b, c, d, e = (" ".join(sentence(rng, 20) for _ in range(3)) for _ in range(5))
    rows = [(1, a), (2, f"{b} {b}"), (3, c), (3, f"{c} {c}"), (4, f"{d} {a}"), (None, f"{e} {e}"), (5, d[:40])]
    passed = []
    with monkeypatch.context() as m:
        m.setattr(spans, "on_executors", lambda df, run, schema, of=spans.on_executors: passed.append((df, run)) or of(df, run, schema))
        found = spans.remove_repeats(docs_of(spark, rows))
    want = [(1, a, 3, 0), (2, b, 6, 3), (3, c, 3, 0), (3, c, 6, 3), (4, d, 6, 3), (None, e, 6, 3), (5, d[:40], 1, 0)]
    key = lambda r: (str(r[0]), r[2])
    assert sorted(((r.doc_id, r.text, r.n_sentences, r.n_removed) for r in found.collect()), key=key) == sorted(want, key=key)
    table, clean = passed[-1]
    hashed = []
    monkeypatch.setattr(spans, "runs", lambda texts, *rest, of=spans.runs: hashed.extend(texts) or of(texts, *rest))
    out = [r for x in clean(iter(pa.table(table.toArrow()).to_batches())) for r in zip(*map(pa.Array.to_pylist, (x["doc_id"], x["text"], x["n_sentences"], x["n_removed"])))]
    assert sorted(out, key=key) == sorted(want, key=key)
    assert sorted(hashed) == sorted(t for i, t in rows if i not in (1, 5))


def brute_lines(rows, sites):
    spread = collections.defaultdict(set)
    for _, text, _, source in rows:
        for line in (text or "").split("\n"):
            spread[line.strip(lines.BLANKS)].add(source)
    common = {k for k, v in spread.items() if k and len(v - {None}) >= sites}
    out = []
    for i, text, _, _ in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        left = [x for x in text.split("\n") if x.strip(lines.BLANKS) not in common]
        n, new = len(text.split("\n")), "\n".join(left)
        whole = len(left) == n or not new.strip(lines.BLANKS + "\n")
        out.append((i, text if whole else new, n, 0 if whole else n - len(left)))
    return sorted(out, key=str)


def cleaned(docs, **settings):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in lines.clean_lines(docs, **settings).collect()), key=str)


@pytest.mark.parametrize("sites", [2, 5, 14])
def test_lines_equal_brute_force(documents, sites):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in documents.collect()]
    assert cleaned(documents, min_sites=sites) == brute_lines(rows, sites)


def test_many_sites_around_the_threshold_are_exact(spark):
    """Sketches of hundreds of sites err; the lines near the threshold must not."""
    rows = []
    for spread in range(180, 221):
        rows += [(len(rows) + s, f"own text number {spread} {s} which is long enough to stay\nline of {spread}", None, f"site{s}") for s in range(spread)]
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    assert cleaned(docs_of(spark, rows), min_sites=200) == brute_lines(rows, 200)
    found = lines.spread(lines.line_table(docs_of(spark, rows)), 200)
    assert found.where("exact").count() > 0


def test_line_edges(spark):
    rows = [(i, f"keep this line of document {i}\n  buy now\t\n\nend {i}", None, f"s{i}") for i in range(6)]
    rows += [(6, None, None, "s1"), (7, "", None, "s2"), (8, "buy now", None, None), (9, "solo\nbuy now\nbuy now\nmore of the text here", None, "s3")]
    rows += [rows[0], (None, "null key\nbuy now and more", None, None), (11, "z" * 300_000 + "\nbuy now", None, "s0")]
    rows += [(20, "buy now\nbuy now\n" * 50 + "own", None, "s9"), (21, " \nbuy now\n\t", None, "s9")]
    docs = docs_of(spark, rows, wide=True).withColumnRenamed("size", "_drop").withColumnRenamed("at", "n_removed").withColumnRenamed("_row", "row")
    assert cleaned(docs) == brute_lines(rows, lines.MIN_SITES)
    assert lines.clean_lines(docs).columns == [*[c for c in docs.columns if c != "n_removed"], "n_lines", "n_removed"]
    assert lines.clean_lines(docs_of(spark, [])).count() == 0
    assert "Python" not in lines.clean_lines(docs)._jdf.queryExecution().executedPlan().toString()


def test_copies_keep_their_lines(spark):
    text = "first line of a text\nsecond line of it\nthird"
    rows = [(i, text, None, f"s{i}") for i in range(9)]
    assert lines.clean_lines(docs_of(spark, rows)).where(F.col("text") == text).count() == 9
