"""Substring deduplication by sliding sentence spans.

A text is cut into sentences. From every sentence the shortest run of sentences with ``WORDS`` words goes forwards, and
from every sentence one goes backwards; with both, a repeated passage is covered from its first sentence to its last
even if neither end falls on a run of the other kind. Runs are hashed and joined globally: a run that also stands in a
document with a smaller doc_id, or earlier in the same document, is a repeat, and its sentences are removed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import kept, on_executors, schema_with, sliced

WORDS = 50
#: Characters of texts that are cut and hashed at a time; a longer text is taken alone.
AT_ONCE = 1 << 18
#: What decides where a sentence ends: white space, its lines, . ! ? and what may close behind them, and what stands
#: before and after white space in front of a capital.
SPACE, LINE, STOP, CLOSE, LOW, CAPITAL = 1, 2, 4, 8, 16, 32
_CLASSES = {SPACE: r"\s+", LINE: r"\n+", STOP: r"[.!?…]+", CLOSE: r"""["'”’)\]]+""", LOW: r"[\p{Ll}\p{N},;:]+", CAPITAL: r"\p{Lu}+"}


@cache
def _kinds() -> np.ndarray:
    """The classes of every character."""
    every = np.arange(0x110000, dtype=np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
    kinds = np.zeros(len(every), np.uint8)
    for kind, pattern in _CLASSES.items():
        for m in regex.finditer(pattern, every):
            kinds[m.start():m.end()] |= kind
    return kinds


def cut(texts: Sequence[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one, where each sentence begins and ends in it, and the first sentence of each text (and the number of all).

    A sentence ends after . ! ? or with its line, and before a capital that follows no capital: a passage that was
    pasted into a sentence begins there. The white space behind it is between the sentences.
    """
    whole = "\0".join(["", *texts, ""])  # a character of no class before, between and behind the texts
    slices = (whole[at:at + AT_ONCE].encode("utf-32-le", "surrogatepass") for at in range(0, len(whole), AT_ONCE))
    kinds = np.concatenate([_kinds()[np.frombuffer(x, np.uint32)] for x in slices])
    space = (kinds & SPACE).view(bool)
    change = np.flatnonzero(space[1:] != space[:-1]) + 1
    begin, end = change[0::2], change[1::2]  # of each run of white space
    before, ends = kinds[begin - 1], np.zeros(len(begin), bool)
    ends |= (before & STOP) > 0
    ends |= ((before & CLOSE) > 0) & ((kinds[begin - 2] & STOP) > 0)
    ends |= ((before & LOW) > 0) & ((kinds[end] & CAPITAL) > 0)
    ends[np.searchsorted(begin, np.flatnonzero(kinds & LINE), "right") - 1] = True
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    last = np.cumsum(sizes + 1)
    starts = np.sort(np.concatenate([last - sizes, end[ends]]))
    return whole, starts, np.sort(np.concatenate([begin[ends], last])), np.append(np.searchsorted(starts, last - sizes), len(starts))


def sentences(text: str) -> tuple[list[str], list[str]]:
    """Sentences, and what stands behind each: joined in turn they are the text."""
    whole, starts, ends, _ = cut([text])
    return [whole[a:b] for a, b in zip(starts, ends)], [*(whole[a:b] for a, b in zip(ends, starts[1:])), ""]


def runs(texts: Sequence[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first, last, hash) of the shortest runs with at least ``words`` words, forwards and backwards, by first sentence.

    ``text`` is the number of the text, sentences are counted in it. Hashes are of 96 bits, as pairs; case and white
    space do not count.
    """
    whole, starts, ends, firsts = cut(texts)
    counts, digests = np.zeros(len(starts), np.int64), []
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        if split := whole[a:b].lower().split():
            counts[i] = len(split)
            digests.append(xxhash.xxh3_64_intdigest(" ".join(split).encode("utf-8", "surrogatepass")))
    some = np.flatnonzero(counts)  # sentences without words begin and end no run
    length, place = np.cumsum(np.append(0, counts[some])), np.searchsorted(some, firsts)
    text = np.searchsorted(firsts, some, "right") - 1
    last = np.searchsorted(length, length[:-1] + words) - 1
    first = np.searchsorted(length, length[1:] - words, "right") - 1
    forward, backward = np.flatnonzero(last < place[text + 1]), np.flatnonzero(first >= place[text])
    n = len(some) + 1
    first, last = np.divmod(np.unique(np.concatenate([forward * n + last[forward], first[backward] * n + backward])), n)
    hashed = memoryview(np.array(digests, np.uint64).tobytes())
    found = [xxhash.xxh3_128_digest(hashed[a:b]) for a, b in zip((8 * first).tolist(), (8 * last + 8).tolist())]
    pairs = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2).copy()
    pairs[:, 1] >>= 32
    text = text[first]
    return text, some[first] - firsts[text], some[last] - firsts[text], pairs


def _parts(texts: Sequence[str]) -> Iterator[tuple[int, int]]:
    """From where to where texts are taken together."""
    begin = size = 0
    for at, text in enumerate(texts):
        if size and size + len(text) > AT_ONCE:
            yield begin, at
            begin, size = at, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def run_table(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(h1, h2, doc_id, again): each different run of each row, and whether the row has it more than once; kept in the
    shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids, texts = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("text").to_pylist()
            for a, b in _parts(texts):
                text, _, _, h = runs(texts[a:b], words)
                order = np.lexsort((h[:, 1], h[:, 0], text))
                text, h = text[order], h[order]
                same = (text[1:] == text[:-1]) & (h[1:] == h[:-1]).all(1)
                new = np.flatnonzero(np.append(True, ~same)[:len(text)])
                again = np.diff(np.append(new, len(text))) > 1
                columns = [pa.array(h[new, 0]), pa.array(h[new, 1].astype(np.int32)), pa.array(ids[a:b][text[new]]), pa.array(again)]
                yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "doc_id", "again"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    return kept(on_executors(rows, run, "h1 bigint, h2 int, doc_id bigint, again boolean"), "runs")


def repeats(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, h1): the runs of each document that a document with a smaller doc_id has too; h1 is null for those that
    a document has more than once itself."""
    found = run_table(docs, words)
    first = found.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("_last"))
    first = kept(first.where("first_doc < _last").drop("_last"), "repeated-runs")
    others = found.join(first, ["h1", "h2"]).where("doc_id > first_doc").select("doc_id", "h1")
    return others.unionByName(found.where("again").select("doc_id", F.lit(None).cast("bigint").alias("h1")))


def remove_repeats(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` with ``text`` without repeated passages, and ``n_sentences``, ``n_removed``.

    The document with the smallest doc_id keeps a passage, and in it the first place. Rows with the same doc_id count as
    one document and keep what they share. A null doc_id is compared with nothing but itself. Null text stays null with
    no sentences. Texts of fewer than ``words`` words have no runs and stay as they are. Whole texts are read; only the
    documents with a repeat, and those without doc_id, are hashed a second time.
    """
    drop = repeats(docs, words).groupBy("doc_id").agg(F.collect_set("h1").alias("_repeats")).withColumnRenamed("doc_id", "_doc")
    base, key = docs.drop("n_sentences", "n_removed"), F.col("doc_id").cast("bigint")
    joined = base.join(drop, key == F.col("_doc"), "left").drop("_doc")
    joined = joined.withColumn("_repeats", F.when(key.isNull(), F.array().cast("array<bigint>")).otherwise(F.col("_repeats")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts, repeated = batch.column("text").to_pylist(), batch.column("_repeats")
            counts = np.zeros((2, len(texts)), np.int64)
            told = [i for i, t in enumerate(texts) if t is not None]
            for a, b in _parts([texts[i] for i in told]):
                counts[0, told[a:b]] = np.diff(cut([texts[i] for i in told[a:b]])[3])
            todo = [i for i in told if repeated[i].is_valid]
            for a, b in _parts([texts[i] for i in todo]):
                part = todo[a:b]
                cleaned = _clean([texts[i] for i in part], [repeated[i].as_py() for i in part], words)
                for i, (left, removed) in zip(part, cleaned):
                    texts[i], counts[1, i] = left, removed
            names = [n for n in batch.schema.names if n != "_repeats"]
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, counts)], [*names, "n_sentences", "n_removed"])

    return on_executors(joined, run, schema_with(joined, ["_repeats"], "n_sentences bigint, n_removed bigint"))


def _clean(texts: Sequence[str], repeated: Sequence[Sequence[int]], words: int) -> Iterator[tuple[str, int]]:
    """What is left of each text, and the number of sentences removed."""
    text, first, last, hashes = runs(texts, words)
    border = np.searchsorted(text, np.arange(len(texts) + 1))
    for t, whole, own in zip(texts, zip(border[:-1], border[1:]), map(set, repeated)):
        at = slice(*whole)
        found, behind = sentences(t)
        gone = np.zeros(len(found) + 1, np.int64)
        seen: set[int] = set()
        for a, b, h in zip(first[at].tolist(), last[at].tolist(), hashes[at, 0].tolist()):
            if h in own or h in seen:
                gone[a] += 1
                gone[b + 1] -= 1
            seen.add(h)
        covered = np.cumsum(gone[:-1]) > 0
        if not covered.any():
            yield t, 0
            continue
        left = "".join(s + e for s, e, c in zip(found, behind, covered) if not c)
        yield left.rstrip(), int(covered.sum())
