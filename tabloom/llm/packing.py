"""Best-fit packing of documents into sequences of bounded length, large documents matched first.

A piece of more than a third of the capacity shares a sequence with at most one other such piece: the largest one left
is matched with the largest that still fits beside it. Smaller pieces, largest first, go where they leave the smallest
gap. Pieces of one length are alike, so all of this is done on the histogram of lengths, whose size is the capacity
whatever the corpus: runs of sequences with the same content are filled together, which gives exactly what packing the
pieces one by one in this order gives. Each piece then finds its place from its number among the pieces of its length.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabloom.llm.bpe import byte_symbols
from tabloom.llm.common import claim, coded, kept, on_executors, sliced, spelt_out

CAPACITY = 4096
#: Encoded words a Python worker keeps, in each of two generations.
MEMO = 300_000
_MADE = ("piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset")


#: Fixed: how this vocabulary splits normalised text into words; white space goes.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Stands for the end of a word; text that holds it, or anything above U+02FF, goes to the library.
_END = "\U0010ffff"


class Ranked:
    """Ids of plain words by ranks: merges in their order are the ranks of what they make, the mark of a word's end is
    merged to its last byte first. Plain words are printable, below U+0300, where lower case and splitting by classes
    of characters need no tables of a certain Unicode version and normalisation changes nothing.
    """

    def __init__(self, model: dict):
        import tiktoken

        symbols, mark, known = byte_symbols(), _END.encode(), model["vocab"]
        label = lambda t: bytes(symbols[c] for c in t.removesuffix("</w>")) + (mark if t.endswith("</w>") else b"")
        singles = [bytes([b]) for b in range(256)]
        order = [*singles, mark[:2], mark[:3], mark, *[b + mark for b in singles]]
        names = {b: c for c, b in symbols.items()}
        self.ids = [known[names[b]] for b in range(256)] + [0, 0, 0] + [known[names[b] + "</w>"] for b in range(256)]
        for merge in model["merges"]:
            made = "".join(merge if isinstance(merge, list) else merge.split(" "))
            order.append(label(made))
            self.ids.append(known[made])
        if len(set(order)) != len(order):
            raise ValueError("a token is made twice")
        self.ids = np.array(self.ids, np.uint32)
        self.lengths = np.array([len(x) for x in order], np.int64)
        self.encoding = tiktoken.Encoding("words", pat_str=f"[^{_END}]+{_END}", mergeable_ranks={x: i for i, x in enumerate(order)}, special_tokens={})
        self.split = regex.compile(SPLIT)

    def encode(self, words: list[str], into: dict[str, bytes]) -> list[str]:
        """Ids of the plain words go into a table; the other words come back."""
        plain, texts, other = [], [], []
        for w in words:
            if not w or len(w) > 300 or max(w) >= "\u0300" or not w.isprintable() or "<|" in w:
                other.append(w)
                continue
            text = w.lower()
            plain.append(w)
            texts.append(text + _END if text.isascii() and text.isalpha() else "".join(x + _END for x in self.split.findall(text)))
        if plain:
            ranks = np.array(self.encoding.encode_ordinary("".join(texts)), np.int64)
            ends = np.cumsum(self.lengths[ranks])
            cuts = np.searchsorted(ends, np.cumsum([len(t.encode()) for t in texts]), "right").tolist()
            ids = self.ids[ranks].tobytes()
            into.update((w, ids[4 * i:4 * j]) for w, i, j in zip(plain, [0, *cuts], cuts))
        return other


class WordIds:
    """Token ids of texts by the ``tokenizers`` library, for vocabularies that drop white space.

    No token and no normalisation reaches across ASCII white space there, so words between white space are encoded on
    their own, each once while it is remembered.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.ranked = Ranked(json.loads(spec)["model"])
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where those of each text begin (and the last end); null encodes like empty text."""
        offsets, codes, words = coded(pc.ascii_split_whitespace(texts.fill_null("")))
        young, old = self.young, self.old
        ask = []
        for w in words:
            if w not in young:
                if w in old:
                    young[w] = old[w]
                else:
                    ask.append(w)
        other = self.ranked.encode(ask, young)
        for w, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            young[w] = array("I", e.ids).tobytes()
        ids, ends = spelt_out([young[w] for w in words], codes)
        if len(young) > MEMO:
            self.young, self.old = {}, young
        return ids, ends[offsets]


_WORKER: dict[str, WordIds] = {}


def _word_ids(name: str, spec) -> WordIds:
    claim("packing", _WORKER.clear)
    if name not in _WORKER:
        _WORKER.clear()
        _WORKER[name] = WordIds(spec.value)
    return _WORKER[name]


def load(spark: SparkSession, path: str):
    """A vocabulary file of the ``tokenizers`` library, read on the driver and broadcast (a few MB)."""
    with open(path, encoding="utf-8") as f:
        return path, spark.sparkContext.broadcast(f.read())


def pieces(docs: DataFrame, tokenizer, capacity: int = CAPACITY, end: int = 1, key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """A row per piece of each document: key, piece, start, length, ids_crc32 (and ids); kept in the shared folder.

    A document is its ids and then the id ``end``. Up to ``capacity`` ids are one piece; only longer ones are cut, into
    pieces of ``capacity`` ids and what is left. Null and empty texts are the id ``end`` alone. ``_part`` and ``_at``
    (the writing task, and the number of the row there) tell equal rows apart.
    """
    if key in _MADE:
        raise ValueError(f"the key cannot be named {key!r}")
    name, spec = tokenizer
    last = np.array([end], np.uint32)
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "piece", "start", "length", "ids_crc32", "_part", "_at", *(["ids"] if keep_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = _word_ids(name, spec), TaskContext.get().partitionId(), 0
        for batch in sliced(batches, 1024):
            rows, found = [], []
            ids, cuts = encoder.encode(batch.column(1))
            for row, (low, high) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                whole = np.concatenate([ids[low:high], last]).tobytes()
                for piece, start in enumerate(range(0, len(whole) // 4, capacity)):
                    own = whole[4 * start:4 * (start + capacity)]
                    rows.append(row)
                    found.append((piece, start, len(own) // 4, zlib.crc32(own), part, at, own))
                    at += 1
            columns = list(zip(*found)) if found else [()] * 7
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            made = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *made[: len(names) - 1]], names)

    schema = f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, _part int, _at bigint" + (", ids binary" if keep_ids else "")
    return kept(on_executors(docs.select(key, text), run, schema), "pieces")


@dataclass
class Run:
    """Sequences ``first``, ``first + 1``, ... of the same content, each with ``gap`` places free at its end."""

    first: int
    count: int
    gap: int


class Plan:
    """Where the pieces of each length go: ``entries`` of (length, rank, first sequence, pieces a sequence, offset).

    The entry holds for pieces of this length from this rank on, up to the next entry's: ``pieces a sequence`` of them
    go one after the other into each sequence, from ``offset`` on.
    """

    def __init__(self, counts: Mapping[int, int], capacity: int = CAPACITY):
        self.capacity, self.sequences = capacity, 0
        self.entries: list[tuple[int, int, int, int, int]] = []
        self.ranks = dict.fromkeys(counts, 0)
        self.left = {s: n for s, n in counts.items() if n}
        if self.left and not 0 < min(self.left) <= max(self.left) <= capacity:
            raise ValueError(f"lengths must lie between 1 and {capacity}")
        self.gaps: list[int] = []
        self.runs: dict[int, list[Run]] = {}
        self._match(sorted(s for s in self.left if 3 * s > capacity))
        for s in sorted((s for s in self.left if 3 * s <= capacity), reverse=True):
            self._fill(s, self.left[s])

    def _new(self, count: int) -> Run:
        run = Run(self.sequences, count, self.capacity)
        self.sequences += count
        return run

    def _put(self, size: int, run: Run, each: int) -> None:
        """``each`` pieces of a length into every sequence of a run."""
        self.entries.append((size, self.ranks[size], run.first, each, self.capacity - run.gap))
        self.ranks[size] += each * run.count
        run.gap -= each * size

    def _free(self, run: Run) -> None:
        if run.gap and run.count:
            if run.gap not in self.runs:
                insort(self.gaps, run.gap)
            self.runs.setdefault(run.gap, []).append(run)

    def _match(self, large: list[int]) -> None:
        left = {s: self.left[s] for s in large}
        while large:
            size = large[-1]
            beside = bisect_left(large, self.capacity - size + 1) - 1  # the largest that fits
            other = large[beside] if beside >= 0 else None
            if other is None:
                pairs = left[size]
            else:
                pairs = left[size] // 2 if other == size else min(left[size], left[other])
            run = self._new(max(pairs, 1))  # the odd one of a length that fits twice is matched further down, or stays alone
            if other is not None and pairs == 0:
                other = large[beside - 1] if beside > 0 else None
            self._put(size, run, 1)
            left[size] -= run.count
            if other is not None:
                self._put(other, run, 1)
                left[other] -= run.count
            self._free(run)
            for s in {size, other} - {None}:
                if left[s] == 0:
                    large.remove(s)

    def _fill(self, size: int, count: int) -> None:
        while count:
            at = bisect_left(self.gaps, size)
            if at == len(self.gaps):
                run = self._new(-(-count // (self.capacity // size)))
            else:
                gap = self.gaps[at]
                run = self.runs[gap].pop()
                if not self.runs[gap]:
                    del self.runs[gap], self.gaps[at]
            each = run.gap // size
            full = min(run.count, count // each)
            rest = Run(run.first + full, run.count - full, run.gap)
            if full:
                count -= full * each
                run.count = full
                self._put(size, run, each)
                self._free(run)
            if count and rest.count:  # fewer pieces than the next sequence has room for
                some = Run(rest.first, 1, rest.gap)
                self._put(size, some, count)
                self._free(some)
                count, rest = 0, Run(rest.first + 1, rest.count - 1, rest.gap)
            self._free(rest)

    def places(self) -> dict[str, np.ndarray]:
        """The entries by length and rank, as arrays."""
        table = np.array(sorted(self.entries), np.int64).reshape(-1, 5)
        return dict(zip(("length", "rank", "sequence", "each", "offset"), table.T))


def _ranked(cut: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """``_rank`` of each piece among those of its length (from 0), and how many there are of each length.

    A length may hold any share of the rows: its pieces are dealt into buckets, numbered there, and the sizes of the
    buckets before, one row each, are added.
    """
    buckets = min(1 << 16, max(int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")), cut.count() // 1_000_000 + 1))
    dealt = cut.withColumn("_bucket", F.pmod(F.xxhash64("_part", "_at"), F.lit(buckets)).cast("int"))
    sizes = kept(dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n")), "length-buckets")
    counts = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy("_part", "_at")
    numbered = dealt.withColumn("_inside", F.row_number().over(inside)).join(offsets, ["length", "_bucket"])
    return numbered.withColumn("_rank", F.col("_before") + F.col("_inside") - 1).drop("_before", "_inside", "_bucket"), counts


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id (from 0, all used) and offset: the place in the sequence, without gaps from 0.

    Every sequence holds at most ``capacity`` ids. No pieces make no sequences. Repeated rows are pieces of their own.
    The driver gets one count a length; the plan it sends out depends on the capacity alone, not on the corpus.
    """
    ranked, counts = _ranked(cut)
    table = cut.sparkSession.sparkContext.broadcast(Plan(counts, capacity).places())
    names = [c for c in cut.columns if c not in ("_part", "_at")]
    fields = [f"`{c}` {cut.schema[c].dataType.simpleString()}" for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = table.value
        keys = p["length"] * (1 << 48) + p["rank"]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            at = np.searchsorted(keys, length * (1 << 48) + rank, "right") - 1
            nth = rank - p["rank"][at]
            sequence = p["sequence"][at] + nth // p["each"][at]
            offset = p["offset"][at] + nth % p["each"][at] * length
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return on_executors(ranked.select(*names, "_rank"), run, ", ".join([*fields, "sequence_id bigint", "offset bigint"]))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_pieces, ids): the packed ids themselves, from pieces that kept their ids."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: F.hex(x["ids"]))
    return packed.groupBy("sequence_id").agg(F.count("*").alias("n_pieces"), F.unhex(F.concat_ws("", parts)).alias("ids"))
