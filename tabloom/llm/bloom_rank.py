"""Ranked lexical search with bit-sliced Bloom signatures.

Index. Documents are dealt into blocks of similar numbers of distinct terms. A block holds one Bloom signature per
document, sliced by bit: row ``b`` is the bitmap of the documents whose signature has bit ``b``. A term sets ``HASHES``
bits, and so does each further level of its count in the document (at least 2, 3, 5, 9, ... occurrences), so a bitmap
never misses a document but may hold too many.

Search. The rows of a query term, and-ed, are the documents that may hold it, and how often at most; the term's weight
times its largest part of the score, added up over the terms of an item, is an upper bound of the score of every
document of the block. The documents with the highest bounds are scored first; the score of the last of an item's best
is then a threshold, and every document whose bound reaches it is scored exactly. Nothing else can be among the best.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import kept, on_executors, sliced

TOP = 10
HASHES = 6
BITS = 12  # at least, for each entry of a signature
LEVELS = 16
BLOCK = 1024
BLOCK_BITS = 1 << 23
#: Characters of items searched for at once; more items are searched in several rounds over the same index.
ROUND_CHARS = 4_000_000
#: Terms looked up together in a block.
TERMS = 4096
#: Documents to score that are sent to all executors; more are joined by a shuffle.
FEW = 100_000

#: Terms are made of digits, lower-cased letters A-Z and everything outside ASCII; the rest separates them.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

SQL = r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
    whole AS (SELECT count(*) AS big_n, sum(len(terms))::BIGINT AS big_l FROM d WHERE len(terms) > 0),
    tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
    weight AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, whole GROUP BY term, big_n),
    ask AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    scored AS (SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))))::BIGINT AS score
               FROM ask JOIN tf USING (term) JOIN weight USING (term), whole GROUP BY ALL)
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= 10"""


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def hashed(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def levels(counts: np.ndarray) -> np.ndarray:
    """The level of each count: 0 for 1, 1 for 2, 2 for 3 and 4, 3 for 5 to 8, ... A level of j means at most 2^j."""
    return np.minimum(np.ceil(np.log2(counts)).astype(np.int64), LEVELS)


def bits(hashes: np.ndarray, level, width: int) -> np.ndarray:
    """(entries, HASHES) rows of the slices: two halves of a mixed hash, stepped."""
    x = hashes + np.uint64(0x9E3779B97F4A7C15) * np.asarray(level, np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    first, step = x >> np.uint64(33), (x & np.uint64(0x7FFFFFFF)) | np.uint64(1)
    return ((first[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(width)).astype(np.int64)


def width_of(size_class: int) -> int:
    return BITS << size_class


def block_of(size_class: int) -> int:
    """Documents in a block: fewer of large ones, so that a block stays within ``BLOCK_BITS``."""
    return max(8, min(BLOCK, BLOCK_BITS // width_of(size_class) // 8 * 8))


def sliced_bits(entries: Sequence[tuple[np.ndarray, np.ndarray]], size_class: int) -> bytes:
    """The slices of a block from (hashes, levels) of its documents: every entry also stands at all lower levels."""
    width = width_of(size_class)
    table = np.zeros((width, -(-len(entries) // 8) * 8), bool)
    for doc, (hashes, level) in enumerate(entries):
        at = 0
        while len(hashes):
            table[bits(hashes, at, width), doc] = True
            at += 1
            more = level >= at
            hashes, level = hashes[more], level[more]
    return np.packbits(table, axis=1).tobytes()


@dataclass
class Asked:
    """Items and their terms: what is broadcast. ``weights`` follow once the corpus has been counted."""

    ids: list
    item_terms: list[list[bytes]]
    vocabulary: dict[bytes, int]
    weights: np.ndarray | None = None
    n: int = 0
    total: int = 0
    thresholds: np.ndarray | None = None

    @staticmethod
    def of(rows) -> "Asked":
        ids, item_terms = [r[0] for r in rows], [sorted(set(terms(r[1]))) for r in rows]
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*item_terms)))}
        return Asked(ids, item_terms, vocabulary)

    def counted(self, n: int, total: int, df: Mapping[int, int]) -> "Asked":
        weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(self.vocabulary))]
        return Asked(self.ids, self.item_terms, self.vocabulary, np.array(weights, np.int64), n, total)

    def spread(self, size: int) -> int:
        """What a document's length adds below the line of its score."""
        return 10 + 90 * size * self.n // self.total

    def score(self, item: int, counts: Mapping[bytes, int], size: int) -> int:
        m, found = self.spread(size), 0
        for t in self.item_terms[item]:
            tf = counts.get(t)
            if tf:
                found += int(self.weights[self.vocabulary[t]]) * (1_000_000_000 * tf // (1000 * tf + 8 * m))
        return found

    def groups(self) -> Iterator[tuple[list[int], list[np.ndarray], np.ndarray, np.ndarray]]:
        """Items by groups with at most ``TERMS`` terms (or one item): items, places of their terms, hashes, weights."""
        held: list[int] = []
        known: dict[bytes, int] = {}
        for item, own in [*enumerate(self.item_terms), (-1, None)]:
            if held and (own is None or len(known.keys() | set(own)) > TERMS):
                weights = np.array([self.weights[self.vocabulary[t]] for t in known], np.int64)
                yield held, [np.array([known[t] for t in self.item_terms[i]], np.int64) for i in held], hashed(list(known)), weights
                held, known = [], {}
            if own:
                held.append(item)
                for t in own:
                    known.setdefault(t, len(known))


def upper_bounds(slices: np.ndarray, sizes: np.ndarray, spread: np.ndarray, groups) -> Iterator[tuple[int, np.ndarray]]:
    """(item, bound of every document) for a block of ``len(sizes)`` documents."""
    width, docs = len(slices), len(sizes)
    for items, places, hashes, weights in groups:
        own = np.bitwise_and.reduce(slices[bits(hashes, 0, width)], axis=1)
        level = np.zeros((len(hashes), docs), np.int64)
        alive = np.arange(len(hashes))
        held = own
        for at in range(1, LEVELS + 1):
            some = held.any(axis=1)
            alive, held = alive[some], held[some]
            if not len(alive):
                break
            held = held & np.bitwise_and.reduce(slices[bits(hashes[alive], at, width)], axis=1)
            level[alive] += np.unpackbits(held, axis=1, count=docs)
        term, doc = np.nonzero(np.unpackbits(own, axis=1, count=docs))
        reached = level[term, doc]
        most = np.where(reached < LEVELS, np.minimum(1 << reached, sizes[doc]), sizes[doc])
        parts = np.zeros((len(hashes), docs), np.int64)
        parts[term, doc] = weights[term] * (1_000_000_000 * most // (1000 * most + 8 * spread[doc]))
        for item, at in zip(items, places):
            yield item, parts[at].sum(axis=0)


def _scan(docs: DataFrame, asked, key: str, text: str, index: bool) -> DataFrame:
    """A pass over the texts: blocks of the index if wanted, and for each task the counts the weights need."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = asked.value.vocabulary
        n_docs = n_terms = 0
        df: Counter = Counter()
        held: dict[int, list] = {}
        key_type = None

        def row(size_class, own):
            ids, sizes, entries = zip(*own) if own else ((), (), ())
            slices = sliced_bits(entries, size_class) if own else None
            found = (n_docs, n_terms, list(df), list(df.values())) if not own else (None, None, None, None)
            columns = [[size_class], [list(ids)], [list(sizes)], [slices], *[[v] for v in found]]
            types = [pa.int32(), pa.list_(key_type or pa.null()), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["size_class", "ids", "sizes", "slices", "n_docs", "n_terms", "terms", "df"])

        for batch in sliced(batches):
            key_type = batch.schema.field(0).type
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = terms(t)
                if not words:
                    continue
                counts = Counter(words)
                n_docs += 1
                n_terms += len(words)
                df.update([vocabulary[w] for w in counts.keys() & vocabulary.keys()])
                if not index:
                    continue
                level = levels(np.fromiter(counts.values(), np.int64, len(counts)))
                size_class = max(4, int(len(counts) + level.sum() - 1).bit_length())
                own = held.setdefault(size_class, [])
                own.append((doc, len(words), (hashed(counts), level)))
                if len(own) >= block_of(size_class):
                    yield row(size_class, held.pop(size_class))
        for size_class, own in held.items():
            yield row(size_class, own)
        if key_type is not None:
            yield row(None, [])

    schema = f"size_class int, ids array<{kind}>, sizes array<bigint>, slices binary, n_docs bigint, n_terms bigint, terms array<int>, df array<bigint>"
    return kept(on_executors(docs.select(key, text), run, schema), "bloom-index")


def _bounds(blocks: DataFrame, asked, top: int, key_type: str) -> DataFrame:
    """(item, key, bound): with thresholds, all documents that reach them; without, each task's ``top`` of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = asked.value
        groups = list(a.groups())
        best: dict[int, tuple[list, np.ndarray]] = {}
        type_ = None

        def out(items, ids, found):
            return pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), pa.array(ids, type_), pa.array(found, pa.int64())], ["item", "key", "bound"])

        for batch in batches:
            for at in range(batch.num_rows):
                type_ = batch.schema.field("ids").type.value_type
                ids, sizes = batch.column("ids")[at].as_py(), np.array(batch.column("sizes")[at].as_py(), np.int64)
                width = width_of(batch.column("size_class")[at].as_py())
                slices = np.frombuffer(batch.column("slices")[at].as_buffer(), np.uint8).reshape(width, -1)
                spread = np.array([a.spread(int(s)) for s in sizes], np.int64)
                items, keys, found = [], [], []
                for item, bound in upper_bounds(slices, sizes, spread, groups):
                    if a.thresholds is not None:
                        hit = np.flatnonzero(bound >= a.thresholds[item])
                        items += [item] * len(hit)
                        keys += [ids[h] for h in hit]
                        found += bound[hit].tolist()
                        continue
                    held, so_far = best.get(item, ([], np.zeros(0, np.int64)))
                    hit = np.argsort(-bound, kind="stable")[:top]
                    hit = hit[bound[hit] > 0]
                    both, names = np.concatenate([so_far, bound[hit]]), held + [ids[h] for h in hit]
                    order = np.argsort(-both, kind="stable")[:top]
                    best[item] = [names[o] for o in order], both[order]
                if items:
                    yield out(items, keys, found)
        for item, (names, bound) in best.items():
            if names:
                yield out([item] * len(names), names, bound.tolist())

    return on_executors(blocks.where("size_class IS NOT NULL").select("size_class", "ids", "sizes", "slices"), run, f"item int, key {key_type}, bound bigint")


def _scored(docs: DataFrame, wanted: DataFrame, asked, key: str, text: str) -> DataFrame:
    """(item, item_id, key, score) of every document row with a wanted (item, key); scores are above 0."""
    kind = docs.schema[key].dataType.simpleString()
    items = kept(wanted.groupBy("key").agg(F.collect_set("item").alias("items")), "to-score")
    few = items.count() <= FEW
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    joined = rows.join(F.broadcast(items) if few else items, rows["_key"].eqNullSafe(items["key"])).select("_key", "_text", "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = asked.value
        for batch in sliced(batches):
            out_items, rows, scores = [], [], []
            for row, (t, own) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                counts = Counter(terms(t))
                size = counts.total()
                for item in own if size else ():
                    score = a.score(item, counts, size)
                    if score > 0:
                        out_items.append(item)
                        rows.append(row)
                        scores.append(score)
            columns = [pa.array(out_items, pa.int32()), batch.column(0).take(pa.array(rows, pa.int64())), pa.array(scores, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["item", "key", "score"])

    return on_executors(joined, run, f"item int, key {kind}, score bigint")


def _best(scored: DataFrame, column: str, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col(column).desc(), "key")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, key: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, key, score): the ``top`` highest-scoring rows of ``docs`` for each item, ties to the smaller key.

    Fewer if fewer score above 0; an item without terms, null or empty, has none. Null and empty documents have no terms
    and are not counted. Rows with the same key are documents of their own. Of items with the same id the one with the
    smallest text counts. Other columns are not read.
    """
    spark = docs.sparkSession
    one = items.groupBy(F.col(item_id).alias("_id")).agg(F.min(item_text).alias("_text"))
    one = kept(one, "items")
    size = one.agg(F.sum(F.length("_text"))).first()[0] or 0
    rounds = size // ROUND_CHARS + 1
    kind, id_type = docs.schema[key].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    found, blocks = None, None
    for at in range(rounds):
        part = Asked.of(one.where(F.pmod(F.xxhash64("_id"), F.lit(rounds)) == at).collect())
        scan = _scan(docs, spark.sparkContext.broadcast(part), key, text, index=blocks is None)
        blocks = scan if blocks is None else blocks
        counts = scan.where("n_docs IS NOT NULL")
        n, total = counts.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        pairs = counts.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy("x.terms").agg(F.sum("x.df").alias("df"))
        part = part.counted(n or 0, total or 1, {r.terms: r.df for r in pairs.collect()})
        asked = spark.sparkContext.broadcast(part)

        first = _best(_bounds(blocks, asked, top, kind), "bound", top).select("item", "key")
        ranked = _best(_scored(docs, first, asked, key, text), "score", top)
        last = {r.item: r.score for r in ranked.where(F.col("rank") == top).select("item", "score").collect()}
        part = replace(part, thresholds=np.array([last.get(i, 1) for i in range(len(part.ids))], np.int64))
        asked = spark.sparkContext.broadcast(part)

        best = _best(_scored(docs, _bounds(blocks, asked, top, kind), asked, key, text), "score", top)
        names = spark.createDataFrame([(i, v) for i, v in enumerate(part.ids)], f"item int, _id {id_type}") if part.ids else one.select(F.lit(0).alias("item"), "_id")
        made = best.join(F.broadcast(names), "item").select(F.col("_id").alias(item_id), "rank", F.col("key").alias(key), "score")
        found = made if found is None else found.unionByName(made)
    return found
