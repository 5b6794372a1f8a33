"""Near-duplicate documents: MinHash signatures in a multi-index Hamming join.

A signature has ``VALUES`` minima of ``BITS`` bits. Two documents are compared if their signatures differ in at most
``DISTANCE`` values. The signature is cut into ``CHUNKS`` parts; by the pigeonhole principle such a pair differs in at
most DISTANCE // CHUNKS values of some part, so each part is indexed once for every way of leaving that many values
out, and the pair meets under one of these keys: no pair within the distance is missed. A pair at the similarity of 0.85
(0.8) is beyond the distance with a probability of 2e-7 (2e-5).

Copies. Equal shingle sets are one class and compared as one. Inside a key, and later inside a family (documents
connected by signatures), only the links that join two parts leave a task, and large groups are dealt out as pairs of
blocks, so no group is ever gathered or written out as all its pairs. Links are confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import Forest, blocked, claim, groups, kept, on_executors, sliced
from tabloom.llm.components import components

VALUES = 40
CHUNKS = 10
DISTANCE = 19
BITS = 16
_KEYS = CHUNKS * comb(VALUES // CHUNKS, DISTANCE // CHUNKS)
#: Groups of up to so many members, and families of up to so many shingles, are one task's work.
WHOLE = 256
SHINGLES = 1 << 20
LARGEST_BLOCK = 4096
_WORDS = 300_000

_rng = np.random.default_rng(20240607)
_A = _rng.integers(1, 1 << 63, VALUES, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 1 << 63, VALUES, dtype=np.uint64)
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _Hashes()


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of ``width`` words in a row, A-Z in lower case; the whole text if it has fewer words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: white space is 0x20 and 0x09 to 0x0D
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    found = np.zeros(n, np.uint64)
    for i in range(min(width, len(words))):
        found = _stir(found + hashed[i:i + n] * _PLACE[i])
    return np.unique(found)


def signature(found: np.ndarray) -> np.ndarray:
    """``VALUES`` numbers of ``BITS`` bits."""
    least = np.empty(VALUES, np.uint64)
    for i in range(VALUES):
        least[i] = (found * _A[i] + _B[i]).min()
    return (_stir(least) >> np.uint64(64 - BITS)).astype(np.uint16)


def _fingerprint(found: np.ndarray) -> tuple[int, int]:
    both = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), "<i8")
    return int(both[0]), int(both[1])


def sign(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, signature) of every row, kept in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("near_dup", _HASHES.clear)
        for batch in sliced(batches):
            out = []
            for text in batch.column("text").to_pylist():
                found = shingles(text, width)
                out.append((len(found), *(_fingerprint(found) if len(found) else (0, 0)), signature(found).tobytes() if len(found) else b""))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else ((),) * 4, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_shingles", "f1", "f2", "signature"])

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return kept(on_executors(narrow, run, "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, signature binary"), "signed")


def index_keys(values: np.ndarray) -> np.ndarray:
    """(signatures, keys) of 64 bits: every chunk without every choice of DISTANCE // CHUNKS of its values."""
    width = VALUES // CHUNKS
    out = []
    for chunk in range(CHUNKS):
        part = values[:, chunk * width:(chunk + 1) * width].astype(np.uint64) + np.uint64(1)
        for left_out in combinations(range(width), DISTANCE // CHUNKS):
            h = np.full(len(values), len(out) + 1, np.uint64)
            for j in range(width):
                if j not in left_out:
                    h = _stir(h + part[:, j] * _PLACE[j])
            out.append(h)
    return np.stack(out, axis=1)


def _signatures(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, VALUES)


def _indexed(classes: DataFrame) -> DataFrame:
    """(key, rep): a row per class and key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = index_keys(_signatures(batch.column("signature")))
            rep = np.repeat(batch.column("rep").to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(rep)], ["key", "rep"])

    return on_executors(classes.select("rep", "signature"), run, "key bigint, rep bigint")


def _n_blocks(members: Column, root_share: float, *, shingle_sum: Column | None = None) -> Column:
    small = members <= WHOLE if shingle_sum is None else (members <= WHOLE) & (shingle_sum <= SHINGLES)
    parts = [F.ceil(F.sqrt(members) * root_share), F.ceil(members / LARGEST_BLOCK)]
    parts += [] if shingle_sum is None else [F.ceil(shingle_sum / SHINGLES)]
    return F.when(small, 1).otherwise(F.greatest(*parts)).cast("int")


def _near_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that connect, in each group, all members within the signature distance of each other."""
    for table, starts in groups(batches, ["key", "block_a", "block_b"]):
        rep, values = table.column("rep").to_numpy(), _signatures(table.column("signature"))
        size = np.diff(starts)
        hub = np.repeat(starts[:-1], size)
        near = np.concatenate([(values[i:i + 20_000] != values[hub[i:i + 20_000]]).sum(1) <= DISTANCE for i in range(0, len(rep), 20_000)])
        direct = np.flatnonzero(near & (np.arange(len(rep)) != hub))
        a, b = [rep[direct]], [rep[hub[direct]]]
        far = np.flatnonzero(~near)
        for s in np.unique(hub[far]):
            inside = slice(s, s + int(size[np.searchsorted(starts, s, "right") - 1]))
            part, forest = values[inside], Forest(inside.stop - s)
            for x in np.flatnonzero(near[inside])[1:]:
                forest.link(0, int(x))
            forest.links.clear()  # these are sent already
            for x in np.flatnonzero(~near[inside]):
                for y in np.flatnonzero((part != part[x]).sum(1) <= DISTANCE):
                    if y != x:
                        forest.link(int(x), int(y))
            pairs = np.array(forest.links, np.int64).reshape(-1, 2) + s
            a.append(rep[pairs[:, 0]])
            b.append(rep[pairs[:, 1]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])


def _confirmed_links(percent: int):
    """Links that connect all members of a group whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in groups(batches, ["family", "block_a", "block_b"]):
            rep, packed = table.column("rep").to_numpy(), table.column("found")
            a, b = [], []
            for s, e in zip(starts[:-1], starts[1:]):
                sets = [np.frombuffer(x, np.uint64) for x in packed.slice(int(s), int(e - s)).to_pylist()]
                pairs = np.array(similar(sets, percent), np.int64).reshape(-1, 2) + s
                a.append(rep[pairs[:, 0]])
                b.append(rep[pairs[:, 1]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return run


def similar(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A forest of the pairs with 100 * intersection >= percent * union. Exact: sizes come from posting lists."""
    forest = Forest(len(sets))
    size = np.array([len(x) for x in sets])
    if len(sets) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if 100 * both >= percent * (size.sum() - both) else []
    term = np.unique(np.concatenate(sets), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(term, kind="stable")
    posting, first = owner[order], np.append(np.searchsorted(term[order], np.arange(term.max() + 1)), len(term))
    at = np.append(0, np.cumsum(size))
    for i in range(1, len(sets)):
        own = term[at[i]:at[i + 1]]
        shared = np.zeros(len(sets), np.int64)
        for part in range(0, len(own), 4096):
            lists = [posting[first[t]:first[t + 1]] for t in own[part:part + 4096]]
            shared += np.bincount(np.concatenate(lists), minlength=len(sets))
        for j in np.flatnonzero(100 * shared[:i] >= percent * (size[:i] + size[i] - shared[:i])):
            forest.link(i, int(j))
    return forest.links


def _sets(docs: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """``members`` with ``found``: the set of each class, from the text of a document that has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for text, f1, f2 in zip(*[batch.column(n).to_pylist() for n in ("text", "f1", "f2")]):
                found = shingles(text, width)
                out.append(found.tobytes() if _fingerprint(found) == (f1, f2) else None)
            rest = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in rest], pa.array(out, pa.binary())], [*rest, "found"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("_doc"), "text")
    joined = members.join(texts, F.col("rep") == F.col("_doc")).drop("_doc")
    names = [f for f in joined.schema.fields if f.name != "text"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in names) + ", found binary"
    return on_executors(joined, run, schema).where("found IS NOT NULL")


def linked(docs: DataFrame, signed: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(classes, components): rep, f1, f2 of each class of equal sets; node (rep) and component of the linked ones."""
    some = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    rows = some.count()
    classes = some.groupBy("f1", "f2").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"),
    )
    classes = kept(classes, "classes", rows)
    occurrences = kept(_indexed(classes), "index")
    shared = kept(occurrences.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "shared-keys", rows * _KEYS // 2)
    met = occurrences.join(shared, "key").join(classes.select("rep", "signature"), "rep")
    blocks = _n_blocks(F.col("members"), 0.1)
    most = shared.agg(F.sum(F.col("members") * blocks)).first()[0] or 0  # a group is connected by fewer links than it has members
    met = blocked(met, ["key"], F.col("rep"), blocks).select("key", "block_a", "block_b", "rep", "signature")
    dealt = met.repartition("key", "block_a", "block_b").sortWithinPartitions("key", "block_a", "block_b")
    near = kept(on_executors(dealt, _near_links, "a bigint, b bigint").distinct(), "near-links", most)

    families = kept(components(near).select(F.col("node").alias("rep"), F.col("component").alias("family")), "families", rows)
    members = families.join(classes.select("rep", "f1", "f2", "n"), "rep")
    sizes = kept(members.groupBy("family").agg(F.count("*").alias("members"), F.sum("n").alias("total")), "family-sizes", rows)
    found = _sets(docs, members.select("rep", "family", "f1", "f2"), width).select("rep", "family", "found").join(sizes, "family")
    blocks = _n_blocks(F.col("members"), 0.4, shingle_sum=F.col("total"))
    most = sizes.agg(F.sum(F.col("members") * blocks)).first()[0] or 0
    dealt = blocked(found, ["family"], F.col("rep"), blocks).select("family", "block_a", "block_b", "rep", "found")
    dealt = dealt.repartition("family", "block_a", "block_b").sortWithinPartitions("family", "block_a", "block_b")
    links = kept(on_executors(dealt, _confirmed_links(percent), "a bigint, b bigint").distinct(), "confirmed-links", most)
    return classes, components(links)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text; others are ignored).

    Two documents are linked if their sets of ``width``-word shingles have 100 * intersection >= percent * union.
    component_id is the smallest doc_id reachable by links, kept whether it is the row's own. Null or wordless texts
    have no set and are linked with nothing. Rows with the same doc_id count as one document and share its component.
    A null doc_id takes no part: component_id is null, kept is true. No rows in, no rows out.
    """
    signed = sign(docs, width)
    classes, found = linked(docs, signed, width, percent)
    reps = kept(
        classes.join(found, F.col("rep") == F.col("node"), "left").select("f1", "f2", F.coalesce("component", "rep").alias("component")),
        "class-components",
    )
    joined = signed.join(reps.select(F.col("f1").alias("_f1"), F.col("f2").alias("_f2"), "component"), (F.col("f1") == F.col("_f1")) & (F.col("f2") == F.col("_f2")), "left")
    component = F.when(F.col("doc_id").isNull(), None).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)),
    )


def deduplicate(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, same columns; of rows with the same doc_id one stays.

    Rows without doc_id, and documents without words, are copies of nothing and stay.
    """
    gone = near_duplicates(docs, width, percent).where("NOT kept").select(F.col("doc_id").alias("_doc")).distinct()
    key = F.col("doc_id").cast("bigint")
    stay = docs.join(gone, key == F.col("_doc"), "left_anti")
    twice = docs.groupBy(key.alias("_twice")).agg(F.count("*").alias("_rows")).where("_rows > 1 AND _twice IS NOT NULL").select("_twice")
    twice = kept(twice, "repeated-ids")
    single = stay.join(twice, key == F.col("_twice"), "left_anti")
    return single.unionByName(stay.join(twice, key == F.col("_twice"), "left_semi").dropDuplicates(["doc_id"]))
