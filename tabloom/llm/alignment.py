"""Alignment of two tokenizers over the same text, from fragments that compose associatively.

Both tokenizers spell the same bytes. Where a token of each ends at the same byte, a group ends. The tokens that end in
a byte range are a fragment: an open prefix (tokens up to the first common end, whose group may have begun before), the
closed groups, and an open suffix (tokens after the last common end). Two neighbouring fragments compose: suffix and
prefix between them join, and are a closed group if the right one has a common end. Composition is associative, so the
fragments of a very long document are made by different tasks and composed in rounds, as a tree.

Every common refinement of the two token sequences is one pair of overlapping tokens: a group of p and q tokens has
p + q - 1 links.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.bpe import byte_symbols
from tabloom.llm.common import claim, coded, kept, on_executors, sliced, spelt_out

#: Bytes of text of a fragment; longer texts are cut into several.
RANGE = 1 << 16
#: Segments a Python worker remembers, in each of two generations.
MEMO = 100_000
#: Distinct linked id pairs whose counts every executor may hold (16 bytes each); more are joined by a shuffle.
MAX_PAIRS = 4_000_000
#: Fragments composed at once in a round.
FAN = 16
#: Letters and digits below this are classed alike by all versions of the splitting pattern; other text goes to the library.
_OLD_CHARS = "԰"
_U64 = np.uint64
#: White space at the start or the end of a piece, or an empty piece.
_BLANK = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\p{Z}]"


def segments(text: str) -> list[str]:
    """Pieces of space + ``text`` between which no token of either tokenizer reaches.

    They are cut before a space that stands between two characters that are no white space.
    """
    out: list[str] = []
    closed = False
    for chunk in text.split(" "):
        if closed and chunk and not chunk[0].isspace():
            out.append(" " + chunk)
        elif out:
            out[-1] += " " + chunk
        else:
            out.append(" " + chunk)
        closed = not out[-1][-1].isspace()
    return out


def split_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """``segments`` of all texts: where each text's begin (and the last end), a code for each, the distinct ones by code.

    Null and empty texts have none.
    """
    texts = texts.fill_null("")
    offsets, codes, chunks = coded(pc.split_pattern(texts, " "))
    names = [" " + c for c in chunks]
    held = pa.array(chunks, pa.string())
    opens = ~pc.match_substring_regex(held, f"^({_BLANK}|$)").to_numpy(zero_copy_only=False)
    closes = ~pc.match_substring_regex(held, f"(^|{_BLANK})$").to_numpy(zero_copy_only=False)
    fine = np.ones(len(codes), bool)
    fine[1:] = opens[codes[1:]] & closes[codes[:-1]]
    fine[offsets[:-1]] = opens[codes[offsets[:-1]]] | (np.diff(offsets) > 1)  # a text starts anywhere, but is not empty
    odd = np.unique(np.searchsorted(offsets, np.flatnonzero(~fine), "right") - 1)
    if not len(odd):
        return offsets, codes, names
    known = {n: i for i, n in enumerate(names)}
    parts, at, sizes = [], 0, np.diff(offsets)
    for row in odd.tolist():
        parts.append(codes[at:offsets[row]])
        text = texts[row].as_py()
        own = [known.setdefault(s, len(known)) for s in segments(text)] if text else []
        parts.append(np.array(own, np.int64))
        sizes[row], at = len(own), offsets[row + 1]
    codes = np.concatenate([*parts, codes[at:]])
    used, codes = np.unique(codes, return_inverse=True)
    names = list(known)
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)]), codes, [names[i] for i in used.tolist()]


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    return np.intersect1d(a_ends, b_ends, assume_unique=True)


def link_pairs(a_ids, a_ends, b_ids, b_ends) -> tuple[np.ndarray, np.ndarray]:
    """(a id << 32 | b id, end) of every overlap of two token sequences over the same bytes."""
    ends = np.union1d(a_ends, b_ends)
    a, b = a_ids[np.searchsorted(a_ends, ends)].astype(_U64), b_ids[np.searchsorted(b_ends, ends)].astype(_U64)
    return a << _U64(32) | b, ends


def group_texts(a_ids, a_ends, b_ids, b_ends, ends) -> list[str]:
    """``a1,a2|b1`` of each group, given where groups end."""
    a_cut, b_cut = [0, *np.searchsorted(a_ends, ends, "right").tolist()], [0, *np.searchsorted(b_ends, ends, "right").tolist()]
    a, b = list(map(str, a_ids.tolist())), list(map(str, b_ids.tolist()))
    return [",".join(a[i:j]) + "|" + ",".join(b[k:m]) for i, j, k, m in zip(a_cut, a_cut[1:], b_cut, b_cut[1:])]


# fragments

@dataclass
class Fragment:
    """Open tokens are (ids, lengths in bytes) of A and B; ``joints`` are the links of groups closed by composing."""

    closed: bool = False
    bad: bool = False
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    text: str = ""
    prefix_a: tuple = ((), ())
    prefix_b: tuple = ((), ())
    suffix_a: tuple = ((), ())
    suffix_b: tuple = ((), ())
    joints: bytes = b""


def _joined(x: tuple, y: tuple) -> tuple:
    return (*x[0], *y[0]), (*x[1], *y[1])


def _group(a: tuple, b: tuple) -> tuple[str, bytes]:
    """Text and links of one group."""
    ids = [np.array(x[0], _U64) for x in (a, b)]
    ends = [np.cumsum(np.array(x[1], np.int64)) for x in (a, b)]
    return ",".join(map(str, a[0])) + "|" + ",".join(map(str, b[0])), link_pairs(ids[0], ends[0], ids[1], ends[1])[0].tobytes()


def composed(f: Fragment, g: Fragment) -> Fragment:
    """The fragment of two neighbouring byte ranges; ``Fragment()`` is neutral."""
    out = Fragment(f.closed or g.closed, f.bad or g.bad, f.n_a + g.n_a, f.n_b + g.n_b, f.n_groups + g.n_groups, joints=f.joints + g.joints)
    texts = [f.text, g.text]
    if f.closed:
        out.prefix_a, out.prefix_b = f.prefix_a, f.prefix_b
        between = _joined(f.suffix_a, g.prefix_a), _joined(f.suffix_b, g.prefix_b)
        if g.closed:
            if not out.bad:
                text, links = _group(*between)
                texts.insert(1, text)
                out.joints += links
            out.n_groups += 1
            out.suffix_a, out.suffix_b = g.suffix_a, g.suffix_b
        else:
            out.suffix_a, out.suffix_b = between
    else:
        out.prefix_a, out.prefix_b = _joined(f.prefix_a, g.prefix_a), _joined(f.prefix_b, g.prefix_b)
        out.suffix_a, out.suffix_b = g.suffix_a, g.suffix_b
    out.text = ";".join(t for t in texts if t)
    return out


#: The byte before a text: composing it with the text's fragment closes the first group.
BEFORE = Fragment(closed=True)


def fragment(a_ids, a_ends, b_ids, b_ends, low: int, high: int, start: int = 0) -> tuple[Fragment, np.ndarray]:
    """Fragment of the tokens that end in (low, high], and the links of its closed groups; tokens begin at ``start``."""
    parts = []
    for ids, ends in ((a_ids, a_ends), (b_ids, b_ends)):
        own = (ends > low) & (ends <= high)
        parts.append((ids[own], ends[own], np.diff(ends, prepend=start)[own]))
    (a, a_end, a_len), (b, b_end, b_len) = parts
    common = common_ends(a_end, b_end)
    out = Fragment(bool(len(common)), n_a=len(a), n_b=len(b))
    if not len(common):
        out.prefix_a, out.prefix_b = (tuple(a.tolist()), tuple(a_len.tolist())), (tuple(b.tolist()), tuple(b_len.tolist()))
        return out, np.zeros(0, _U64)
    inner = []
    for side, ids, ends, lengths in (("a", a, a_end, a_len), ("b", b, b_end, b_len)):
        i, j = np.searchsorted(ends, [common[0], common[-1]], "right")
        setattr(out, f"prefix_{side}", (tuple(ids[:i].tolist()), tuple(lengths[:i].tolist())))
        setattr(out, f"suffix_{side}", (tuple(ids[j:].tolist()), tuple(lengths[j:].tolist())))
        inner += [ids[i:j], ends[i:j]]
    out.n_groups = len(common) - 1
    out.text = ";".join(group_texts(*inner, common[1:]))
    return out, link_pairs(*inner)[0] if len(inner[0]) else np.zeros(0, _U64)


# tokens

class Pair:
    """Tokenizers A (byte-level BPE of the ``tokenizers`` library) and B (a ``sentencepiece`` model) of a Python worker."""

    def __init__(self, spec: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(spec)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        special = {t["content"] for t in json.loads(spec).get("added_tokens") or []}
        known, symbols = json.loads(spec)["model"]["vocab"], byte_symbols()
        labels = {i: bytes(symbols[c] for c in t) for t, i in known.items() if t not in special}
        self.a_labels = [labels.get(i, b"") for i in range(max(labels) + 1)]
        self.a_lengths = np.array([len(x) for x in self.a_labels], np.int64)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p, _ in pieces):
            raise ValueError("pieces of this model reach across spaces")
        self.b_labels = [bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in pieces]
        self.b_lengths = np.array([len(x) for x in self.b_labels], np.int64)
        # where ids follow the order of merges they are ranks, and encoding by ranks gives the same ids
        merges = [m if isinstance(m, list) else m.split(" ") for m in json.loads(spec)["model"]["merges"]]
        order = [known[x + y] for x, y in merges]
        self.ranks = None
        if order == sorted(order) and order and order[0] >= 256:
            import public_tokenizers

            self.ranks = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={x: i for i, x in labels.items() if i <= order[-1]}, special_tokens={})
        #: Whether a link's ids fit into 32 bits together; then links are remembered and stored like that.
        self.narrow = max(len(self.a_labels), len(self.b_labels)) <= 1 << 16
        #: How a token is written: followed by a comma, or by what ends its side of the group.
        self.spelling = [b"%d%c" % (i, end) for i in range(len(self.a_labels)) for end in b",|"]
        self.spelling += [b"%d%c" % (i, end) for i in range(len(self.b_labels)) for end in b",;"]
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def _plain(self, segment: str) -> bool:
        """Whether it may be encoded in a row with others, by ranks."""
        if self.ranks is None or len(segment) > 500 or not (segment.isascii() or max(segment) < _OLD_CHARS):
            return False
        return len(segment) > 1 and not segment[1].isspace() and not segment[-1].isspace()

    def tokens(self, some: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bool]]:
        """Ids and ends of A and B over all segments in a row, where segments end, and which either of them does not spell."""
        raw = "".join(some).encode()
        if plain:
            a = np.array(self.ranks.encode_ordinary("".join(some)), np.int64)
        else:
            found = self.a.encode_batch_fast(some, add_special_tokens=False)
            a = np.array(list(itertools.chain.from_iterable(e.ids for e in found)), np.int64)
        b = np.array(list(itertools.chain.from_iterable(self.b.encode([s[1:] for s in some], num_threads=1))), np.int64)
        a_ends, b_ends = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        stops = np.cumsum([len(s) if s.isascii() else len(s.encode()) for s in some])
        bad = [False] * len(some)
        for ids, ends, labels in ((a, a_ends, self.a_labels), (b, b_ends, self.b_labels)):
            if b"".join(map(labels.__getitem__, ids.tolist())) != raw or not np.isin(stops, ends).all():
                bad = [True] if len(some) == 1 else [self.tokens([s], False)[5][0] for s in some]
                break
        return a, a_ends, b, b_ends, stops, bad

    def window(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]:
        """Ids and ends of A and B over space + ``text``, and whether either does not spell it."""
        some = segments(text)
        *found, _, bad = self.tokens(some, all(map(self._plain, some)))
        return *found, any(bad)

    def _make(self, some: list[str], plain: bool) -> None:
        """Entries (n_a, n_b, n_groups, tokens as places in ``spelling``, links) of new segments; None if not spelt."""
        a, a_ends, b, b_ends, stops, bad = self.tokens(some, plain)
        if any(bad):
            self.young.update((s, None) for s, x in zip(some, bad) if x)
            some = [s for s, x in zip(some, bad) if not x]
            if not some:
                return
            a, a_ends, b, b_ends, stops, bad = self.tokens(some, plain)
        links, ends = link_pairs(a, a_ends, b, b_ends)
        common = common_ends(a_ends, b_ends)
        a_cut, b_cut = np.searchsorted(a_ends, common, "right"), np.searchsorted(b_ends, common, "right")
        # tokens in the order of writing: the A side of a group, then its B side
        order = np.zeros(len(a) + len(b), np.uint32)
        a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_last[a_cut - 1] = b_last[b_cut - 1] = 1
        a_size, b_size = np.diff(a_cut, prepend=0), np.diff(b_cut, prepend=0)
        order[np.arange(len(a)) + np.repeat(b_cut - b_size, a_size)] = 2 * a + a_last
        order[np.arange(len(b)) + np.repeat(a_cut, b_size)] = 2 * (len(self.a_labels) + b) + b_last
        if self.narrow:
            links = (links >> _U64(16) | links & _U64(0xFFFF)).astype(np.uint32)
        written, linked, wide = order.tobytes(), links.tobytes(), links.itemsize
        cuts = [np.searchsorted(x, stops, "right") for x in (a_ends, b_ends, common, ends)]
        sizes = [np.diff(c, prepend=0).tolist() for c in cuts[:3]]
        tokens, joins = [0, *(4 * (cuts[0] + cuts[1])).tolist()], [0, *(wide * cuts[3]).tolist()]
        for s, n, m, g, t0, t1, l0, l1 in zip(some, *sizes, tokens, tokens[1:], joins, joins[1:]):
            self.young[s] = n, m, g, written[t0:t1], linked[l0:l1]

    def remember(self, names: list[str]) -> list[tuple | None]:
        """Entries of these segments."""
        if len(self.young) > MEMO:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        ask = []
        for s in names:
            if s not in young:
                if s in old:
                    young[s] = old[s]
                else:
                    ask.append(s)
        plain: list[str] = []
        other: list[str] = []
        for s in ask:
            (plain if self._plain(s) else other).append(s)
        if plain:
            self._make(plain, True)
        if other:
            self._make(other, False)
        return [young[s] for s in names]


_WORKER: dict[str, Pair] = {}


def _pair(name: str, files) -> Pair:
    claim("alignment", _WORKER.clear)
    if name not in _WORKER:
        _WORKER.clear()
        _WORKER[name] = Pair(*files.value)
    return _WORKER[name]


def load(spark: SparkSession, path_a: str, path_b: str):
    """Both vocabulary files, read on the driver and broadcast (a few MB)."""
    with open(path_a, encoding="utf-8") as f, open(path_b, "rb") as g:
        return f"{path_a} {path_b}", spark.sparkContext.broadcast((f.read(), g.read()))


# short texts: whole in one task

def _counted(links: np.ndarray) -> pa.RecordBatch:
    pairs, times = np.unique(links, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(times.astype(np.int64))], ["pair", "times"])


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values between neighbouring offsets."""
    so_far = np.concatenate([np.zeros(1, np.int64), np.cumsum(values)])
    return so_far[offsets[1:]] - so_far[offsets[:-1]]


_ALIGNED = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, links binary"


def _aligned(docs: DataFrame, files) -> DataFrame:
    """Texts whose tokens one task aligns whole: (_key, n_a, n_b, n_groups, n_links, groups_sha256, links).

    Both the counting and the sums over counts need the links. They are kept in the shared folder, 4 or 8 bytes each,
    since encoding the texts again takes more time.
    """
    name, held = files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(name, held)
        kind = np.uint32 if pair.narrow else _U64
        for batch in sliced(batches):
            offsets, codes, names = split_texts(batch.column(1))
            entries = pair.remember(names)
            spelt = np.array([e is not None for e in entries], bool)
            entries = [e or (0, 0, 0, b"", b"") for e in entries]
            whole = (_sums(~spelt[codes], offsets) == 0) & (np.diff(offsets) > 0)
            sizes = np.array([e[:3] for e in entries], np.int64).reshape(-1, 3)
            a, b, g = (np.where(whole, _sums(x[codes], offsets), 0) for x in sizes.T)
            links, _ = spelt_out([e[4] for e in entries], codes[np.repeat(whole, np.diff(offsets))], kind)
            ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(a + b - g)]) * links.itemsize
            stored = pa.Array.from_buffers(pa.large_binary(), len(whole), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(links.tobytes())])
            written, breaks = spelt_out([e[3] for e in entries], np.arange(len(entries)))
            parts, breaks = list(map(pair.spelling.__getitem__, written.tolist())), breaks.tolist()
            texts = [b"".join(parts[i:j]) for i, j in zip(breaks, breaks[1:])]
            digests = [
                hashlib.sha256(b"".join([texts[c] for c in codes[i:j].tolist()])[:-1]).hexdigest() if ok else ""
                for ok, i, j in zip(whole.tolist(), offsets[:-1].tolist(), offsets[1:].tolist())
            ]
            columns = [*[pa.array(x, pa.int64()) for x in (a, b, g, a + b - g)], pa.array(digests, pa.string()), stored.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["_key", *[f.split()[0] for f in _ALIGNED.split(", ")]])

    return kept(on_executors(docs.select("_key", "_text"), run, f"_key {docs.schema['_key'].dataType.simpleString()}, " + _ALIGNED), "aligned-short")


def _stored_links(links: pa.Array, n: int) -> np.ndarray:
    """``n`` links (a id << 32 | b id) of all rows in a row, as ``_aligned`` stored them."""
    raw = b"".join(links.to_pylist())
    if len(raw) == 8 * n:
        return np.frombuffer(raw, np.int64)
    narrow = np.frombuffer(raw, np.uint32).astype(np.int64)
    return narrow >> 16 << 32 | narrow & 0xFFFF


def _short_pairs(aligned: DataFrame) -> DataFrame:
    """(pair, times): partial counts, some for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("alignment links", lambda: None)
        for batch in sliced(batches):
            yield _counted(_stored_links(batch.column(1), pc.sum(batch.column(0)).as_py() or 0))

    return on_executors(aligned.where("n_links > 0").select("n_links", "links"), run, "pair bigint, times bigint")


def _short_rows(aligned: DataFrame, table, key: str) -> DataFrame:
    """Results of ``_aligned`` texts. ``table``: pairs, their counts, the highest count of each B id."""
    made = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("alignment links", lambda: None)
        pairs, counts, best = table.value
        for batch in sliced(batches):
            n = batch.column("n_links").to_numpy()
            offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
            links = _stored_links(batch.column("links"), int(offsets[-1]))
            found = counts[np.searchsorted(pairs, links)]  # every link is counted
            hit = found == best[links & 0xFFFFFFFF]
            sums = [pa.array(_sums(x, offsets), pa.int64()) for x in (hit, found)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("_key", *made[:4])], *sums, batch.column("groups_sha256")], [key, *made])

    return on_executors(aligned, run, f"`{key}` {aligned.schema['_key'].dataType.simpleString()}, " + _RESULT)


_RESULT = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


# long texts: byte ranges

def byte_ranges(text: str, size: int) -> list[tuple[str, int, int, int]]:
    """(window, its first byte, low, high): tokens that end in (low, high] are those of the window that end there.

    Ranges are about ``size`` bytes; a window reaches to the ends of the segments at both edges. A border inside a
    segment longer than ``size`` moves to the segment's end, so that no segment is in more than two windows.
    """
    parts = [(s, len(s.encode())) for s in segments(text)]
    total, out = sum(n for _, n in parts), []
    starts = list(itertools.accumulate([n for _, n in parts], initial=0))
    low, first = 0, 0
    at = 0
    for border in range(size, total, size):
        while starts[at + 1] < border:
            at += 1
        if border <= low:
            continue
        if parts[at][1] > size:
            border = starts[at + 1]
            if border >= total:
                break
        out.append(("".join(s for s, _ in parts[first:at + 1]), starts[first], low, border))
        low, first = border, at if starts[at + 1] > border else at + 1
    out.append(("".join(s for s, _ in parts[first:]), starts[first], low, total))
    return out


_OPEN = ("prefix_a", "prefix_b", "suffix_a", "suffix_b")
_FRAGMENT = "_part int, _at bigint, k int, closed boolean, bad boolean, n_a bigint, n_b bigint, n_groups bigint, text string, joints binary, " + ", ".join(f"{s}_{x} binary" for s in _OPEN for x in ("ids", "lengths"))
_NAMES = [f.split()[0] for f in _FRAGMENT.split(", ")]


def _row(part: int, at: int, k: int, f: Fragment) -> tuple:
    return (part, at, k, f.closed, f.bad, f.n_a, f.n_b, f.n_groups, f.text, f.joints, *[array("q", x).tobytes() for s in _OPEN for x in getattr(f, s)])


def _read(r: dict) -> Fragment:
    f = Fragment(r["closed"], r["bad"], r["n_a"], r["n_b"], r["n_groups"], r["text"], joints=r["joints"])
    for s in _OPEN:
        setattr(f, s, tuple(tuple(memoryview(r[f"{s}_{x}"]).cast("q")) for x in ("ids", "lengths")))
    return f


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
    kinds = [types[f.split()[1]] for f in _FRAGMENT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], _NAMES)


def cut(docs: DataFrame, size: int = RANGE) -> DataFrame:
    """A row per byte range of (_key, _text); ``_part`` and ``_at`` tell rows with equal keys apart. Kept in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in sliced(batches, 16):
            for row, text in enumerate(batch.column(1).to_pylist()):
                ranges = byte_ranges(text, size)
                columns = [[part] * len(ranges), [at] * len(ranges), list(range(len(ranges))), *map(list, zip(*ranges))]
                types = [pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
                keys = batch.column(0).take(pa.array([row] * len(ranges), pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, *[pa.array(c, t) for c, t in zip(columns, types)]], ["_key", "_part", "_at", "k", "window", "first", "low", "high"])
                at += 1

    kind = docs.schema["_key"].dataType.simpleString()
    return kept(on_executors(docs, run, f"_key {kind}, _part int, _at bigint, k int, window string, first bigint, low bigint, high bigint"), "ranges")


def _fragments(ranges: DataFrame, files) -> DataFrame:
    """A fragment per byte range, and ``links`` of its closed groups. Kept in the shared folder."""
    name, held = files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(name, held)
        for batch in sliced(batches, 16):
            for r in batch.to_pylist():
                a, a_ends, b, b_ends, bad = pair.window(r["window"][1:])
                f, links = Fragment(closed=True, bad=True), np.zeros(0, _U64)
                if not bad:
                    f, links = fragment(a, a_ends + r["first"], b, b_ends + r["first"], r["low"], r["high"], r["first"])
                made = _batch([_row(r["_part"], r["_at"], r["k"], f)])
                yield pa.RecordBatch.from_arrays([*made.columns, pa.array([links.tobytes()], pa.binary())], [*_NAMES, "links"])

    even = ranges.repartition(F.xxhash64("_part", "_at", "k"))
    return kept(on_executors(even.select("_part", "_at", "k", "window", "first", "low", "high"), run, _FRAGMENT + ", links binary"), "fragments")


def _reduced(fragments: DataFrame) -> DataFrame:
    """One fragment per document: rounds of composing up to ``FAN`` neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, so_far = None, Fragment()
        for batch in sliced(batches, 16):
            for r in batch.to_pylist():
                here = r["_part"], r["_at"], r["k"] // FAN
                if own not in (None, here):
                    yield _batch([_row(*own, so_far)])
                    so_far = Fragment()
                own, so_far = here, composed(so_far, _read(r))
        if own is not None:
            yield _batch([_row(*own, so_far)])

    level = fragments.select(*_NAMES)
    while (level.agg(F.max("k")).first()[0] or 0) > 0:
        dealt = level.repartition("_part", "_at", F.floor(F.col("k") / FAN)).sortWithinPartitions("_part", "_at", "k")
        level = kept(on_executors(dealt, run, _FRAGMENT), "composed")
    return level


def _long(docs: DataFrame, files, size: int) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs) of long texts: per document its final figures, and (_part, _at, pair, times) of its links."""
    ranges = cut(docs, size)
    fragments = _fragments(ranges, files)
    whole = _reduced(fragments)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 16):
            rows = []
            for r in batch.to_pylist():
                f = composed(BEFORE, _read(r))
                digest = "" if f.bad else hashlib.sha256(f.text.encode()).hexdigest()
                figures = (0, 0, 0, 0) if f.bad else (f.n_a, f.n_b, f.n_groups, f.n_a + f.n_b - f.n_groups)
                rows.append((r["_part"], r["_at"], *figures, digest, b"" if f.bad else f.joints))
            types = [pa.int32(), *[pa.int64()] * 5, pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["_part", "_at", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])

    schema = "_part int, _at bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, links binary"
    done = kept(on_executors(whole, finish, schema), "aligned")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 16):
            for part, at, links in zip(*[c.to_pylist() for c in batch.columns]):
                c = _counted(np.frombuffer(links, _U64))
                yield pa.RecordBatch.from_arrays([pa.array([part] * c.num_rows, pa.int32()), pa.array([at] * c.num_rows, pa.int64()), *c.columns], ["_part", "_at", "pair", "times"])

    good = done.where("n_a > 0").select("_part", "_at")
    inner = fragments.select("_part", "_at", "links").join(good, ["_part", "_at"], "left_semi")
    links = inner.unionByName(done.where("n_a > 0").select("_part", "_at", "links"))
    pairs = kept(on_executors(links, count, "_part int, _at bigint, pair bigint, times bigint"), "long-pairs")
    names = ranges.where("k = 0").select("_key", "_part", "_at")
    return names.join(done.drop("links"), ["_part", "_at"]), pairs


def _b_id(pair: str):
    return F.col(pair).bitwiseAND(F.lit(0xFFFFFFFF))


def align(docs: DataFrame, files, key: str = "doc_id", text: str = "text", size: int = RANGE, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """A row per document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and texts whose bytes one of the tokenizers does not give again, have zeros and ''. Texts of
    more than ``size`` bytes are aligned in byte ranges by different tasks. Repeated rows are documents of their own and
    count in the pair counts. Only the key and the text are read.

    Short texts are encoded once, and their links kept. Pair counts are a table of the two vocabularies. Up to
    ``max_pairs`` of them are sent to the executors, which look up the links of the short texts; if there are more, every text goes the way of long ones and is joined with the counts.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    is_long = F.coalesce(F.octet_length("_text") + 1 > size, F.lit(False))
    short = rows.where(~is_long)
    done, pairs = _long(rows.where(is_long), files, size)
    aligned = _aligned(short, files)
    parts = _short_pairs(aligned).unionByName(pairs.select("pair", "times"))
    counts = kept(parts.groupBy("pair").agg(F.sum("times").alias("n")), "pair-counts")
    best = counts.groupBy(_b_id("pair").alias("b")).agg(F.max("n").alias("best"))
    few = counts.count() <= max_pairs
    if not few:
        some = F.coalesce(F.length("_text") > 0, F.lit(False))
        done, pairs = _long(rows.where(some), files, size)
        aligned = _aligned(rows.where(~some), files)
        counts_of_short = (np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64))
    else:
        held = counts.orderBy("pair").toArrow()
        pair, n = (held.column(c).to_numpy() for c in ("pair", "n"))
        top = np.zeros(int((pair & 0xFFFFFFFF).max()) + 1 if len(pair) else 1, np.int64)
        np.maximum.at(top, pair & 0xFFFFFFFF, n)
        counts_of_short = (pair, n, top) if len(pair) else (np.zeros(1, np.int64), np.zeros(1, np.int64), top)
    rated = counts.withColumn("b", _b_id("pair")).join(best, "b").select("pair", "n", (F.col("n") == F.col("best")).cast("bigint").alias("hit"))
    linked = pairs.join(F.broadcast(rated) if few else rated, "pair").groupBy("_part", "_at").agg(
        F.sum(F.col("times") * F.col("hit")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    zero = F.lit(0).cast("bigint")
    long_rows = done.join(linked, ["_part", "_at"], "left").select(
        F.col("_key").alias(key), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
    return _short_rows(aligned, spark.sparkContext.broadcast(counts_of_short), key).unionByName(long_rows)
