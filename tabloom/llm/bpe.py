"""Byte-pair encoding and decoding by a tokenization automaton.

Compiling. The automaton has a start and a state for each token, entered by the arc that emits the token. It begins
with the single bytes, every one of which may follow every other. Merges are added in order; merging ``a b`` into ``c``
is a gadget: the arc from ``a`` to ``b`` goes, ``c`` gets the arcs that led to ``a``, and the arcs that left ``b``. So
whether an arc ``s -> t`` stands in the end follows by taking gadgets off again, the younger of the two tokens first:
what the last part of ``s`` or the first part of ``t`` had then, unless a merge of the two came between.

Byte by byte an arc is the path of its label's bytes, and the automaton is made deterministic by sets: a state is the
set of all (token, bytes begun after it) that agree with what was read. Every string has one path through the automaton,
so a set holds one whole tokenization of what was read, its first member. With 50,000 tokens the full table of states
by bytes would have billions of cells; a cell is filled when a text first asks for it.

Encoding. Words of a batch are read side by side, one column of bytes after the other, by the table of (state, byte);
ids are read off backwards: the token a state ends with says how far back the one before ends.

Decoding. The labels of the arcs, one after the other.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from tabloom.llm.common import claim, coded, on_executors, schema_with, sliced, spelt_out

#: Fixed: how this vocabulary splits text into words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces of text a Python worker remembers, in each of two generations.
MEMO = 250_000
#: States of the table; a full one starts again empty.
STATES = 400_000
#: Words read side by side, and the bytes above which a word is read on its own.
WORDS, LONG = 20_000, 64
#: White space at the start or the end of a piece.
_BLANK = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\p{Z}]"
_ALWAYS = 1 << 60


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files: itself if printable, else from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tables:
    """Compiled from a vocabulary file of the ``tokenizers`` library (byte-level BPE); small enough to broadcast."""

    def __init__(self, spec: dict):
        symbols = byte_symbols()
        model = spec["model"]
        known = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.labels = {i: bytes(symbols[c] for c in t) for t, i in known.items() if t not in self.special}
        self.labels |= {i: t.encode() for t, i in self.special.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.born = {known[c]: -1 for c in symbols if c in known}
        self.fused: dict[tuple[int, int], int] = {}
        for at, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            pair, made = (known[a], known[b]), known[a + b]
            if made in self.born:
                raise ValueError(f"token {made} is made twice")
            if all(p in self.born for p in pair) and self.arc(*pair):  # else the merge never finds its pair
                self.parts[made], self.born[made], self.fused[pair] = pair, at, at

    def arc(self, s: int, t: int) -> bool:
        """Whether token ``t`` may follow token ``s``."""
        born, parts, fused, until = self.born, self.parts, self.fused, _ALWAYS
        while True:
            if fused.get((s, t), _ALWAYS) < until:
                return False
            if born[s] > born[t]:
                until, s = born[s], parts[s][1]
            elif born[t] >= 0:  # of two overlapping equal pairs the left one merges: that merge still counts here
                until, t = born[t] + 1, parts[t][0]
            else:
                return True


class Automaton:
    """Encoder of one Python worker, with the table it has filled so far."""

    def __init__(self, tables: Tables):
        self.tables = tables
        self.sizes = np.zeros(max(tables.labels) + 1, np.int64)
        self.steps: dict[int, int] = {}  # node << 8 | byte -> node of the labels' bytes; 0 is the root
        self.token: list[int] = [-1]  # of a node, or -1
        for t in tables.born:
            node = 0
            for byte in tables.labels[t]:
                node = self.steps.setdefault(node << 8 | byte, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
            self.token[node], self.sizes[t] = t, len(tables.labels[t])
        self.begun = {k >> 8 for k in self.steps}  # nodes from which bytes lead on
        self.split = regex.compile(SPLIT)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(tables.special, key=len, reverse=True))) + ")") if tables.special else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self._empty()

    # the table

    def _empty(self) -> None:
        self.sets: list[tuple[int, ...]] = []  # members of a state: (token + 1) << 32 | node, the whole tokenization first
        self.number: dict[tuple[int, ...], int] = {}
        self.last = array("q")  # the token a state ends with
        self.cells: dict[int, int] = {}  # state << 8 | byte -> state
        self.arcs: dict[int, bool] = {}
        self._state((0,))

    def _state(self, members: tuple[int, ...]) -> int:
        at = self.number.get(members)
        if at is None:
            at = self.number[members] = len(self.sets)
            self.sets.append(members)
            self.last.append((members[0] >> 32) - 1)
        return at

    def _fill(self, cell: int) -> int:
        byte, steps, token, begun = cell & 255, self.steps, self.token, self.begun
        whole, members = -1, []
        for m in self.sets[cell >> 8]:
            node = steps.get((m & 0xFFFFFFFF) << 8 | byte)
            if node is None:
                continue
            t = token[node]
            if t >= 0 and whole < 0:
                key = m >> 32 << 32 | t
                stands = self.arcs.get(key)
                if stands is None:
                    stands = self.arcs[key] = m < 1 << 32 or self.tables.arc((m >> 32) - 1, t)
                if stands:
                    whole = t
            if node in begun:
                members.append(m >> 32 << 32 | node)
        if whole < 0:
            raise ValueError(f"byte {byte} has no token")
        self.cells[cell] = to = self._state((whole + 1 << 32, *members))
        return to

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Token ids of pre-split words, packed."""
        if len(self.sets) > STATES:
            self._empty()
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        states = np.zeros(len(raw), np.int64)
        order = np.argsort(-lengths, kind="stable")
        long = int(np.count_nonzero(lengths > LONG))
        get, fill = self.cells.get, self._fill
        for w in order[:long].tolist():
            state = 0
            for at in range(starts[w], starts[w] + lengths[w]):
                cell = state << 8 | int(raw[at])
                state = get(cell, -1)
                state = fill(cell) if state < 0 else state
                states[at] = state
        short, sizes = starts[order[long:]], lengths[order[long:]]
        here = np.zeros(len(short), np.int64)
        for column in range(int(sizes[0]) if len(sizes) else 0):
            live = int(np.searchsorted(-sizes, -column))  # words with more bytes than this
            at = short[:live] + column
            cells, place = np.unique(here[:live] << 8 | raw[at], return_inverse=True)
            to = [get(c, -1) for c in cells.tolist()]
            here[:live] = np.array([fill(c) if t < 0 else t for c, t in zip(cells.tolist(), to)])[place]
            states[at] = here[:live]
        return self._read_off(starts, lengths, np.array(self.last)[states])

    def _word(self, word: str) -> bytes:
        return self._words([word.encode()])[0]

    def _read_off(self, starts: np.ndarray, lengths: np.ndarray, last: np.ndarray) -> list[bytes]:
        """Ids of each word, from the token that ends at each byte."""
        word, end, backwards = np.arange(len(starts)), lengths.copy(), []
        counts = np.zeros(len(starts), np.int64)
        while len(word):
            t = last[starts[word] + end - 1]
            backwards.append((word, t))
            counts[word] += 1
            end = end - self.sizes[t]
            word, end = word[end > 0], end[end > 0]
        cuts = np.cumsum(counts)
        ids = np.zeros(int(cuts[-1]) if len(cuts) else 0, np.uint32)
        for back, (word, t) in enumerate(backwards):
            ids[cuts[word] - 1 - back] = t
        packed, ends = ids.tobytes(), (4 * cuts).tolist()
        return [packed[i:j] for i, j in zip([0, *ends], ends)]

    # texts

    def _pieces(self, new: list[str]) -> None:
        """Ids of new pieces of text are remembered."""
        split = [[p] if p.isascii() and p[1:].isalpha() and (p[0] == " " or p[0].isalpha()) else self.split.findall(p) for p in new]
        known = dict.fromkeys(w for own in split for w in own)
        names = list(known)
        for at in range(0, len(names), WORDS):
            some = names[at:at + WORDS]
            known.update(zip(some, self._words([w.encode() for w in some])))
        for p, own in zip(new, split):
            self.young[p] = known[own[0]] if len(own) == 1 else b"".join(map(known.__getitem__, own))

    def _remembered(self, names: list[str]) -> list[bytes]:
        if len(self.young) > MEMO:
            self.young, self.old = {}, self.young
        young, old, new = self.young, self.old, []
        for p in names:
            if p not in young:
                if p in old:
                    young[p] = old[p]
                else:
                    new.append(p)
        if new:
            self._pieces(new)
        return [young[p] for p in names]

    def _cut(self, text: str) -> list[str]:
        """Pieces of a text, cut before spaces that stand between two characters that are no white space."""
        out: list[str] = []
        for chunk in text.split(" "):
            if out and chunk and out[-1] and not chunk[0].isspace() and not out[-1][-1].isspace():
                out.append(" " + chunk)
            elif out:
                out[-1] += " " + chunk
            else:
                out.append(chunk)
        return [p for p in out if p]

    def _special(self, text: str) -> bytes:
        """Ids of a text in which names of special tokens stand: they are those tokens."""
        special = self.tables.special
        parts = [p for p in self.cut.split(text) if p]
        return b"".join(array("I", [special[p]]).tobytes() if p in special else b"".join(self._remembered(self._cut(p))) for p in parts)

    def _coded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Where each text's pieces begin (and the last end), a code for each piece, and ids by code."""
        texts = texts.fill_null("")
        offsets, codes, chunks = coded(pc.split_pattern(texts, " "))
        held = pa.array(chunks, pa.string())
        opens = ~pc.match_substring_regex(held, f"^({_BLANK}|$)").to_numpy(zero_copy_only=False)
        closes = ~pc.match_substring_regex(held, f"(^|{_BLANK})$").to_numpy(zero_copy_only=False)
        fine = np.ones(len(codes), bool)
        fine[1:] = opens[codes[1:]] & closes[codes[:-1]]
        fine[offsets[:-1]] = True  # a text starts anywhere
        odd = set((np.searchsorted(offsets, np.flatnonzero(~fine), "right") - 1).tolist())
        odd |= {r for r in np.flatnonzero(np.diff(offsets) == 1).tolist() if not chunks[codes[offsets[r]]]}  # empty texts
        marked: set[int] = set()
        for name in self.tables.special:
            marked |= set(np.flatnonzero(pc.match_substring(texts, name).to_numpy(zero_copy_only=False)).tolist())
        names = [*[" " + c for c in chunks], *chunks]
        codes = codes.copy()
        codes[offsets[:-1]] += len(chunks)  # no space before the first piece
        more: dict[str, int] = {}  # pieces of texts with other white space
        whole: list[bytes] = []
        parts, at, sizes = [], 0, np.diff(offsets)
        for row in sorted(odd | marked):
            parts.append(codes[at:offsets[row]])
            at, text = offsets[row + 1], texts[row].as_py()
            if row in marked:
                whole.append(self._special(text))
                own = [-len(whole)]
            else:
                own = [more.setdefault(p, len(names) + len(more)) for p in self._cut(text)]
            parts.append(np.array(own, np.int64))
            sizes[row] = len(own)
        codes = np.concatenate([*parts, codes[at:]]) if parts else codes
        used, codes = np.unique(codes, return_inverse=True)
        names += more
        made = iter(self._remembered([names[i] for i in used.tolist() if i >= 0]))
        ids = [next(made) if i >= 0 else whole[-i - 1] for i in used.tolist()]
        return np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)]), codes, ids

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where those of each text begin (and the last end). Null is like empty."""
        offsets, codes, ids = self._coded(texts)
        flat, ends = spelt_out(ids, codes)
        return flat, ends[offsets]

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Number of tokens of each text; ids are not put together."""
        offsets, codes, ids = self._coded(texts)
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))[codes] // 4)])
        return np.diff(ends[offsets])

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit numbers. Names of special tokens in the text are those tokens."""
        return self.encode_texts(pa.array([text], pa.string()))[0].tobytes()


def decode_ids(tables: Tables, ids: bytes) -> str:
    return b"".join(map(tables.labels.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


_WORKER: dict[str, Automaton] = {}


def _automaton(name: str, tables) -> Automaton:
    claim("bpe", _WORKER.clear)
    if name not in _WORKER:
        _WORKER.clear()
        _WORKER[name] = Automaton(tables.value)
    return _WORKER[name]


def load(spark: SparkSession, path: str):
    """The compiled tables of a vocabulary file, read and compiled on the driver and broadcast (a few MB)."""
    with open(path, encoding="utf-8") as f:
        return path, spark.sparkContext.broadcast(Tables(json.load(f)))


def _replace(batch: pa.RecordBatch, drop: list[str], add: dict[str, pa.Array]) -> pa.RecordBatch:
    keep = [n for n in batch.schema.names if n not in drop and n not in add]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in keep], *add.values()], [*keep, *add])


def encode(docs: DataFrame, tokenizer, text: str = "text", keep_text: bool = True, decoded: str | None = None) -> DataFrame:
    """``docs`` with ``n_tokens`` long and ``ids`` binary (little-endian unsigned 32-bit numbers).

    ``decoded`` names a column for what the ids decode to; it is made by the worker that encodes, without a second pass.

    Null text encodes like empty text, to no tokens. Columns already named so are replaced. Rows are independent:
    repeated rows and very long texts need nothing special, and no rows in are no rows out.
    """
    name, tables = tokenizer
    drop = [] if keep_text else [text]
    made = ["n_tokens", "ids", *([decoded] if decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(name, tables)
        for batch in sliced(batches, 1024):
            flat, cuts = automaton.encode_texts(batch.column(text))
            packed, ends = flat.tobytes(), (4 * cuts).tolist()
            ids = [packed[i:j] for i, j in zip(ends, ends[1:])]
            columns = {"n_tokens": pa.array(np.diff(cuts), pa.int64()), "ids": pa.array(ids, pa.binary())}
            if decoded:
                columns[decoded] = pa.array([decode_ids(automaton.tables, i) if i else "" for i in ids], pa.string())
            yield _replace(batch, drop, columns)

    kinds = "n_tokens bigint, ids binary" + (f", `{decoded}` string" if decoded else "")
    return on_executors(docs, run, schema_with(docs, [*made, *drop], kinds))


def decode(encoded: DataFrame, tokenizer, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text that the column ``ids`` stands for; null decodes to empty text.

    Bytes that are no valid UTF-8, as when ids were cut off inside a character, become U+FFFD.
    """
    tables = tokenizer[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [decode_ids(tables.value, i) if i else "" for i in batch.column(ids).to_pylist()]
            yield _replace(batch, [], {into: pa.array(texts, pa.string())})

    return on_executors(encoded, run, schema_with(encoded, [into], f"{into} string"))
