"""Sampled segmentations over a SentencePiece vocabulary, and lossless decoding.

A text is a lattice: nodes are its positions, edges the vocabulary's pieces. A forward pass sums the
weights of all segmentations up to each node; a backward pass draws one, each with probability in
proportion to its weight. Random numbers follow from seed and row key, so a row always gets the same pieces.

No piece of such a vocabulary has a word mark after another character or a line feed, so every segmentation
breaks there and the lattice falls apart into units, mostly words. The lattices of the different units of a
few texts are laid out in one array and worked on together in NumPy.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_columns, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SEED = 20240610
POWER = 1.0  # exponent of the weights: larger values stay closer to the best segmentation
AT_ONCE = 1 << 20  # bytes of text whose lattices are in memory together; one text may be longer
MARK = "▁"  # stands for a space
LITERAL = "\ud800"  # stands for a MARK of the text itself; cannot occur in valid text
END = "\ud801"  # stands between units
_UNIT = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")
_BITS = 21  # of a code point
_SLOT_BITS = 19  # of the hash table, for up to some 400,000 prefixes


class Vocabulary(NamedTuple):
    """Trie over pieces: a hash table from state and character to the next state; piece and log weight per state."""

    steps: np.ndarray  # state, character and next state in one number, -1 where free; stands at its slot or the next free one
    piece: np.ndarray
    weight: np.ndarray
    bytes_: list[int]  # ids of the byte pieces
    byte_weight: float
    surface: list[bytes]  # per id


def _slot(key: np.ndarray) -> np.ndarray:
    return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).view(np.int64)


def _next(state: np.ndarray, character: np.ndarray, v: Vocabulary) -> np.ndarray:
    """The state after a character, -1 if no piece goes on like that."""
    key = (state << _BITS) | character
    slot = _slot(key)
    there = v.steps[slot]
    out = np.where(there >> _SLOT_BITS == key, there & ((1 << _SLOT_BITS) - 1), -1)
    look = np.flatnonzero((out < 0) & (there >= 0))
    while len(look):
        slot[look] = (slot[look] + 1) & (len(v.steps) - 1)
        there = v.steps[slot[look]]
        hit = there >> _SLOT_BITS == key[look]
        out[look[hit]] = there[hit] & ((1 << _SLOT_BITS) - 1)
        look = look[~hit & (there >= 0)]
    return out


def load(path: str = MODEL, power: float = POWER) -> Vocabulary:
    """The vocabulary of a model with byte fallback.

    Scores of a unigram model are log probabilities. In a BPE model a score is minus the merge rank; the
    probability is then taken as inverse to the rank.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.vocab_size()
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
    normal = {model.id_to_piece(i): i for i in range(n) if not special[i] and not model.is_byte(i)}
    if any(MARK in p.lstrip(MARK) or "\n" in p for p in normal):
        raise ValueError("a piece has a word mark after another character, or a line feed")
    score = {p: model.get_score(i) for p, i in normal.items()}
    ranked = all(s <= 0 and s == int(s) for s in score.values())
    if ranked:
        score = {p: -math.log(1 + min(-s, n)) for p, s in score.items()}
    bytes_ = [0] * 256
    surface = [b""] * n
    for i in range(n):
        if model.is_byte(i):
            value = int(model.id_to_piece(i)[3:5], 16)
            bytes_[value], surface[i] = i, bytes([value])
    for p, i in normal.items():
        surface[i] = p.replace(MARK, " ").encode()

    # a trie: state 0 is the root, every other prefix of a piece has a state of its own
    states = {"": 0} | {p: i for i, p in enumerate(sorted({p[:k] for p in normal for k in range(1, len(p) + 1)}), 1)}
    if len(states) > 0.8 * (1 << _SLOT_BITS):
        raise ValueError("too many pieces for the table")
    steps = np.full(1 << _SLOT_BITS, -1, np.int64)
    for p, i in states.items():
        if p:
            key = (states[p[:-1]] << _BITS) | ord(p[-1])
            slot = int(_slot(np.array([key]))[0])
            while steps[slot] >= 0:
                slot = (slot + 1) % len(steps)
            steps[slot] = key << _SLOT_BITS | i
    piece, weight = np.full(len(states), -1, np.int32), np.zeros(len(states))
    for p, i in normal.items():
        piece[states[p]], weight[states[p]] = i, power * score[p]
    return Vocabulary(steps, piece, weight, bytes_, float(weight.min()) - power, surface)


class _Lattice(NamedTuple):
    """Nodes level by level, level d holding position d of every unit that long; edges by the node they end at."""

    first: np.ndarray  # edge per node, and one more
    start: np.ndarray
    piece: np.ndarray  # -1 - character for a character that is spelled in bytes
    running: np.ndarray  # sum of the odds of all edges before an edge, and one more
    last: np.ndarray  # node per unit


def lattice(units: list[str], v: Vocabulary) -> _Lattice:
    """The forward pass over all units, longest first, at once, level after level."""
    line = np.frombuffer((END.join(units) + END).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ends = np.flatnonzero(line == ord(END))
    begins = np.concatenate([[0], ends[:-1] + 1])
    size = ends - begins
    # units of a level are a prefix of all units, so unit u has node level[d] + u
    wide = len(units) - np.searchsorted(size[::-1], np.arange(size[0] + 1))
    level = np.concatenate([[0], np.cumsum(wide)])
    n = int(level[-1])
    codes, onward = np.empty(n, np.int64), np.empty(n, np.int64)
    for d, (k, base) in enumerate(zip(wide.tolist(), level.tolist(), strict=False)):
        codes[base : base + k] = line[begins[:k] + d]
        onward[base : base + k] = np.arange(base + k, base + 2 * k)

    # all edges, one array per length of their pieces
    inside = np.flatnonzero(codes != ord(END))
    at, end, state = inside, inside, np.zeros(len(inside), np.int64)
    found, count, single = [], np.zeros(n, np.int64), np.zeros(n, bool)
    while len(at):
        state = _next(state, codes[end], v)
        ok = np.flatnonzero(state >= 0)
        at, end, state = at[ok], onward[end[ok]], state[ok]
        piece = v.piece[state]
        whole = np.flatnonzero(piece >= 0)
        if not found:
            single[at[whole]] = True
        found.append((at[whole], end[whole], piece[whole], v.weight[state[whole]]))
        count[end[whole]] += 1
    spelled = inside[~single[inside]]
    c = np.where(codes[spelled] == ord(LITERAL), ord(MARK), codes[spelled])
    width = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
    found.append((spelled, onward[spelled], -1 - c, v.byte_weight * width))
    count[onward[spelled]] += 1

    # no two edges of one length end at the same node; longer pieces come first
    first = np.concatenate([[0], np.cumsum(count)])
    place, total = first[:-1].copy(), int(first[-1])
    start, piece, weight = np.empty(total, np.int64), np.empty(total, np.int32), np.empty(total)
    for at, end, which, w in reversed(found):
        slot = place[end]
        start[slot], piece[slot], weight[slot] = at, which, w
        place[end] = slot + 1

    forward, odds = np.zeros(n), np.empty(total)
    for a, b in zip(level[1:-1].tolist(), level[2:].tolist(), strict=True):
        x, y = first[a], first[b]
        begin = first[a:b] - x
        value = forward[start[x:y]] + weight[x:y]
        top = np.maximum.reduceat(value, begin)
        value -= np.repeat(top, count[a:b])
        np.exp(value, out=odds[x:y])
        forward[a:b] = top + np.log(np.add.reduceat(odds[x:y], begin))
    running = np.concatenate([[0.0], np.cumsum(odds)])
    return _Lattice(first, start, piece, running, level[size] + np.arange(len(units)))


def _uniform(key: np.ndarray, step: int) -> np.ndarray:
    return (mix(key + np.uint64(step * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(11)) * 2.0**-53


def sample(graph: _Lattice, unit: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One segmentation per entry of ``unit``: pieces one after the other, and how many each entry has."""
    node, who, roots = graph.last[unit], np.arange(len(unit)), len(graph.last)
    drawn = []
    count = np.zeros(len(unit), np.int64)
    step = 0
    while len(who):
        edge, last_edge = graph.first[node], graph.first[node + 1] - 1
        low, high = graph.running[edge], graph.running[last_edge + 1]
        goal = low + _uniform(key, step) * (high - low)
        look = np.flatnonzero((edge < last_edge) & (graph.running[edge + 1] <= goal))
        while len(look):
            edge[look] += 1
            look = look[(edge[look] < last_edge[look]) & (graph.running[edge[look] + 1] <= goal[look])]
        drawn.append((who, graph.piece[edge]))
        count[who] += 1
        node = graph.start[edge]
        go_on = np.flatnonzero(node >= roots)
        who, node, key = who[go_on], node[go_on], key[go_on]
        step += 1
    last = np.cumsum(count) - 1
    out = np.empty(int(count.sum()), np.int64)
    for k, (w, piece) in enumerate(drawn):
        out[last[w] - k] = piece
    return out, count


def encode(texts: list[str], keys: list[int], v: Vocabulary, seed: int = SEED) -> list[np.ndarray]:
    """Ids of one sampled segmentation per text."""
    units: list[str] = []
    sizes = []
    for text in texts:
        marked = MARK + text.replace(MARK, LITERAL).replace(" ", MARK) if text else ""
        found = _UNIT.findall(marked)
        units += found
        sizes.append(len(found))
    if not units:
        return [np.zeros(0, np.int32) for _ in texts]
    known = {u: i for i, u in enumerate(sorted(dict.fromkeys(units), key=len, reverse=True))}
    unit = np.fromiter(map(known.__getitem__, units), np.int64, len(units))
    place = np.concatenate([np.arange(n, dtype=np.uint64) for n in sizes])
    key = np.repeat(np.array([(k + seed) % 2**64 for k in keys], np.uint64), sizes)
    pieces_, count = sample(lattice(list(known), v), unit, mix(mix(key) + place))
    # characters that are spelled in bytes
    width = np.ones(len(pieces_), np.int64)
    spelled = np.flatnonzero(pieces_ < 0)
    c = -1 - pieces_[spelled]
    n_bytes = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
    width[spelled] = n_bytes
    at = (np.cumsum(width) - width)[spelled]
    ids = np.repeat(pieces_, width).astype(np.int32)
    byte_ids = np.array(v.bytes_, np.int32)
    for k in range(4):
        here = n_bytes > k
        value = c[here] >> 6 * (n_bytes[here] - 1 - k)
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[n_bytes[here]]
        ids[at[here] + k] = byte_ids[value | lead if k == 0 else value & 0x3F | 0x80]
    per_unit = np.add.reduceat(width, np.cumsum(count) - count)
    ends = np.concatenate([[0], np.cumsum(per_unit)])[np.concatenate([[0], np.cumsum(sizes)])]
    return [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def decode(ids: pa.Array, v: Vocabulary) -> pa.Array:
    """The texts of a list array of ids: inverse of ``encode`` for every text and sample."""
    sizes = np.array(pc.fill_null(pc.list_value_length(ids), 0), np.int64)
    flat = np.array(ids.flatten(), np.int64)
    begin = (np.cumsum(sizes) - sizes)[sizes > 0]
    flat[begin] += len(v.surface)  # the space before a text is not its own
    surface = pa.array(v.surface + [s[1:] for s in v.surface], pa.large_binary())
    joined = surface.take(pa.array(flat))
    ends = np.cumsum(np.array(pc.binary_length(joined), np.int64)) if len(flat) else np.zeros(0, np.int64)
    edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
    gone = pa.py_buffer(np.packbits(np.array(ids.is_valid()), bitorder="little").tobytes()) if ids.null_count else None
    whole = pa.Array.from_buffers(pa.large_string(), len(ids), [gone, pa.py_buffer(edges.tobytes()), joined.buffers()[2]])
    return whole.cast(pa.string())


def encode_texts(docs: DataFrame, key: Column, text_column: str = "text", model: str = MODEL, seed: int = SEED,
                 power: float = POWER) -> DataFrame:
    """``docs`` with ``token_ids array<int>``; an existing column of that name is replaced.

    ``key`` is a long that identifies the row: equal keys and texts give equal samples. A NULL text gives
    NULL, an empty one an empty array. Whole texts are encoded. The model file is read by the driver only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(load(model, power)))  # a vocabulary has a fixed size
    slim = keep_columns(docs, {"token_ids": F.lit(None).cast("array<int>")})
    names, at = slim.columns, slim.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(*shared.value)
        for batch in batches:
            for part in _parts(batch, at):
                texts = part.column(at).to_pylist()
                ids = encode([t or "" for t in texts], part.column(part.num_columns - 1).to_pylist(), v, seed)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), pa.array(np.concatenate(ids)),
                    mask=pa.array([t is None for t in texts]),
                )
                columns = part.columns[:-2] + [lists]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return slim.withColumn("_piece_key", key).mapInArrow(run, slim.schema)


def _parts(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Slices of about AT_ONCE bytes of text in column ``at``."""
    sizes = np.cumsum(np.array(pc.fill_null(pc.binary_length(batch.column(at)), 0), np.int64))
    start = 0
    while start < batch.num_rows:
        done = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, done + AT_ONCE)))
        yield batch.slice(start, end - start)
        start = end


def decode_texts(docs: DataFrame, ids_column: str = "token_ids", model: str = MODEL) -> DataFrame:
    """``docs`` with ``decoded``, the text of the ids; NULL ids give NULL. An existing ``decoded`` is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(load(model)))
    slim = keep_columns(docs, {"decoded": F.lit(None).cast("string")})
    names, at = slim.columns, slim.columns.index(ids_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(*shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield pa.RecordBatch.from_arrays(part.columns[:-1] + [decode(part.column(at), v)], names=names)

    return slim.mapInArrow(run, slim.schema)
