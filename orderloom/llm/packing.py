"""Packing by concatenating and cutting.

All documents' tokens form one stream, cut every 2048 tokens. The place of a document in the stream is a
prefix sum in two passes: tasks tokenise their rows and store, with the ids, the tokens before each row in its
task; the tasks' totals, one record each, are summed up; then every row knows its place and its cuts.

The order of the stream is the order in which the rows are read. It is fixed in the stored ids, so a lost
executor changes nothing. Only the end of the stream is shorter than a window: it is cut into windows of
falling powers of two, which need no padding.

A text is tokenised in runs between spaces and line feeds, each distinct run once as long as a worker remembers
it; marks at the end of a word are a run of their own, and a run of Latin-1 has the ids of its lower-case
form. The vocabulary drops white space, lower-cases, and tokenises words and marks apart, so the ids are those
of the whole text (tested on all texts of a table and on odd ones).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
LENGTH = 2048
END_ID = 1
AT_ONCE = 1 << 22  # bytes of text that are split together; one text may be longer
KNOWN = 1_000_000  # a worker forgets its runs when it would know more than that
MARKS = ".,;:!?#$%&*()[]{}\"/@^_+=~-"  # no apostrophe, which may belong to the word, and none of a special token
BETWEEN = "0"  # a digit is a token of its own


class Encoder:
    """Ids of texts, run by run. ``known`` numbers the runs seen; the ids of run k are ``table[begin[k]:begin[k + 1]]``."""

    def __init__(self, tokenizer: str) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(tokenizer)
        if any(self.model.encode(t, add_special_tokens=False).ids != 2 * self.model.encode("a", add_special_tokens=False).ids
               for t in ("a a", "a\n a ")):
            raise ValueError("the tokenizer must drop white space")
        ids = [self.model.encode(t, add_special_tokens=False).ids for t in (BETWEEN, "A", "a")]
        self.between = ids[0][0] if len(ids[0]) == 1 else None
        self.any_case = ids[1] == ids[2]
        # a word and the marks after it are tokenised apart
        self.word_ends = all(self.model.encode(f"a{m}", add_special_tokens=False).ids
                             == self.model.encode(f"a {m}", add_special_tokens=False).ids for m in MARKS)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.table, self.begin = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _plain(self, run: str) -> str:
        """A run with the same ids, for runs of Latin-1. A special token's name has "<" and keeps its case."""
        return run.lower() if self.any_case and (run.isascii() or max(run) <= "ÿ") and "<" not in run else run

    def _learn(self, new: list[str]) -> None:
        """Runs without the separator are encoded as one text that it divides, the others by themselves."""
        plain = [self._plain(r) for r in new]
        open_ = [r for r in dict.fromkeys(plain) if r not in self.known]
        joint = [r for r in open_ if BETWEEN not in r] if self.between is not None else []
        alone = [r for r in open_ if BETWEEN in r] if self.between is not None else open_
        tables, sizes = [self.table], [np.zeros(0, np.int64)]
        if joint:
            ids = np.array(self.model.encode_batch_fast([f" {BETWEEN} ".join(joint)], add_special_tokens=False)[0].ids, np.uint32)
            border = np.flatnonzero(ids == self.between)
            sizes.append(np.diff(np.concatenate([[-1], border, [len(ids)]])) - 1)
            tables.append(np.delete(ids, border))
        if alone:
            found = [e.ids for e in self.model.encode_batch_fast(alone, add_special_tokens=False)]
            sizes.append(np.array([len(i) for i in found], np.int64))
            tables += [np.array(i, np.uint32) for i in found]
        self.known.update(zip(joint + alone, range(len(self.begin) - 1, len(self.begin) - 1 + len(open_)), strict=True))
        self.known.update([(r, self.known[p]) for r, p in zip(new, plain, strict=True) if r != p])
        self.table = np.concatenate(tables)
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(np.concatenate(sizes))])

    def texts(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has; NULL is an empty text."""
        spaced = pc.replace_substring(pc.fill_null(texts, "").cast(pa.large_string()), "\n", " ")
        if self.word_ends:
            spaced = pc.replace_substring_regex(spaced, f"([A-Za-zÀ-ÖØ-öø-ÿ])([{re.escape(MARKS)}]+) ", r"\1 \2 ")
        runs = pc.split_pattern(spaced, " ")
        coded = runs.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        if len(self.known) > KNOWN:
            self.forget()
        number = np.fromiter((self.known.get(r, -1) for r in distinct), np.int64, len(distinct))
        fresh = np.flatnonzero(number < 0)
        if len(fresh):
            new = distinct[fresh].tolist()
            self._learn(new)
            number[fresh] = [self.known[r] for r in new]
        number = number[np.asarray(coded.indices)]
        size = self.begin[number + 1] - self.begin[number]
        upto = np.concatenate([[0], np.cumsum(size)])
        first = np.asarray(runs.offsets) - runs.offsets[0].as_py()
        count = np.diff(upto[first]) + 1  # with the end
        # where each id comes from: one more per id, with a jump at each run
        flat = np.full(int(count.sum()), end_id, "<u4")
        own = np.ones(len(flat), bool)
        own[np.cumsum(count) - 1] = False
        flat[own] = self.table[np.arange(upto[-1]) + np.repeat(self.begin[number] - upto[:-1], size)]
        return flat, count


_encoders: dict[int, Encoder] = {}  # of this Python worker, which serves one task after another


def _encoder(tokenizer: str) -> Encoder:
    key = hash(tokenizer)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(tokenizer)
    return _encoders[key]


def _slices(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(np.array(pc.fill_null(pc.binary_length(batch.column(at)), 0), np.int64))
    start = 0
    while start < batch.num_rows:
        done = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, done + AT_ONCE)))
        yield batch.slice(start, end - start)
        start = end


def tokenise(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer: str = TOKENIZER,
             end_id: int = END_ID) -> DataFrame:
    """``(id, part, before, n, ids)``: ids as little-endian unsigned 32-bit numbers, ``part`` the task that read
    the row and ``before`` the ids before it there. The tokenizer file is read by the driver only."""
    with open(tokenizer, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary has a fixed size
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    schema = rows.selectExpr("id", "0 AS part", "0L AS before", "0L AS n", "CAST('' AS BINARY) AS ids").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = _encoder(shared.value), TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in _slices(batch, 1):
                flat, count = encoder.texts(piece.column(1), end_id)
                ends = np.cumsum(count)
                data = pa.py_buffer(flat.tobytes())
                offsets = pa.py_buffer((4 * np.concatenate([[0], ends])).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays([
                    piece.column(0), pa.array(np.full(len(count), part, np.int32)), pa.array(before + ends - count),
                    pa.array(count), pa.Array.from_buffers(pa.binary(), len(count), [None, offsets, data]),
                ], names=["id", "part", "before", "n", "ids"])
                before += int(ends[-1])

    return rows.mapInArrow(run, schema)


def tail_windows(total: int, length: int = LENGTH) -> list[tuple[int, int, int]]:
    """``(sequence_id, begin, end)`` of what the stream has after its last full window."""
    full, rest = divmod(total, length)
    sizes = [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]
    ends = list(accumulate(sizes, initial=full * length))
    return [(full + k, a, b) for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True))]


def pack(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer: str = TOKENIZER,
         end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    """``(id, start, length, sequence_id, offset, doc_tokens, ids)``, one row per piece of a document.

    Every document ends in ``end_id``; a NULL or empty text is that id alone. Whole texts are tokenised,
    a text of any length is cut over as many windows as it needs. NULL and repeated ids stay, each row a
    document of its own. Windows hold ``length`` tokens, those of the stream's end a power of two. An empty
    table gives no rows. Other columns are not looked at.
    """
    stored = cut(tokenise(docs, id_column, text_column, tokenizer, end_id))
    totals = stored.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("n")).orderBy("part").collect()
    bases = list(accumulate((r.n for r in totals), initial=0))
    places = stored.sparkSession.createDataFrame([(r.part, b) for r, b in zip(totals, bases, strict=False)], "part int, base long")
    # one record of 16 bytes per task of the first pass: 13 MB for 100 TB in splits of 128 MB
    placed = stored.join(F.broadcast(places), "part").withColumn("from", F.col("base") + F.col("before"))
    placed = placed.withColumn("to", F.col("from") + F.col("n"))

    full = bases[-1] // length
    window = "struct<sequence_id:bigint,begin:bigint,end:bigint>"
    fixed = F.transform(
        F.sequence(F.floor(F.col("from") / length), F.least(F.floor((F.col("to") - 1) / length), F.lit(full - 1))),
        lambda w: F.struct(w.alias("sequence_id"), (w * length).alias("begin"), (w * length + length).alias("end")),
    ).cast(f"array<{window}>")
    none = F.array().cast(f"array<{window}>")
    windows = F.when(F.col("from") < full * length, fixed).otherwise(none)
    last = [F.struct(*[F.lit(v).cast("long").alias(n) for v, n in zip(w, ("sequence_id", "begin", "end"), strict=True)])
            for w in tail_windows(bases[-1], length)]
    if last:
        hit = F.filter(F.array(*last), lambda w: (w["begin"] < F.col("to")) & (w["end"] > F.col("from")))
        windows = F.concat(windows, hit)

    def piece(w):
        begin, end = F.greatest(w["begin"], F.col("from")), F.least(w["end"], F.col("to"))
        return F.struct(
            (begin - F.col("from")).alias("start"), (end - begin).alias("length"), w["sequence_id"].alias("sequence_id"),
            (begin - w["begin"]).alias("offset"), F.col("n").alias("doc_tokens"),
            F.substring("ids", (4 * (begin - F.col("from")) + 1).cast("int"), (4 * (end - begin)).cast("int")).alias("ids"),
        )

    return placed.select("id", F.inline(F.transform(windows, piece)))


def sequences(pieces: DataFrame) -> DataFrame:
    """``(sequence_id, length, pieces, ids)``: the windows themselves, from at most as many pieces as they have tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    whole = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.count("*").alias("pieces"), whole.alias("ids"))
