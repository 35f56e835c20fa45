"""Whitening, packing and Merkle proofs against brute force, and on rows that are odd in some way."""

import random
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from orderloom.llm import merkle, packing, whitening
from orderloom.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, start string, root string, n string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))


def frame(spark, rows):
    """Documents with extra columns whose names clash with those used inside."""
    return spark.createDataFrame([(*r, "old", "old", "old", "old") for r in rows], SCHEMA)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, dim string, id string")


# whitening


def brute_whitening(rows, k=4):
    """Definitions taken literally: rationals for the covariance, numpy only for the eigenvectors."""
    use = [(i, [int(np.floor(256 * c)) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in use})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    mean = [Fraction(v, n) for v in s]
    cov = np.array([[float(sum((x[a] - mean[a]) * (x[b] - mean[b]) for x in fit) / n) for b in range(d)] for a in range(d)])
    values, axes = np.linalg.eigh(cov)
    keep = np.argsort(-values)[:k]
    out = {}
    for i, x in use:
        centred = np.array([float(a - m) for a, m in zip(x, mean, strict=True)])
        far = sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True))
        out.setdefault(i, []).append((far, centred @ axes[:, keep] / np.sqrt(values[keep])))
    return n, out, values[keep] / np.trace(cov)


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(200, 7)) @ np.diag([3, 2.2, 1.5, 1, 0.6, 0.3, 0.1]) + np.arange(7)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)] + [(1, rows[9][1]), (None, rows[4][1])]
    odd = [(2000, None), (2001, [1.0, None, *[0.0] * 5]), (2002, [float("inf"), *[0.0] * 6]), (2003, [float("nan"), *[0.0] * 6]), (2004, [])]
    got = whitening.whiten(vectors(spark, [(i, v, "old", "old", "old") for i, v in rows + odd])).collect()
    n, want, share = brute_whitening(rows)
    assert n == 200 and len(got) == 4 * len(rows) and {r.n for r in got} == {200}
    sign = {r.component: np.sign(r.whitened) * np.sign(want[5][0][1][r.component - 1]) for r in got if r.id == 5}
    seen = {}
    for r in got:
        assert abs(r.explained - share[r.component - 1]) < 1e-12 and r.identity_error < 1e-9
        seen.setdefault(r.id, []).append((r.component, r.deviation, sign[r.component] * r.whitened))
    for i, parts in want.items():
        expected = sorted((c + 1, far, w[c]) for far, w in parts for c in range(4))
        for a, b in zip(sorted(seen[i]), expected, strict=True):
            assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-9


def test_whitening_is_exact_for_large_components(spark):
    """2^40 in all rows: no digit of the centred values is lost; small and large batches agree."""
    rows = [(i, [2.0**40 + i / 256, -(2.0**40) - 3 * (i % 5) / 256, float(i % 3)]) for i in range(50)]
    got = whitening.whiten(vectors(spark, [(i, v, "", "", "") for i, v in rows])).collect()
    _, want, share = brute_whitening(rows)
    for r in got:
        far, w = want[r.id][0]
        assert r.deviation == far and abs(abs(r.whitened) - abs(w[r.component - 1])) < 1e-9
    assert {len({r.component for r in got})} == {3} and all(abs(r.explained - share[r.component - 1]) < 1e-12 for r in got)
    huge = whitening.whiten(vectors(spark, [(i, [1e30 * i, 1e300], "", "", "") for i in range(3)])).collect()
    assert len(huge) == 6  # beyond the long range: its ends, and no deviation where that leaves the range too


def test_polarised_covariances_equal_products():
    rng = np.random.default_rng(8)
    x = rng.integers(-500, 500, (300, 5))
    z = x - x.mean(axis=0)
    q = lambda v: (v * v).sum()
    assert abs((q(z[:, 0] + z[:, 1]) - q(z[:, 0]) - q(z[:, 1])) / 2 - (z[:, 0] * z[:, 1]).sum()) < 1e-6


def test_whitening_without_variance(spark):
    one = whitening.whiten(vectors(spark, [(i, [0.5, 0.25], "", "", "") for i in range(3)])).collect()
    assert len(one) == 6 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.n == 1 for r in one)
    flat = whitening.whiten(vectors(spark, [(i, [float(i), 0.25], "", "", "") for i in range(3)])).collect()
    assert all((r.whitened is None) == (r.component == 2) and r.identity_error < 1e-12 for r in flat)
    mixed = whitening.whiten(vectors(spark, [(1, [1.0], "", "", ""), (2, [2.0], "", "", ""), (3, [1.0, 2.0], "", "", "")])).collect()
    assert {(r.id, r.n) for r in mixed} == {(1, 2), (2, 2), (3, 1)}
    assert whitening.whiten(vectors(spark, [])).collect() == []


# packing


def reference_ids(text):
    from tokenizers import Tokenizer

    if not hasattr(reference_ids, "model"):
        reference_ids.model = Tokenizer.from_file(packing.TOKENIZER)
    return reference_ids.model.encode(text or "", add_special_tokens=False).ids + [1]


def check_packing(rows, got):
    """rows: (id, text) with unique ids; got: pieces with ids."""
    windows, parts = {}, {}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
        parts.setdefault(r.id, []).append((r.start, ids, r.doc_tokens))
    for k, pieces in windows.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        windows[k] = at
    assert sorted(windows) == list(range(len(windows)))
    short = [n for n in windows.values() if n != packing.LENGTH]
    assert all(n <= packing.LENGTH for n in windows.values()) and len(set(short)) == len(short)
    assert all(n & (n - 1) == 0 for n in short)  # powers of two need no padding
    assert set(parts) == {i for i, _ in rows}
    for i, text in rows:
        ids = reference_ids(text)
        assert [x for _, piece, _ in sorted(parts[i]) for x in piece] == ids and {n for *_, n in parts[i]} == {len(ids)}
        assert [s for s, *_ in sorted(parts[i])] == np.cumsum([0] + [len(p) for _, p, _ in sorted(parts[i])]).tolist()[:-1]


def test_packing_of_a_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check_packing(rows, packing.pack(docs.repartition(5)).collect())
    crc = {(r.doc_id, r.start): r for r in QUERIES["op12_packing"](spark, SMALL).collect()}
    for i, text in rows[:50]:
        ids = np.array(reference_ids(text), "<u4")
        for (d, start), r in crc.items():
            if d == i:
                assert r.ids_crc32 == zlib.crc32(ids[start : start + r.length].tobytes())


ODD_TEXTS = [None, "", " \n\t ", LONG, "x" * 5000, "<|endoftext|> <|ENDOFTEXT|>a.", "it's IT'S. 0 00 0.", "J̌ K. J̌. ΣΑΣ ΣΑΣ.",
             "a.́ b", "İ ẞ. ß", "日本 。x", "\x1c a\x85b  c.", "a. . .. ?! '. x'. <a. <B. ", "🎉. A🎉."]


def test_packing_of_odd_rows(spark):
    rows = list(enumerate(ODD_TEXTS))
    check_packing(rows, packing.pack(frame(spark, [(i, t, "en", "s", 1) for i, t in rows])).collect())
    twice = packing.pack(frame(spark, [(None, "one two", "en", "s", 1)] * 2 + [(7, "one two", None, None, None)] * 2)).collect()
    assert len({(r.sequence_id, r.offset) for r in twice}) == len(twice) and sum(r.length for r in twice) == 12
    assert packing.pack(frame(spark, [])).collect() == []


def test_packing_long_runs_and_lengths(spark):
    rows = [(i, "tok " * n) for i, n in enumerate([2047, 4095, 1, 6000, 63])]
    got = packing.pack(frame(spark, [(i, t, "en", "s", 1) for i, t in rows]).coalesce(1)).collect()
    check_packing(rows, got)
    whole = {r.sequence_id: r for r in packing.sequences(packing.pack(frame(spark, [(i, t, "en", "s", 1) for i, t in rows]))).collect()}
    assert all(len(r.ids) == 4 * r.length for r in whole.values()) and sum(r.length for r in whole.values()) == sum(n + 1 for n in (2047, 4095, 1, 6000, 63))
    assert packing.tail_windows(2048 * 3) == [] and packing.tail_windows(2048 + 5) == [(1, 2048, 2052), (2, 2052, 2053)]


def test_encoder_forgets_and_splits_alike(monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("aAzJ0 .,;:!?#&*([\"/_-'\n\t<|>sStTÉé́̌Σς日🎉ſK") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    monkeypatch.setattr(packing, "KNOWN", 500)
    with open(packing.TOKENIZER, encoding="utf-8") as f:
        encoder = packing.Encoder(f.read())
    for k in range(0, 3000, 100):
        flat, count = encoder.texts(pa.array(texts[k : k + 100]), 1)
        got = np.split(flat, np.cumsum(count)[:-1])
        assert [g.tolist() for g in got] == [reference_ids(t) for t in texts[k : k + 100]]


# Merkle


def h(text):
    return sha256(text.encode()).hexdigest()


def brute_merkle(rows):
    """The contract word for word: whole levels as lists, proofs by walking up."""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: h("".join(map(enc, (r[0], r[3], r[2], r[4], text))))
    tops, found = [], []
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))

    def walk(levels, at):
        out, sides = [], []
        for level in levels[:-1]:
            run = range(at // 8 * 8, min(at // 8 * 8 + 8, len(level)))
            left, right = [level[k] for k in run if k < at], [level[k] for k in run if k > at]
            out += left + right
            sides.append(("".join(left), "".join(right)))
            at //= 8
        return out, sides

    def tree(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([h("".join(levels[-1][k : k + 8])) for k in range(0, len(levels[-1]), 8)])
        return levels

    for lang in langs:
        mine = sorted([(r[0] is not None, r[0] or 0, leaf(r, r[1]), r) for r in rows if r[2] == lang], key=lambda x: x[:3])
        found.append((mine, tree([x[2] for x in mine])))
        tops.append(found[-1][1][-1][0])
    top = tree(tops)
    out = []
    for g, (mine, levels) in enumerate(found):
        for k, (_, _, own, r) in enumerate(mine):
            a, sides = walk(levels, k)
            b, more = walk(top, g)
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf(r, text)
            for left, right in sides + more:
                folded = h(left + folded + right)
            out.append((str(r[0]), own, tops[g], top[-1][0], h("".join(a + b)), folded, folded == top[-1][0]))
    return sorted(out)


@pytest.mark.parametrize("depth", [3, 1])
@pytest.mark.parametrize("case", ["many", "odd", "one", "langs"])
def test_merkle_equals_brute_force(spark, monkeypatch, depth, case):
    """depth=1: blocks of 8 leaves, so that most nodes are fetched and rounds are many."""
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle._blocks, "__defaults__", (depth,))
    rng = random.Random(depth)
    many = [(i, f"Text {rng.random()} ABC", rng.choice(["en", "en", "en", "de", None]), f"s{i % 4}", i) for i in range(700)]
    odd = [(1, None, "x", "a", None), (2, "", "", None, 0), (3, LONG, None, None, 5), (None, "AB", "é", "s", 1), (None, "AB", "é", "s", 1),
           (None, "CD", "é", "s", 1), *[(7, "Same Row", "x", "s", 1)] * 700, (7, "Other Row", "x", "s", 1), (8, "ÄÖ A", "x", "s", 1)]
    langs = [(i, f"T{i}", f"l{i % 90}", "s", i) for i in range(200)]
    rows = {"many": many, "odd": odd, "one": many[:1], "langs": langs}[case]
    got = merkle.verify_documents(frame(spark, rows)).collect()
    assert sorted((str(r.id), r.leaf, r.subroot, r.root, r.proof, r.folded_root, r.verified) for r in got) == brute_merkle(rows)


def test_merkle_of_nothing(spark):
    assert merkle.verify_documents(frame(spark, [])).collect() == []


def test_multiproof_is_minimal():
    """No node is fetched that derives from others, and none too few: every leaf's siblings follow."""
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 700)
        own = np.array(sorted(rng.sample(range(n), rng.randint(1, min(n, 30)))))
        level_widths = merkle.widths(n)
        known = {(0, int(p)) for p in own}
        fetched = {(level, int(p)) for level, places in merkle.missing(own, level_widths) for p in places}
        for level, width in enumerate(level_widths[:-1]):
            for run in range(level_widths[level + 1]):
                members = {(level, p) for p in range(8 * run, min(8 * run + 8, width))}
                if members & known:
                    assert members - known <= fetched  # what cannot be derived is fetched
                    assert not (members & known & fetched)  # what can be is not
                    known.add((level + 1, run))
        assert all(level < len(level_widths) - 1 for level, _ in fetched)
