"""The training-data operators against brute force, and on rows that are odd in some way."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderloom.llm import (
    html_text, language_id, line_dedup, mixing, near_dup, pieces, quality_rules, resampling, toxicity, vector_search,
)
from orderloom.session import settings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))


def frame(spark, rows):
    """Documents with extra columns whose names clash with results."""
    return spark.createDataFrame([(i, t, "en", s, 1, "old", "old") for i, t, s in rows], SCHEMA)


ODD = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, LONG, "b"), (5, LONG, "b"), (None, "one two", "b"),
       (7, "one two", None), (7, "one two", None), (8, "▁   日本 🎉\x00", "c")]


def test_mix_keeps_targets_and_caps(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(1, 40), "hot" if i % 3 else rng.choice(["a", "b", None])) for i in range(3000)]
    plan = [r.asDict() for r in mixing.copies(frame(spark, rows)).collect()]
    assert sorted(r["id"] for r in plan) == list(range(3000))
    words = Counter()
    for _, t, s in rows:
        words[s] += len(t.split())
    order = sorted(words, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_, rest = {}, set(order), sum(words.values())
    while True:  # resharing as the contract words it
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * words[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 3 * words[s]
            rest -= target[s]
        open_ -= full
    taken = Counter()
    for r in plan:
        assert r["source_size"] == words[r["source"]]
        assert math.isclose(r["target"], target[r["source"]], rel_tol=1e-9)
        assert r["copies"] in (math.floor(r["target"] / r["source_size"] + 1e-9), math.floor(r["target"] / r["source_size"]) + 1)
        assert r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
    assert all(abs(taken[s] - target[s]) <= 41 for s in order)
    again = {r.id: r.copies for r in mixing.copies(frame(spark, rows[::-1])).collect()}
    assert again == {r["id"]: r["copies"] for r in plan}


def test_mix_meets_targets_on_repeated_rows(spark):
    """Rows without id and rows of one id, as a large part of a source, miss the target by under one document."""
    rows = [(None, f"t{i} " + "w " * 9, "hot") for i in range(500)] + [(7, "same words again", "b")] * 301
    rows += [(100 + i, "x " * (1 + i % 9), ("b", "c", None)[i % 3]) for i in range(200)]
    docs = frame(spark, rows)
    plan = mixing.copies(docs)
    spelled = mixing.rows_taken(plan, 64).collect()
    assert Counter((r.id, r.source, r["size"]) for r in spelled) == Counter((i, s, len(t.split())) for i, t, s in rows)
    taken, target = Counter(), {r.source: r.target for r in spelled}
    for r in spelled:
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r["size"]
    assert all(abs(taken[s] - target[s]) <= 10 for s in target)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter((r.doc_id, r.text, r.source) for r in mixed.collect())
    sums = Counter()
    for (i, t, s), n in got.items():
        sums[s] += n * len(t.split())
    assert sums == taken
    assert all(got[r] <= 3 * n for r, n in Counter(rows).items())
    assert got == Counter((r.doc_id, r.text, r.source) for r in mixing.mix(frame(spark, rows[::-1])).collect())


def test_mix_rounding_is_unbiased(spark):
    rows = spark.createDataFrame([(i, "s", 1 + i % 7, 1, 0, 0.1 + 0.8 * (i % 5) / 5) for i in range(40)],
                                 "id long, source string, size long, n long, whole long, p double")
    sums = Counter()
    for seed in range(12):
        got = mixing.round_dependently(rows, seed).collect()
        assert abs(sum(r.size * r.extra for r in got) - sum((1 + i % 7) * (0.1 + 0.8 * (i % 5) / 5) for i in range(40))) <= 7
        for r in got:
            sums[r.id % 5] += r.extra
    assert all(abs(sums[k] / 96 - (0.1 + 0.16 * k)) < 0.2 for k in range(5))


def test_quality_lines(spark):
    clean = " ".join(f"Clean{i} word{i} stands." for i in range(30))
    bad = " ".join(f"shout{i}!!" for i in range(30))
    rows = [(1, clean, "a"), (2, clean + "\n" + bad, "a"), (3, bad + "\n" + bad, "a"), (4, "a b c " * 40, "a")]
    got = {r.doc_id: r for r in quality_rules.judge(frame(spark, rows)).collect()}
    assert got[1].kept and got[1].cleaned_text == clean
    assert got[2].cleaned_text == clean and got[2].n_failed_words == 30 and got[2].kept
    assert not got[3].kept and got[3].n_dup_lines == 1
    assert got[4].n_repeat_words == 120 and got[4].base_failed
    assert {r.doc_id for r in quality_rules.keep_good(frame(spark, rows)).collect()} == {1, 2}


def test_quality_of_one_long_line(spark):
    rng = random.Random(2)
    clean = " ".join(f"word{int(4000 * rng.random() ** 2)}" for _ in range(50_000))
    loop = " ".join(f"word{i % 11}" for i in range(50_000))
    half = " ".join(["same"] * 25_300 + clean.split()[:24_700])
    got = {r.doc_id: r for r in quality_rules.judge(frame(spark, [(1, clean, "a"), (2, loop, "a"), (3, half, "a")])).collect()}
    assert got[1].kept and got[1].n_failed_words == 0 and got[1].cleaned_text == clean
    assert got[2].n_failed_words == 50_000 and got[3].n_failed_words == 50_000


def jaccard_components(rows, percent):
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in rows if (w := (t or "").lower().split())}
    up = {i: i for i, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {i: find(i) for i, _ in rows}


@pytest.mark.parametrize("small", [64, 2])
def test_near_copies_equal_brute_force(spark, monkeypatch, small):
    """small=2 sends every larger bucket through the blocks."""
    monkeypatch.setattr(near_dup, "SMALL", small)
    monkeypatch.setattr(near_dup.blocked_links, "__defaults__", (4,))
    rng, rows = random.Random(2), []
    for _ in range(12):
        base = [f"t{rng.randint(0, 10**6)}" for _ in range(120)]
        for _ in range(14):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(120)] = f"e{rng.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + k, t) for k, t in enumerate(["", None, "a b", "A  b", "lone"])]
    got = {r.id: r.component_id for r in near_dup.group(frame(spark, [(i, t, "s") for i, t in rows]), percent=85).collect()}
    assert got == jaccard_components(rows, 85)


def test_superminhash_estimates_jaccard():
    a = near_dup.mix(np.arange(1000, dtype=np.uint64))
    sigs = near_dup.superminhash([a[:800], a[200:], a[:3], a[:3]])
    assert abs((sigs[0] == sigs[1]).mean() - 0.6) < 0.12 and (sigs[2] == sigs[3]).all()


def test_contract_long_chain(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert len({r.root for r in near_dup.contract(edges).collect()}) == 1
    assert near_dup.contract(edges.where("false")).count() == 0


def test_languages(spark):
    rows = [(i, ("the cat and the dog in that house " if i % 2 else "der hund und die katze in dem haus ") * 3, "a") for i in range(20)]
    docs = frame(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "en").otherwise("de"))
    got = language_id.identify(docs.unionByName(frame(spark, [(90, "123 !", "a"), (91, None, "a")])), docs).collect()
    assert all(r.lang_pred == ("und" if r.doc_id >= 90 else "en" if r.doc_id % 2 else "de") and 0 <= r.score <= 1 for r in got)


def rank_order(docs, learned, top):
    """Language and score by the definition: lists of n-grams, places looked up one by one."""

    def grams(text):
        kept = "".join(c if c.isalpha() else " " for c in (text or "").lower())
        found = Counter()
        for word in kept.split():
            padded = f" {word} "
            found.update(g for k in (1, 2, 3) for i in range(len(padded) - k + 1) if (g := padded[i : i + k]) != " ")
        return found

    order = lambda g: tuple(map(ord, g.rjust(3, "\0")))
    first = lambda n: [g for g, _ in sorted(n.items(), key=lambda x: (-x[1], order(x[0])))][:top]
    counts = {}
    for text, lang in learned:
        if text is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(grams(text))
    places = {lang: {g: i for i, g in enumerate(first(n))} for lang, n in sorted(counts.items()) if n}
    out = []
    for text in docs:
        own = first(grams(text))
        far = {lang: sum(abs(p[g] - i) if g in p else top for i, g in enumerate(own)) for lang, p in places.items()}
        best = min(far, key=lambda lang: (far[lang], lang)) if own and far else None
        out.append(("und", 0.0) if best is None else (best, 1 - far[best] / (top * len(own))))
    return out


@pytest.mark.parametrize("top", [12, 300])
def test_languages_equal_plain_rank_order(spark, top):
    rng = random.Random(top)
    letters = {"aa": "abcde", "bb": "cdefg", "cc": "äöüab", "dd": "日本語ab"}
    text = lambda lang: " ".join("".join(rng.choices(letters[lang], k=rng.randint(1, 5))) for _ in range(rng.randint(1, 12)))
    rows = [(i, text(lang), lang) for i, lang in enumerate(rng.choices([*letters], k=120))]
    rows += [(200, None, "aa"), (201, "12 !", "bb"), (202, text("aa"), None), (203, "a", "ee"), (204, "a", "ff"), (205, LONG, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs, docs, top=top).collect()}
    want = dict(zip([r[0] for r in rows], rank_order([r[1] for r in rows], [r[1:] for r in rows], top), strict=True))
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(got[k][1] == pytest.approx(want[k][1]) for k in want)


def test_line_dedup_counts_per_host(spark):
    rows = [(i, f"own line {i}\nMenu" + ("\n\nrare" if i < 3 else ""), "h") for i in range(100)] + [(200, "Menu", "g"), (201, None, "h")]
    got = {r.doc_id: r for r in line_dedup.drop_boilerplate(frame(spark, rows)).collect()}
    assert got[5].cleaned_text == "own line 5" and got[1].cleaned_text == "own line 1\n\nrare"
    assert got[200].cleaned_text == "Menu" and got[201].cleaned_text is None


def planted(seed):
    """Documents of three hosts, and their templates: lines on a known share of the pages, beside stock lines met by chance."""
    rng, rows, templates = random.Random(seed), [], set()
    for host, pages, shares in (
        ("large", 6000, (0.0015, 0.003, 0.01, 0.02, 0.049, 0.2)), ("middle", 600, (0.01, 0.02, 0.049, 0.2)), ("small", 60, (0.1, 0.2)),
    ):
        text = [[f"own {host} {i}"] for i in range(pages)]
        for share in shares:
            templates.add((host, f"template {share}"))
            for i in rng.sample(range(pages), round(share * pages)):
                text[i].append(f"template {share}")
        for i in range(pages):
            text[i].append(f"stock {rng.randrange(3 * pages)}")
        rows += [(len(rows) + i, "\n".join(t), host) for i, t in enumerate(text)]
    return rows, templates


def test_line_dedup_finds_planted_lines(spark):
    rows, templates = planted(6)
    templates = {(h, t) for h, t in templates if float(t.split()[1]) > line_dedup.RATIO}
    dropped = set()
    for r in line_dedup.drop_boilerplate(frame(spark, rows)).collect():
        dropped |= {(r.source, x) for x in set(rows[r.doc_id][1].split("\n")) - set(r.cleaned_text.split("\n"))}
    assert templates <= dropped  # all above the ratio
    assert len(templates) >= 0.9 * len(dropped)  # precision


def test_line_dedup_counts_texts_not_copies(spark):
    """A text copied a hundred times in a host keeps its lines; a line on many different texts goes."""
    rows = [(i, "copied line\nsecond copied line", "h") for i in range(100)] + [(100 + i, f"own {i}\nFooter", "h") for i in range(40)]
    schema = "doc_id long, text string, source string, _host string, _key string, _lines string, n_lines string"
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], schema)
    got = {r.doc_id: r for r in line_dedup.drop_boilerplate(docs).collect()}
    assert got[5].cleaned_text == rows[5][1] and got[110].cleaned_text == "own 10" and got[110]._host == "a" and got[110].n_dropped == 1
    kept = line_dedup.without_boilerplate(docs)
    assert kept.columns == docs.columns and {r._lines for r in kept.collect()} == {"c"}


def test_html_layout():
    page = ('<title>no</title><style>x</style><p>One <b>two</b>\n three<p>Four<ul><li>a<li>b<ol><li>c</ol></ul>'
            '<div hidden>no</div><table><tr><th>Name<th>N<tr><td>alpha<td>1</table>end &lt; <script>"</p>"</script>x')  # fmt: skip
    assert html_text.visible_text(page) == (
        "One two three\n\nFour\n\n- a\n- b\n  1. c\n\nName   N\nalpha  1\n\nend < x")
    assert html_text.visible_text(None) is None and html_text.visible_text("") == ""
    assert html_text.visible_text("<div>" * 5000 + "deep < x") == "deep < x"


@pytest.mark.parametrize("page, text", [
    ("<p title=don't>It's visible</p> rest", "It's visible\n\nrest"),
    ('<a href="x"">Click</a> on', "Click on"),
    ('<a href="x>Click</a> on', "Click on"),
    ("<p a\"b=c'd>one \"two\"</p>", 'one "two"'),
    ('<a title = "1>2" b>t</a><p style="display: none">no</p>', "t"),
])
def test_html_stray_quotes(page, text):
    assert html_text.visible_text(page) == text


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, rng.integers(-3, 4, 8) / 7) for i in range(300)]
    rows = [(i, v.tolist()) for i, v in vectors] + [(50_000, None), (400, [float("nan")] * 8), (450, [1.0, None])]
    got = vector_search.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 50 == 0).collect()
    ints = {i: np.floor(256 * v).astype(int) for i, v in vectors}
    for q in range(0, 300, 50):
        want = sorted(((-int(ints[q] @ v), i) for i, v in ints.items() if i != q))[:5]
        assert [(r.rank, r.id, r.score) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == [
            (k, i, -s) for k, (s, i) in enumerate(want, 1)]
    assert {r.query_id for r in got} == set(range(0, 300, 50))


SEARCHED = "vec_id long, embedding array<double>, query_id string, score string, rank string, v string"


def searched(spark, rows, k=5):
    """Answers over vectors with extra columns whose names clash."""
    return vector_search.search(spark.createDataFrame([(i, v, "old", "old", "old", "old") for i, v in rows], SEARCHED),
                                F.col("id") % 50 == 0, k).collect()


@pytest.mark.parametrize("scale", [2.0**20, 2.0**40, 2.0**54, 1e300])
def test_search_of_large_components(spark, scale):
    """Finite components of any size take part; ranks are exact, scores NULL only beyond the long range."""
    rng = np.random.default_rng(11)
    rows = [(i, [float(x) * scale / 8 if j else float(x) for j, x in enumerate(rng.integers(-8, 9, 4))]) for i in range(120)]
    rows += [(200, [scale, 1.0, 0.0, 0.0]), (201, [float("inf")] * 4), (250, [float("-inf"), 0.0, 0.0, 0.0])]
    ends = -(2**63), 2**63 - 1
    ints = {i: [min(max(math.floor(c * 256) if abs(c) < 1e290 else int(c), ends[0]), ends[1]) for c in v] for i, v in rows if all(map(math.isfinite, v))}
    got = searched(spark, rows)
    for q in (0, 50, 100, 200):
        want = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q)[:5]
        mine = sorted((r.rank, r.id, r.score) for r in got if r.query_id == q)
        assert mine == [(k, i, -s if -(2**63) <= -s < 2**63 else None) for k, (s, i) in enumerate(want, 1)]
    assert {r.query_id for r in got} == {0, 50, 100, 200}


def test_search_of_odd_rows(spark):
    rng = np.random.default_rng(12)
    copies = [(i, [0.5, 0.25]) for i in range(400)]  # one vector, a large part of the table
    rows = copies + [(i, rng.normal(size=2).tolist()) for i in range(400, 460)] + [(450, [9.0, 9.0]), (None, [99.0, 99.0]), (500, [])]
    rows += [(600, [1.0, 2.0, 3.0]), (601, [3.0, 2.0, 1.0]), (650, None)]
    got = searched(spark, rows)
    ints = {}
    for i, v in rows:
        if i is not None and v:
            x = tuple(math.floor(256 * c) for c in v)
            ints[i] = min(ints.get(i, x), x)  # of a repeated id the smallest vector
    for q in range(0, 651, 50):
        if q not in ints:
            assert not [r for r in got if r.query_id == q]
            continue
        want = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q and len(v) == len(ints[q]))
        assert sorted((r.rank, r.id, r.score) for r in got if r.query_id == q) == [(k, i, -s) for k, (s, i) in enumerate(want[:5], 1)]
    assert len([r for r in got if r.query_id == 600]) == 1  # fewer candidates than k


def test_bounds_hold():
    rng = np.random.default_rng(4)
    v, q = rng.integers(-300, 300, (50, 6)), rng.integers(-300, 300, (9, 6))
    low = v.min(axis=0).astype(float)
    width = (v.max(axis=0) - low) / 16
    lower, upper = vector_search.bounds(None, np.minimum((v - low) / width, 15).astype(np.uint8), low, width, q)
    assert (lower <= q @ v.T).all() and (q @ v.T <= upper).all()


def test_resampling(spark):
    rows = [(i, ("good plain words " if i % 3 else "### junk $$$ ") * (1 + i % 9), "a") for i in range(300)]
    docs = frame(spark, rows).withColumn("good", F.col("doc_id") % 3 > 0)
    got = resampling.resample(docs, F.col("good"), keep_percent=50).collect()
    assert sum(r.kept for r in got) == 150 and all(r.id % 3 for r in got if r.kept)
    assert min(r.sample_key for r in got if r.kept) >= max(r.sample_key for r in got if not r.kept)


def test_log_weights_equal_a_plain_model(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices("Aa bb cc dd ee".split(), k=rng.randint(0, 8))) if i else None, "a") for i in range(60)]
    docs = frame(spark, rows).repartition(4)
    buckets = 1 << 20  # so many that no two n-grams share one
    counts = resampling.bucket_counts(docs, "text", F.when(F.col("doc_id") != 5, F.col("doc_id") % 3 == 0), buckets)
    ratios = resampling.log_ratios([tuple(r) for r in counts.where("n_raw > 0").collect()], buckets)
    got = {r.doc_id: r.log_weight for r in resampling.log_weights(docs, ratios).collect()}

    def grams(text):
        w = (text or "").lower().split()
        return [*w, *zip(w, w[1:])]

    raw, target = Counter(), Counter()
    for i, text, _ in rows:
        raw.update(grams(text))
        target.update(grams(text) if i % 3 == 0 else [])
    size = lambda n: sum(n.values()) + buckets
    for i, text, _ in rows:
        want = sum(math.log((target[g] + 1) / size(target)) - math.log((raw[g] + 1) / size(raw)) for g in grams(text))
        assert got[i] == pytest.approx(want, abs=1e-9)


def test_target_marks(spark):
    docs = frame(spark, [(i % 10, "x", "a") for i in range(30)] + [(None, "x", "a")])
    ids = spark.createDataFrame([(i,) for i in (1, 1, 2, 3, 4, 77, None)], "good long")
    every = resampling.marked_target(docs, ids)
    assert every.count() == 31 and {r.doc_id for r in every.where("_target").collect()} == {1, 2, 3, 4}
    few = resampling.marked_target(docs, ids.where("good < 70"), rows=2)
    assert few.count() == 31 and few.where("_target").select("doc_id").distinct().count() == 2


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def test_pieces_round_trip(vocabulary):
    texts = ["", " ", "a", "Hello  world\n\tx", "▁ ▁▁", "日本語 🎉 \x00", "z" * 3000, LONG[:5000]]
    a = pieces.encode(texts, list(range(8)), vocabulary)
    b = pieces.encode(texts[::-1], list(range(8))[::-1], vocabulary)[::-1]
    assert all((x == y).all() for x, y in zip(a, b, strict=True))
    lists = pa.array([*a, None], pa.list_(pa.int32()))
    assert pieces.decode(lists, vocabulary).to_pylist() == [*texts, None]
    assert pieces.decode(lists.slice(3, 4), vocabulary).to_pylist() == texts[3:7]
    assert pieces.decode(lists.slice(0, 1), vocabulary).to_pylist() == [""]
    assert pieces.decode(lists.slice(8), vocabulary).to_pylist() == [None]


def test_pieces_follow_their_weights(vocabulary):
    graph = pieces.lattice(["▁other"], vocabulary)
    into = {}
    for node in range(1, 7):
        for e in range(graph.first[node], graph.first[node + 1]):
            into.setdefault(node, []).append((int(graph.start[e]), int(graph.piece[e])))
    weight = {int(p): w for p, w in zip(vocabulary.piece, vocabulary.weight, strict=True) if p >= 0}

    def ways(node):
        return [((), 0.0)] if node == 0 else [(s + (p,), w + weight[p]) for a, p in into[node] for s, w in ways(a)]

    chance = {s: math.exp(w) for s, w in ways(6)}
    keys = near_dup.mix(np.arange(20_000, dtype=np.uint64))
    out, count = pieces.sample(graph, np.zeros(20_000, np.int64), keys)
    seen = Counter(map(tuple, np.split(out, np.cumsum(count)[:-1])))
    for s, c in chance.items():
        assert abs(seen[tuple(s)] / 20_000 - c / sum(chance.values())) < 0.02


def test_toxicity_learns_and_ignores_order(spark):
    rng = random.Random(5)
    word = lambda: f"w{rng.randint(0, 300)}"
    rows, labels = [], []
    for i in range(400):
        w = [word() for _ in range(30)]
        if i % 4 == 0:
            w[rng.randrange(30)] = rng.choice(["vilea", "vileb", "vilec"])
        rows.append((i, " ".join(w), "a"))
        labels.append((i, int(i % 4 == 0)))
    docs, labelled = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    net = toxicity.fit(toxicity.labelled_sample(docs, labelled, F.col("id") < 300))
    held = [r for r in toxicity.score(docs, net).collect() if r.doc_id >= 300]
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.95
    odd = toxicity.score(frame(spark, ODD), net).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    empty = toxicity.fit(toxicity.labelled_sample(docs, labelled.where("false"), F.lit(True)))
    assert toxicity.score(docs, empty).count() == 400


def test_toxicity_gathers_arrow_and_trains_in_few_tasks(spark, monkeypatch):
    docs = frame(spark, [(i, f"vile word{i % 9}" if i % 4 == 0 else f"kind word{i % 7}", "a") for i in range(200)])
    labels = spark.range(200).selectExpr("id AS doc_id", "CAST(id % 4 = 0 AS int) AS toxic")
    sample = toxicity.labelled_sample(docs.repartition(12), labels, F.lit(True))
    monkeypatch.setattr(type(docs), "toPandas", lambda self: pytest.fail("an object for every value"))
    with settings(spark, {"spark.sql.execution.arrow.pyspark.enabled": "false"}):
        net = toxicity.fit(sample)
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in toxicity.score(docs, net).collect()]) == 1
    parts = lambda size: toxicity._in_tasks(docs.repartition(40), size).rdd.getNumPartitions()
    assert (parts(0), parts(20 * toxicity.TASK_BYTES), parts(20 * toxicity.TASK_BYTES + 1), parts(1 << 50)) == (toxicity.LEAST_TASKS, 20, 21, 40)


def toxic_words(seed, n=240):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        w = [f"w{rng.randint(0, 60)}" for _ in range(rng.choice([0, 1, 2, 20]) if i % 9 == 0 else 20)]
        # harmless words apart, an insult when one follows the other
        if i % 3 == 0 and len(w) > 2:
            at = rng.randrange(len(w) - 1)
            w[at : at + 2] = ["vile", "beast"]
        out.append((" ".join(w), int(i % 3 == 0)))
    return out


def trained(rows, **how):
    cache = [toxicity.hash_words([t], {}) for t, _ in rows]
    return toxicity.train([p[w].astype(np.uint32) for _, w, p in cache], [y for _, y in rows], ["en"] * len(rows), **how)


def test_gradients_equal_differences():
    rows = toxic_words(1, 40)
    net = trained(rows, odds_start=False)
    row, words, pairs = toxicity.hash_words([t for t, _ in rows], {})
    entries, starts = toxicity._entries(net.keys, pairs[words]), toxicity._starts(row, len(rows))
    y = np.array([label for _, label in rows], float)
    weight = np.linspace(0.5, 2, len(y))

    def loss(state):
        z = toxicity.logits(toxicity._with_parameters(net, state), entries, starts)
        return float(np.mean(weight * (np.logaddexp(0, z) - y * z)))

    state = [x.copy() for x in toxicity._parameters(net)]
    grads = toxicity._gradients(net, entries, starts, y, weight)
    rng = np.random.default_rng(2)
    for x, g in zip(state, grads, strict=True):
        for i in rng.choice(x.size, min(x.size, 25), replace=False):
            at = np.unravel_index(i, x.shape)
            if x is state[0] and at[0] == 0:
                continue  # the row of unknown words is held at zero
            kept, h = x[at], 1e-6
            x[at] = kept + h
            above = loss(state)
            x[at] = kept - h
            below = loss(state)
            x[at] = kept
            assert g[at] == pytest.approx((above - below) / (2 * h), abs=1e-6)


def test_scores_of_batches_equal_plain_logits():
    rows = toxic_words(3)
    net = trained(rows)
    texts = [t for t, _ in rows] + [None, "", "vile", "vile beast", LONG, "vile beast " * 3000]
    want = []
    for t in texts:
        row, words, pairs = toxicity.hash_words([t], {})
        z = toxicity.logits(net, toxicity._entries(net.keys, pairs[words]).reshape(-1, 2), toxicity._starts(row, 1))[0]
        want.append(1 / (1 + np.exp(-(z - net.offsets[0]))))
    assert toxicity.score_texts(net, texts) == pytest.approx(want, abs=1e-4)


def test_random_start_learns_word_pairs():
    net = trained(toxic_words(4, 600), odds_start=False)
    held = toxic_words(5, 300)
    right = [(s >= 0.5) == (y == 1) for s, (t, y) in zip(toxicity.score_texts(net, [t for t, _ in held]), held) if len(t.split()) > 2]
    assert np.mean(right) > 0.95


def test_contradictory_and_repeated_labels(spark):
    docs = frame(spark, [(i, f"word{i % 5} other", "a") for i in range(20)])
    labels = spark.createDataFrame([(i, y) for i in range(20) for y in (0, i % 2, i % 2)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    sample = {r.id: r.label for r in toxicity.labelled_sample(docs, labels, F.lit(True)).collect()}
    assert sample == {i: i % 2 for i in range(20)}


def test_every_labelled_document_is_counted_and_trained_on(spark):
    n = 4000  # the first 3,000 documents alone would not tell what the last ones say
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("common "), F.when(F.col("id") % 2 == 1, "vile").otherwise("mild"),
                                 F.lit(" only"), F.col("id")).alias("text"), F.when(F.col("id") % 3 > 0, "a").alias("lang"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    sample = toxicity.labelled_sample(docs, labels, F.lit(True))
    assert sample.count() == n
    counts = toxicity._count(toxicity._hashed(sample), ["a"]).set_index("key")
    of = {w: counts.loc[toxicity.hashes(w)[0]].tolist() for w in ("common", "vile")}
    in_lang = sum(i % 3 > 0 for i in range(n))
    assert of == {"common": [n, n // 2, in_lang], "vile": [n // 2, n // 2, sum(i % 3 > 0 for i in range(1, n, 2))]}
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "30000", "spark.sql.files.openCostInBytes": "1"}):
        shared = toxicity.fit(sample)  # weights of several tasks are averaged
    assert all(r.predicted == r.doc_id % 2 for r in toxicity.score(docs, shared).collect())
    net = toxicity.fit(sample)
    assert all(r.predicted == r.doc_id % 2 for r in toxicity.score(docs, net).collect())
    again = toxicity.fit(sample.repartition(5))
    assert np.allclose(again.embedding, net.embedding) and again.offsets == pytest.approx(net.offsets, abs=0.01)


OPERATORS = {
    "mix": lambda d: mixing.mix(d),
    "judge": quality_rules.judge,
    "keep_good": quality_rules.keep_good,
    "near": near_dup.without_near_copies,
    "language": lambda d: language_id.identify(d, d),
    "lines": line_dedup.without_boilerplate,
    "html": lambda d: html_text.render(d, "text"),
    "resample": lambda d: resampling.resample(d, F.col("lang") == "en"),
    "pieces": lambda d: pieces.decode_texts(pieces.encode_texts(d, F.xxhash64("doc_id"))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(spark, name):
    rows = OPERATORS[name](frame(spark, ODD)).collect()
    if name not in ("mix", "keep_good", "near"):
        assert len(rows) == len(ODD)
    if name == "near":
        assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "3", "4", "7", "8"]
    if name == "pieces":
        assert all(r.decoded == r.text for r in rows)
    assert OPERATORS[name](frame(spark, [])).collect() == []


def test_empty_search(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert vector_search.search(none, F.col("id") % 50 == 0).collect() == []


def test_pipeline_stages(spark):
    rng = random.Random(6)
    text = lambda: "\n".join(" ".join(f"v{rng.randint(0, 5000)}" for _ in range(12)) + "." for _ in range(8))
    rows = [(i, text(), f"s{i % 2}") for i in range(40)]
    rows += [(40, rows[0][1], "s0"), (41, " ".join(f"{w}!!" for w in rows[1][1].split()), "s1"), (42, None, "s1")]
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    ids = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        ids.append((name, sorted(r.doc_id for r in docs.select("doc_id").collect())))
        if name != "piece_sampling":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert ids[0][1] == [*range(41)] and ids[1][1] == [*range(41)] and ids[2][1] == [*range(40)]
    assert set(ids[3][1]) <= set(range(40)) and ids[3][1] == ids[4][1]
    assert all(r.decoded == r.text for r in docs.collect())


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, name, stage):
    clash = frame(spark, ODD).withColumns({c: F.lit("old") for c in ("_w", "_n", "_lines", "_host", "_key", "n_words", "row_key", "comp")})
    got = stage(spark, clash, "")
    rows = got.collect()
    assert stage(spark, clash.where("false"), "").collect() == []
    if name != "piece_sampling":
        assert got.columns == clash.columns and all(r["_w"] == "old" and r.score == "old" for r in rows)
    # texts without words, or with few, fail the base rules; only equal texts are near copies; lines and pieces keep all
    expected = {"quality_rules": [4, 5], "line_dedup": [1, 2, 3, 4, 5, 7, 7, 8, None], "piece_sampling": [1, 2, 3, 4, 5, 7, 7, 8, None]}
    ids = sorted((r.doc_id for r in rows), key=lambda i: (i is None, i))
    if name in expected:
        assert ids == expected[name]
    if name == "near_dedup":
        assert [i for i in ids if i in (1, 2, 3, 8)] == [1, 2, 3, 8] and len(ids) == 6
    if name == "mix_sources":
        # sources without a word take nothing; elsewhere a text without words is copied like its neighbours
        assert set(ids) <= {3, 4, 5, 7, 8, None}
