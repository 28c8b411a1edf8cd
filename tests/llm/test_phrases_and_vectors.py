"""Collocations, the multi-index and whitening against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from cases import documents, empty, lower, row
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidestar.llm import collocations, multi_index, whitening

# --- collocations


def brute_collocations(docs, least, share, best):  # noqa: ANN001, ANN201
    f, n, holders = defaultdict(Counter), Counter(), defaultdict(set)
    for doc_id, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
                    holders[lang, tuple(words[i : i + k])].add(doc_id)
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found, held = [], Counter()
        for q, a in candidates.items():
            for k in range(2, len(q)):
                for i in range(len(q) - k + 1):
                    held[q[i : i + k]] = max(held[q[i : i + k]], a)
        for p, a in candidates.items():
            if 100 * held[p] >= share * a:
                continue
            cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), left, right, p))
        for rank, (score, a, phrase, left, right, _) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out), holders


def got_collocations(docs, least, share=80, best=2000):  # noqa: ANN001, ANN201
    rows = collocations.collocations(docs, least, share, best).collect()
    return sorted(tuple(r)[:8] for r in rows), {(r.lang, tuple(r.phrase.split(" "))): r.doc_id for r in rows}


def test_stored_hashes_are_read_and_sent_in_small_parts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 50_000)
    texts = spark.createDataFrame([(f"en{i % 2}", f"w{i} a b " * 4000) for i in range(120)], "lang string, text string").coalesce(1)
    words = collocations.hashed(texts)
    files = [pq.ParquetFile(f.removeprefix("file:").replace("//", "/")).metadata for f in words.inputFiles()]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == words.count() > 100
    assert max(g.num_rows for g in groups) <= 16  # one group of all rows before: a reader unfolds it as a whole
    assert words.agg(F.sum("n")).first()[0] == 120 * 3 * 4000
    monkeypatch.setattr(collocations, "SENT", 3)
    monkeypatch.setattr(collocations, "HELD", 50_000)
    marked = collocations.Bitmap(collocations.frequent_prints(words, 1, None, 200_000))  # a and b: 240,000 in each language
    print_of = collocations.Prints()
    for lang in ("en0", "en1"):
        hashes = [np.array([xxhash.xxh3_64_intdigest(w)], np.uint64) for w in (b"a", b"b", b"w7")]
        assert [bool(marked(print_of(h, lang, 1)[0])[0]) for h in hashes] == [True, True, False]


def test_collocations_of_awkward_documents(spark):
    extra = [row(60, "New York\tis big; new york is Big!\x0bnew york\x0cnew york\rnew york"), row(61, "é É é É a\x1cb a\x1cb a\x1cb", "und"), row(62, "é É é É", None)]
    docs = documents(spark).unionByName(spark.createDataFrame([e for e in extra], documents(spark).schema)).repartition(5)
    plain = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    for least, best in ((2, 40), (3, 2000)):
        want, holders = brute_collocations(plain, least, 80, best)
        got, pointers = got_collocations(docs, least, best=best)
        assert got == want and len(want) > 30
        assert all(p is None or p in holders[key] for key, p in pointers.items())
    assert collocations.collocations(empty(spark)).count() == 0
    assert collocations.collocations(docs.where("doc_id in (3, 4, 5)")).count() == 0


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="aAbc .,\n\t", max_size=60), st.sampled_from(["x", "y", None])), max_size=12))
def test_collocations_of_random_texts(spark, texts):
    docs = [(i, t, lang) for i, (t, lang) in enumerate(texts)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    assert got_collocations(frame, 2)[0] == brute_collocations(docs, 2, 80, 2000)[0]


def test_words_that_share_a_fingerprint_are_told_apart_by_the_text():
    held = [w.encode() for w in "a b a b c d a b c d e f".split()]
    words = collocations.Words()
    serial = np.array([words[w] for w in held])
    places = np.arange(len(held) - 1)
    phrases, n, where = collocations.counted(held, serial, np.zeros(len(places), np.uint64), places, 2)
    want = Counter(b" ".join(held[i : i + 2]) for i in places)
    assert dict(zip(phrases, n.tolist(), strict=True)) == want
    assert all(b" ".join(held[p : p + 2]) == w for w, p in zip(phrases, where, strict=True))


def test_the_bitmap_holds_every_frequent_fingerprint(spark):
    r = random.Random(5)
    prints = [r.randrange(-(2**63), 2**63) for _ in range(3000)] + [0, -1, 2**63 - 1, -(2**63)]
    frame = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    held = collocations.Bitmap(collocations.bitmap(frame))
    assert held(np.array(prints, np.int64).view(np.uint64)).all()
    others = np.array([r.randrange(2**64) for _ in range(20_000)], np.uint64)
    assert held(others).mean() < 0.01


# --- nearest neighbours


EMBEDDINGS = "vec_id bigint, embedding array<float>, label int, id bigint, members int, first int, hits int, query int"


def vectors(spark, rows):  # noqa: ANN001, ANN201
    return spark.createDataFrame([(i, v, 0, 1, 1, 1, 1, 1) for i, v in rows], EMBEDDINGS)


def awkward(seed=1, width=6):  # noqa: ANN001, ANN201
    r = np.random.default_rng(seed)
    rows = [(i, r.normal(size=width).astype(np.float32).tolist()) for i in range(200)]
    copy, turned = rows[50][1], [2 * x for x in rows[50][1]]
    rows += [(1000 + i, copy) for i in range(40)] + [(2000 + i, turned) for i in range(8)]
    rows += [(100, rows[100][1]), (100, rows[7][1]), (None, copy), (None, rows[3][1]), (150, None), (3000, [0.0] * width)]
    rows += [(3050, [1.0, None] + [0.0] * (width - 2)), (3100, [float("nan")] + [1.0] * (width - 1)), (3150, [math.inf] + [0.0] * (width - 1))]
    return rows + [(3200, [1.0, 2.0]), (3250, [1e-30] * width), (3300, [3e38] * width), (3350, [])]


def brute_neighbours(rows, every, count):  # noqa: ANN001, ANN201
    rows = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    width = max(len(v) for _, v in rows)
    unit = np.array([list(map(float, np.float32(v))) + [0.0] * (width - len(v)) for _, v in rows])
    unit /= np.abs(unit).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    out = []
    for at, (i, _) in enumerate(rows):
        if i is not None and i % every == 0:
            near = np.round(unit @ unit[at], 9)
            others = sorted((-near[j], k is None, k or 0, j) for j, (k, _) in enumerate(rows) if j != at)[:count]
            out.append((i, [(None if missing else k, -s) for s, missing, k, _ in others]))
    return out


def answers(df):  # noqa: ANN001, ANN201
    """Answers by query; those of rows that repeat an id lie one after another."""
    found = defaultdict(list)
    for r in df.collect():
        found[r.query_id].append((r.rank, r.vec_id, round(r.score, 9)))
    return found


def test_neighbours_of_awkward_vectors(spark):
    rows = awkward()
    frame = vectors(spark, rows).repartition(4)
    got = answers(multi_index.neighbours(frame, reach=1.0))
    want = defaultdict(list)
    for i, found in brute_neighbours(rows, 50, 5):
        want[i] += [(rank, k, s) for rank, (k, s) in enumerate(found, 1)]
    assert {i: Counter(v) for i, v in got.items()} == {i: Counter(v) for i, v in want.items()}
    assert 150 in got and 3000 not in got and 3350 not in got


def test_few_or_no_candidates(spark):
    few = vectors(spark, [(0, [1.0, 0.0]), (1, [0.6, 0.8]), (50, [0.0, 1.0])])
    got = answers(multi_index.neighbours(few))
    assert [k for _, k, _ in sorted(got[0])] == [1, 50] and [k for _, k, _ in sorted(got[50])] == [1, 0]
    assert multi_index.neighbours(vectors(spark, [(0, [1.0])])).count() == 0
    assert multi_index.neighbours(few.limit(0)).count() == 0
    assert multi_index.neighbours(vectors(spark, [(0, None), (50, [0.0]), (100, [])])).count() == 0


@pytest.mark.parametrize("scale", ["0.01", "0.1"])
def test_recall(spark, scale):
    frame = spark.read.parquet(f"{SMALL.replace('0.001', scale)}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in frame.collect()]
    want = dict(brute_neighbours(rows, 50, 5))
    got = answers(multi_index.neighbours(frame))
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = sum(len({k for _, k, _ in got[i]} & {k for k, _ in want[i]}) for i in want)
    assert hits >= 0.9 * 5 * len(want)
    exact = {(i, k): s for i in want for k, s in want[i]}
    assert all(abs(s - exact[i, k]) < 1e-8 for i in got for _, k, s in got[i] if (i, k) in exact)


def test_pairs_of_centroids_are_seen_by_summed_distance():
    r = np.random.default_rng(3)
    one, two, counts = r.random(9), r.random(7), r.integers(0, 5, (9, 7))
    total = one[:, None] + two[None, :]
    for goal in (0, 1, 20, counts.sum(), counts.sum() + 1):
        marked = multi_index.seen(one, two, counts, goal)
        held = counts[marked].sum()
        assert held >= min(goal, counts.sum())
        if marked.any():
            assert total[marked].max() <= total[~marked].min(initial=np.inf)
            assert goal <= 0 or held - counts[total == total[marked].max()].sum() < goal


# --- whitening


def brute_whitening(rows):  # noqa: ANN001, ANN201
    rows = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width, n = max(len(v) for _, v in rows), len(rows)
    x = [[min(max(math.floor(1024 * float(np.float32(c))), -(2**53)), 2**53) + 100_000 for c in v] + [100_000] * (width - len(v)) for _, v in rows]
    sums = [sum(column) for column in zip(*x, strict=True)]
    d = [[n * a - s for a, s in zip(r, sums, strict=True)] for r in x]
    squares = [sum(c * c for c in r) for r in d]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in d), n**3)) for j in range(width)] for i in range(width)])
    values, ways = np.linalg.eigh(cov)
    z = np.array([[float(Fraction(c, n)) for c in r] for r in d])
    return [i for i, _ in rows], squares, values[::-1], ways[:, ::-1], z


def check_whitening(rows, got, count=8):  # noqa: ANN001, ANN201
    ids, squares, values, ways, z = brute_whitening(rows)
    count = min(count, len(values))
    table = defaultdict(list)
    for r in got:
        table[r.component].append(r)
    assert sorted(table) == list(range(1, count + 1))
    for k, found in table.items():
        want = z @ ways[:, k - 1] / np.sqrt(values[k - 1])
        by = sorted(zip(ids, squares, want, strict=True), key=lambda t: (str(t[0]), t[1]))
        found = sorted(found, key=lambda r: (str(r.vec_id), r.deviation if r.deviation is not None else 2**99))
        assert [(r.vec_id, r.n) for r in found] == [(i, len(ids)) for i, _, _ in by]
        assert [r.deviation for r in found] == [s if s < 2**63 else None for _, s, _ in by]
        mine = np.array([r.whitened for r in found])
        theirs = np.array([w for _, _, w in by])
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-6
        assert abs(found[0].explained - values[k - 1] / values.sum()) < 1e-9
    assert {r.identity_error for r in got} != {None} and max(r.identity_error for r in got) < 1e-4
    assert len({r.identity_error for r in got}) == 1


def test_whitening_of_awkward_vectors(spark):
    rows = [r for r in awkward(2, 11) if r[0] != 3300]
    got = whitening.whiten(vectors(spark, rows).repartition(5)).collect()
    check_whitening(rows, got)
    assert Counter(r.vec_id for r in got if r.component == 1)[3000] == 1  # a zero vector is a vector
    rows = [(i, [x * (1e4 if i % 7 == 0 else 1) for x in v]) for i, v in awkward(3, 5) if i is not None and i < 100]
    check_whitening(rows, whitening.whiten(vectors(spark, rows).repartition(3)).collect())


def test_whitening_of_real_vectors(spark):
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in frame.collect()]
    check_whitening(rows, whitening.whiten(frame).collect())


def test_whitening_without_variance(spark):
    one = whitening.whiten(vectors(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.component, r.whitened, r.explained, r.deviation, r.identity_error) for r in one] == [(1, None, None, 0, None), (2, None, None, 0, None)]
    flat = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 3.0]), (3, [1.0, 4.0])])).collect()
    assert {(r.component, r.whitened is None, r.explained) for r in flat} == {(1, False, 1.0), (2, True, 0.0)}
    assert whitening.whiten(vectors(spark, [(1, None), (2, [None]), (3, [])])).count() == 0
    assert whitening.whiten(vectors(spark, [])).count() == 0
    with pytest.raises(ValueError):
        whitening.whiten(vectors(spark, [(1, [0.0] * 5000)]))
