"""Mixing, sharding, embeddings, conversations and the pipeline against brute force."""

from __future__ import annotations

from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from cases import documents, empty, row, smallest_reachable
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tidestar.llm import bpe, components, forest, grid, lookup, mixing, queries, quotes, robust

# --- components


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, links):
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.component for r in components.components(frame).collect()}
    nodes = {x for link in links if link[0] != link[1] for x in link}
    assert got == smallest_reachable(nodes, [k for k in links if k[0] != k[1]])


# --- mixing


def brute_rates(members, domains, targets):  # noqa: ANN001, ANN201
    """A hundred plain projected gradient steps."""
    n = np.array([m.n_tokens for m in members], float)
    p = np.array([m.p for m in members])
    gram = (p * n[:, None]).T @ p
    inverse = np.linalg.pinv(gram)
    want = np.array([targets.get(d, 0.0) for d in domains])
    want = n.sum() * want / want.sum()
    r = np.ones(len(n))
    for _ in range(100):
        r = np.maximum(0, r - p @ (inverse @ ((p * (n * r)[:, None]).sum(axis=0) - want)))
    residual = (p * (n * r)[:, None]).sum(axis=0) - want
    return r, residual @ inverse @ residual


@pytest.mark.parametrize("targets", [mixing.TARGETS, {2: 1.0}, {0: 0.5, 1: 0.5}, {3: 0.9, 2: 0.1}])
def test_rates_fit_the_targets_as_well_as_plain_steps(spark, targets):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = mixing.classifier(docs, labels)
    members = mixing.posteriors(docs, model)
    rows = members.collect()
    steps = mixing.fit(members, model[0], targets)
    rate = np.array([r for (r,) in members.select(mixing.rate(steps, len(model[0]))).collect()])
    assert (rate >= 0).all()
    n, p = np.array([m.n_tokens for m in rows], float), np.array([m.p for m in rows])
    want = np.array([targets.get(d, 0.0) for d in model[0]])
    residual = (p * (n * rate)[:, None]).sum(axis=0) - n.sum() * want / want.sum()
    misfit = residual @ np.linalg.pinv((p * n[:, None]).T @ p) @ residual
    assert misfit <= brute_rates(rows, model[0], targets)[1] + 1e-9 * n.sum()


def test_membership_is_that_of_the_labels(spark):
    folder = SMALL.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    learned, tested = labels.where("doc_id % 5 > 0"), labels.where("doc_id % 5 = 0")
    domains, priors, logs = mixing.classifier(docs, learned)
    got = mixing.posteriors(docs, (domains, priors, logs)).join(tested, "doc_id").collect()
    right = [domains[int(np.argmax(r.p))] == r.quality * 2 + r.toxic for r in got]
    assert np.mean(right) > 0.82 and all(abs(sum(r.p) - 1) < 1e-9 for r in got)


def test_mixing_of_awkward_documents(spark):
    docs = documents(spark)
    rows = [(10, 1, 0), (11, 0, 0), (12, 1, 1), (12, 1, 1), (None, 1, 0), (13, None, 0), (14, 5, 5), (3, 0, 0)]
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    got = mixing.mix(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in docs.collect())
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {0}
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) and abs(sum(r.membership) - 1) < 1e-9 for r in got)
    none = mixing.mix(docs, labels.limit(0)).collect()
    assert {r.rate for r in none} == {1.0} and {r.copies for r in none} == {1}
    assert {r.rate for r in mixing.mix(docs, labels, {}).collect()} == {1.0}
    assert mixing.mix(empty(spark), labels).count() == 0
    again = mixing.mixed_documents(docs, labels)
    assert again.columns == docs.columns
    times = {r.doc_id: max(x.copies for x in got if x.doc_id == r.doc_id) for r in got}
    assert Counter(r.doc_id for r in again.collect()) == Counter({r.doc_id: 0 for r in got}) + Counter({k: v * [r.doc_id for r in got].count(k) for k, v in times.items()})


def test_mixing_runs_no_python(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    plan = mixing.mix(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- sharding


def test_lookup_table_is_even_and_changes_little():
    names = [f"shard-{i:02d}" for i in range(32)]
    table = lookup.lookup_table(names)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1
    without = lookup.lookup_table([n for i, n in enumerate(names) if i != 5])
    kept = [a for a in range(len(table)) if table[a] != 5]
    moved = sum(names[table[a]] != [n for i, n in enumerate(names) if i != 5][without[a]] for a in kept)
    assert moved < 0.1 * len(table)
    with pytest.raises(ValueError):
        lookup.lookup_table(names, 5000)
    with pytest.raises(ValueError):
        lookup.lookup_table(["a", "a"])


def test_lookup_of_awkward_documents(spark):
    docs = documents(spark)
    table = lookup.lookup_table(["a", "b", "c"], 101)
    got = lookup.place(docs, "doc_id", ["a", "b", "c"], 101)
    assert sorted(got.columns) == sorted(docs.columns)
    want = Counter((r.doc_id, lookup.number("" if r.doc_id is None else str(r.doc_id)) % 101) for r in docs.collect())
    assert Counter((r.doc_id, r.slot) for r in got.collect()) == want
    assert all(r.shard == "abc"[table[r.slot]] for r in got.collect())
    assert lookup.place(empty(spark), "doc_id", ["a"], 101).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracles(spark, name):
    con = duckdb.connect()
    for name_ in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {name_} AS SELECT * FROM '{SMALL}/{name_}.parquet'")
    df = queries.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE[name]})").fetchall()
    assert Counter(map(tuple, df.select(*columns).collect())) == Counter(want)


# --- embeddings


def brute_links(rows, threshold):  # noqa: ANN001, ANN201
    good = [r.embedding is not None and None not in r.embedding and bool(np.isfinite(np.array(r.embedding, float)).all()) and any(r.embedding) for r in rows]
    width = max((len(r.embedding) for r in rows if r.embedding), default=1)
    unit = [np.pad(np.array(r.embedding, float), (0, width - len(r.embedding))) if ok else np.zeros(width) for r, ok in zip(rows, good, strict=True)]
    unit = [u / np.abs(u).max() / np.linalg.norm(u / np.abs(u).max()) if ok else u for u, ok in zip(unit, good, strict=True)]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if good[i] and good[j] and float(unit[i] @ unit[j]) >= threshold]
    n = Counter(x for link in links for x in link)
    group = smallest_reachable(range(len(rows)), links)
    least = defaultdict(list)
    for i, g in group.items():
        if rows[i].vec_id is not None:
            least[g].append(rows[i].vec_id)
    return Counter((r.vec_id, n[i], min(least[group[i]], default=None)) for i, r in enumerate(rows))


def vectors(spark, kind="float"):  # noqa: ANN001, ANN201
    r = np.random.default_rng(11)
    rows = []
    for cluster in range(12):
        base = r.normal(size=8)
        rows += [(100 * cluster + i, (base + r.normal(size=8) * 0.25).tolist()) for i in range(40)]
    rows += [(5000 + i, rows[0][1]) for i in range(30)]  # copies
    rows += [(6000, [x * 3 for x in rows[0][1]]), (6001, [-x for x in rows[0][1]]), (6002, rows[0][1][:5]), (6003, rows[0][1][:5])]
    rows += [(7000, None), (7001, [0.0] * 8), (7002, [float("nan")] + [1.0] * 7), (7003, [float("inf")] + [1.0] * 7), (7004, [None] + [1.0] * 7), (7005, [])]
    rows += [(None, rows[1][1]), (3, rows[1][1]), (3, rows[300][1]), (8000, [1e37] * 8), (8001, [1e-37] * 8)]
    return spark.createDataFrame([(*x, 1, True, 1, 1) for x in rows], f"vec_id bigint, embedding array<{kind}>, label int, kept boolean, id bigint, n bigint")


@pytest.mark.parametrize(("kind", "block", "leaf"), [("float", 512 * 1024, 128), ("float", 512, 4), ("double", 4000, 128)])
def test_links_of_awkward_vectors(spark, monkeypatch, kind, block, leaf):
    monkeypatch.setattr(grid, "BLOCK_BYTES", block)
    monkeypatch.setattr(grid, "LEAF_ROWS", leaf)
    frame = vectors(spark, kind)
    got = grid.near_duplicates(frame, 0.95).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == brute_links(frame.collect(), 0.95)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_no_vectors(spark):
    assert grid.near_duplicates(vectors(spark).limit(0)).count() == 0
    assert grid.near_duplicates(vectors(spark).where("vec_id = 7000")).count() == 1


def test_distant_intervals_are_skipped():
    r = np.random.default_rng(1)
    unit = r.normal(size=(512, 4))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    basis = np.eye(4)
    order = np.lexsort(np.floor(unit / 0.32).T[::-1])
    unit = unit[order]
    left, right = grid.join_intervals(unit, unit, basis, 0.95, 0.3163, True)
    want = np.argwhere(np.triu(unit @ unit.T >= 0.95, 1))
    assert sorted(zip(left.tolist(), right.tolist(), strict=True)) == sorted(map(tuple, want.tolist()))


# --- conversations


def test_levels_of_quotes():
    text = "Hi\nOn Friday Ann wrote:\n> one  TWO\n> > three\n>>four\n>\nbye\n 5 > 4"
    body, own, quoted = quotes.parse(text)
    assert body == "Hi\nbye\n 5 > 4"
    h = quotes.normal_hash
    assert own == [h("Hi"), h("bye"), h("5 > 4")]
    assert quoted == [{"level": 1, "line": h("one two")}, {"level": 2, "line": h("three")}, {"level": 2, "line": h("four")}]
    assert quotes.parse(None) == ("", [], []) == quotes.parse("")


CHAT = "conv_id bigint, turn bigint, role string, text string, parent bigint, root bigint, depth bigint, line string, owner bigint, level int"


def chat(spark, rows):  # noqa: ANN001, ANN201
    return spark.createDataFrame([(*r, 9, 9, 9, "x", 9, 9) for r in rows], CHAT)


def test_conversations_of_awkward_messages(spark):
    rows = [
        (1, 0, "user", "alpha\ncommon"),
        (1, 1, "assistant", "> alpha\nbeta\ncommon"),
        (1, 2, "user", "> beta\n>> alpha\ngamma"),
        (1, 3, "user", "> alpha\n> common\ndelta"),  # more lines of 0 and 1 alike: alpha is 0's, common 1's later
        (1, 4, "user", ">> gamma\nonly the inner quote is known"),
        (1, 5, "user", "> nobody said this\nepsilon"),
        (1, 6, None, None),
        (1, 7, "user", ""),
        (1, 8, "user", "> later words"),
        (1, 9, "user", "later words"),
        (1, 9, "user", "later words"),
        (2, 0, "user", "alpha"),
        (2, 1, "user", "> ALPHA  \nzeta"),
        (None, 1, "user", "> alpha"),
        (3, None, "user", "> alpha"),
        (4, 5, "user", "> four\nfive"),
        (4, 2, "user", "four"),
    ]
    got = quotes.conversations(chat(spark, rows))
    seen = Counter((r.conv_id, r.turn, r.parent, r.root, r.depth) for r in got.collect())
    want = [(1, 0, None, 0, 0), (1, 1, 0, 0, 1), (1, 2, 1, 0, 2), (1, 3, 1, 0, 2), (1, 4, 2, 0, 3), (1, 5, None, 5, 0), (1, 6, None, 6, 0), (1, 7, None, 7, 0)]
    want += [(1, 8, None, 8, 0), (1, 9, None, 9, 0), (1, 9, None, 9, 0), (2, 0, None, 0, 0), (2, 1, 0, 0, 1), (None, 1, None, 1, 0), (3, None, None, None, 0), (4, 5, 2, 2, 1), (4, 2, None, 2, 0)]
    assert seen == Counter(want)
    assert quotes.conversations(chat(spark, [])).count() == 0
    assert {r.body for r in got.collect() if r.turn == 2 and r.conv_id == 1} == {"gamma"}


def test_a_long_thread_and_a_common_line(spark, monkeypatch):
    monkeypatch.setattr(quotes, "BLOCK", 16)
    rows = [(1, 0, "user", "line 0\nthanks")]
    rows += [(1, i, "user", f"> line {i - 1 if i % 3 else i // 2}\n> thanks\nline {i}\nthanks") for i in range(1, 200)]
    got = {r.turn: (r.parent, r.depth) for r in quotes.conversations(chat(spark, rows)).collect()}
    depth = {0: 0}
    for i in range(1, 200):
        parent = i - 1  # "thanks" and the line vote alike where they differ; the latest message wins
        depth[i] = depth[parent] + 1
        assert got[i] == (parent, depth[i])


def test_quoted_tables_come_back(spark):
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet")
    threads = quotes.with_quotes(turns)
    want = Counter((r.conv_id, r.turn, r.answers) for r in threads.collect())
    got = quotes.conversations(threads)
    assert Counter((r.conv_id, r.turn, r.parent) for r in got.collect()) == want
    bodies = Counter((r.conv_id, r.turn, r.text.strip("\n")) for r in turns.collect())
    assert Counter((r.conv_id, r.turn, r.body) for r in got.collect()) == bodies


def test_every_message_is_quoted_once(spark):
    rows = [(1, 0, "u", "zero"), (1, 0, "u", "other zero"), (1, 2, "u", "two"), (1, 5, "u", "five"), (1, 1, "u", "one"), (1, 1, "u", "one")]
    rows += [(None, 0, "u", "x"), (None, 1, "u", "y"), (2, None, "u", "z"), (3, 1, "u", None), (4, 0, "u", None), (4, 1, "u", "after null")]
    threads = quotes.with_quotes(chat(spark, rows))
    got = Counter((r.conv_id, r.turn) for r in threads.collect())
    assert got == Counter((c, t) for c, t, _, _ in rows)
    told = {(r.conv_id, r.turn): (r.answers, r.text) for r in threads.collect()}
    assert told[1, 5] == (None, "five") and told[3, 1] == (None, None) and told[None, 1] == (None, "y")
    assert told[1, 1] == (0, "On Monday somebody wrote:\n> other zero\none")
    assert told[4, 1][0] == 0 and told[4, 1][1].endswith("after null")
    out = quotes.conversations(threads)
    assert Counter((r.conv_id, r.turn) for r in out.collect()) == got
    assert quotes.with_quotes(chat(spark, [])).count() == 0


# --- pipeline


def test_pipeline_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "MinHash near-dedup", "mixing sources to target weights", "BPE encoding and decoding"]
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())

    first = stages["quality rules"](spark, docs, SMALL)
    assert first.columns == columns and ids(first) == ids(robust.verdicts(docs).where("kept"))
    first.write.parquet(f"{folder}/1")
    first = spark.read.parquet(f"{folder}/1")

    from test_texts import brute_components

    second = stages["MinHash near-dedup"](spark, first, SMALL)
    least = {c for _, _, c in brute_components(first.collect(), 5)}
    assert second.columns == columns and ids(second) == Counter(least)
    second.write.parquet(f"{folder}/2")
    second = spark.read.parquet(f"{folder}/2")

    third = stages["mixing sources to target weights"](spark, second, SMALL)
    copies = {r.doc_id: r.copies for r in mixing.mix(second, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()}
    assert third.columns == columns and ids(third) == +Counter(copies)
    third.write.parquet(f"{folder}/3")
    third = spark.read.parquet(f"{folder}/3")

    last = stages["BPE encoding and decoding"](spark, third, SMALL)
    own = Counter((r.doc_id, r.ids_sha256) for r in bpe.encode(third, queries.public_tokenizers.path("byte_bpe_50k.json")).collect())
    assert Counter((r.doc_id, r.ids_sha256) for r in last.collect()) == own


def test_pipeline_of_awkward_documents(spark, folder):
    docs = documents(spark)
    spark.createDataFrame([(10, 1, 0), (11, 0, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() > 0
    empty(spark).write.parquet(f"{folder}/none/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{folder}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0


def test_near_duplicate_stage_uses_five_words(spark):
    text = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"w{i}" if i % 12 else f"v{i}" for i in range(60))
    docs = spark.createDataFrame([row(1, text), row(2, text + " end"), row(3, other)], documents(spark).schema)
    assert sorted(r.doc_id for r in forest.kept_documents(docs).collect()) == [1, 3]
