"""SimHash, components, vectors, tool calls and the SQL twins."""

import os
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from compare import connect, differences
from deliverylens.llm import hnsw, queries, simhash, toolcalls
from deliverylens.llm.components import connected_components

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string"


def roots(vertices, links):
    """The smallest vertex that each reaches."""
    parent = {v: v for v in vertices}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {v: find(v) for v in vertices}


# --- components ---


@pytest.mark.parametrize("shape", ["random", "path", "star", "none"])
def test_components(spark, shape):
    rng = random.Random(2)
    links = {
        "random": [(rng.randint(-50, 150), rng.randint(-50, 150)) for _ in range(120)],
        "path": [(k, k + 1) for k in rng.sample(range(60), 60)],
        "star": [(500, k) for k in range(60)],
        "none": [],
    }[shape]
    df = spark.createDataFrame([*links, *links[:5], (None, 1), (2, None), (9999, 9999)], "a long, b long")
    found = {r.id: r.component for r in connected_components(df).collect()}
    real = [(a, b) for a, b in links if a != b]
    assert found == roots({v for x in real for v in x}, real)


# --- simhash ---


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=100, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="aAbé \t\n\x0b\x1c ", max_size=60)))
def test_fingerprint_like_its_definition(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_long_fingerprints_in_windows(monkeypatch):
    text = " ".join(f"w{k % 97}" for k in range(5_000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "WINDOW_SHINGLES", 64)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


def near(prints):
    return [(a, b) for k, a in enumerate(prints) for b in prints[:k] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3]


@pytest.mark.parametrize("tile", [2048, 4])
def test_every_near_pair_is_connected(spark, monkeypatch, tile):
    """Clusters of close fingerprints, also where crowded variants are cut into tiles."""
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = random.Random(7)
    prints = {0, -1, 7}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(12):
            value = centre
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                value ^= 1 << bit
            prints.add(value - (1 << 64) if value >> 63 else value)
    prints = sorted(prints)
    found = simhash.near_links(spark.createDataFrame([(p,) for p in prints], "fp long"))
    links = [(r.a, r.b) for r in found.collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 3 for a, b in links)
    assert roots(prints, links) == roots(prints, near(prints))


def test_variants_of_fingerprints_are_never_broadcast(spark):
    """They are 64 rows a fingerprint, which the planner does not know of."""
    rng = random.Random(5)
    lone = [rng.getrandbits(64) - (1 << 63) for _ in range(2_000)]
    prints = lone + [fp ^ 5 for fp in lone[:200]]
    links = simhash.near_links(spark.createDataFrame([(fp,) for fp in prints], "fp long"))
    assert {tuple(sorted(r)) for r in links.collect()} == {tuple(sorted((fp, fp ^ 5))) for fp in lone[:200]}
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and "BroadcastExchange" not in plan


def test_simhash_rows(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    base = [" ".join(rng.choices(words, k=120)) for _ in range(25)]
    texts = [None, "", " \n", *base]
    for t in base:
        for _ in range(4):
            parts = t.split()
            parts[rng.randrange(len(parts))] = "changed"
            texts.append(" ".join(parts).upper())
    texts += base[:5]
    ids = [*range(1000, 1000 - len(texts) + 1, -1), None]
    table = spark.createDataFrame(list(zip(ids, texts)), DOCS).withColumn("fp", F.lit(1)).withColumn("id", F.lit(2))
    rows = simhash.near_duplicates(table).collect()
    assert len(rows) == len(texts)
    prints = [plain_fingerprint(t) for t in texts]
    assert sorted(r.fingerprint for r in rows) == sorted(f"{p:016x}" for p in prints)
    group = roots(set(prints), near(sorted(set(prints))))
    smallest = {}
    for i, p in zip(ids, prints):
        if i is not None:
            smallest[group[p]] = min(smallest.get(group[p], i), i)
    expected = {(i, f"{p:016x}", smallest.get(group[p])) for i, p in zip(ids, prints)}
    assert {tuple(r) for r in rows} == expected
    kept = simhash.keep_one_each(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(smallest.values()))
    # of rows that share an id one stays, rows without one all do
    twice = table.unionAll(table)
    again = [r.doc_id for r in simhash.keep_one_each(twice).collect()]
    assert sorted(i for i in again if i is not None) == sorted(set(smallest.values())) and again.count(None) == 2
    assert simhash.near_duplicates(table.limit(0)).count() == 0
    assert simhash.keep_one_each(table.limit(0)).count() == 0


# --- vectors ---

VECTORS = "vec_id long, embedding array<float>, label int"


def cluster_rows(n_clusters, size, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n_clusters):
        centre = rng.normal(size=dim)
        for _ in range(size):
            v = centre + rng.normal(size=dim) * rng.choice([0.05, 0.25, 0.6])
            rows.append((len(rows), [float(np.float32(x)) for x in v], c % 3))
    return rows


def plain_vectors(rows, cosine=0.93):
    good = [
        r for r in rows
        if r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])
    ]
    links, count = [], {r[0]: 0 for r in rows}
    for i, a in enumerate(good):
        for b in good[:i]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    links.append((a[0], b[0]))
                    count[a[0]] += 1
                    count[b[0]] += 1
    return count, roots([r[0] for r in rows if r[0] is not None], links)


@pytest.mark.parametrize("shard_rows", [4096, 40])
def test_vector_rows(spark, shard_rows):
    rows = cluster_rows(9, 25)
    n = len(rows)
    nan, inf = float("nan"), float("inf")
    rows += [(n, rows[0][1], 0), (n + 1, rows[0][1], 0), (n + 2, rows[0][1], None), (n + 3, None, 0), (n + 4, [0.0] * 16, 0)]
    rows += [(n + 5, [nan] * 16, 0), (n + 6, [inf] + [1.0] * 15, 0), (n + 7, [None] + [1.0] * 15, 0), (n + 8, [], 0)]
    rows += [(n + 9, [2.0 * x for x in rows[0][1]], 0), (n + 10, [1.0, 2.0], 0), (n + 11, [2.0, 4.0], 0)]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], f"{VECTORS}, id int, shard int")
    got = {r.vec_id: r for r in hnsw.near_vectors(table, shard_rows=shard_rows).collect()}
    count, component = plain_vectors(rows)
    assert len(got) == len(rows)
    wrong = [i for i in count if got[i].n_links != count[i]]
    assert len(wrong) <= 0.02 * len(rows)
    assert sum(got[i].n_links for i in count) >= 0.98 * sum(count.values())
    assert all(got[i].component_id == component[i] for i in count if i not in wrong)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_vector_edges(spark):
    same = [1.0, 0.0]
    table = spark.createDataFrame([(None, same, 1), (5, same, 1), (5, same, 1), (7, same, 1)], VECTORS)
    rows = sorted(((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in hnsw.near_vectors(table).collect()))
    assert rows == [(-1, 0, None, False), (5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False)]
    assert hnsw.near_vectors(table.limit(0)).count() == 0
    assert [r.n_links for r in hnsw.near_vectors(table.where("vec_id is null")).collect()] == [0]


def test_recall_of_one_graph():
    rows = cluster_rows(6, 150, dim=24, seed=3)
    vectors = np.array([r[1] for r in rows])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    truth = vectors @ vectors.T >= 0.93
    met, width, recall = hnsw.Graph.build(vectors).audited(vectors, 0.93)
    assert recall >= 0.99 and not (met & ~truth).any()
    assert (met & truth).sum() >= 0.98 * truth.sum()


def unit_rows(n, dim, seed):
    vectors = np.random.default_rng(seed).normal(size=(n, dim))
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def test_audit_without_links_rests_on_neighbours():
    vectors, queries = unit_rows(1200, 32, 1), unit_rows(200, 32, 2)
    graph = hnsw.Graph.build(vectors)
    for asked, own in ((vectors, True), (queries, False)):
        near = asked @ vectors.T
        if own:
            np.fill_diagonal(near, -2)
        assert not (near >= 0.93).any()
        _, width, recall = graph.audited(asked, 0.93, own=own)
        true = np.argsort(-near, axis=1)[:, :10]
        shares = [
            np.mean([len(set(f) & set(t)) / 10 for f, t in zip(graph.nearest(asked, w)[0].tolist(), true.tolist())])
            for w in (hnsw.BEAM, width)
        ]
        assert recall >= 0.99 and shares[1] >= 0.97
        if not own:  # the first beam misses too many of the nearest ten
            assert shares[0] < 0.95 and width > hnsw.BEAM


def test_hits_of_vectors_on_themselves_are_no_evidence():
    vectors = unit_rows(96, 16, 3)
    vectors[1], vectors[3] = vectors[0], vectors[2]
    true = vectors @ vectors.T >= 0.93
    assert true.sum() == 96 + 4
    graph = hnsw.Graph.build(vectors)

    def within(queries, width, least):
        met = queries @ vectors.T >= least
        if width == hnsw.BEAM:
            met[0, 1] = False  # one of four links, but one of a hundred with the vectors themselves
        return met

    graph.within = within
    met, width, recall = graph.audited(vectors, 0.93, own=True)
    assert width > hnsw.BEAM and recall >= 0.99 and (met == true).all()


class Looked(np.ndarray):
    """Neighbours that count how often they are looked up."""

    looks = 0

    def __getitem__(self, key):
        Looked.looks += 1
        return np.asarray(self)[key]


def test_a_shard_is_worked_in_few_large_steps(monkeypatch):
    """What made CPU seconds grow faster than vectors: choices of neighbours came one by one, and
    a beam took a step for each of its vertices."""
    n, calls, choose = 1500, [], hnsw.Graph._chosen

    def counted(self, *args):
        calls.append(1)
        return choose(self, *args)

    monkeypatch.setattr(hnsw.Graph, "_chosen", counted)
    vectors = unit_rows(n, 32, 6)
    graph = hnsw.Graph.build(vectors)
    assert len(calls) < n / 4
    asked = unit_rows(50, 32, 7)
    true = np.argsort(-(asked @ vectors.T), axis=1)[:, :10]
    graph.layers[0] = graph.layers[0].view(Looked)
    Looked.looks = 0
    found = graph.nearest(asked, 256)[0]
    assert Looked.looks < 256 / 4
    assert np.mean([len(set(f) & set(t)) / 10 for f, t in zip(found.tolist(), true.tolist())]) >= 0.99


def test_double_precision_decides_about_links():
    """Cosines so near to the bound that single precision cannot tell on which side they are."""
    rng = np.random.default_rng(8)
    one = unit_rows(1, 16, 9)[0]
    across = rng.normal(size=(400, 16))
    across -= np.outer(across @ one, one)
    across /= np.linalg.norm(across, axis=1, keepdims=True)
    cosines = 0.93 + rng.choice([-1, 1], 400) * 1e-9
    vectors = np.vstack((one, cosines[:, None] * one + np.sqrt(1 - cosines**2)[:, None] * across))
    graph = hnsw.Graph.build(vectors)
    assert (graph.within(vectors[:1], 512, 0.93)[0] == (vectors @ one >= 0.93)).all()
    assert (np.sum(vectors @ one >= 0.93) == 1 + (cosines > 0.93).sum())


def test_audit_of_each_pair_of_shards(spark):
    rows = [(k, v.tolist(), k % 2) for k, v in enumerate(unit_rows(300, 16, 4))]
    audits = hnsw.audit_vectors(spark.createDataFrame(rows, VECTORS), shard_rows=50).collect()
    assert {r.label for r in audits} == {0, 1} and any(r.shard_a < r.shard_b for r in audits)
    assert len({(r.label, r.shard_a, r.shard_b) for r in audits}) == len(audits) == 2 * (3 * 4 // 2)
    assert all(r.dim == 16 and r.recall >= 0.99 and r.sought > 0 for r in audits)


# --- tool calls ---

CALLS = "conv_id long, call_id string, turn long, tool string, arguments string, needs array<string>"
RESULTS = "conv_id long, call_id string, turn long, content string"
SCHEMAS = {
    "f": (
        toolcalls.Field("n", "integer", least=1, most=5),
        toolcalls.Field("name", "string", required=False, least=2),
        toolcalls.Field("share", "number", required=False),
        toolcalls.Field("on", "boolean", required=False),
        toolcalls.Field("list", "array", required=False),
        toolcalls.Field("map", "object", required=False),
    )
}


@pytest.mark.parametrize(
    ("arguments", "errors"),
    [
        ('{"n":3}', ""),
        ('{"n":9}', "n: above 5"),
        ('{"n":0,"name":"x"}', "n: below 1; name: below 2"),
        ('{"n":"3"}', "n: not integer"),
        ('{"n":1.5}', "n: not integer"),
        ('{"n":null}', "n: missing"),
        ("{}", "n: missing"),
        ('{"n":1,"zz":1,"aa":2}', "aa: unknown; zz: unknown"),
        ('{"n":1,"share":0.5,"on":true,"list":[1],"map":{"a":1}}', ""),
        ('{"n":1,"share":"a","on":1,"list":{},"map":[]}', "share: not number; on: not boolean; list: not array; map: not object"),
        ("[1]", "arguments: not an object"),
        ("oops", "arguments: not an object"),
        ("", "arguments: not an object"),
        (None, "arguments: not an object"),
    ],
)
def test_schemas(spark, arguments, errors):
    df = spark.createDataFrame([("f", arguments)], "tool string, arguments string")
    assert "; ".join(df.select(toolcalls.validate(F.col("tool"), F.col("arguments"), SCHEMAS)).first()[0]) == errors


def plain_levels(calls):
    needs = {}
    for conv, call, need in calls:
        needs.setdefault((conv, call), set()).update((conv, n) for n in need or [])
    needs = {k: {n for n in v if n in needs} for k, v in needs.items()}
    levels = {}
    while ready := [k for k in needs if k not in levels and all(n in levels for n in needs[k])]:
        levels |= {k: 1 + max((levels[n] for n in needs[k]), default=-1) for k in ready}
    return levels


def test_levels(spark):
    rng = random.Random(9)
    calls = [(c, f"c{k}", [f"c{rng.randrange(12)}" for _ in range(rng.choice([0, 0, 1, 2]))]) for c in range(8) for k in range(10)]
    calls += [(1, "c3", ["c4"]), (9, "self", ["self"]), (9, "behind", ["self"]), (9, "free", None)]
    # a long chain, with a fork and a ring of single needs
    calls += [(10, f"k{k}", [f"k{k - 1}"] if k else []) for k in range(70)]
    calls += [(10, "fork", ["k50", "k9"]), (10, "after", ["fork"]), (10, "join", ["after", "k69", "k69"])]
    calls += [(11, f"r{k}", [f"r{(k + 1) % 5}"]) for k in range(5)] + [(11, "tail", ["r0"]), (11, "two", ["tail", "lone"]), (11, "lone", [])]
    df = spark.createDataFrame(calls, "conv_id long, call_id string, needs array<string>")
    found = {(r.conv_id, r.call_id): r.level for r in toolcalls.topological_levels(df).collect()}
    assert found == plain_levels(calls)


def test_tool_rows(spark):
    calls = [
        (1, "a", 0, "f", '{"name":"é\\n","n":1, "map":{"z":1,"b":[{"y":null,"x":2}]}}', None),
        (1, "b", 2, "f", '{"n":9}', ["a"]),
        (1, "b", 2, "f", '{"n":9}', ["a"]),
        (1, "c", 4, "g", "oops", ["b", "gone"]),
        (1, "x", 5, "f", '{"n":1}', ["y"]),
        (1, "y", 6, "f", '{"n":1}', ["x"]),
        (2, "a", 0, "f", '{"n":1}', []),
        (None, "a", 0, "f", '{"n":1}', []),
        (2, None, 0, None, None, None),
    ]
    results = [(1, "a", 1, "r1"), (1, "a", 1, "r0"), (1, "a", 9, "r2"), (3, "a", 1, None), (None, "a", 1, "lost"), (1, "b", None, "late")]
    make = lambda n=None: (
        spark.createDataFrame(calls[:n] if n is not None else calls, CALLS).withColumn("level", F.lit(7)),
        spark.createDataFrame(results, RESULTS).withColumn("tool", F.lit("t")),
    )
    rows = toolcalls.link_tools(*make(), SCHEMAS).collect()
    got = sorted((str(r.conv_id), str(r.call_id), r.status, r.level, r.n_results) for r in rows)
    assert got == sorted(
        [
            ("1", "a", "ok", 0, 3), ("1", "b", "invalid", 1, 1), ("1", "b", "invalid", 1, 1), ("1", "c", "invalid", 2, 0),
            ("1", "x", "cyclic", None, 0), ("1", "y", "cyclic", None, 0), ("2", "a", "unanswered", 0, 0),
            ("None", "a", "unanswered", 0, 0), ("2", "None", "invalid", 0, 0), ("3", "a", "orphan", None, 1),
            ("None", "a", "orphan", None, 1),
        ]
    )
    text = {(r.conv_id, r.call_id): r.json for r in rows if r.conv_id is not None}
    assert text[1, "a"] == (
        '{"arguments":{"map":{"b":[{"x":2,"y":null}],"z":1},"n":1,"name":"é\\n"},"call_id":"a","name":"f","result":"r0"}'
    )
    assert text[1, "c"] == '{"arguments_text":"oops","call_id":"c","name":"g"}'
    assert {r.status for r in toolcalls.link_tools(*make(0), SCHEMAS).collect()} == {"orphan"}
    empty = toolcalls.link_tools(make()[0], make()[1].limit(0), SCHEMAS)
    assert empty.count() == len(calls)


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_sql_twins(spark, name, sf_dir="/root/testdata/sf0.01"):
    assert not differences(queries.queries()[name](spark, sf_dir), connect(sf_dir), queries.oracle_sql()[name])


def test_bit_matrices():
    rng = np.random.default_rng(3)
    for n in (1, 7, 8, 300, 530):
        linked = rng.random((n, n)) < 0.05
        bits = hnsw.symmetric(np.packbits(linked, axis=1))
        both = linked | linked.T
        np.fill_diagonal(both, False)
        assert (np.unpackbits(bits, axis=1, count=n).astype(bool) == both).all()
        assert (np.concatenate([block for _, block in hnsw._blocks(bits, n)]) == both).all()


def test_labels_of_any_type_meet_only_their_like(spark):
    """Texts, fractions that would be cut to the same whole number, and truth values."""
    vector = [1.0, 0.0]
    for kind, labels in (("string", ["a", "b", "a", None]), ("double", [1.2, 1.7, 1.2, None]), ("boolean", [True, False, True, None])):
        rows = spark.createDataFrame([(k, x, vector) for k, x in enumerate(labels)], f"vec_id long, label {kind}, embedding array<float>")
        found = {r.vec_id: (r.n_links, r.component_id) for r in hnsw.near_vectors(rows).collect()}
        assert found == {0: (1, 0), 1: (0, 1), 2: (1, 0), 3: (0, 3)}


def test_every_message_is_accounted_for(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 2, "assistant", "c")]
    rows += [(1, 3, None, None), (2, 5, "assistant", "alone"), (None, 0, "tool", 'q"'), (1, 0, "system", "Be kind.")]
    found = toolcalls.chat_rows(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    calls = sum(r.status not in ("orphan", "message") for r in found)
    messages = [r for r in found if r.status == "message"]
    assert calls + sum(r.n_results for r in found) + len(messages) == len(rows)
    assert sorted(r.json for r in messages) == [
        '{"content":"Be kind.","role":"system"}', '{"content":"Be kind.","role":"system"}', '{"content":"q\\"","role":"tool"}', "{}",
    ]
    assert {r.turn for r in messages} == {0, 3}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")
def test_every_sample_message_is_accounted_for(spark):
    found = queries.op8_tool_calls(spark, SF_DIR)
    told = found.agg(F.sum(F.when(F.col("status") == "orphan", 0).otherwise(1) + F.col("n_results"))).first()[0]
    assert told == spark.read.parquet(f"{SF_DIR}/conversations.parquet").count()
