import math

import numpy as np
import pytest

from cartledger.llm import crosspolytope, nndescent, queries

SCHEMA = "vec_id long, embedding array<float>, label int, node long, links int"


def awkward_vectors(spark, d=8, near=40):
    """A dense group, copies, repeated rows, unusable vectors, null ids and labels."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=d).tolist(), i % 3, 1, 1) for i in range(100)]
    centre = rng.normal(size=d)
    rows += [(200 + i, (centre + rng.normal(size=d) * 0.02).tolist(), 1, 1, 1) for i in range(near)]
    rows += [(300 + i, centre.tolist(), 1, 1, 1) for i in range(30)]
    rows += [(300, centre.tolist(), 1, 1, 1), (400, centre.tolist(), 2, 1, 1), (401, (-centre).tolist(), 1, 1, 1)]
    rows += [
        (500, None, 1, 1, 1), (501, [0.0] * d, 1, 1, 1), (502, [math.nan] + [1.0] * (d - 1), 1, 1, 1),
        (503, [math.inf] * d, 1, 1, 1), (504, [None] + [1.0] * (d - 1), 1, 1, 1), (505, [], 1, 1, 1),
        (506, centre.tolist(), None, 1, 1), (None, centre.tolist(), 1, None, None), (None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute_links(rows, similarity=0.98):
    ready = [usable(r.embedding) and r.label is not None for r in rows]
    links = [set() for _ in rows]
    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if ready[i] and ready[j] and a.label == b.label and len(a.embedding) == len(b.embedding):
                x, y = np.array(a.embedding, float), np.array(b.embedding, float)
                if x @ y / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= similarity:
                    links[i].add(j)
                    links[j].add(i)
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = set(), [i]
        while todo:
            a = todo.pop()
            if a not in group:
                group.add(a)
                todo += links[a]
        seen |= group
        ids = [rows[g].vec_id for g in group if rows[g].vec_id is not None]
        for g in group:
            out[g] = min(ids) if ids else None
    return sorted(((r.vec_id, len(links[i]), out[i], r.vec_id == out[i]) for i, r in enumerate(rows)), key=str)


@pytest.mark.parametrize("block", [2048, 16])
def test_awkward_links(spark, monkeypatch, block):
    """Also with buckets far above one block."""
    monkeypatch.setattr(crosspolytope, "BLOCK", block)
    rows = awkward_vectors(spark)
    got = sorted((tuple(r) for r in crosspolytope.near_vectors(rows).collect()), key=str)
    assert got == brute_links(rows.collect())


def test_floats_and_doubles_link_alike(spark):
    """Floats travel as floats; a pair at the limit is decided in double precision either way."""
    rng = np.random.default_rng(5)
    near = rng.normal(size=8)
    rows = [(i, (near + rng.normal(size=8) * 0.13).astype(np.float32).tolist(), 1) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert df.select(crosspolytope.doubles(df, "EMBEDDING")).dtypes[0][1] == "array<float>"
    wide = df.withColumn("embedding", df["embedding"].cast("array<double>"))
    got = [sorted(tuple(r) for r in crosspolytope.near_vectors(d).collect()) for d in (df, wide)]
    assert got[0] == got[1] == sorted(tuple(r) for r in brute_links(df.collect()))


def test_real_links(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    got = sorted((tuple(r) for r in queries.op10_crosspolytope(spark, sf_dir).collect()), key=str)
    assert got == brute_links(rows)


def test_no_vectors(spark):
    empty = awkward_vectors(spark).limit(0)
    assert crosspolytope.near_vectors(empty).collect() == []
    assert nndescent.search(nndescent.build(empty), empty, 5).collect() == []


def test_near_pairs_share_a_bucket():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    r = rng.normal(size=x.shape)
    r -= (r * x).sum(1)[:, None] * x
    y = 0.98 * x + math.sqrt(1 - 0.98**2) * r / np.linalg.norm(r, axis=1)[:, None]
    for hashes, tables in crosspolytope.TABLES.items():
        a, b = (crosspolytope.bucket_keys(v, tables, hashes).reshape(len(v), -1) for v in (x, y))
        found = (a[:, :, None] == b[:, None, :]).any((1, 2)).mean()
        assert found > 0.998


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 16))
    assert np.linalg.norm(crosspolytope.hadamard(x), axis=1) == pytest.approx(np.linalg.norm(x, axis=1))
    assert crosspolytope.hadamard(crosspolytope.hadamard(x)) == pytest.approx(x)


def nearest(rows, query, k):
    scored = [
        (-float(np.dot(np.array(query.embedding, float), np.array(r.embedding, float))), r.vec_id is None, r.vec_id)
        for r in rows
        if usable(r.embedding) and r.vec_id != query.vec_id
    ]
    return sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k]


def test_search_of_a_small_table_is_exact(spark):
    rows = awkward_vectors(spark)
    index = nndescent.build(rows)
    asked = rows.where("vec_id in (0, 20, 200, 300, 401, 500, 505)")
    got = nndescent.search(index, asked, 10).collect()
    whole = rows.collect()
    for q in (0, 20, 200, 300, 401):
        query = next(r for r in whole if r.vec_id == q)
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        want = nearest(whole, query, 10)
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert [r.score for r in mine] == pytest.approx([-w[0] for w in want], abs=1e-6)
    assert {r.query_id for r in got} == {0, 20, 200, 300, 401}


def test_fewer_candidates_than_asked_for(spark):
    rows = spark.createDataFrame([(i, [1.0, float(i)], 0, 1, 1) for i in range(5)], SCHEMA)
    got = nndescent.search(nndescent.build(rows), rows.where("vec_id = 0"), 20).collect()
    assert sorted(r.vec_id for r in got) == [1, 2, 3, 4]


def test_recall_against_brute_force(spark):
    """With leaves so small that rounds and walks have to find the neighbours."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    leaf, sample = nndescent.LEAF, nndescent.SAMPLE_LEAF
    nndescent.LEAF, nndescent.SAMPLE_LEAF = 64, 8
    try:
        got = nndescent.search(nndescent.build(rows), rows.where("vec_id % 20 = 0"), 20).collect()
    finally:
        nndescent.LEAF, nndescent.SAMPLE_LEAF = leaf, sample
    table = rows.toPandas()
    x = np.stack(table.embedding.to_numpy()).astype(float)
    ids = table.vec_id.to_numpy()
    place = {v: i for i, v in enumerate(ids)}
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        score = x @ x[place[q]]
        score[place[q]] = -np.inf
        best = set(ids[np.argsort(-score)[:20]])
        hits += len(best & {r.vec_id for r in got if r.query_id == q})
        total += 20
    assert hits / total >= 0.9


def test_recall_in_a_tight_group(spark, monkeypatch):
    """A third of all rows differ by less than a byte a component could tell."""
    monkeypatch.setattr(nndescent, "LEAF", 256)
    monkeypatch.setattr(nndescent, "SAMPLE_LEAF", 8)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, 64))
    x[::3] = x[0] + rng.normal(size=(2000, 64)) * 0.01  # mutual cosine about 0.9999
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist(), 0, 1, 1) for i, v in enumerate(x)], SCHEMA)
    got = nndescent.search(nndescent.build(rows), rows.where("vec_id % 60 = 0"), 20).collect()
    hits = 0
    for q in range(0, 6000, 60):
        score = x.astype(float) @ x[q].astype(float)
        score[q] = -np.inf
        hits += len(set(np.argsort(-score)[:20].tolist()) & {r.vec_id for r in got if r.query_id == q})
    assert hits / 2000 >= 0.9


@pytest.mark.parametrize("size, k", [(17, 20), (20, 20), (30, 40)])
def test_small_separate_groups_are_left_for_the_rest(spark, size, k):
    rng = np.random.default_rng(size)
    centres = np.eye(8)[:2]
    rows = [(g * size + i, (centres[g] + rng.normal(size=8) * 0.01).tolist(), 0, 1, 1) for g in range(2) for i in range(size)]
    table = spark.createDataFrame(rows, SCHEMA)
    got = nndescent.search(nndescent.build(table), table, k).collect()
    whole = table.collect()
    want = min(k, 2 * size - 1)
    for q in whole:
        mine = {r.vec_id for r in got if r.query_id == q.vec_id}
        assert len(mine) == want and mine == {w[2] for w in nearest(whole, q, k)}


def test_codes_are_close_and_symmetric():
    x = np.random.default_rng(3).normal(size=(50, 64))
    code = nndescent.decode(nndescent.encode(x))
    like = nndescent._likeness(code, code)
    assert (like == like.T).all()
    assert like == pytest.approx(x @ x.T, abs=0.6)


def test_extreme_components_link(spark):
    from cartledger.llm import crosspolytope

    rows = [(1, [1e200, 0.0]), (2, [1e200, 1e190]), (3, [1e-200, 0.0]), (4, [1e-200, 1e-210]), (5, [0.0, 1e308]),
            (6, [-1e-300, 1e-300]), (7, [-5e300, 5e300]), (8, [5e-324, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in crosspolytope.near_vectors(df).collect()}
    assert got == {1: (4, 1), 2: (4, 1), 3: (4, 1), 4: (4, 1), 8: (4, 1), 5: (0, 5), 6: (1, 6), 7: (1, 6)}


def test_rounds_and_walks_end_by_themselves(spark):
    """A small table, so one leaf; and leaves of a few, so the rounds have to find the rest."""
    from cartledger.llm import nndescent

    rng = np.random.default_rng(9)
    x = rng.normal(size=(900, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    asked = df.where("vec_id % 20 = 0")
    index = nndescent.build(df)
    found = nndescent.search(index, asked, 20)
    assert found.count() == 45 * 20 and nndescent.recall(index, found, 20) > 0.95


def test_overfull_leaves_are_split_until_they_fit(spark, monkeypatch):
    """A table far larger than the trees' sample, a third of it one tight group."""
    monkeypatch.setattr(nndescent, "SAMPLE", 64)
    monkeypatch.setattr(nndescent, "LEAF", 64)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(2_400, 12))
    x[:800] = x[0] + rng.normal(size=(800, 12)) * 0.01
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    nodes = rows.select(rows.vec_id.alias("node"), rows.embedding.alias("vec"))
    trees = [nndescent.grow(x[::40], 1, t) for t in range(2)]
    parts = nndescent._parts(nodes, trees)
    sizes = [r["count"] for r in parts.groupBy("tree", "leaf").count().collect()]
    assert max(sizes) <= 128 and sum(sizes) == 2 * len(x) == parts.select("tree", "node").distinct().count()
    assert min(sizes) > 16  # medians: no splinters, so none was dealt by hash into crumbs
    index = nndescent.build(rows)
    found = nndescent.search(index, rows.where("vec_id % 20 = 0"), 20)
    assert found.count() == 120 * 20
    assert nndescent.recall(index, found, 20) >= 0.9


def test_equal_places_in_an_overfull_leaf_are_dealt_by_hash(spark, monkeypatch):
    monkeypatch.setattr(nndescent, "LEAF", 8)
    rows = [(i, [1.0, 2.0]) for i in range(100)]
    nodes = spark.createDataFrame(rows, "node long, vec array<double>")
    tree = nndescent.Tree(0, np.zeros((0, 2)), np.zeros(0))
    parts = nndescent._parts(nodes, [tree])
    assert parts.count() == 100 and parts.select("leaf").distinct().count() > 3
