import random
import re

import corpus
import corpus_pipeline
import pytest
import xxhash

from cartledger.llm import graph, queries, simhash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """(fingerprint -> set of fingerprints reached) by comparing all pairs."""
    left, found = set(fps), {}
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            a = todo.pop()
            group.add(a)
            near = {b for b in left if (a ^ b).bit_count() <= 3}
            left -= near
            todo += near
        found |= dict.fromkeys(group, group)
    return found


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    reach = plain_components(fps)
    ids = {}
    for (i, _), f in zip(rows, fps):
        ids.setdefault(f, []).append(i)

    def least(f):
        known = [i for g in reach[f] for i in ids[g] if i is not None]
        return min(known) if known else None

    return sorted(
        ((i, f"{f:016x}", least(f)) for (i, _), f in zip(rows, fps)), key=lambda r: (r[0] is not None, r)
    )


def got(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is not None, r))


def test_awkward_rows(spark):
    docs = corpus.awkward_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(simhash.near_duplicates(docs)) == expected(rows)


def test_real_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(simhash.near_duplicates(docs)) == expected(rows)


def test_empty_table(spark):
    assert simhash.near_duplicates(corpus.no_documents(spark)).collect() == []
    assert simhash.keep_one(corpus.no_documents(spark)).collect() == []


@pytest.mark.parametrize("split_above", [64, 2])
def test_all_close_pairs_are_found(spark, monkeypatch, split_above):
    """Crowded halves too: half of the fingerprints share one half."""
    monkeypatch.setattr(simhash, "SPLIT_ABOVE", split_above)
    rng = random.Random(3)
    fps = set()
    for base in (0, (1 << 63) | 12345, rng.getrandbits(64)):
        for _ in range(60):
            fp = base
            for bit in rng.sample(range(64) if rng.random() < 0.5 else range(32), rng.randint(0, 5)):
                fp ^= 1 << bit
            fps.add(fp)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3}
    pairs = simhash.near_pairs(spark.createDataFrame([(f,) for f in signed], "fp long"))
    assert {tuple(r) for r in pairs.collect()} == want


def test_one_row_of_each_group_stays(spark):
    docs = corpus.awkward_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    roots = {component for _, _, component in expected(rows)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(roots)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 150)] + [(7, 7), (None, 3), (5, 4)]
    rows = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {tuple(r) for r in rows} == {(i, 0) for i in range(41)} | {(j, 100) for j in range(100, 150)}


def exploded_and_broadcast(plan):
    """Sides of broadcast joins that hold an explode, whose rows Spark does not foresee."""
    children = plan.children()
    found = [x for i in range(children.size()) for x in exploded_and_broadcast(children.apply(i))]
    if plan.nodeName().startswith("Broadcast") and plan.nodeName().endswith("Join"):
        side = plan.left() if plan.buildSide().toString() == "BuildLeft" else plan.right()
        found += [side.toString()] if "Generate" in side.toString() else []
    return found


@pytest.fixture
def broadcasts(monkeypatch):
    """What ``exploded_and_broadcast`` finds in every plan that is stored on the way."""
    found, joins = [], []

    def watched(df, label, store=graph.stored):
        plan = df._jdf.queryExecution().sparkPlan()
        found.extend(exploded_and_broadcast(plan))
        joins.extend(re.findall("SortMergeJoin .*Inner", plan.toString()))
        return store(df, label)

    for module in (simhash, graph):
        monkeypatch.setattr(module, "stored", watched)
    return found, joins


@pytest.mark.parametrize("split_above", [64, 1])
def test_pipeline_broadcasts_no_balls(spark, sf_dir, monkeypatch, broadcasts, split_above):
    monkeypatch.setattr(simhash, "SPLIT_ABOVE", split_above)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    corpus_pipeline.distinct_documents(spark, docs, sf_dir).collect()
    found, joins = broadcasts
    assert joins and not found


def test_op1_broadcasts_no_balls(spark, sf_dir, broadcasts):
    queries.op1_simhash(spark, sf_dir).collect()
    found, joins = broadcasts
    assert joins and not found
