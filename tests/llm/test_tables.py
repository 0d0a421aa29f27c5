"""Sharding, mixing and packing on awkward and real tables."""

import zlib
from collections import Counter, defaultdict

import corpus
import numpy as np
import pytest

from cartledger.checks.compare import compare_rows, connect
from cartledger.llm import mixing, packing, queries, sharding


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, sf_dir, name):
    result = queries.QUERIES[name](spark, sf_dir)
    with connect(sf_dir) as con:
        answer = con.execute(queries.ORACLE_SQL[name])
        assert compare_rows(result.columns, result.collect(), answer) == []


def test_small_shards_against_sql(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    result = sharding.shard(docs, 20_000)
    with connect(sf_dir) as con:
        answer = con.execute(sharding.SQL.format(limit=20_000))
        assert compare_rows(result.columns, result.collect(), answer) == []


def test_no_shard_of_several_rows_is_too_large(spark):
    """Also when one key, or one row repeated, holds a third of all bytes."""
    hot = [(77, "hot " * 25, "en", "a", i, "x", i, 1) for i in range(60)]
    same = [(78, "same " * 20, "en", "a", 1, "x", 1, 1)] * 60
    docs = corpus.awkward_documents(spark, hot + same)
    rows = sharding.shard(docs, 1_000).collect()
    assert len(rows) == docs.count()
    sums, counts = Counter(), Counter()
    for r in rows:
        sums[r.shard] += r.bytes
        counts[r.shard] += 1
    assert all(sums[s] <= 1_000 or counts[s] == 1 for s in sums)
    assert all(r.shard_bytes == sums[r.shard] for r in rows)
    assert sharding.shard(corpus.no_documents(spark), 10).collect() == []


def test_shards_are_written_whole(spark, tmp_path):
    docs = corpus.awkward_documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    sharding.write_shards(docs, str(tmp_path / "out"), 100)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.select("doc_id").collect()) == sorted(docs.select("doc_id").collect())
    assert set(docs.columns) < set(back.columns)


def test_mixing_awkward_rows(spark):
    many = [(100 + i, "a b c d e", "en", "a", 1, "x", 1, 1) for i in range(200)]
    docs = corpus.awkward_documents(spark, many)
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    source = {r.doc_id: r.source for r in docs.collect()}
    taken, target = defaultdict(int), {}
    for r in rows:
        assert r.taken in (0, r.size, 2 * r.size)
        if r.doc_id is not None:
            taken[source[r.doc_id]] += r.taken
            target[source[r.doc_id]] = r.target
    assert abs(taken["a"] - target["a"]) <= 300  # the size of its largest document
    assert target[None] == 0.0
    assert sorted(map(tuple, mixing.mix(docs).collect()), key=str) == sorted(map(tuple, rows), key=str)
    copies = Counter(r.doc_id for r in mixing.mixed_rows(docs).collect())
    for r in rows:
        if r.doc_id is not None and r.size and r.doc_id != 2:
            assert copies[r.doc_id] == r.taken // r.size
    assert mixing.mixed_rows(docs).columns == docs.columns
    assert mixing.mix(corpus.no_documents(spark)).collect() == []


def test_a_hot_key_is_split(spark):
    """A third of all rows on one id, most of them copies of one row."""
    rows = [(5, "one two three", "s")] * 300 + [(5, f"w{i} x", "s") for i in range(40)]
    rows += [(1_000 + i, "a b c d", "s") for i in range(500)] + [(2_000 + i, "a b", "t") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    for share in (0.35, 0.9, 1.2, 1.5):
        got = mixing.mix(docs, share=share).collect()
        assert len(got) == len(rows)
        taken = sum(r.taken for r in got if r.source_size == 2980 or r.size > 2 or r.doc_id < 2_000)
        target = next(r.target for r in got if r.doc_id == 5)
        assert abs(taken - target) <= 4 and all(r.taken in (0, r.size, 2 * r.size) for r in got)
        copies = Counter(map(tuple, mixing.mixed_rows(docs, share=share).collect()))
        sizes = {k: len(k[1].split()) * n for k, n in copies.items()}
        assert sum(n for k, n in sizes.items() if k[2] == "s") == taken
        assert max(copies.values()) <= 600


def test_one_source_and_sources_without_words(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "c", "s"), (3, "", "t")], "doc_id long, text string, source string")
    rows = {r.doc_id: r for r in mixing.mix(docs).collect()}
    assert rows[1].target == 4.5 and rows[3].target == 0.0 and rows[3].taken == 0
    assert abs(rows[1].taken + rows[2].taken - 4.5) <= 1


@pytest.mark.parametrize("seed", range(3))
def test_plan_places_every_piece(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.lognormal(4, 1.2, 3000).astype(int), 1, 512)
    bins = packing.plan(Counter(lengths.tolist()), 512)
    used = Counter()
    for content, times in bins:
        assert sum(content) <= 512
        for length in content:
            used[length] += times
    assert used == Counter(lengths.tolist())
    assert sum(times for _, times in bins) <= -(-lengths.sum() // 512) + 2
    assert packing.plan({}, 512) == []
    assert packing.plan({512: 3, 1: 1}, 512) == [([512], 3), ([1], 1)]


def check_packed(docs, capacity=2048):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(packing.tokenizer_paths()[1])
    texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=str)
    want = Counter()
    for key, text in texts:
        ids = np.array([*exact.encode(text, add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % capacity or capacity
        for n, (a, b) in enumerate(zip([0, *range(first, len(ids), capacity)], range(first, len(ids) + 1, capacity))):
            want[key, n, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    rows = packing.packed_documents(docs, capacity=capacity).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in rows)
    assert len(by) <= -(-total // capacity) + max(2, len(rows) // 50)


def test_packing_awkward_rows(spark):
    check_packed(corpus.awkward_documents(spark))
    assert packing.packed_documents(corpus.no_documents(spark)).collect() == []


def test_packing_real_rows_and_short_sequences(spark, sf_dir):
    check_packed(spark.read.parquet(f"{sf_dir}/documents.parquet"), 256)


def test_sequences_hold_the_ids(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(50)
    rows = packing.sequences(docs).collect()
    assert all(len(r.ids) == 4 * r.length for r in rows)
    pieces = packing.pieces(docs).collect()
    assert sum(r.length for r in rows) == sum(r.length for r in pieces)
    joined = Counter(b"".join(bytes(r.ids) for r in rows)[i : i + 4] for i in range(0, 4 * sum(r.length for r in rows), 4))
    assert joined == Counter(b"".join(bytes(r.ids) for r in pieces)[i : i + 4] for i in range(0, 4 * sum(r.length for r in pieces), 4))

