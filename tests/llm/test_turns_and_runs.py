"""Chat formatting, hard negatives and periodic runs against brute-force versions."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cartledger.checks.compare import compare_rows, connect
from cartledger.llm import chat, negatives, periodic, queries
from tests.conftest import bag
from tests.llm.corpus import awkward_documents, no_documents

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op11_chat", "op12_negatives"])
def test_equal_to_sql(spark, name):
    got = queries.QUERIES[name](spark, SF)
    with connect(SF) as con:
        assert not compare_rows(got.columns, got.collect(), con.execute(queries.ORACLE_SQL[name]))


# Chat


CONTROLS = [*chat.USER, *chat.ASSISTANT, *chat.OTHER, *chat.SPEAKER]
CHATS = "conv_id long, turn long, role string, text string, segments int, CONV int"


def test_chat_comes_back(spark):
    pieces = ["", "a", "\\", "<", "[", "<<", ">", "\n", *CONTROLS, *[c[0] + "\\" + c[1:] for c in CONTROLS]]
    texts = ["".join(p) for n in (1, 2, 3) for p in itertools.product(pieces, repeat=n)]
    texts = random.Random(3).sample(texts, 2_000) + [c for c in CONTROLS] + ["x</s>y " * 20_000, "\\" * 50_000 + "</s>", "<" + "\\" * 50_000]
    roles = ["user", "assistant", "system", "tool", "", "</role>", "a<role>b\nc", None, "User"]
    rows = [(i // 40, i % 40, roles[i % len(roles)], t, 1, 2) for i, t in enumerate(texts)]
    rows += [(7_000, None, None, None, None, None), (None, 1, "user", "u", 0, 0), (7_001, 0, "user", "same", 0, 0), (7_001, 0, "user", "same", 0, 0)]
    back = {r["conv_id"]: r for r in chat.read_back(chat.segments(spark.createDataFrame(rows, CHATS))).collect()}
    whole = {}
    for conv, turn, role, text, *_ in rows:
        whole.setdefault(conv, []).append((turn or 0, role or "", text or ""))
    assert back.keys() == whole.keys()
    for conv, turns in whole.items():
        assert [(t["role"], t["text"]) for t in back[conv]["turns"]] == [(r, t) for _, r, t in turns]
        assert back[conv]["loss"] == [t for _, r, t in turns if r == "assistant"]


def test_chat_escapes_only_what_clashes(spark):
    rows = [(1, 0, "user", "a \\ b <i> [x]", 0, 0), (1, 1, "assistant", "fine", 0, 0), (2, 0, "user", "</s>", 0, 0)]
    found = chat.segments(spark.createDataFrame(rows, CHATS))
    texts = dict(found.select("conv_id", chat.formatted(found)).collect())
    assert texts == {1: "[INST]a \\ b <i> [x][/INST]<s>fine</s>", 2: "[INST]<\\/s>[/INST]"}
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("broken", ["[INST]a</s>", "x[INST]a[/INST]", "[INST]a[/INST]x", "<role>r</role>[INST]a[/INST]", "[INST]a", "<role>r</role><s>a<</SYS>>"])
def test_broken_texts_have_no_turns(spark, broken):
    assert chat.parse(spark.createDataFrame([(broken,)], "t string"), "t", "turns").first()["turns"] is None


def test_no_chats(spark):
    assert chat.segments(spark.createDataFrame([], CHATS)).collect() == []


# Hard negatives


VECTORS = "vec_id long, embedding array<double>, label int, row int, ID int"


def mined(rows, every):
    """The rows of ``mine`` from (id, vector, label), by Python integers."""
    ready = [
        (i, [math.floor(256 * x) if abs(x) < 2**52 else int(x) * 256 for x in v], k) for i, v, k in rows
        if i is not None and v is not None and k is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    clamp = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    out = []
    for a, v, k in ready:
        if a % every:
            continue
        scored = sorted((-clamp(sum(x * y for x, y in zip(v, w))), i, m) for i, w, m in ready if len(w) == len(v))
        for s, p, _ in [r for r in scored if r[2] == k and r[1] != a][:5]:
            near = [r for r in scored if r[2] != k and 50 * -s <= 100 * -r[0] <= 95 * -s][:3]
            out += [(a, p, n + 1, r[1], -s, -r[0]) for n, r in enumerate(near)]
    return sorted(out)


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def test_negatives_by_brute_force(spark):
    random_ = np.random.default_rng(2)
    rows = [(i, [float(x) for x in random_.normal(0.3, 1, 6)], int(random_.integers(3))) for i in range(900)]
    rows += [(i, rows[i][1], 0) for i in range(300)] + [rows[7], rows[7]]  # repeated ids and rows
    rows += [(2_000 + i, rows[0][1], i % 3) for i in range(600)]  # copies, ties
    rows += [(3_000, None, 1), (3_001, [1.0] * 6, None), (None, [1.0] * 6, 1), (3_007, [1.0, None] * 3, 1)]
    rows += [(3_014, [float("nan")] * 6, 1), (3_021, [float("inf")] * 6, 1), (3_028, [0.0] * 6, 1), (3_035, [], 1)]
    rows += [(3_042, [1.0, 2.0], 0), (3_043, [3.0, 1.0], 0), (3_044, [2.5, 1.0], 1), (3_049, [-1.0, 0.5], 1), (3_050, [0.0, 0.0], 0)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], VECTORS)
    got = negatives.mine(df, F.col("id") % 7 == 0)
    assert bag(got, *COLUMNS) == mined(rows, 7)


def test_large_components(spark):
    rows = [(0, [1e200, 1.0], 0), (1, [1e180, 5.0], 0), (2, [1e10, -1e12], 0), (3, [2e9, 3e8], 1), (4, [1.0, 1.0], 1),
            (5, [7e307, -1e300], 1), (6, [-1e17, 3.0], 0), (7, [123456789.5, 3.0], 0), (14, [2e8, 1e7], 1), (21, [9e7, 1e6], 1)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], VECTORS)
    assert bag(negatives.mine(df, F.col("id") % 7 == 0), *COLUMNS) == mined(rows, 7)
    assert negatives.mine(df.limit(0), F.col("id") % 7 == 0).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_packed_products_are_exact(data):
    size = data.draw(st.sampled_from([3, 300, 2**20, 2**40, 2**70]))
    whole = st.integers(-size, size)
    d, n = data.draw(st.integers(0, 5)), data.draw(st.integers(0, 6))
    rows = np.array(data.draw(st.lists(st.lists(whole, min_size=d, max_size=d), min_size=n, max_size=n)), object).reshape(n, d)
    if size < 2**60:
        rows = rows.astype(np.int64)
    anchor = data.draw(st.lists(whole, min_size=d, max_size=d))
    block = negatives.Packed(rows, min(anchor, default=0) - 1, max(anchor, default=0) + 3)
    exact = [sum(a * int(x) for a, x in zip(anchor, row)) for row in rows]
    assert block.scores(anchor).tolist() == [max(-(1 << 63), min((1 << 63) - 1, s)) for s in exact]


@pytest.mark.parametrize("anchor", [-(2**63), 2**40, 3, 0, -(2**70)])
@pytest.mark.parametrize("row", [-1, -(2**40), -(2**52) + 1, 2**40])
def test_rows_all_alike_are_exact(row, anchor):
    """Their fields are small, but not what is taken off them."""
    d = 2_100
    block = negatives.Packed(np.full((3, d), row, np.int64), anchor, anchor)
    score = max(-(1 << 63), min((1 << 63) - 1, d * row * anchor))
    assert block.scores([anchor] * d).tolist() == [score] * 3


# Periodic runs


def slow_runs(words):
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            part = words[start : start + length]
            if length >= max(6, 4 * q) and not any(part[r:] == part[:-r] for r in range(1, q)):
                found.append((start, length, q))
            i = max(i, start + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_by_brute_force():
    draw = random.Random(8)
    for _ in range(1_500):
        letters, n = draw.choice([1, 2, 2, 3, 6]), draw.randint(0, 90)
        words = [draw.randrange(letters) for _ in range(n)]
        for _ in range(draw.randint(0, 3) if n else 0):
            p, start = draw.randint(1, 20), draw.randrange(n)
            unit = [draw.randrange(letters) for _ in range(p)]
            many = (unit * 8)[: draw.randint(p, 7 * p)]
            words[start : start + len(many)] = many
        assert periodic.runs(np.array(words, np.int64)) == slow_runs(words)
    with pytest.raises(ValueError):
        periodic.runs(np.zeros(3, np.int64), repeats=2)


def test_guaranteed_overlap():
    for least, repeats in ((6, 4), (20, 3), (1, 5)):
        for low in (1, 2, 4, 8, 64):
            assert periodic.guaranteed(low, least, repeats) == min(max(least, repeats * q) - q for q in range(low, 2 * low))


def planted(key, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(key).encode()), len(words)
    if key is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def slow_row(key, text):
    words = planted(key, text)
    found = slow_runs(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    drop = {i for s, m, q in found for i in range(s + q, s + m)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (key, len(found), *figures, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_periodic_query_by_brute_force(spark, tmp_path):
    draw = random.Random(4)
    texts = [" ".join(f"w{draw.randrange(draw.choice([2, 3, 40]))}" for _ in range(draw.randint(0, 120))) for _ in range(400)]
    more = [(100 + i, t, "en", "s", 1, "x", 1, 1) for i, t in enumerate(texts)]
    more += [(600, "é  b " * 9, "en", "s", 1, "x", 1, 1), (601, "a\u000bb\u000ca\r\nb a\tb a b a b", "en", "s", 1, "x", 1, 1)]
    docs = awkward_documents(spark, more).where("doc_id is null or doc_id <> 9")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_periodic(spark, str(tmp_path))
    want = [slow_row(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert bag(got) == sorted(want, key=lambda r: [(v is not None, v) for v in r])


def test_runs_of_awkward_texts(spark):
    found = periodic.detect(awkward_documents(spark)).where("doc_id = 9").first()
    assert found["runs"] == [(0, 40_000, 2)] and found["collapsed"] == "long words"
    assert periodic.detect(no_documents(spark)).collect() == []
