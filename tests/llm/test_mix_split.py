import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slatemill.llm import mixing as M
from slatemill.llm import splitting as S
from slatemill.llm import tokenizer

PATH = tokenizer.default_path()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(0, 10_000)), max_size=12), st.integers(0, 40_000))
def test_water_filling(parts, total):
    weights, caps = [w for w, _ in parts], [float(c) for _, c in parts]
    got = M.water_fill(weights, caps, total)
    room = sum(c for w, c in zip(weights, caps) if w > 0)
    assert all(0 <= g <= c * (1 + 1e-9) for g, c in zip(got, caps)) and sum(got) == pytest.approx(min(total, room), rel=1e-6, abs=1e-6)
    free = [g / w for g, w, c in zip(got, weights, caps) if w > 1e-9 and 0 < g < c * (1 - 1e-9)]
    assert not free or max(free) == pytest.approx(min(free), rel=1e-6)


def test_mix(spark):
    docs = [(i, "abc"[i % 3], f"some words of text number {i}") for i in range(300)] + [(300, None, "x"), (301, "zz", "y"), (302, "a", None), (303, "a", ""), (0, "a", "some words of text number 0"), (None, "a", "t")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").selectExpr("*", "1 n_tokens", "2 bin")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.3, 1), ("c", 0.1, 5), ("none", 0.1, 3), (None, 0.2, 1)], "source string, target_share double, max_repeat int")
    records, report = M.mix(df, targets)
    rows = records.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) and {r["source"] for r in rows} <= set("abc")
    by = {r["source"]: r for r in report.collect()}
    assert by["none"]["chosen_tokens"] == 0 and sum(r["actual_share"] for r in by.values()) == pytest.approx(1)
    sizes = {s: sum(r["n_tokens"] * r["n_repeat"] for r in rows if r["source"] == s) for s in "abc"}
    assert all(by[s]["chosen_tokens"] == sizes[s] and by[s]["most_repeats"] <= by[s]["max_repeat"] for s in "abc")
    want = dict(zip("abc", M.water_fill([0.5, 0.3, 0.1], [by[s]["available_tokens"] * m for s, m in zip("abc", (2, 1, 5))], sum(by[s]["available_tokens"] for s in "abc"))))
    assert all(want[s] - 40 <= sizes[s] <= want[s] for s in "abc")
    assert sorted(map(tuple, M.mix(df.repartition(7), targets)[0].collect())) == sorted(map(tuple, rows))
    by_size, _ = M.mix(df.withColumn("size", F.lit(10)), targets, size="size")
    assert {r["n_tokens"] for r in by_size.collect()} == {10}
    records, report = M.mix(df.limit(0), targets)
    assert records.count() == 0 and {r["chosen_tokens"] for r in report.collect()} == {0}


def joined(pieces, text):
    at = 0
    for begin, end, _ in pieces:
        assert begin <= at < end
        at = end
    return at == len(text)


def cut(text, limits):
    model = tokenizer.pieces(PATH)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    token = model.encode([text])[0]
    place = np.minimum(np.maximum(np.cumsum(model.width[np.array(token)]) - 1, 0), len(codes))
    upto = np.cumsum(np.bincount(place, minlength=len(codes) + 1))
    upto[0] = 0
    return model, S.split(model, text, S.strengths(codes), np.r_[False, model.safe(codes)], upto, limits)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(["已知函数", "。", "\n\n", "\n", "Word ", "word, ", "3.5", "．", "a" * 30, "　", "é", "😀", "数据获取一个", "x²", "; "]), min_size=1, max_size=150), st.sampled_from([(1, 0), (2, 1), (3, 0), (7, 6), (16, 0), (16, 4), (16, 15), (40, 12), (64, 31)]))
def test_pieces_fit_and_join(parts, setting):
    text = "".join(parts)
    model, (found,) = cut(text, [setting])
    assert joined(found, text)
    for (b, e, n), after in zip(found, [*found[1:], None]):
        assert n == model.count(text[b:e]) and (n <= setting[0] or e - b == 1)
        if after and 0 < setting[1] < setting[0] // 2 >= 8:
            assert after[0] < e


def test_natural_boundaries():
    text = "第一段的文字在这里，说了一些话。又说了一句。\n\n" * 3 + "第二段开始了，" * 6
    _, (found,) = cut(text, [(60, 8)])
    assert all(text[:e].endswith(("\n", "。")) for _, e, _ in found[:-1][:2])
    best = S.Strongest(np.array([0, 3, 1, 3, 2]))
    assert best.best(0, 4) == 3 and best.best(0, 2) == 1 and best.best(4, 4) == 4


def test_frame(spark):
    text = "很长的文字。" * 400
    docs = spark.createDataFrame([(1, text), (2, "短"), (3, None), (4, ""), (5, "字" * 30_000), (6, "a" * 5000)], "doc_id long, text string").selectExpr("*", "'x' piece", "1 setting_id")
    settings_ = spark.createDataFrame([("s", 128, 16), ("t", 256, 0), ("bad", None, 3), (None, 64, 0), ("tiny", 2, 0), ("wide", 32, 30), ("none", 0, 0), ("back", 64, -3)], "setting_id string, max_tokens int, overlap_tokens int")
    got = S.split_documents(docs, settings_).collect()
    assert {r["setting_id"] for r in got} == {"s", "t", "wide", "tiny", "back"} and {r["doc_id"] for r in got if r["setting_id"] == "s"} == {1, 5, 6}
    limit, model = {"s": 128, "t": 256, "wide": 32, "tiny": 2, "back": 64}, tokenizer.pieces(PATH)
    assert all(r["n_tokens"] == model.count(r["piece"]) <= limit[r["setting_id"]] for r in got)
    for s in limit:
        mine = sorted((r["piece_no"], r["begin"], r["end"], r["piece"]) for r in got if r["setting_id"] == s and r["doc_id"] == 1)
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1)) and joined([m[1:4] for m in mine], text) and all(text[b:e] == p for _, b, e, p in mine)
    with pytest.raises(ValueError):
        S.split_documents(docs, spark.createDataFrame([("wide", 32, 32)], "setting_id string, max_tokens int, overlap_tokens int"))
    assert S.split_documents(docs.limit(0), settings_).count() == 0 and S.split_documents(docs, settings_.limit(0)).count() == 0
