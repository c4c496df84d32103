import random

import numpy as np
import pyarrow as pa

from slatemill.llm import leak as L

ITEMS = [("h1", "圆的半径为35.6，弦的长度为51.8，忽略彩绘键盘自身的质量与摩擦，点K在线段OK上移动，速度为每秒49.05 cm，请设计实验验证碘液的作用．"), ("h2", "The foggy barrel near the rapid festival was described by Halle because the telescope needed more water. Neither the quiet ladder nor the wild mirror could explain it."), ("h3", "短题"), ("h4", None), (None, "没有编号的题目没有编号的题目没有编号的题目")]


def planted(seed=3):
    """Documents with whole, half, damaged and torn passages, and with too little."""
    random.seed(seed)
    noise = lambda n: "".join(chr(random.randint(0x5000, 0x8000)) for _ in range(n))
    a, b = ITEMS[0][1], ITEMS[1][1]
    damaged = list(a)
    for k in range(20, len(a), 40):
        damaged[k] = "口"
    docs = [
        (1, noise(50) + a + noise(50), {"h1"}),
        (2, noise(500) + a[len(a) // 3 :] + noise(9), {"h1"}),
        (3, "".join(damaged), {"h1"}),
        (4, a[:30] + "\n（接上页）\n" + a[30:].replace("，", ", ") + noise(40), {"h1"}),
        (5, noise(9) + b.upper().replace(" ", "  ") + noise(5), {"h2"}),
        (6, a + b, {"h1", "h2"}),
        (7, noise(80) + a[:20] + noise(80), set()),
        (8, b[:50], set()),
        (9, noise(3000), set()),
        (10, "忽略彩绘键盘自身的质量与摩擦，" + noise(30) + "点K在线段OK上移动，", set()),
        (11, noise(200_000) + a + noise(100_000), {"h1"}),
    ]
    return docs


def test_planted(spark):
    docs = planted()
    df = spark.createDataFrame([(i, t) for i, t, _ in docs] + [(12, None), (13, ""), (None, ITEMS[0][1]), (1, docs[0][1])], "doc_id long, text string").selectExpr("*", "1 item_id", "'x' share")
    items = spark.createDataFrame(ITEMS + ITEMS[:1], "item_id string, text string").selectExpr("*", "7 doc_id")
    got = L.leaked_items(df, items).collect()
    assert len(got) == len({(r["doc_id"], r["item_id"]) for r in got})
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, h) for i, _, hs in docs for h in hs}
    assert all(0.4 < r["share"] <= 1 for r in got)
    assert L.leaked_items(df.limit(0), items).count() == 0 and L.leaked_items(df, items.limit(0)).count() == 0


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_CHARS", 10)
    df = spark.createDataFrame([(i, t) for i, t, _ in planted()], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in L.leaked_items(df, spark.createDataFrame(ITEMS, "item_id string, text string")).collect()}
    assert got == {(i, h) for i, _, hs in planted() for h in hs}


def torn():
    """Half of each item with an insertion of six characters at every third place and one character in forty damaged."""
    random.seed(5)
    noise = lambda n: "".join(chr(random.randint(0x5000, 0x8000)) for _ in range(n))
    out = []
    for item in (ITEMS[0][1], ITEMS[1][1]):
        for begin in (0, len(item) // 2):
            for at in range(4, len(item) // 2 - 4, 3):
                part = list(item[begin : begin + len(item) // 2 + 1])
                for k in range(random.randrange(40), len(part), 40):
                    part[k] = "口"
                out.append(noise(60) + "".join(part[:at]) + noise(6) + "".join(part[at:]) + noise(60))
    return out


def test_torn_as_by_brute_force(spark, monkeypatch):
    """Nothing that the alignment of every document with every item accepts is lost before it."""
    texts = torn() + [t for _, t, _ in planted()[:10]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in L.leaked_items(df, spark.createDataFrame(ITEMS[:2], "item_id string, text string")).collect()}
    monkeypatch.setattr(L, "_stretch", lambda *_: True)
    want = set()
    for name, item in ITEMS[:2]:
        item = L.bare(pa.array([item]))[0]
        for n, text in enumerate(texts):
            text = L.bare(pa.array([text]))[0]
            p, q = np.nonzero(L.rolled(text, L.ANCHOR)[:, None] == L.rolled(item, L.ANCHOR)[None, :])
            if len(p) and (x := L.passage(p, q, len(item), least=0.46 * len(item), agreement=0.9)) and x[1] > x[0]:
                want.add((n, name))
    assert got == want and len({n for n, _ in want if n < len(torn())}) > 0.9 * len(torn())


def test_long_items_with_scattered_damage(spark):
    """Whole copies of items of 50 to 3,000 characters with one damaged character in thirty or forty are all found."""
    random.seed(9)
    letters = [chr(c) for c in random.sample(range(0x4E00, 0x9000), 900)]
    items, docs = [], []
    for n in (50, 200, 500, 800, 1500, 3000):
        for part in (30, 40):
            text = [random.choice(letters) for _ in range(n)]
            items.append((f"{n}/{part}", "".join(text)))
            for k in range(random.randrange(part), n, part):
                text[k] = "口"
            docs.append((len(docs), "前文" * 20 + "".join(text) + "后文" * 20))
    got = {(r["doc_id"], r["item_id"]) for r in L.leaked_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")).collect()}
    assert got == {(k, name) for k, (name, _) in enumerate(items)}
