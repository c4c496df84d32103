import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from slatemill.llm import textnorm as T


def test_skeleton():
    same = [("１２ｘ，（ａ）", "12x,(a)"), ("é", "é"), ("a b　c\td", "a b c d"), ("a​b­‍c﻿", "abc"), ("Аᴀ"[0] + "РОС", "APOC"), ("⼀⻋⻓", "一车长"), ("Ω µ", "Ω μ"), ("ѐ", "è"), ("28∶71", "28:71"), ("a\r\nb", "a\nb")]
    for a, b in same:
        assert T.skeleton(a) == T.skeleton(b), (a, b)
    for a, b in (("x²", "x2"), ("a₂", "a2"), ("①", "1"), ("a b", "ab"), ("A", "a"), ("l", "1"), ("α", "a")):
        assert T.skeleton(a) != T.skeleton(b), (a, b)


def test_lattice_keeps_scripts_and_unites_shapes():
    counts = T.bigrams(["the cope price scope peace"] * 20 + ["Россия место сорок роса сор"] * 20)
    lattice = T.Lattice(counts)
    assert lattice.text("the сopе") == lattice.text("the cope") == "the cope"
    assert lattice.text("Pоcсия") == lattice.text("Россия") == "Россия"


def test_shared_shapes_are_told_by_the_search():
    """A bar that may be an I or an l is read as the corpus reads it there, against its likelier shape too."""
    lattice = T.Lattice(T.bigrams(["look little In It Iron old cold"] * 50))
    assert lattice.text("Ӏn") == lattice.text("In") == "In" and lattice.text("oӏd") == lattice.text("old") == "old"
    assert lattice.text("Ӏook") == lattice.text("ꓲook") == "look" and lattice.text("Ӏook") != T.skeleton("Ӏook")
    assert lattice.text("ᎪᏢ") == lattice.text("AP") and lattice.text("օld") == "old"
    assert lattice.text("I1") != lattice.text("l1") and lattice.text("O") != lattice.text("0")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([s for s in T.SHAPES]), min_size=1, max_size=12), st.randoms())
def test_form_depends_on_shape_only(shapes, rnd):
    lattice = T.Lattice(T.bigrams(["some cope", "сорок"]))
    forms = {lattice.text("".join(rnd.choice(s) for s in shapes)) for _ in range(6)}
    assert len(forms) == 1


def test_pairs(spark, rows):
    data = [("t", "1", "abc １"), ("t", "2", "abc 1"), ("t", "3", "abc 1"), ("t", "3", "abc 1"), ("u", "4", "аbc 1"), ("t", "5", None), ("t", "6", ""), ("t", "7", "​"), ("t", None, "аbc 1"), ("t", "8", "аbc 1" * 20_000), ("t", "9", "abc 1" * 20_000)]
    df = spark.createDataFrame(data, "src string, id string, text string").selectExpr("*", "'x' canonical_key", "1 raw_key", "'y' canonical")
    counts = T.count_bigrams(df, "text")
    got = rows(T.look_alikes(T.canonical(df, "text", counts, drop_text=True)))
    assert got == {("t", "1", "2"), ("t", "1", "3"), ("t", "6", "7"), ("t", "8", "9")}
    assert rows(T.look_alikes(T.canonical(df, "text", counts, drop_text=True), block=1)) == got
    classes = T.look_alike_classes(T.canonical(df, "text", counts, drop_text=True)).collect()
    assert sorted(r["id"] for r in classes) == ["1", "2", "3", "6", "7", "8", "9"] and len({r["class_id"] for r in classes}) == 3 and len({r["spelling"] for r in classes}) == 6
    assert {r["canonical"] for r in T.canonical(df, "text", counts).filter("id in ('1', '2', '3', '4')").collect()} == {"abc 1"}
    assert T.look_alikes(T.canonical(df.limit(0), "text", {}, drop_text=True)).count() == 0


def test_found_against_plain_grouping(spark, rows):
    from slatemill.llm.queries import QUERIES

    d, want = "/root/testdata/sf0.001", set()
    for table, key, column in (("task", "task_id", "stem"), ("ocr_lines", "line_id", "text")):
        seen = pd.read_parquet(f"{d}/{table}.parquet", columns=[key, column]).dropna().drop_duplicates()
        groups = {}
        for i, t in zip(seen[key], seen[column]):
            groups.setdefault(T.skeleton(t), []).append((i, t))
        want |= {(table, min(i, j), max(i, j)) for g in groups.values() for i, a in g for j, b in g if a != b and i != j}
    assert rows(QUERIES["p6_found"](spark, d), "src", "id_a", "id_b") == want
