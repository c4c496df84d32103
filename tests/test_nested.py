import json
import random

from slatemill.operators.nested import Broken, Record, parse_triples, pivot_group, related_tables, triples, typed_tables


def loads(text):
    while isinstance(text, str):
        text = json.loads(text)
    return text


def test_layouts_give_the_same_nodes():
    flat = [{"id": "a", "kids": [{"id": "b"}, None, {"id": "c"}]}]
    for root in (flat, {"items": flat}, [flat], json.dumps(flat), json.dumps(json.dumps({"items": json.dumps(flat)}))):
        got = list(triples(json.dumps(root), "n"))
        assert sorted(v for *_, leaf, v in got if leaf == "id") == ["a", "b", "c"]
        parents = {v: p for _, i, p, _, leaf, v in got if leaf == "id"}
        inst = {v: i for _, i, _, _, leaf, v in got if leaf == "id"}
        assert parents["b"] == parents["c"] == inst["a"] and parents["a"] == "" and len(set(inst.values())) == 3
    ordinals = {v: k for _, _, _, k, leaf, v in triples(json.dumps(flat), "n") if leaf == "id"}
    assert ordinals == {"a": 1, "b": 1, "c": 3}


def test_maps_scalars_and_depth():
    got = list(triples(json.dumps({"x": {"t": 1, "pages": [3, 4]}, "y": {"t": None}}), "n"))
    assert [v for *_, leaf, v in got if leaf == "@key"] == ["x", "y"] and [v for *_, leaf, v in got if leaf == "@value"] == ["3", "4"]
    assert len({i for _, i, *_, leaf, _ in got if leaf == "@"}) == 4
    deep = '[{"id": "z", "c": ' * 2000 + "[]" + "}]" * 2000
    assert sum(leaf == "id" for *_, leaf, _ in triples(deep, "n")) == 2000
    assert [v for *_, leaf, v in triples("[" * 20_000 + '{"id": 7}' + "]" * 20_000, "n") if leaf == "id"] == ["7"]
    for broken in (None, "", "{broken", "[1,]", '{"a" 1}', "[1] 2", '{"a": 1]', "[", "nul", '["a]'):
        assert list(triples(broken, "n")) == []
    assert list(triples("[]", "n")) == [] and list(triples("null", "n")) == []


def test_wrappings_do_not_run_together():
    """Members of different wrappings at equal places stay apart; fields that are null make an instance of their element."""
    got = list(triples('[{"items": [{"id": "a"}]}, {"items": [{"id": "b"}]}, {"id": null, "items": [{"id": "c"}]}, [[1, 2], [3]]]', "n"))
    inst = {v: (i, p) for _, i, p, _, leaf, v in got if leaf in ("id", "@value")}
    assert len(set(inst.values())) == 6 and inst["a"][1] == inst["b"][1] == "" and inst["c"][1] != ""
    assert [v for *_, leaf, v in triples('{"a": 1, "a": 2}', "n") if leaf == "a"] == ["2"]
    assert {leaf: v for *_, leaf, v in triples('[{"a": {"b": {"c": 1.50}, "d": "\\u4e00"}, "e": true}]', "n") if v} == {"a.b.c": "1.50", "a.d": "一", "e": "true"}


def test_stream_reads_what_the_json_module_reads():
    random.seed(4)

    def made(depth):
        kind = random.randrange(6 if depth else 3)
        if kind < 3:
            return random.choice([None, True, 1.5e3, -7, "", "a\"b\\c\n", "[oops", "汉字", "{}x"])
        return [made(depth - 1) for _ in range(random.randrange(4))] if kind < 5 else {f"k{i}": made(depth - 1) for i in range(random.randrange(4))}

    def plain(x):
        return [y for v in (x.values() if isinstance(x, dict) else x) for y in plain(v)] if isinstance(x, (dict, list)) else [] if x is None else [x if isinstance(x, str) else json.loads(json.dumps(x))]

    for _ in range(400):
        value = [made(4)]
        text = json.dumps(value, ensure_ascii=random.random() < 0.5, indent=random.choice([None, 1]))
        got = [v for _, _, _, v in Record(text).leaves]
        assert [str(x) for x in got] == [x if isinstance(x, str) else json.dumps(x) for x in plain(value)]
        cut = text[: random.randrange(1, len(text))]
        try:
            json.loads(cut)
        except ValueError:
            try:
                Record(cut)
                raise AssertionError(cut)
            except Broken:
                pass


def test_typed_and_related_tables(spark, rows):
    df = spark.createDataFrame([(1, [{"a": "x", "s": {"b": 2}, "e": [{"q": "1"}, None]}, None, {"a": None, "s": None, "e": []}]), (2, None), (3, [])], "id int, c array<struct<a:string,s:struct<b:int>,e:array<struct<q:string>>>>")
    got = typed_tables(df, "id", "c")
    assert rows(got["c"].selectExpr("record_id", "concat_ws('.', cast(places as array<string>))", "a", "s_b")) == {("1", "1", "x", 2), ("1", "3", None, None)}
    assert rows(got["c.e"].selectExpr("record_id", "concat_ws('.', cast(places as array<string>))", "q")) == {("1", "1.1", "1")}
    parsed = parse_triples(spark.createDataFrame([("r", '[{"id": "a", "pages": [3, 3], "x": {"y": 1}}]')], "r string, j string"), "r", "j", "n")
    tables = related_tables(parsed)
    assert set(tables) == {"n", "n.pages"} and rows(tables["n"], "id", "x_y") == {("a", "1")} and sorted(r["value"] for r in tables["n.pages"].collect()) == ["3", "3"]


def test_tables(spark, rows):
    records = [("r1", json.dumps([{"id": "a", "v": 1}, {"id": "b"}])), ("r1", json.dumps([{"id": "a", "v": 1}, {"id": "b"}])), ("r2", None), ("r3", "oops"), ("r4", "[]")]
    df = spark.createDataFrame(records, "rid string, j string").selectExpr("*", "'clash' path", "'clash' value")
    table = pivot_group(parse_triples(df, "rid", "j", "n"), {"id": "id", "v": "v"})
    assert rows(table, "record_id", "ordinal", "id", "v") == {("r1", 1, "a", "1"), ("r1", 2, "b", None)}
    assert pivot_group(parse_triples(df.limit(0), "rid", "j", "n"), {"id": "id"}).count() == 0


def test_found_against_plain_recursion(spark, rows):
    """p5_found on a data directory against a recursion written apart from it."""
    import pandas as pd

    from slatemill.queries import QUERIES

    d, want = "/root/testdata/sf0.001", set()
    for r in pd.read_parquet(f"{d}/predictions.parquet").to_dict("records"):
        for i, c in enumerate(r["final_top3"] if r["final_top3"] is not None else [], 1):
            if c is not None:
                want.add(("predictions", r["prediction_id"], "candidate", str(i), r["prediction_id"]))
                for j, e in enumerate(c["evidence"] if c["evidence"] is not None else [], 1):
                    if e is not None:
                        want.add(("predictions", r["prediction_id"], "evidence", f"{i}.{j}", str(i)))
    for r in pd.read_parquet(f"{d}/lesson_split.parquet").to_dict("records"):
        rid = r["split_id"]

        def task(t, above):
            want.add(("lesson_split", rid, "task", t["task_id"], t.get("section_id") or above))
            for side, pages in (t.get("source_pages") or {}).items():
                for page in pages if isinstance(pages, list) else [pages]:
                    if page is not None:
                        want.add(("lesson_split", rid, "page", f"{side}:{page}", t["task_id"]))

        def node(n, above, key=None):
            own = n.get("node_id", key)
            want.add(("lesson_split", rid, "node", own, n.get("parent_id") or above))
            for x in n.get("children") or []:
                node(x, own)
            for x in n.get("tasks") or []:
                task(x, own)

        nodes, tasks = loads(r["nodes"]), loads(r["tasks"])
        if isinstance(nodes, dict) and "node_id" not in nodes:
            for k, n in nodes.items():
                node(n, rid, k)
        else:
            for n in [nodes] if isinstance(nodes, dict) else nodes or []:
                node(n, rid)
        for t in (tasks["items"] if isinstance(tasks, dict) else tasks) or []:
            task(t, rid)
    assert rows(QUERIES["p5_found"](spark, d), "src", "record_id", "child_kind", "child_id", "parent_id") == want
