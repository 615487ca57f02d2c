"""Flattened documents and rescued CSV cells."""

from __future__ import annotations

import datetime as dt
import json
import random

from pyspark.sql import types as T

from basketwork.sources import nested, rescue


def frame(spark, documents: list):
    texts = [(i, d if d is None or isinstance(d, str) else json.dumps(d)) for i, d in enumerate(documents)]
    return nested.parsed(spark.createDataFrame(texts, "id int, json string"), "json")


def test_objects_become_typed_columns(spark):
    docs = [{"a": 1, "b": {"c": "x", "d": {"e": 1.5, "f": True}}}, {"a": 2, "b": {"d": None}, "g": [1, 2]}, None, "not json", "[1]"]
    flat = nested.flatten(frame(spark, docs), "document", ["id"], None)
    assert {f.name for f in flat.rows.schema.fields} == {"id", "document"}  # an array beside objects: no common object
    flat = nested.flatten(frame(spark, docs[:4]), "document", ["id"])
    kinds = dict(flat.rows.dtypes)
    assert kinds == {"id": "int", "a": "bigint", "b_c": "string", "b_d_e": "decimal(2,1)", "b_d_f": "boolean", "g": "array<bigint>"}
    rows = {r.id: r for r in flat.rows.collect()}
    assert (rows[0].a, rows[0].b_c, float(rows[0].b_d_e), rows[0].b_d_f, rows[0].g) == (1, "x", 1.5, True, None)
    assert (rows[1].a, rows[1].b_c, rows[1].g) == (2, None, [1, 2])
    assert all(rows[i].a is None for i in (2, 3))


def test_arrays_of_objects_become_children_at_any_depth(spark):
    docs = [{"n": 1, "l": [{"p": 1, "m": [{"q": "x"}, {"q": "y"}]}, {"p": 2}]}, {"n": 2, "l": []}, {"n": 3}]
    flat = nested.flatten(frame(spark, docs), "document", ["id"])
    child = flat.children["l"]
    assert sorted(map(tuple, child.rows.select("id", "position", "p").collect())) == [(0, 0, 1), (0, 1, 2)]
    deep = child.children["m"].rows
    assert sorted(map(tuple, deep.select("id", "position", "m_position", "q").collect())) == [(0, 0, 0, "x"), (0, 0, 1, "y")]


def test_mixed_odd_and_clashing_names(spark):
    docs = [{"k": 1, "a b": {"c.d": 1}, "a_b": 2, "id": 9, "v": [[1], [2]], "x": [1, "t"]}, {"k": "text"}, {"k": {"o": 1}}]
    flat = nested.flatten(frame(spark, docs), "document", ["id"])
    rows = {r.id: r.asDict() for r in flat.rows.collect()}
    assert [rows[i]["k"] for i in range(3)] == ["1", "text", '{"o":1}']
    assert rows[0]["a b_c.d"] == 1 and rows[0]["a_b"] == 2 and rows[0]["id"] == 0 and rows[0]["id_2"] == 9
    assert rows[0]["x"] == ["1", "t"]


def test_no_documents(spark):
    flat = nested.flatten(frame(spark, []), "document", ["id"])
    assert flat.rows.isEmpty() and not flat.children


def test_random_documents_equal_brute_force(spark):
    rng = random.Random(4)

    def value(depth: int):
        return {k: value(depth - 1) for k in rng.sample("abcd", rng.randrange(1, 4))} if depth else rng.randrange(9)

    def leaves(doc, names=()):
        return {"_".join(names): doc} if not isinstance(doc, dict) else {k: v for n, d in doc.items() for k, v in leaves(d, (*names, n)).items()}

    docs = [value(3) for _ in range(50)]
    flat = nested.flatten(frame(spark, docs), "document", ["id"]).rows
    rows = {r.id: r.asDict() for r in flat.collect()}
    for i, doc in enumerate(docs):
        assert {k: v for k, v in rows[i].items() if v is not None and k != "id"} == leaves(doc)


def test_rejected_documents(spark):
    df = spark.createDataFrame([(0, "{"), (1, "{}"), (2, None), (3, "3")], "id int, json string")
    assert [r.id for r in nested.rejected(df, "json").collect()] == [0]


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType()), T.StructField("price", T.DecimalType(8, 2)), T.StructField("late", T.StringType())])


def read(spark, tmp_path, text: str):
    path = tmp_path / "drop.csv"
    path.write_text(text)
    return rescue.read_csv(spark, str(path), SCHEMA)


def test_bad_cells_are_kept_and_counted(spark, tmp_path):
    text = 'day,id,more,price\n2024-01-31,1,x,1.50\nsoon,one,"a, ""b""\nc",2\n,,,\n2024-01-01,4,too,1,many\n2024-01-01,5\n2024-02-30,6,y,9999999999\n'
    found = read(spark, tmp_path, text)
    rows = {r.more: r for r in found.rows.collect()}
    assert (rows["x"].id, rows["x"].day, str(rows["x"].price), rows["x"].late, rows["x"].rescued) == (1, dt.date(2024, 1, 31), "1.50", None, None)
    odd = rows['a, "b"\nc']
    assert odd.rescued == {"day": "soon", "id": "one"} and odd.id is None and odd.price == 2
    assert rows["y"].rescued == {"day": "2024-02-30", "price": "9999999999"}
    assert rows[None].rescued is None
    assert sorted(r.record for r in found.broken.collect()) == ["2024-01-01,4,too,1,many", "2024-01-01,5"]
    assert found.rows.count() == 4 and found.broken.count() == 2
    assert {r.column_name: r.cells for r in rescue.report(found).collect()} == {"day": 2, "id": 1, "price": 1, "(record)": 2}


def test_a_header_alone(spark, tmp_path):
    found = read(spark, tmp_path, "id,day,price,late\n")
    assert found.rows.isEmpty() and rescue.report(found).isEmpty()
