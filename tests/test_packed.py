import pytest

from terrane.operators import packed

CASES = [
    (None, []), ("", []), ("   ", []), ("nan", []), ("None", []), ("[]", []), (" ; ", []), ("|", []), ("n/a", []), ("'nan'", []),
    ("12", ["12"]), ("12.0", ["12"]), ("1.0|2.00", ["1", "2"]), ("1||2", ["1", "2"]), ("|3|4|", ["3", "4"]), ("5, 6 ;7/8&9", ["5", "6", "7", "8", "9"]),
    ("[1, 2]", ["1", "2"]), ("{1,2}", ["1", "2"]), ("1 2\t3\n4", ["1", "2", "3", "4"]), ('"1|2|3"', ["1", "2", "3"]), ("'1';'2'", ["1", "2"]),
    ('"8795, rear"', ["8795, rear"]), ('1,"2, b",3', ["1", "2, b", "3"]), ("'36146-b'|7", ["36146-b", "7"]), ('"603 b";"4"', ["603 b", "4"]),
    ("7,7", ["7", "7"]), ('"10339,part 2"|none', ["10339,part 2"]), ("nan|5", ["5"]), ('5,"none",6', ["5", "6"]), ("1,2;3|4 5", ["1", "2", "3", "4", "5"]),
    ("1.5|2", ["1.5", "2"]), ("2024-01-05|3", ["2024-01-05", "3"]), ("12e3,4", ["12e3", "4"]), ('"a ""b"" c",7', ['a "b" c', "7"]), ('"1.0, 2.0";"x 3"', ["1", "2", "x 3"]), ("o'hara|5", ["5"]), ('"12|13', ["12", "13"]),
    ("  1 & 2 ", ["1", "2"]), ("1;2 3", ["1", "2", "3"]), ("''|4", ["4"]), ("1\u00a02", ["1", "2"]), ('"5 a" "6"', ["5 a", "6"]), ("(7)|[8]", ["7", "8"]),
    ('"9\', x"|3', ["9', x", "3"]), ("|".join(map(str, range(5000))), [str(i) for i in range(5000)]), (",".join(f'"{i}, a"' for i in range(800)), [f"{i}, a" for i in range(800)]),
]


def test_cases(spark):
    rows = [("s", i, text) for i, (text, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows * 2, "src string, row_id long, packed string")
    got: dict[int, list[str]] = {}
    for r in packed.unpack(df).orderBy("row_id", "pos").collect():
        got.setdefault(r["row_id"], []).append(r["item"])
        assert r["pos"] == len(got[r["row_id"]])
    for i, (text, want) in enumerate(CASES):
        assert got.get(i, []) == want, text


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "1|2", "x", 7)], "id long, f string, _skeleton string, _rule int")
    row = packed.split_packed(df, "f").first()
    assert row["items"] == ["1", "2"] and row["_skeleton"] == "x" and row["_rule"] == 7
    assert packed.unpack(spark.createDataFrame([], "src string, row_id long, packed string")).count() == 0


def test_null_row_id_and_shuffle_path(spark, monkeypatch):
    monkeypatch.setattr(packed, "MAX_BROADCAST_SKELETONS", 0)
    df = spark.createDataFrame([("s", None, "1,2"), ("s", None, "1,2"), ("s", 3, "'a b'")], "src string, row_id long, packed string")
    assert sorted((r["row_id"] is None, r["pos"], r["item"]) for r in packed.unpack(df).collect()) == [(False, 1, "a b"), (True, 1, "1"), (True, 2, "2")]


@pytest.mark.parametrize("shape,kind", [("", 0), (None, 0), ("|", 0), ("a", 0), ("9|9", 1), ('"9|9"', 1), ('"9, a"', 2), ("'9-a'", 2), ("a'a|9", 1)])
def test_rules(shape, kind):
    assert packed.rule_of(shape)[0] == kind


@pytest.mark.parametrize("shape,splits,keeps", [("9|9", "|", ",; /"), ("9, 9", ",", "| ;"), ("9 9", " \t\u00a0", "|,;"), ("9 ; 9 9", "; ", "|,"), ('"9|9"', '|"', ",; ")])
def test_marks(shape, splits, keeps):
    _, marks, seps, _ = packed.rule_of(shape)
    cut = {m for m, s in zip(marks, seps, strict=True) if s == packed._SEP}
    assert set(splits) <= cut and not set(keeps) & cut


def test_skeletons_are_few_and_keep_every_delimiter(spark):
    import random

    rnd = random.Random(1)
    texts = ["".join(f"{rnd.randrange(10**6)}{rnd.choice(['|', ',', '; ', ' '])}" for _ in range(60)) + "7" for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    shapes = [r[0] for r in df.select(packed.skeleton(df["t"])).collect()]
    assert len(set(shapes)) <= 4 and all({"|", ",", ";"} <= set(s) for s in shapes)
