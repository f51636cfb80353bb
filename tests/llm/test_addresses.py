from datetime import datetime

import pytest

from terrane.llm import addresses as ad
from terrane.session import Scratch

PARSED = [
    (("Flt 4", "41", "Ravenbarrow  Crt", "Faldirworth", "QA2 3PX"), ("4", "41", "", "qa2", "3px", [("ravenbarrow", "court")])),
    ((None, "1/12", "Fennfield Terrace", None, "QA1-1LL"), ("1", "12", "", "qa1", "1ll", [("fennfield", "terrace")])),
    ((None, None, "Fennfield Terrace 12 (flat 2)", None, None), ("2", "12", "", "", "", [("fennfield", "terrace")])),
    ((None, "No. 32-A", "Thornrook Cres", "X", None), ("", "32a", "", "", "", [("thornrook", "crescent")])),
    ((None, "25A.", "Brac Close", "X", None), ("", "25a", "", "", "", [("brac", "close")])),
    ((None, None, "12 N. Wendstead Cl", "X", None), ("", "12", "", "", "", [("north wendstead", "close")])),
    ((None, "17–19", "Fenn Ter", "X", "qa1"), ("", "17-19", "", "qa1", "", [("fenn", "terrace")])),
    (("PEBBLE HSE", None, "Old Gorse Cr", "", "QAI 1LL"), ("", "", "pebble house", "qa1", "1ll", [("old gorse", "crescent")])),
    ((None, None, None, None, None), ("", "", "", "", "", [])),
]


@pytest.mark.parametrize("fields,want", PARSED)
def test_parse(fields, want):
    assert ad.parse(*fields)[:6] == want


@pytest.mark.parametrize("a,b,same", [("abc", "abc", True), ("abc", "acb", True), ("abc", "ab", True), ("abc", "xabc", True), ("abc", "axc", True), ("abc", "cab", False), ("abc", "a", False)])
def test_edits_one(a, b, same):
    assert ad.edits_one(a, b) is same


def _record(fid, premise, number, road, locality, postcode, x=None, y=None):
    return (fid, premise, number, road, locality, postcode, x, y, datetime(2024, 1, 1))


SCHEMA = "point_fid long, address_premise string, address_number string, address_road string, address_locality string, postcode string, x_27700 double, y_27700 double, edited_at timestamp_ntz"


def test_pairs(spark):
    filler = [_record(1000 + i, None, str(100 + i), f"{name} {kind}", place, code) for i, (name, kind, place, code) in enumerate([("Thornbrook", "Crescent", "Faldirworth", "QA2 1AA")] * 6 + [("Birkwood", "Close", "Faldirworth", "QA2 3CC")] * 6 + [("Thornbrook", "Crescent", "Baxelham", "QA3 1AA")] * 6)]
    rows = [
        _record(1, None, "12", "Thornbrook Crescent", "Faldirworth", "QA2 1AA"), _record(2, None, None, "12, Thornbrok Cres", "Faldirworth", None), _record(3, None, "No 12", "Faldirworth", "THORNBROOK CR", "QA21AA"),
        _record(4, None, "12", "Thornbrook", "Faldirwrth", "QA2 1AA"), _record(5, "Flat 2", "12", "Thornbrook Crescent", "Faldirworth", "QA2 1AA"), _record(6, None, "2/12", "Thornbrook Cr", "Faldirworth", "QA2"),
        _record(7, None, "12a", "Thornbrook Crescent", "Faldirworth", "QA2 1AA"), _record(8, None, "12", "Thornbrook Crescent", "Baxelham", "QA3 1AA"), _record(9, None, "12-14", "Thornbrook Crescent", "Faldirworth", "QA2 1AA"),
        _record(10, "Heron Hse", None, "Birkwood Close", "Faldirworth", "QA2 3CC"), _record(11, None, None, "Heron House, Birkwod Clo", "Faldirworth", "QA2 3CC"), _record(12, "Heron Mill", None, "Birkwood Close", "Faldirworth", "QA2 3CC"),
        _record(13, None, None, None, None, None), _record(14, None, "12", None, None, None), _record(1, None, "12", "Thornbrook Crescent", "Faldirworth", "QA2 1AA"),
    ]
    df = spark.createDataFrame(rows + filler, SCHEMA)
    got = {(r[0], r[1]) for r in ad.same_place(df, Scratch(spark, "t")).collect() if r[0] < 1000 and r[1] < 1000}
    assert got == {(1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4), (5, 6), (10, 11)}


def test_empty(spark):
    assert ad.same_place(spark.createDataFrame([], SCHEMA), Scratch(spark, "t")).count() == 0
