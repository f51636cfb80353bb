import os

import duckdb
import pytest

from terrane.llm import queries

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    rows = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
    assert rows
    if name in queries.ORACLES:
        con = duckdb.connect()
        for f in os.listdir(DIR):
            con.execute(f"create view {f[:-8]} as select * from '{DIR}/{f}'")
        cur = con.execute(queries.ORACLES[name])
        at = [[x[0] for x in cur.description].index(c) for c in cols]
        assert rows == sorted(tuple(str(r[i]) for i in at) for r in cur.fetchall())


def test_pairs_of_one_place_are_whole(spark):
    """Pairs are ordered, come once, and hold for all records of a place: if two records share a place with a third, they share it."""
    rows = [(r["left_fid"], r["right_fid"]) for r in queries.p3_found(spark, DIR).collect()]
    assert len(rows) == len(set(rows)) and all(a < b for a, b in rows)
    near = {}
    for a, b in rows:
        near.setdefault(a, {a}).add(b)
        near.setdefault(b, {b}).add(a)
    assert all(near[b] == near[a] for a, b in rows)


def test_packing_leaves_little_room(spark):
    room = queries.p8_room(spark, DIR).first()
    assert room["containers"] == -(-room["tokens"] // queries.CAPACITY) or room["unused_share"] < 0.02


def test_scores_found_and_rates_agree(spark):
    scores = {r["doc_id"]: (r["source"], r["score"]) for r in queries.p9_scores(spark, DIR).collect()}
    assert all(0 <= s <= 1 for _, s in scores.values())
    flagged = {d for d, (_, s) in scores.items() if s >= queries.moderation.THRESHOLD}
    assert {r["doc_id"] for r in queries.p9_found(spark, DIR).collect()} == flagged
    rates = {r["source"]: (r["documents"], r["flagged"]) for r in queries.p9_rates(spark, DIR).collect()}
    assert rates == {s: (sum(x == s for x, _ in scores.values()), sum(scores[d][0] == s for d in flagged)) for s in {x for x, _ in scores.values()}}
