import random
from datetime import datetime, timedelta

import pytest

from terrane.operators import references as ref
from terrane.session import Scratch

DAYS = [datetime(2024, 3, 1) + timedelta(days=i) for i in range(40)]
T = [datetime(2024, m, 1) for m in range(1, 13)]


def _run(spark, refs, live):
    r = spark.createDataFrame(refs, "src string, row_id long, key long, at timestamp_ntz")
    p = spark.createDataFrame(live, "key long, born timestamp_ntz, died timestamp_ntz")
    keys = Scratch(spark, "t").put(ref.orphan_keys(r.where("key is not null"), ref.existence_deltas(p, "key", "born", "died")), "k")
    return sorted(((x["src"], x["ref_month"], x["row_id"], x["fid"]) for x in ref.orphan_references(r, keys).collect()), key=str)


def _brute(refs, live):
    out = set()
    for src, row, key, at in refs:
        if key is None:
            continue
        born = [b for k, b, _ in live if k == key and b is not None]
        died = [d for k, _, d in live if k == key and d is not None]
        if not born or (at is not None and (at < min(born) or (died and at >= max(died)))):
            out.add((src, at and at.strftime("%Y-%m"), row, key))
    return sorted(out, key=str)


REFS = [("e", 1, 10, T[0]), ("e", 2, 10, T[1]), ("e", 3, 10, T[4]), ("e", 3, 10, T[4]), ("e", 4, 11, T[2]), ("e", 5, None, T[2]), ("e", 6, 12, None), ("e", 7, 10, None), ("e", 8, 13, T[3]), ("e", 9, 13, T[5]), ("e", 10, 14, T[0])]
LIVE = [(10, T[1], T[4]), (10, T[2], T[4]), (13, T[3], None), (14, None, None), (None, T[0], None)]


@pytest.mark.parametrize("most", [200_000, 0])
def test_against_brute(spark, monkeypatch, most):
    monkeypatch.setattr(ref, "MAX_BROADCAST_KEYS", most)
    hot = [("h", i, 77, T[i % 12]) for i in range(600)]
    assert sorted(_run(spark, REFS + hot, LIVE), key=str) == _brute(REFS + hot, LIVE)


def test_empty(spark):
    assert _run(spark, [], LIVE) == [] and _run(spark, [], []) == []
    assert len(_run(spark, REFS, [])) == len(_brute(REFS, []))


def _alive(changes, key, at):
    return sum(sign for k, t, sign in changes if k == key and t <= at) > 0


def test_ledger_over_batches(spark):
    """Deletion and creation again, late deletions, changes and references taken back: batches in any order give what counting says."""
    rnd = random.Random(8)
    changes, at = [], {}
    for _ in range(160):
        key = rnd.randrange(12)
        at[key] = at.get(key, 0) + rnd.randrange(1, 4)
        if at[key] < 40:
            alive = _alive(changes, key, DAYS[39])
            changes.append((key, DAYS[at[key]], -1 if alive else 1))
    refs = [("r", i, rnd.randrange(14), DAYS[rnd.randrange(40)]) for i in range(300)]
    taken_back = refs[:20]
    deltas = [(k, t, 0, s) for k, t, s in changes] + [(k, t, 1, 0) for _, _, k, t in refs] + [(k, t, -1, 0) for _, _, k, t in taken_back]
    rnd.shuffle(deltas)
    schema = "key long, at timestamp_ntz, refs long, exists long"
    state = spark.createDataFrame([], schema)
    scratch = Scratch(spark, "ledger")
    for i in range(3):
        state = scratch.put(ref.merge(state, spark.createDataFrame(deltas[i::3], schema)), f"s{i}")
    keys = scratch.put(ref.orphan_keys(state, state), "keys")
    left = spark.createDataFrame(refs[20:], "src string, row_id long, key long, at timestamp_ntz")
    got = sorted((r["row_id"], r["fid"]) for r in ref.orphan_references(left, keys).collect())
    assert got == sorted((i, k) for _, i, k, t in refs[20:] if not _alive(changes, k, t))
    assert state.where("refs = 0 and exists = 0").count() == 0


def test_state_is_minimal(spark):
    schema = "key long, at timestamp_ntz, refs long, exists long"
    state = ref.ledger(spark.createDataFrame([(1, T[0], 0, 1), (1, T[3], 0, -1), (2, T[1], 1, 0)], schema))
    undone = ref.merge(state, spark.createDataFrame([(1, T[3], 0, 1), (2, T[1], -1, 0)], schema)).collect()
    assert [(r["key"], r["at"], r["exists"]) for r in undone] == [(1, T[0], 1)]
