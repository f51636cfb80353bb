import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from terrane.llm import tokenizer as tk

REFERENCE = Tokenizer.from_file(tk.DEFAULT_PATH)
REFERENCE.encode_special_tokens = True


def want(text):
    return REFERENCE.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=60))
def test_any_text(text):
    assert tk.encoder().encode(text) == want(text)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a" * 40_000, " " * 5000 + "x", "!" * 20_001, "it's we'll I'd \r\n\t x   y\x1c\x85z", "é" * 3000, "漢字🙂🏽" * 500, "0123456789" * 300])
def test_hard_texts(text):
    assert tk.encoder().encode(text) == want(text)


def test_append_and_replace():
    v, rnd = tk.encoder().vocabulary, random.Random(4)
    whole = b"internationalisation of the anchorgroups" * 20
    table = tk.PrefixTable(v)
    for i in range(0, len(whole), 37):
        table.append(whole[i : i + 37])
    assert table.last == tk.PrefixTable(v, whole).last
    for _ in range(20):
        lo = rnd.randrange(len(table.data))
        hi = min(len(table.data), lo + rnd.randrange(5))
        table.replace(lo, hi, bytes(rnd.choice(b"abction ") for _ in range(rnd.randrange(6))))
        assert table.last == tk.PrefixTable(v, table.data).last
    assert table.replace(5, 6, b"Q") < len(table.data) or len(table.data) < 400
    assert b"".join(tk_bytes(v, n) for n in table.numbers()) == table.data


def tk_bytes(v, n):
    return bytes([n]) if v.parts[n] is None else tk_bytes(v, v.parts[n][0]) + tk_bytes(v, v.parts[n][1])


def test_frame(spark):
    rows = [(1, None), (2, ""), (3, " "), (4, "two words"), (4, "two words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["ids"]) for r in tk.encode_corpus(df, "doc_id", "text").collect())
    assert got == [(1, []), (2, []), (3, want(" ")), (4, want("two words")), (4, want("two words"))]
    assert tk.encode_corpus(df.limit(0), "doc_id", "text").count() == 0
    assert "Exchange" not in tk.encode_corpus(df, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
