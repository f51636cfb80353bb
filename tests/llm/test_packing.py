import random

import numpy as np

from terrane.llm import packing
from terrane.llm.tokenizer import encoder


def test_hilbert_neighbours():
    side = 8
    cells = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    keys = packing.hilbert_key(cells, bits=3)
    assert sorted(keys) == list(range(side**3))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_packer_is_exact():
    rnd = np.random.default_rng(1)
    sizes = np.concatenate([rnd.integers(0, 300, 3000), rnd.integers(300, 5000, 200), np.zeros(50, int), np.full(40, 2048)])
    packer, rows = packing.Packer(2048, 0), []
    for lo in range(0, len(sizes), 512):
        rows += packer.pack(np.arange(lo, min(lo + 512, len(sizes))), sizes[lo : lo + 512])
    rows += packer.finish()
    check(rows, dict(enumerate(sizes.tolist())), 2048)
    used = sum(sizes) / (2048 * len({r[3] for r in rows}))
    assert used > 0.98


def test_batches_do_not_matter():
    sizes = np.random.default_rng(4).integers(0, 900, 700)
    def run(step):
        packer, rows = packing.Packer(1000, 0), []
        for lo in range(0, len(sizes), step):
            rows += packer.pack(np.arange(lo, min(lo + step, len(sizes))), sizes[lo : lo + step])
        return rows + packer.finish()
    assert run(1) == run(37) == run(700)


def test_containers_hold_neighbours():
    """Items of a container lie within a short stretch of the curve: nothing waits long behind the head of the window."""
    sizes = np.random.default_rng(5).integers(1, 700, 5000)
    packer = packing.Packer(2048, 0)
    rows = packer.pack(np.arange(5000), sizes) + packer.finish()
    boxes = {}
    for doc, _, _, box, _ in rows:
        boxes.setdefault(box, []).append(doc)
    spread = np.array([max(b) - min(b) for b in boxes.values()])
    assert np.median(spread) <= 2 * packing.WINDOW and 1 - sizes.sum() / (2048 * len(boxes)) < 0.005


def check(rows, sizes, capacity):
    by_doc, by_box = {}, {}
    for doc, piece, tokens, box, start in rows:
        by_doc.setdefault(doc, []).append((piece, tokens))
        by_box.setdefault(box, []).append((start, tokens))
    assert set(by_doc) == set(sizes)
    for doc, pieces in by_doc.items():
        pieces.sort()
        assert sum(t for _, t in pieces) == sizes[doc] and [p for p, _ in pieces] == list(range(len(pieces)))
        assert len(pieces) == max(1, -(-sizes[doc] // capacity))
    for parts in by_box.values():
        at = 0
        for start, tokens in sorted(p for p in parts if p[1]):
            assert start == at
            at += tokens
        assert at <= capacity


def test_frame(spark):
    rnd = random.Random(3)
    texts = [None, "", "  ", "x" * 9000, "same text"] + ["same text"] * 400 + [" ".join(rnd.choice(["road", "wall", "plot", "hedge"]) for _ in range(rnd.randrange(1, 400))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [tuple(r) for r in packing.fill_containers(df, "doc_id", "text", 256).collect()]
    check(rows, {i: len(encoder().encode(t)) for i, t in enumerate(texts)}, 256)
    assert packing.fill_containers(df.limit(0), "doc_id", "text", 256).count() == 0
