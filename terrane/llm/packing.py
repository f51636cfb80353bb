"""Filling containers of fixed capacity with items along a space-filling curve.

Method: every document becomes a hashed vector (each token id has a fixed random direction),
projected to three dimensions and placed on a Hilbert curve. Items are range-sorted by curve key and
packed along the curve: a container begins with the next item of the curve and takes, of the WINDOW
items after it, those whose sizes fill it best (exact subset sums, nearer items first). So a container
holds neighbours of the curve, and no more than WINDOW items wait. Only (id, size, key) is shuffled.

Defined results
- an item over the capacity is cut into full containers and a rest, which is packed like an item;
- an item without size (null or empty text) goes into the next container, or opens one if there is none;
- the result does not depend on the size of the batches that reach a task;
- ties on the curve are ordered by id, so many equal items spread over several ranges;
- the container of an item depends on the number of ranges, which follows the number of items.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.llm.tokenizer import DEFAULT_PATH, encoder
from terrane.session import Scratch

DIMENSIONS, BITS = 3, 16
ITEMS_PER_RANGE, WINDOW = 50_000, 48

PLACED = "doc_id long, piece int, tokens int, container_id long, start int"


def _directions(n: int) -> np.ndarray:
    """A fixed unit-variance direction for each token id; rarer tokens (later ids) weigh more."""
    mixed = (np.arange(n, dtype=np.uint64)[:, None] * np.uint64(DIMENSIONS) + np.arange(DIMENSIONS, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(30)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(27)
    sign = np.where((mixed >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
    return sign * np.log2(2.0 + np.arange(n))[:, None]


def place(ids: list[int], directions: np.ndarray) -> np.ndarray:
    """Grid cell of one document: its damped token counts projected, each axis spread evenly by the normal law."""
    if not ids:
        return np.zeros(DIMENSIONS, dtype=np.int64)
    tokens, counts = np.unique(np.asarray(ids), return_counts=True)
    weight = 1.0 + np.log(counts)
    used = directions[tokens] * weight[:, None]
    scale = math.sqrt(float((used[:, 0] ** 2).sum()))
    z = used.sum(axis=0) / scale
    share = [0.5 * (1.0 + math.erf(v / math.sqrt(2.0))) for v in z]
    return np.array([min(2**BITS - 1, int(s * 2**BITS)) for s in share], dtype=np.int64)


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Distance along the Hilbert curve of rows of grid coordinates (Gray-code transposition)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = np.int64(1) << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], dtype=np.int64)
    q = np.int64(1) << (bits - 1)
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros(x.shape[1], dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def size_and_key(text: Column, path: str = DEFAULT_PATH) -> Column:
    """struct(tokens, key) of a text."""
    made = T.StructType([T.StructField("tokens", T.IntegerType()), T.StructField("key", T.LongType())])

    @F.pandas_udf(made)
    def measure(texts: pd.Series) -> pd.DataFrame:
        e = encoder(path)
        directions = getattr(e, "directions", None)
        if directions is None:
            directions = e.directions = _directions(max(e.vocabulary.public) + 2)
        sizes, cells = np.zeros(len(texts), dtype=np.int32), np.zeros((len(texts), DIMENSIONS), dtype=np.int64)
        for i, text in enumerate(texts):
            ids = e.encode(text)
            sizes[i], cells[i] = len(ids), place(ids, directions)
        return pd.DataFrame({"tokens": sizes, "key": hilbert_key(cells)})

    return measure(text)


Row = tuple[int, int, int, int, int]


class Packer:
    """Fills one container after the other from a window of the items next on the curve."""

    def __init__(self, capacity: int, first: int, window: int = WINDOW) -> None:
        self.capacity, self.next, self.window = capacity, first, window
        self.waiting: list[tuple[int, int, int]] = []
        self.empty: list[tuple[int, int]] = []
        self.mask = (1 << (capacity + 1)) - 1

    def _container(self) -> int:
        self.next += 1
        return self.next - 1

    def _fill(self) -> list[Row]:
        """The next container: the head of the window and the later items that leave the least room."""
        items = self.waiting
        reach, steps = 1 << items[0][0], []
        for size, _, _ in items[1:]:
            steps.append(reach)
            reach |= (reach << size) & self.mask
        total, taken = reach.bit_length() - 1, set()
        for i in range(len(steps) - 1, -1, -1):
            if not (steps[i] >> total) & 1:
                taken.add(i + 1)
                total -= items[i + 1][0]
        taken.add(0)
        box, out, at = self._container(), [], 0
        for i in sorted(taken):
            size, doc, piece = items[i]
            out.append((doc, piece, size, box, at))
            at += size
        out += [(doc, piece, 0, box, at) for doc, piece in self.empty]
        self.empty = []
        self.waiting = [x for i, x in enumerate(items) if i not in taken]
        return out

    def pack(self, ids: np.ndarray, sizes: np.ndarray) -> list[Row]:
        """Rows (doc_id, piece, tokens, container, start) of the containers filled by now."""
        out: list[Row] = []
        for doc, size in zip(ids.tolist(), sizes.tolist(), strict=True):
            pieces, rest = divmod(size, self.capacity)
            out += [(doc, piece, self.capacity, self._container(), 0) for piece in range(pieces)]
            if rest:
                self.waiting.append((rest, doc, pieces))
                if len(self.waiting) > self.window:
                    out += self._fill()
            elif not pieces:
                self.empty.append((doc, 0))
        return out

    def finish(self) -> list[Row]:
        """The rest of a range."""
        out: list[Row] = []
        while self.waiting:
            out += self._fill()
        if self.empty:
            box = self._container()
            out += [(doc, piece, 0, box, 0) for doc, piece in self.empty]
            self.empty = []
        return out


def fill_containers(docs: DataFrame, key: str, text: str, capacity: int, path: str = DEFAULT_PATH) -> DataFrame:
    """(doc_id, piece, tokens, container_id, start) of all documents."""
    scratch = Scratch(docs.sparkSession, "packing")
    items = scratch.put(
        docs.select(F.col(key).alias("doc_id"), size_and_key(F.col(text), path).alias("m")).select("doc_id", "m.tokens", "m.key"), "items"
    )
    ranges = max(1, -(-items.count() // ITEMS_PER_RANGE))

    def along(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        packer = Packer(capacity, TaskContext.get().partitionId() << 40)
        names = ["doc_id", "piece", "tokens", "container_id", "start"]
        for batch in batches:
            yield pd.DataFrame(packer.pack(batch["doc_id"].to_numpy(), batch["tokens"].to_numpy()), columns=names)
        yield pd.DataFrame(packer.finish(), columns=names)

    ordered = items.repartitionByRange(ranges, "key", "doc_id").sortWithinPartitions("key", "doc_id").select("doc_id", "tokens")
    return ordered.mapInPandas(along, PLACED)


def curve_spread(placed: DataFrame, docs: DataFrame, key: str, text: str, path: str = DEFAULT_PATH) -> DataFrame:
    """One row: the mean standard deviation, within a container, of the place on the curve (0 to 1); 0.29 or a little
    less, for small containers, in random order."""
    keys = docs.select(F.col(key).alias("doc_id"), size_and_key(F.col(text), path)["key"].alias("key"))
    share = F.col("key") / F.lit(float(2 ** (DIMENSIONS * BITS)))
    boxes = placed.where("tokens > 0").select("doc_id", "container_id").distinct().join(keys, "doc_id").groupBy("container_id").agg(
        F.stddev_pop(share).alias("spread"), F.count("*").alias("n")
    )
    return boxes.where("n > 1").agg(F.avg("spread").alias("spread"))
