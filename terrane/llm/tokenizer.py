"""Encoding a corpus with a public byte-level BPE tokenizer.

Method: prefix dynamic programming. For every prefix of a pretoken the table keeps the one token
that its encoding ends with; it is the only vocabulary entry ending there that may follow the last
token of the prefix before it. Whether two tokens may stand side by side is found by taking their
merges back in time. Appending extends the table; an edit re-encodes from the edit until the table
agrees with the old one again.

Defined results: a null and an empty text give an empty list; special tokens' strings are ordinary
text; every other text, of any length, is encoded whole. Nothing is shuffled.
"""

from __future__ import annotations

import json
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_PATH = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: the split pattern of the public tokenizer, with white space spelt out as the Unicode property.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Pretokens kept per worker, and the longest that is kept.
CACHE_ENTRIES, CACHE_CHARS = 300_000, 48


def _byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary writes for each byte: printable ones themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(extra)
            extra += 1
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Tokens numbered by age: bytes 0 to 255, then one for each merge in order."""

    def __init__(self, path: str) -> None:
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = _byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.public = [model["vocab"][c] for c in letters]
        number = {c: b for b, c in enumerate(letters)}
        self.parts: list[tuple[int, int] | None] = [None] * 256
        self.merge: dict[tuple[int, int], int] = {}
        self.size = [1] * 256
        self.matcher = ahocorasick.Automaton()
        for pair in model["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            n = len(self.public)
            number[left + right] = n
            self.public.append(model["vocab"][left + right])
            self.parts.append((number[left], number[right]))
            self.merge[number[left], number[right]] = n
            self.size.append(self.size[number[left]] + self.size[number[right]])
        for text, n in number.items():
            self.matcher.add_word("".join(chr(byte_of[c]) for c in text), n)
        self.matcher.make_automaton()
        self.longest = max(self.size)
        self._beside: dict[tuple[int, int], bool] = {}

    def beside(self, a: int, b: int) -> bool:
        """Whether tokens ``a`` and ``b`` stay as they are when their bytes are encoded together."""
        known = self._beside.get((a, b))
        if known is None:
            if len(self._beside) > 2_000_000:
                self._beside.clear()
            known = self._beside[a, b] = self._undisturbed(a, b)
        return known

    def _undisturbed(self, a: int, b: int) -> bool:
        # Going back in time from the finished tokens, the merge across the border must never have
        # come up before the pieces at the border grew. At equal age the left one is merged first.
        before = len(self.public)
        while True:
            across = self.merge.get((a, b))
            if across is not None and across < before:
                return False
            if a > b:
                if self.parts[a] is None:
                    return True
                before, a = a, self.parts[a][1]
            else:
                if self.parts[b] is None:
                    if self.parts[a] is None:
                        return True
                    before, a = a, self.parts[a][1]
                else:
                    before, b = b + 1, self.parts[b][0]


class PrefixTable:
    """The last token of every prefix of a byte string, open to appends and edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, data: bytes) -> None:
        """Extend by ``data``; earlier entries hold for any continuation and stay."""
        vocabulary, last, size, beside = self.vocabulary, self.last, self.vocabulary.size, self.vocabulary.beside
        known = len(last)
        base = max(0, known - vocabulary.longest)
        self.data += data
        for end, token in vocabulary.matcher.iter(self.data[base:].decode("latin-1")):
            here = base + end
            if here < len(last):
                continue
            start = here + 1 - size[token]
            if start >= 0 and (start == 0 or beside(last[start - 1], token)):
                last.append(token)

    def replace(self, lo: int, hi: int, new: bytes) -> int:
        """Put ``new`` for bytes ``lo`` to ``hi``; gives the number of entries that were worked out anew."""
        old, tail = self.last, self.data[hi:]
        self.data, self.last = self.data[:lo], old[:lo]
        self.append(new)
        done, same = len(new), 0
        for i in range(0, len(tail), 64):
            self.append(tail[i : i + 64])
            for k in range(i, min(i + 64, len(tail))):
                same = same + 1 if self.last[lo + len(new) + k] == old[hi + k] else 0
            done += min(64, len(tail) - i)
            if same >= self.vocabulary.longest:
                rest = i + 64
                self.data += tail[rest:]
                self.last += old[hi + rest :]
                break
        return done

    def numbers(self) -> list[int]:
        out, i = [], len(self.last)
        while i:
            out.append(self.last[i - 1])
            i -= self.vocabulary.size[out[-1]]
        out.reverse()
        return out

    def ids(self) -> list[int]:
        return [self.vocabulary.public[n] for n in self.numbers()]


class Encoder:
    """Text to ids, remembering frequent pretokens."""

    def __init__(self, path: str = DEFAULT_PATH) -> None:
        self.vocabulary = Vocabulary(path)
        self.split = regex.compile(PATTERN).findall
        self.cache: dict[str, list[int]] = {}

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        cache = self.cache
        for piece in self.split(text):
            ids = cache.get(piece)
            if ids is None:
                ids = PrefixTable(self.vocabulary, piece.encode("utf-8", "surrogatepass")).ids()
                if len(piece) <= CACHE_CHARS:
                    if len(cache) >= CACHE_ENTRIES:
                        cache.clear()
                    cache[piece] = ids
            out += ids
        return out


@lru_cache(maxsize=2)
def encoder(path: str = DEFAULT_PATH) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def token_ids(text: Column, path: str = DEFAULT_PATH) -> Column:
    """array<int> of ids; Arrow batches, no shuffle."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode(texts: pd.Series) -> pd.Series:
        e = encoder(path)
        return pd.Series([e.encode(t) for t in texts], index=texts.index, dtype=object)

    return encode(text)


def encode_corpus(df: DataFrame, key: str, text: str, path: str = DEFAULT_PATH) -> DataFrame:
    """(key, ids) of every row."""
    return df.select(F.col(key), token_ids(F.col(text), path).alias("ids"))
