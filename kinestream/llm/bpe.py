"""Byte-pair encoding and decoding with a public vocabulary file, by contiguous arrays of pair ranks."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from functools import cached_property, lru_cache
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that the pre-tokenizer takes as white space (Unicode's White_Space property).
SPACES = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SEGMENT = re.compile(f"[^{SPACES}]+")
#: str.split() also splits at these, which the pre-tokenizer takes as ordinary characters.
_NO_SPACE = re.compile("[\x1c-\x1f]")
_NONE = 1 << 60
#: Words of more parts than this use a heap, whose time grows by n log n.
SHORT = 96
#: Runs and words that a worker remembers at most, the characters and ids of all of them, which bounds them to some 70 MB, and the characters of one: longer ones
#: hardly come again. The first ones met stay, as they are mostly the frequent ones; after REFRESH others, which suggests other texts, it forgets all and starts anew.
REMEMBERED, HELD, LONGEST, REFRESH = 300_000, 5_000_000, 64, 3_000_000


@lru_cache(1)
def classes() -> dict[str, str]:
    """The characters of Unicode's categories L and N, and those that Python's tables lack, as the inside of a character class."""
    spans: dict[str, list[list[int]]] = {"L": [], "N": [], "Cn": []}
    for code in range(sys.maxunicode + 1):
        category = unicodedata.category(chr(code))
        own = spans.get(category if category == "Cn" else category[0])
        if own is None:
            continue
        if own and own[-1][1] == code - 1:
            own[-1][1] = code
        else:
            own.append([code, code])
    return {kind: "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in own) for kind, own in spans.items()}


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where it is printable, else the next unused from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBPE:
    """A BPE with word-end marks, as a tokenizers JSON file of that kind states it.

    Texts are composed (NFC) and put in lower case; white space only separates. Strings of special tokens
    inside a text are these tokens, as they are by the library's default. Merging is done here alone; of characters that Python's
    Unicode tables lack the library says class, case and composition.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            stated = json.load(f)
        model = stated["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.tokens = [""] * (max(max(vocab.values()), *(t["id"] for t in stated["added_tokens"])) + 1)
        for token, i in vocab.items():
            self.tokens[i] = token
        self.special = {t["content"]: t["id"] for t in stated["added_tokens"]}
        for content, i in self.special.items():
            self.tokens[i] = content
        self.decimals = [str(i) for i in range(len(self.tokens))]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {vocab[a] << 20 | vocab[b]: r for r, (a, b) in reversed([*enumerate(pairs)])}
        self.merged = [vocab[a + b] for a, b in pairs]
        letters = _byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + end] for c in letters]
        letter, number = classes()["L"], classes()["N"]
        self.piece = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{SPACES}{letter}{number}]+")
        self.newer = re.compile(f"[{classes()['Cn']}]")
        self.path = path
        self.splitter = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.plain = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
        self.known: dict[str, tuple[int, ...]] = {}
        self.passed = self.held = 0

    def word(self, word: str) -> list[int]:
        """The ids of one pre-token: the adjacent pair of least rank, the leftmost of equals, merges until none is left."""
        raw = word.encode()
        parts = [self.inner[b] for b in raw]
        parts[-1] = self.last[raw[-1]]
        if len(parts) > SHORT:
            return self._long(parts)
        rank, merged = self.ranks.get, self.merged
        ranks = [rank(a << 20 | b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
        left = len(ranks)
        while left and (least := min(ranks)) != _NONE:
            i = ranks.index(least)
            parts[i] = made = merged[least]
            del parts[i + 1], ranks[i]
            left -= 1
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 20 | made, _NONE)
            if i < left:
                ranks[i] = rank(made << 20 | parts[i + 1], _NONE)
        return parts

    def _long(self, parts: list[int]) -> list[int]:
        """The same for a word of any length: pairs wait in a heap by rank and place, parts are linked both ways."""
        rank, merged, n = self.ranks.get, self.merged, len(parts)
        before, after, gone = [*range(-1, n - 1)], [*range(1, n + 1)], bytearray(n)
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank(parts[i] << 20 | parts[i + 1], _NONE)) != _NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if not gone[i] else n
            if j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], gone[j], after[i] = merged[r], 1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if 0 <= x and y < n and (s := rank(parts[x] << 20 | parts[y], _NONE)) != _NONE:
                    heapq.heappush(heap, (s, x, parts[x], parts[y]))
        return [p for p, g in zip(parts, gone, strict=True) if not g]

    def _word(self, word: str) -> tuple[int, ...]:
        return self._keep(word, tuple(self.word(word)))

    def _keep(self, key: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        if len(key) > LONGEST:
            return ids
        if len(self.known) < REMEMBERED and self.held < HELD:
            self.known[key] = ids
            self.held += len(key) + len(ids)
        else:
            self.passed += 1
            if self.passed >= REFRESH:
                self.known.clear()
                self.passed = self.held = 0
        return ids

    @cached_property
    def _tables(self) -> tuple:
        """The library's normalizer and pre-tokenizer, whose Unicode tables are newer than Python's. Loaded where a text needs them."""
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.path)
        return library.normalizer, library.pre_tokenizer

    def words(self, part: str) -> list[str]:
        """The pre-tokens of a run without white space and special tokens."""
        if part.isascii():
            return self.plain.findall(part.lower())
        if self.newer.search(part):
            normalizer, splitter = self._tables
            plain = normalizer.normalize_str(part)
            return [plain[a:b] for _, (a, b) in splitter.pre_tokenize_str(plain)]
        # Lower case letter by letter: no final sigma.
        return self.piece.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())

    def segment(self, segment: str) -> tuple[int, ...]:
        """The ids of a run without white space. A pre-token is remembered as the run that it would be by itself."""
        known, new = self.known.get, self._word
        if segment.isascii() and segment.isalpha():
            word = segment.lower()
            found = known(word) or new(word)
            if word == segment:
                return found
        else:
            ids: list[int] = []
            for part in self.splitter.split(segment) if any(s in segment for s in self.special) else [segment]:
                if part in self.special:
                    ids.append(self.special[part])
                elif part:
                    for word in self.words(part):
                        ids += known(word) or new(word)
            found = tuple(ids)
        return self._keep(segment, found)

    def segments(self, text: str) -> list[str]:
        """The runs between white space. None of them changes the tokens of another."""
        return text.split() if not _NO_SPACE.search(text) else _SEGMENT.findall(text)

    def pieces(self, text: str) -> list[tuple[int, ...]]:
        """The ids of each segment, in order."""
        known, new = self.known.get, self.segment
        return [known(s) or new(s) for s in self.segments(text)]

    def encode(self, text: str | None) -> list[int]:
        return [*chain.from_iterable(self.pieces(text or ""))]

    def decode(self, ids: list[int]) -> str:
        """The tokens, joined by one space: the file states no decoder."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])


@lru_cache(2)
def load(path: str) -> WordBPE:
    """The tokenizer of a file, once in each Python worker."""
    return WordBPE(path)


def encoded(text: Column, path: str) -> Column:
    """The ids of a text as an array; of null: an empty one."""

    @F.pandas_udf("array<int>")
    def of(texts: pd.Series) -> pd.Series:
        bpe = load(path)
        return pd.Series([bpe.encode(t) for t in texts])

    return of(text)


def decoded(ids: Column, path: str) -> Column:
    """The text of an array of ids; of null: the empty text."""

    @F.pandas_udf("string")
    def of(arrays: pd.Series) -> pd.Series:
        bpe = load(path)
        return pd.Series([bpe.decode(a) if a is not None else "" for a in arrays])

    return of(ids)


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Each text is encoded, and its ids are decoded again, in the same task, so that neither leaves the worker.
    Null, empty and blank texts have no tokens; their digests are those of the empty string. Ids may be null and
    may repeat; other columns of ``docs`` are not read.
    """

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def of(texts: pd.Series) -> pd.DataFrame:
        bpe = load(path)
        decimals, rows = bpe.decimals, []
        for t in texts:
            ids = bpe.encode(t)
            joined = " ".join([decimals[i] for i in ids])
            rows.append((len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(bpe.decode(ids).encode()).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).alias("doc_id"), of(F.col(text_col)).alias("r")).select("doc_id", "r.*")
