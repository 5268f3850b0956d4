"""BPE encoding by dynamic programming over prefixes, and decoding.

Each prefix of a word has exactly one encoding, so it is enough to store the
last token of every prefix.  A suffix automaton over the vocabulary gives, at
each position, the tokens that end there, longest first; a token is the last one
if it may follow the last token of the prefix in front of it.  Whether two
tokens may stand side by side is found by undoing their merges, latest first:
no merge across the border may come earlier than the merge just undone.
Following the stored tokens back from the end of the word gives the ids.

The words of a batch of texts are encoded side by side with numpy; words met
before come from a bounded memory.

NULL or empty text: no tokens.  Rows are independent: repeated rows, NULL keys
and further columns change nothing; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakemart.llm.common import batch_of, sha256, ship, slices

ENDS = 256  # added to the byte at the end of a word
SYMBOLS = 512
NEVER = np.int64(1 << 40)
CELLS = 1 << 21  # of the table words x positions
REMEMBERED = 250_000  # words
# White space as the tokenizer's regular expressions see it (fixed values).
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
EXPECTED_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Lookup:
    """Integer keys to integers, as an open hash table in numpy arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 2.5))))
        size = 1 << self.bits
        self.keys = np.full(size, -1, dtype=np.int64)
        self.values = np.full(size, -1, dtype=np.int64)
        left = np.arange(len(keys))
        slot = self._home(keys)
        while len(left):
            free = self.keys[slot] == -1
            first = np.unique(slot[free], return_index=True)[1]
            winners = np.flatnonzero(free)[first]
            self.keys[slot[winners]] = keys[left[winners]]
            self.values[slot[winners]] = values[left[winners]]
            rest = np.ones(len(left), dtype=bool)
            rest[winners] = False
            left, slot = left[rest], (slot[rest] + 1) & (size - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, -1 where a key is missing."""
        slot = self._home(keys)
        there = self.keys[slot]
        found = np.where(there == keys, self.values[slot], -1)
        open_rows = np.flatnonzero((there != keys) & (there != -1))
        while len(open_rows):
            slot[open_rows] = (slot[open_rows] + 1) & (len(self.keys) - 1)
            there = self.keys[slot[open_rows]]
            hit = there == keys[open_rows]
            found[open_rows[hit]] = self.values[slot[open_rows[hit]]]
            open_rows = open_rows[~hit & (there != -1)]
        return found


class SuffixAutomaton:
    """All substrings of the vocabulary; states know the token that ends in them."""

    def __init__(self, tokens: list[tuple[int, ...]]):
        steps: list[dict[int, int]] = [{}]
        link, length = [-1], [0]

        def add(last: int, symbol: int) -> int:
            known = steps[last].get(symbol)
            if known is not None and length[known] == length[last] + 1:
                return known
            if known is not None:
                return split(last, symbol, known)
            new = len(steps)
            steps.append({})
            link.append(0)
            length.append(length[last] + 1)
            at = last
            while at != -1 and symbol not in steps[at]:
                steps[at][symbol] = new
                at = link[at]
            if at != -1:
                target = steps[at][symbol]
                link[new] = target if length[target] == length[at] + 1 else split(at, symbol, target)
            return new

        def split(at: int, symbol: int, target: int) -> int:
            copy = len(steps)
            steps.append(dict(steps[target]))
            link.append(link[target])
            length.append(length[at] + 1)
            link[target] = copy
            while at != -1 and steps[at].get(symbol) == target:
                steps[at][symbol] = copy
                at = link[at]
            return copy

        for token in tokens:
            last = 0
            for symbol in token:
                last = add(last, symbol)
        self.link = np.array(link, dtype=np.int64)
        self.length = np.array(length, dtype=np.int64)
        keys = np.fromiter((s * SYMBOLS + c for s, d in enumerate(steps) for c in d), dtype=np.int64)
        values = np.fromiter((t for d in steps for t in d.values()), dtype=np.int64)
        self.steps = Lookup(keys, values)
        self.token = np.full(len(steps), -1, dtype=np.int64)
        for number, token in enumerate(tokens):
            at = 0
            for symbol in token:
                at = steps[at][symbol]
            self.token[at] = number
        # The next state up the suffix links that ends a token.
        self.shorter = np.full(len(steps), -1, dtype=np.int64)
        for state in np.argsort(self.length, kind="stable")[1:]:
            up = self.link[state]
            self.shorter[state] = up if self.token[up] >= 0 else self.shorter[up]

    def advance(self, state: np.ndarray, size: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest suffix of (text + symbol) that the vocabulary contains."""
        state, size = state.copy(), size.copy()
        result = self.steps.get(state * SYMBOLS + symbol)
        rows = np.flatnonzero((result < 0) & (state > 0))
        while len(rows):
            state[rows] = self.link[state[rows]]
            size[rows] = self.length[state[rows]]
            result[rows] = self.steps.get(state[rows] * SYMBOLS + symbol[rows])
            rows = rows[(result[rows] < 0) & (state[rows] > 0)]
        return np.maximum(result, 0), np.where(result >= 0, size + 1, 0)


class BpeModel:
    """A word-end BPE vocabulary with the tests the dynamic programme needs.

    Tokens carry internal numbers: the bytes, the bytes at the end of a word,
    then the merges in their order.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        splitter = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or splitter != EXPECTED_SPLIT:
            raise ValueError(f"{path}: not a word-end BPE vocabulary")
        end, vocab, letters = model["end_of_word_suffix"], model["vocab"], byte_letters()
        names = [*letters, *(c + end for c in letters)]
        number = {name: i for i, name in enumerate(names)}
        spelled: list[tuple[int, ...]] = [(i,) for i in range(SYMBOLS)]
        left, right = list(range(SYMBOLS)), list(range(SYMBOLS))
        for a, b in model["merges"]:
            if a + b in number:
                raise ValueError(f"{path}: two merges make one token")
            number[a + b] = len(names)
            names.append(a + b)
            left.append(number[a])
            right.append(number[b])
            spelled.append(spelled[number[a]] + spelled[number[b]])
        self.left, self.right = np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)
        merged = np.arange(SYMBOLS, len(names), dtype=np.int64)
        self.pairs = Lookup(self.left[merged] * (1 << 20) + self.right[merged], merged)
        self.size = np.array([len(s) for s in spelled], dtype=np.int64)
        self.automaton = SuffixAutomaton(spelled)
        self.id_text = [str(vocab[n]) for n in names]
        self.names = names
        self.special = {t["content"]: str(t["id"]) for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.words = regex.compile(splitter.replace(r"\s", BLANK))
        self.ids: dict[str, str] = {}
        self.decoded: dict[str, str] = {}

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether the encoding of both texts together keeps the border between them."""
        a, b = first.copy(), second.copy()
        limit = np.full(len(a), NEVER)
        good = np.ones(len(a), dtype=bool)
        rows = np.arange(len(a))
        while len(rows):
            x, y = a[rows], b[rows]
            across = self.pairs.get(x * (1 << 20) + y)
            broken = (across >= 0) & (across < limit[rows])
            good[rows[broken]] = False
            undo_x = (self.left[x] != x) & ((x > y) | (self.left[y] == y))
            undo_y = ~undo_x & (self.left[y] != y)
            limit[rows] = np.where(undo_x, x, y + 1)
            a[rows] = np.where(undo_x, self.right[x], x)
            b[rows] = np.where(undo_y, self.left[y], y)
            rows = rows[~broken & (undo_x | undo_y)]
        return good

    def encode_words(self, words: list[str]) -> list[tuple[str, str]]:
        """(ids joined by a space, tokens joined by a space) of each word."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.array([len(r) for r in raw], dtype=np.int64)
        order = np.argsort(-sizes, kind="stable")
        out: list[tuple[str, str]] = [("", "")] * len(words)
        start = 0
        while start < len(order):
            longest = int(sizes[order[start]])
            rows = order[start : start + max(1, CELLS // longest)]
            start += len(rows)
            flat = np.frombuffer(b"".join([raw[r] for r in rows]), dtype=np.uint8).astype(np.int64)
            self._encode_block(flat, sizes[rows], rows, out)
        return out

    def _encode_block(self, flat: np.ndarray, sizes: np.ndarray, rows: np.ndarray, out: list) -> None:
        # Words lie one behind the other, longest first: those that reach a position come first.
        begin = np.cumsum(sizes) - sizes
        flat[begin + sizes - 1] += ENDS
        last = np.full(len(flat), -1, dtype=np.int64)
        state = np.zeros(len(rows), dtype=np.int64)
        size = np.zeros(len(rows), dtype=np.int64)
        auto = self.automaton
        for at in range(int(sizes[0])):
            reach = int(np.searchsorted(-sizes, -at, side="left"))
            here = begin[:reach] + at
            state, size = auto.advance(state[:reach], size[:reach], flat[here])
            whole = (auto.token[state] >= 0) & (auto.length[state] == size)
            candidate = np.where(whole, state, auto.shorter[state])
            left = np.arange(reach)
            while len(left):
                token = auto.token[candidate[left]]
                before = at - self.size[token]
                fits = before < 0
                inner = np.flatnonzero(~fits)
                fits[inner] = self.compatible(last[begin[left[inner]] + before[inner]], token[inner])
                last[here[left[fits]]] = token[fits]
                left = left[~fits]
                candidate[left] = auto.shorter[candidate[left]]
        # Back from the ends: one token of every unfinished word a round.
        position = sizes - 1
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        live = np.arange(len(rows))
        while len(live):
            token = last[begin[live] + position[live]]
            parts.append((live, token))
            position[live] -= self.size[token]
            live = live[position[live] >= 0]
        owner = np.concatenate([p[0] for p in parts])
        tokens = np.concatenate([p[1] for p in parts])
        turn = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        by_word = np.lexsort((-turn, owner))
        tokens = tokens[by_word].tolist()
        ends = np.cumsum(np.bincount(owner, minlength=len(rows))).tolist()
        ids, names, low = self.id_text, self.names, 0
        for row, high in zip(rows.tolist(), ends):
            own = tokens[low:high]
            if len(own) == 1:
                out[row] = (ids[own[0]], names[own[0]])
            else:
                out[row] = (" ".join([ids[t] for t in own]), " ".join([names[t] for t in own]))
            low = high

    def words_of(self, text: str) -> list[str]:
        """The words of a text, normalised; special tokens as they stand."""
        if "<|" in text:
            parts = self.special_split.split(text)
            return [w for p in parts for w in ([p] if p in self.special else self._plain(p))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        # Lower case letter by letter: no rule for the sigma at a word's end.
        normal = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return self.words.findall(normal)

    def learn(self, words: set[str]) -> None:
        """Remember ids and tokens of words, in a memory of bounded size."""
        if len(self.ids) + len(words) > REMEMBERED:
            self.ids.clear()
            self.decoded.clear()
        new = [w for w in words if w not in self.ids]
        for word, (ids, tokens) in zip(new, self.encode_words(new)):
            self.ids[word] = ids
            self.decoded[word] = tokens
        for token, number in self.special.items():
            self.ids[token], self.decoded[token] = number, token

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of tokens, ids, decoded text) of each text."""
        lists = [self.words_of(t) for t in texts]
        self.learn({w for words in lists for w in words}.difference(self.special))
        rows = []
        for words in lists:
            ids = " ".join(map(self.ids.__getitem__, words))
            rows.append((ids.count(" ") + bool(ids), ids, " ".join(map(self.decoded.__getitem__, words))))
        return rows


@lru_cache(maxsize=2)
def load_model(path: str) -> BpeModel:
    return BpeModel(path)


def encode_decode(
    docs: DataFrame, path: str, keys: tuple[str, ...] = ("doc_id",), text: str = "text", digests: bool = False
) -> DataFrame:
    """The keys with n_tokens, ids (joined by a space) and the decoded text.

    ``digests`` returns ids_sha256 and decoded_sha256 in place of the two texts.
    """
    ship(docs.sparkSession)
    names = list(keys)
    columns = ("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(path)
        for batch, texts in slices(batches, "__text"):
            rows = model.encode(texts)
            shown = [(sha256(i), sha256(d)) if digests else (i, d) for _, i, d in rows]
            yield batch_of(
                batch,
                names,
                n_tokens=pa.array([r[0] for r in rows], pa.int64()),
                **{c: pa.array([s[k] for s in shown], pa.string()) for k, c in enumerate(columns)},
            )

    picked = docs.select(*names, docs[text].alias("__text"))
    schema = StructType(
        [*(picked.schema[n] for n in names), StructField("n_tokens", LongType())]
        + [StructField(c, StringType()) for c in columns]
    )
    return picked.mapInArrow(run, schema)
