"""Token counts: lengths of greedy word pieces, counted by an automaton without building the pieces.

Greedy longest-match-first splitting takes the longest vocabulary entry at the start of a word, then goes on behind
it. The automaton does the same in one pass over the word's bytes: it walks a trie of the vocabulary, and where no
branch goes on it follows a failure link. The link of a node leads to the node of what is left of its string after
the greedy pieces that are then certain have been popped; how many those are is stored beside the link. So every
byte is looked at once and only counts are added up.

A word is a maximal run of bytes other than white space; ASCII punctuation marks are words of their own; A-Z count
as a-z. The last byte of a word is a symbol of its own, since entries with the end mark fit only there.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lapstar.llm.common import map_texts, texts_of
from lapstar.llm.hashing import Table
from lapstar.llm.words import LOWER, SPACE, word_ranges

SYMBOLS = 512
LAST = 256
LONG_WORD = 64
PUNCTUATION = np.zeros(256, bool)
for _first, _last in ((33, 47), (58, 64), (91, 96), (123, 126)):
    PUNCTUATION[_first : _last + 1] = True


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte, back to the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def read_vocabulary(path: str, end: str = "</w>") -> list[bytes | tuple[bytes, bool]]:
    """Entries of a byte-level vocabulary as (bytes, only at a word's end); special tokens are left out."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {x["content"] for x in content.get("added_tokens", ())}
    letters = byte_letters()
    found = []
    for text in content["model"]["vocab"]:
        if text not in special:
            body = text.removesuffix(end) if text != end else text
            found.append((bytes(letters[x] for x in body), body != text))
    return found


class Automaton:
    """Trie, failure links and popped counts of a vocabulary. Node 0 is the root; -1 stands for no way on."""

    def __init__(self, vocabulary: Iterable[tuple[bytes, bool]]):
        children: list[dict[int, int]] = [{}]
        token = [False]
        for entry, at_end in vocabulary:
            if not entry:
                continue
            symbols = list(entry)
            if at_end:
                symbols[-1] += LAST
            # An entry without the end mark also fits at the end of a word, but only as a whole.
            for path in (symbols,) if at_end else (symbols, [*symbols[:-1], symbols[-1] + LAST]):
                node = 0
                for symbol in path:
                    if symbol not in children[node]:
                        children[node][symbol] = len(children)
                        children.append({})
                        token.append(False)
                    node = children[node][symbol]
                token[node] = True
        self.fail, self.pops, self.rest = self._links(children, token)
        self.children = children
        keys = np.array([v * SYMBOLS + s for v, own in enumerate(children) for s in own], np.int64)
        self.table = Table(keys, np.array([child for own in children for child in own.values()], np.int64))

    @staticmethod
    def _links(children, token):
        n = len(children)
        fail, pops, rest = np.full(n, -1, np.int64), np.zeros(n, np.int64), np.full(n, -1, np.int64)
        rest[0] = 0
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for symbol, node in children[parent].items():
                queue.append(node)
                if token[node]:
                    fail[node], pops[node] = 0, 1
                else:
                    at, popped = fail[parent], pops[parent]
                    while at >= 0 and symbol not in children[at]:
                        popped += pops[at]
                        at = fail[at]
                    if at >= 0:
                        fail[node], pops[node] = children[at][symbol], popped
                # The pieces of the node's whole string, or -1 if it cannot be split.
                if fail[node] >= 0 and rest[fail[node]] >= 0:
                    rest[node] = pops[node] + rest[fail[node]]
        return fail, pops, rest

    def step(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The child of each node by its symbol, or -1."""
        return self.table.get(nodes * SYMBOLS + symbols)

    def count(self, word: bytes) -> int:
        """Pieces of one word; -1 if it cannot be split."""
        node, total = 0, 0
        for i, byte in enumerate(word):
            symbol = byte + LAST * (i == len(word) - 1)
            while symbol not in self.children[node]:
                total += int(self.pops[node])
                node = int(self.fail[node])
                if node < 0:
                    return -1
            node = self.children[node][symbol]
        return total + int(self.rest[node]) if self.rest[node] >= 0 else -1

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word ``data[start:end]``; -1 if it cannot be split. All words step together."""
        out = np.zeros(len(starts), np.int64)
        length = ends - starts
        for i in np.flatnonzero(length > LONG_WORD):
            out[i] = self.count(data[starts[i] : ends[i]].tobytes())
        order = np.argsort(-length, kind="stable")
        order = order[np.searchsorted(-length[order], -LONG_WORD) :]
        begin, size = starts[order], length[order]
        node, total = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for t in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -t, "left"))  # the words longer than t come first
            symbol = data[begin[:n] + t].astype(np.int64)
            symbol[size[:n] == t + 1] += LAST
            after = self.step(node[:n], symbol)
            open_ = np.flatnonzero(after < 0)
            while len(open_):
                at = node[open_]
                alive = at >= 0
                open_, at = open_[alive], at[alive]
                total[open_] += self.pops[at]
                node[open_] = at = self.fail[at]
                alive = at >= 0
                open_, at = open_[alive], at[alive]
                after[open_] = self.step(at, symbol[open_])
                open_ = open_[after[open_] < 0]
            node[:n] = after
        good = (node >= 0) & (self.rest[node] >= 0)
        out[order] = np.where(good, total + self.rest[node], -1)
        return out


def count_pieces(docs: DataFrame, vocabulary: Iterable[tuple[bytes, bool]], text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` of every row of ``docs``.

    A word that the vocabulary cannot split counts as one token and one unknown word. Null and empty texts, and
    texts of white space, have no words. Repeated rows are counted each. Only ``doc_id`` and the text are read.
    """
    automaton = Automaton(vocabulary)

    def count(data: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
        data = LOWER[data]
        alone = PUNCTUATION[data]
        starts, ends = word_ranges(offsets, ~(SPACE[data] | alone), alone)
        found = automaton.counts(data, starts, ends)
        upto = np.searchsorted(starts, offsets)

        def per_text(values: np.ndarray) -> pa.Array:
            sums = np.concatenate([[0], np.cumsum(values)])[upto]
            return pa.array(sums[1:] - sums[:-1], pa.int64())

        return {
            "n_words": pa.array(upto[1:] - upto[:-1], pa.int64()),
            "n_tokens": per_text(np.where(found < 0, 1, found)),
            "n_unknown": per_text((found < 0).astype(np.int64)),
        }

    return map_texts(
        texts_of(docs, text_col=text_col), count, "doc_id long, n_words long, n_tokens long, n_unknown long"
    )
