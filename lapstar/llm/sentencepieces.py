"""SentencePiece encoding with seeded merge-dropout, and decoding.

Byte-pair merging as the vocabulary's scores order it: adjacent symbols whose joined text is a piece are candidates;
an agenda gives the best candidate, the leftmost of equals, until none is left. With dropout, a candidate that the agenda
gives is skipped if a keyed hash of the seed, the document, its place and its piece falls below the rate; it comes up
again only in another form, when a neighbour has merged. So a text has as many segmentations as there are seeds, each
of which decodes to the text.

Texts are cut into units that no piece crosses (a unit begins at each run of spaces, and letters that no piece has stand
alone), and the agendas of all units of many texts run together: a round takes the best candidate of every unit. Units
longer than ``LONG_UNIT`` have an agenda of their own, a heap.

Spaces become the space mark, with one put before each text; letters outside the vocabulary become byte pieces. A space
mark in the text itself also becomes byte pieces, so that decoding loses nothing.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lapstar.llm.common import map_texts, mix, ragged, texts_of
from lapstar.llm.hashing import Table

SPACE_MARK = "▁"
LONG_UNIT = 200
RATE = 0.1
_NONE = np.int64(np.iinfo(np.int64).max)
_KEYS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


class Vocabulary:
    """Pieces of a byte-pair model with byte fallback, and which pairs of symbols make a piece.

    Symbols are the pieces and, after them, letters that only occur inside pieces.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.size = size
        self.bytes = np.full(256, -1, np.int64)
        pieces: dict[str, int] = {}
        raw: list[bytes] = [b""] * size
        for i in range(size):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(text[1:-1], 16)] = i
                raw[i] = bytes([int(text[1:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[text] = i
                raw[i] = text.replace(SPACE_MARK, " ").encode()
        if (self.bytes < 0).any():
            raise ValueError("the model has no byte fallback")
        symbols = dict(pieces)
        for text in pieces:
            if SPACE_MARK in text.lstrip(SPACE_MARK):
                raise ValueError("a piece of the model crosses a space")
            for letter in text:
                symbols.setdefault(letter, len(symbols) + size)
        numbers = {number: k for k, number in enumerate(sorted(set(symbols.values())))}
        self.space = symbols.get(SPACE_MARK, -1)
        self.letters = np.full(0x110000, -1, np.int32)
        for text, number in symbols.items():
            if len(text) == 1 and text != SPACE_MARK:
                self.letters[ord(text)] = number
        self.letters[0x20] = self.space
        self.limit = max(numbers, default=0) + 1
        # Ranks by score, equal scores together; the greatest score comes first.
        scores = np.array([model.get_score(i) for i in range(size)])
        self.ranks = np.searchsorted(np.unique(-scores), -scores).astype(np.int64)
        pairs = {}
        for text, number in pieces.items():
            for cut in range(1, len(text)):
                left, right = symbols.get(text[:cut]), symbols.get(text[cut:])
                if left is not None and right is not None:
                    pairs[left * self.limit + right] = number
        self.pairs = pairs
        self.table = Table(np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int64))
        self.piece_lengths = np.array([len(x) for x in raw], np.int64)
        self.piece_begins = np.cumsum(self.piece_lengths) - self.piece_lengths
        self.pool = np.frombuffer(b"".join(raw), np.uint8)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, or -1."""
        return self.table.get(left * self.limit + right)


def skipped(key: np.ndarray, begin: np.ndarray, end: np.ndarray, piece: np.ndarray, rate: float) -> np.ndarray:
    """Whether each merge is skipped: of the document with this key, of the letters ``begin`` to ``end``, to ``piece``."""
    drawn = mix(key + begin.astype(np.uint64) * _KEYS[0] + end.astype(np.uint64) * _KEYS[1] + piece.astype(np.uint64) * _KEYS[2])
    return drawn < np.uint64(min(int(rate * 2.0**64), 2**64 - 1))


def agenda(vocabulary: Vocabulary, letters: np.ndarray, key: np.uint64, begin: int, rate: float) -> list[tuple[int, int]]:
    """Place and symbol of what is left of one unit; its letters stand from ``begin`` on."""
    n = len(letters)
    symbol, after, before = letters.tolist(), [*range(1, n), -1], list(range(-1, n - 1))
    ends = list(range(1, n + 1))
    alive = [True] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(left: int, right: int) -> None:
        if left >= 0 and right >= 0:
            piece = vocabulary.pairs.get(symbol[left] * vocabulary.limit + symbol[right], -1)
            if piece >= 0:
                heapq.heappush(heap, (int(vocabulary.ranks[piece]), left, ends[right], piece))

    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, left, end, piece = heapq.heappop(heap)
        right = after[left]
        if not alive[left] or right < 0 or ends[right] != end:
            continue  # one of the two has merged meanwhile
        if vocabulary.pairs.get(symbol[left] * vocabulary.limit + symbol[right]) != piece:
            continue
        place = [np.array([x]) for x in (begin + left, begin + end, piece)]
        if rate and skipped(np.array([key]), *place, rate)[0]:
            continue
        symbol[left], ends[left], after[left], alive[right] = piece, end, after[right], False
        if after[left] >= 0:
            before[after[left]] = left
        offer(before[left], left)
        offer(left, after[left])
    return [(begin + i, symbol[i]) for i in range(n) if alive[i]]


def _merge(vocabulary: Vocabulary, symbol: np.ndarray, place: np.ndarray, end: np.ndarray, unit: np.ndarray,
           keys: np.ndarray, rate: float, out: np.ndarray) -> None:
    """Runs the agendas of all units, symbols of a unit in a row; writes what is left to ``out`` by place.

    ``keys`` has the key of each place's document, and ``place`` and ``end`` count from the first text's begin.
    """
    origin, key = keys
    piece = np.full(len(symbol), -1, np.int64)
    inside = np.flatnonzero(unit[:-1] == unit[1:])
    piece[inside] = vocabulary.merged(symbol[inside], symbol[inside + 1])
    while len(symbol):
        first = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
        at = np.arange(len(symbol))
        order = np.where(piece >= 0, vocabulary.ranks[piece] << 32 | at, _NONE)
        best = np.minimum.reduceat(order, first)
        going = best != _NONE
        if not going.all():  # units without candidates are done
            stays = np.repeat(going, np.diff(np.append(first, len(symbol))))
            done = ~stays
            out[place[done]] = symbol[done]
            symbol, place, end, unit, piece = symbol[stays], place[stays], end[stays], unit[stays], piece[stays]
            moved = np.cumsum(stays) - 1
            best = moved[best[going] & 0xFFFFFFFF]
            if not len(symbol):
                return
        else:
            best = best & 0xFFFFFFFF
        if rate:
            text = origin[place[best]]
            skip = skipped(key[place[best]], place[best] - text, end[best + 1] - text, piece[best], rate)
            piece[best[skip]] = -1
            best = best[~skip]
        if not len(best):
            continue
        symbol[best], end[best] = piece[best], end[best + 1]
        keep = np.ones(len(symbol), bool)
        keep[best + 1] = False
        left = (np.cumsum(keep) - 1)[best]
        symbol, place, end, unit, piece = symbol[keep], place[keep], end[keep], unit[keep], piece[keep]
        for changed in (left, left - 1):
            changed = changed[(changed >= 0) & (changed < len(symbol) - 1)]
            same = unit[changed] == unit[changed + 1]
            pair = changed[same]
            piece[pair] = vocabulary.merged(symbol[pair], symbol[pair + 1])
            piece[changed[~same]] = -1
        piece[-1] = -1


def encode(vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, rate: float = RATE):
    """Ids of all texts one after the other, and how many each has. ``keys`` has a 64-bit key per text."""
    n = len(offsets) - 1
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    starts = (data & 0xC0) != 0x80
    letters_upto = np.concatenate([[0], np.cumsum(starts)])[offsets]
    sizes = np.diff(letters_upto)
    # One mark before every text that is not empty.
    prefixed = sizes > 0
    points = np.insert(points, letters_upto[:-1][prefixed], 0x20)
    sizes = sizes + prefixed
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    text = np.repeat(np.arange(n), sizes)
    origin, key = bounds[:-1][text], keys[text]
    symbol = vocabulary.letters[points].astype(np.int64)
    total = len(symbol)
    out = np.full(total, -1, np.int64)
    known = symbol >= 0
    space = symbol == vocabulary.space
    # A unit begins with a text, with a run of marks, and behind a letter that no piece has.
    begins = np.zeros(total, bool)
    begins[bounds[:-1][sizes > 0]] = True
    begins[1:] |= (space[1:] & ~space[:-1]) | ~known[:-1]
    unit = np.cumsum(begins | ~known)
    at = np.flatnonzero(known)
    if len(at):
        unit = unit[at]
        first = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
        length = np.diff(np.append(first, len(unit)))
        out[at[np.repeat(length == 1, length)]] = symbol[at[np.repeat(length == 1, length)]]
        for k in np.flatnonzero(length > LONG_UNIT).tolist():
            own = at[first[k] : first[k] + length[k]]
            text_begin = int(origin[own[0]])
            for place, found in agenda(vocabulary, symbol[own], key[own[0]], int(own[0]) - text_begin, rate):
                out[text_begin + place] = found
        some = np.repeat((length > 1) & (length <= LONG_UNIT), length)
        at, unit = at[some], unit[some]
        if len(at):
            _merge(vocabulary, symbol[at], at, at + 1, unit, (origin, key), rate, out)
    # Letters that are no pieces, known or not, are written as bytes.
    out[(out >= vocabulary.size) | ~known] = -2
    found = np.flatnonzero(out != -1)
    ids, lost = out[found], np.flatnonzero(out[found] == -2)
    counts = np.ones(len(found), np.int64)
    if len(lost):
        letters = points[found[lost]]
        width = 1 + (letters >= 0x80).astype(np.int64) + (letters >= 0x800) + (letters >= 0x10000)
        counts[lost] = width
        ids = np.repeat(ids, counts)
        raw = np.frombuffer(letters.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        ids[ids == -2] = vocabulary.bytes[raw]
    per_text = np.bincount(text[found], counts, n).astype(np.int64)
    return ids, per_text


def decode(vocabulary: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins (one more entry): pieces joined, the first mark taken off."""
    lengths = vocabulary.piece_lengths[ids]
    data = vocabulary.pool[np.repeat(vocabulary.piece_begins[ids], lengths) + ragged(lengths)]
    upto = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
    begins = upto[:-1][np.diff(upto) > 0]
    marks = begins[data[begins] == 0x20]
    keep = np.ones(len(data), bool)
    keep[marks] = False
    return data[keep], np.concatenate([[0], np.cumsum(keep)])[upto]


def text_keys(doc_ids: pa.Array, seed: int) -> np.ndarray:
    """Keys of documents by id; all null ids have one."""
    ids = doc_ids.fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False).view(np.uint64)
    return mix(mix(ids + _KEYS[3]) + np.uint64(seed % 2**64))


def _rows(docs: DataFrame, model: str, seed: int, rate: float, text_col: str, schema: str, output) -> DataFrame:
    if not 0 <= rate < 1:
        raise ValueError("the rate is a share below 1")
    vocabulary = Vocabulary(model)

    def run(data: np.ndarray, offsets: np.ndarray, doc_ids: pa.Array) -> dict[str, pa.Array]:
        ids, counts = encode(vocabulary, data, offsets, text_keys(doc_ids, seed), rate)
        back, bounds = decode(vocabulary, ids, counts)
        same = np.diff(bounds) == np.diff(offsets)
        if not (same.all() and np.array_equal(back, data)):
            for i in np.flatnonzero(same):
                same[i] = np.array_equal(back[bounds[i] : bounds[i + 1]], data[offsets[i] : offsets[i + 1]])
        return output(ids, counts) | {"lossless": pa.array(same)}

    return map_texts(texts_of(docs, text_col=text_col), run, schema, with_ids=True)


def encoded(docs: DataFrame, model: str, seed: int = 0, rate: float = RATE, text_col: str = "text") -> DataFrame:
    """``doc_id, ids, lossless`` of every row: its pieces, and whether they decode to the text.

    Null and empty texts have no pieces. Rows with equal id, text and seed have equal pieces; null ids count as one
    id. Columns other than ``doc_id`` and the text are left out.
    """

    def output(ids: np.ndarray, counts: np.ndarray) -> dict[str, pa.Array]:
        cuts = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        return {"ids": pa.ListArray.from_arrays(cuts, pa.array(ids.astype(np.int32)))}

    return _rows(docs, model, seed, rate, text_col, "doc_id long, ids array<int>, lossless boolean", output)


def summary(docs: DataFrame, model: str, seed: int = 0, rate: float = RATE, text_col: str = "text") -> DataFrame:
    """``doc_id, n_pieces, ids_crc32, lossless`` of every row; the sum is of the ids as 32-bit little-endian numbers."""

    def output(ids: np.ndarray, counts: np.ndarray) -> dict[str, pa.Array]:
        raw, ends = memoryview(ids.astype("<u4").tobytes()), (4 * np.cumsum(counts)).tolist()
        crc = [zlib.crc32(raw[b:e]) for b, e in zip([0, *ends[:-1]], ends, strict=True)]
        return {"n_pieces": pa.array(counts, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}

    schema = "doc_id long, n_pieces long, ids_crc32 long, lossless boolean"
    return _rows(docs, model, seed, rate, text_col, schema, output)
