"""SentencePiece encoding and decoding as a weighted finite-state transducer.

`compile_model` reads a .model file (protocol buffer wire format, read here) and builds

- the normaliser: a transducer that puts the blank mark before the text, maps blanks to it and, if the
  model says so, drops extra blanks and applies rewriting rules of characters;
- the lexicon: an automaton over the pieces' characters; where a piece ends it emits the piece's id at the cost -score;
- byte fallback: for each character an arc that emits its UTF-8 bytes' ids, at a cost above every piece's.

A text is composed with these as a linear automaton (states are its positions, and only reachable arcs
are made) and the tropical shortest path is taken in order of position. For a unigram model the path of least cost is
the library's own result. A BPE model's library encoder merges by rank, which is no sum of costs; but its
result is the one path on which each two neighbouring pieces, merged from their characters alone, stay
apart. So for a BPE model an acceptor of piece pairs is composed in as well, with infinite weight (the semiring's
zero) for pairs that would merge across their boundary; one path of finite weight is left, and of each
prefix too, so one state a position is enough. Ids are then those of the library.

Unigram paths of equal cost are settled by fewer pieces, then the longer last piece. As no piece has a blank mark
after another character, every path passes the positions before blank marks; the text is cut there, and
before punctuation behind a letter or digit where no piece holds these two side by side, and a unit's path is looked up once found.

Nulls: a null text counts as empty and has no ids. Characters outside the vocabulary come as byte pieces,
or the unknown id where the model has none. Long texts are encoded whole, unit by unit. A text's own blank
marks (U+2581) decode as blanks, as in the library. Repeated rows give equal ids, an empty table an empty result.
"""

from __future__ import annotations

import itertools
import re
import string
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEPT, chunks, ship_package, text_or_empty

BLANK = "▁"
#: ASCII marks.
MARKS = string.punctuation
CACHED_UNITS, LONGEST_CACHED, CACHED_PAIRS = 400_000, 48, 400_000
# Fixed values of the format: kinds of pieces
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Stands for no piece before.
NOTHING = 1 << 22
#: Added to the largest cost of a piece for a character that has none.
FALLBACK_EXTRA = 10.0
#: Pieces at this cost or above are there to be reached by merging only, and do not count for the fallback's cost.
HIDDEN_COST = 1e8


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a message."""
    i = 0

    def varint() -> int:
        nonlocal i
        value = shift = 0
        while True:
            b = data[i]
            i += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while i < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[i : i + n]
            i += n


@dataclass(frozen=True)
class Piece:
    text: str
    cost: float
    kind: int


def read_model(data: bytes) -> tuple[list[Piece], dict[str, bool | bytes]]:
    """The pieces in order of ids, and the settings: the normaliser's, and whether the model is of the BPE kind."""
    pieces, normal = [], {"dummy_prefix": True, "remove_extra": True, "escape": True, "charsmap": b"", "bpe": False}
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            pieces.append(Piece(own.get(1, b"").decode("utf-8"), -struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
        elif number == 2:
            normal["bpe"] = dict(_fields(value)).get(3, 1) == 2
        elif number == 3:
            for k, v in _fields(value):
                name = {2: "charsmap", 3: "dummy_prefix", 4: "remove_extra", 5: "escape"}.get(k)
                if name:
                    normal[name] = v if name == "charsmap" else bool(v)
    return pieces, normal


class Transducer:
    """The composed normaliser, lexicon and fallback; `encode` is the shortest path's output, `decode` its inverse."""

    def __init__(self, pieces: list[Piece], dummy_prefix: bool = True, remove_extra: bool = False, escape: bool = True, rules: dict[str, str] | None = None, bpe: bool = False):
        self.pieces, self.dummy_prefix, self.remove_extra, self.escape, self.rules = pieces, dummy_prefix, remove_extra, escape, rules or {}
        self.bytes: dict[int, int] = {}
        self.unknown = next((i for i, p in enumerate(pieces) if p.kind == UNKNOWN), 0)
        lexicon = [(i, p) for i, p in enumerate(pieces) if p.kind in (NORMAL, USER_DEFINED) and p.text]
        for i, p in enumerate(pieces):
            if p.kind == BYTE:
                self.bytes[int(p.text[1:-1], 16)] = i
            if p.kind == USER_DEFINED and bpe:
                raise ValueError("user-defined pieces of BPE models are not supported")
        self.costs: dict[str, tuple[float, int]] = {}
        for i, p in lexicon:
            if p.text not in self.costs or p.cost < self.costs[p.text][0]:
                self.costs[p.text] = (p.cost, i)
        # the lexicon: gives the arcs that end at each position, longest first
        self.lexicon = ahocorasick.Automaton()
        for t, (cost, i) in self.costs.items():
            self.lexicon.add_word(t, (len(t), cost, i))
        self.lexicon.make_automaton()
        self.fallback = max((p.cost for _, p in lexicon if p.cost < HIDDEN_COST), default=0.0) + FALLBACK_EXTRA
        inner = any(re.search(f"[^{BLANK}]{BLANK}", p.text) for _, p in lexicon)
        alone = "".join(c for c in "\t\n\r" if not any(c in p.text for _, p in lexicon))
        # no piece has a mark right after a letter or digit that is not among these: all paths pass the positions between the two
        held = "".join(sorted({a for _, p in lexicon for a, b in itertools.pairwise(p.text) if a.isalnum() and b in MARKS}))
        mark, other = f"[{re.escape(MARKS)}]", f"[^{re.escape(MARKS)}{BLANK}{alone}]"
        after = f"{BLANK}*+{mark}*+{other}++(?:(?<![^\\W_{held}]){mark}++{other}*+)*+|{BLANK}*+{mark}++"
        self.unit = None if inner else re.compile(f"[{alone}]|{after}|{BLANK}+" if alone else f"{after}|{BLANK}+")
        self.rewrite = re.compile("|".join(map(re.escape, sorted(self.rules, key=len, reverse=True)))) if self.rules else None
        self.known: dict[str, bytes] = {}
        self.covered = {t for t in self.costs if len(t) == 1}
        self.bpe = bpe
        blank = lambda t: t.replace(BLANK, " ") if escape else t
        self.raw = [bytes([int(p.text[1:-1], 16)]) if p.kind == BYTE else b"" if p.kind == CONTROL else " ⁇ ".encode() if p.kind == UNKNOWN else blank(p.text).encode("utf-8", "surrogatepass") for p in pieces]
        self.apart: dict[int, bool] = {}

    def merges(self, symbols: list[str], boundary: int | None = None) -> list[str] | None:
        """Symbols merged by least cost, leftmost first, until none merge; None as soon as a merge crosses the boundary (a number of characters)."""
        symbols, costs = list(symbols), self.costs
        while len(symbols) > 1:
            pairs = [(costs[j][0], i) for i, j in enumerate(map(str.__add__, symbols, symbols[1:])) if j in costs]
            if not pairs:
                break
            i = min(pairs)[1]
            if boundary is not None and sum(map(len, symbols[: i + 1])) == boundary:
                return None
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    def _stay_apart(self, key: int) -> bool:
        """The acceptor's weight of a pair, by its key: whether two neighbours do not merge across their boundary, or (with no one before) whether a piece is reached by merging at all."""
        a, b = key >> 22, key & (1 << 22) - 1
        y = self.symbol(b)
        if a == NOTHING:
            return self.merges(list(y)) == [y]
        x = self.symbol(a)
        return self.merges(list(x + y), len(x)) is not None and self.stays(NOTHING << 22 | b)

    def stays(self, key: int) -> bool:
        found = self.apart.get(key)
        if found is None:
            if len(self.apart) >= CACHED_PAIRS:
                self.apart.clear()
            found = self.apart[key] = self._stay_apart(key)
        return found

    def symbol(self, number: int) -> str:
        """A piece's text, or a character without a piece."""
        return self.pieces[number].text if number < len(self.pieces) else chr(number - len(self.pieces))

    def normalise(self, text: str) -> str:
        """The normaliser's output."""
        if self.rewrite:
            text = self.rewrite.sub(lambda m: self.rules[m[0]], text)
        if self.remove_extra:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        text = " " + text if self.dummy_prefix else text
        return text.replace(" ", BLANK) if self.escape else text

    def arcs(self, text: str, at: int) -> Iterator[tuple[int, float, int | None]]:
        """End, cost and piece (None: fallback) of each arc that leaves a position of the composed automaton."""
        for end in range(at + 1, len(text) + 1):
            if text[at:end] in self.costs:
                yield end, *self.costs[text[at:end]]
        yield at + 1, self.fallback, None

    def shortest(self, text: str) -> tuple[float, list[tuple[int, int, int | None]]]:
        """Cost and arcs (begin, end, piece) of the shortest path over a normalised text.

        One relaxation, positions in order, of states (position, last piece). One state a position is enough: without the
        acceptor of pairs the last piece does not matter, and with it only one is reached by arcs of finite weight,
        so the arcs left at a position need no weighing once it is reached.
        """
        n, fallback, paired, extra = len(text), self.fallback, self.bpe, len(self.pieces)
        apart, costs, stays = self.apart, self.costs, self.stays
        best: list = [None] * (n + 1)  # cost, number of arcs, begin of the last arc, its piece
        best[0] = (0.0, 0, 0, NOTHING)
        # where single characters' arcs begin; with the acceptor a piece of one character takes the place of its fallback
        single = [i for i, c in enumerate(text) if not paired or c not in costs]
        offered = 0

        def fall_back(up_to: int) -> int:
            """Relaxes the single characters' arcs that end at positions up to `up_to`; how many are done."""
            for k in range(offered, len(single)):
                begin = single[k]
                if begin >= up_to:
                    return k
                own, symbol = best[begin], extra + ord(text[begin])
                if own is not None and (not paired or stays(own[3] << 22 | symbol)):
                    total, old = own[0] + fallback, best[begin + 1]
                    if old is None or total < old[0]:
                        best[begin + 1] = (total, own[1] + 1, begin, symbol)
            return len(single)

        for last, (size, weight, piece) in self.lexicon.iter(text):
            if offered < len(single) and single[offered] < last:
                offered = fall_back(last)
            end = last + 1
            begin = end - size
            own, old = best[begin], best[end]
            if own is None:
                continue
            if paired:
                if old is not None:
                    continue
                key = own[3] << 22 | piece
                fits = apart.get(key)
                if not (stays(key) if fits is None else fits):
                    continue
            total, count = own[0] + weight, own[1] + 1
            # of one position's arcs the longer comes first
            if old is None or total < old[0] or (total == old[0] and count < old[1]):
                best[end] = (total, count, begin, piece)
        fall_back(n)
        if best[n] is None:
            raise ValueError("no segmentation: the pieces are not those of a merging model")
        path, at = [], n
        while at > 0:
            _, _, begin, piece = best[at]
            path.append((begin, at, piece if piece < extra else None))
            at = begin
        return best[n][0], path[::-1]

    def only_path(self, text: str) -> list[int] | None:
        """The pieces of `shortest`'s path with the acceptor: the same relaxation over weights zero and infinity, costs left out, as one path is all there is.

        None where a character has no piece of its own, or no path is found: `shortest` has the fallback's arcs.
        """
        apart, stays, n = self.apart, self.stays, len(text)
        last: list = [None] * (n + 1)  # the piece before, as the upper part of a pair's key
        back = [0] * (n + 1)
        last[0] = NOTHING << 22
        for end, (size, _, piece) in self.lexicon.iter(text):
            end += 1
            if last[end] is None:
                own = last[end - size]
                if own is not None:
                    key = own | piece
                    fits = apart.get(key)
                    if stays(key) if fits is None else fits:
                        last[end], back[end] = piece << 22, end - size
        if last[n] is None or not self.covered.issuperset(text):
            return None
        out, at = [], n
        while at > 0:
            out.append(last[at] >> 22)
            at = back[at]
        out.reverse()
        return out

    def _unit_ids(self, unit: str) -> bytes:
        only = self.only_path(unit) if self.bpe else None
        if only is not None:
            return array("I", only).tobytes()
        out: list[int] = []
        for begin, end, piece in self.shortest(unit)[1]:
            if piece is not None:
                out.append(piece)
            elif self.bytes:
                out.extend(self.bytes[b] for b in unit[begin:end].encode("utf-8", "surrogatepass"))
            else:
                out.append(self.unknown)
        return np.array(out, "<u4").tobytes()

    def encode_packed(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        whole = self.normalise(text or "")
        if not whole:
            return b""
        if self.unit is None:
            return self._unit_ids(whole)
        units, known = self.unit.findall(whole), self.known
        out = list(map(known.get, units))
        if None in out:
            if len(known) >= CACHED_UNITS:
                known.clear()
            for i, ids in enumerate(out):
                if ids is None:
                    u = units[i]
                    ids = out[i] = known.get(u) or self._unit_ids(u)
                    if len(u) <= LONGEST_CACHED:
                        known[u] = ids
        return b"".join(out)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text."""
        return np.frombuffer(self.encode_packed(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces and bytes joined, blank marks to blanks, without the blank put before."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def compile_model(path: str, rules: dict[str, str] | None = None) -> Transducer:
    """The transducer of a .model file. A model with a compiled character map needs the map's `rules` (string to string)."""
    with open(path, "rb") as f:
        pieces, normal = read_model(f.read())
    if normal["charsmap"] and rules is None:
        raise ValueError("the model rewrites characters: pass its rules")
    return Transducer(pieces, normal["dummy_prefix"], normal["remove_extra"], normal["escape"], rules, normal["bpe"])


@lru_cache(maxsize=2)
def _compiled(path: str) -> Transducer:
    return compile_model(path)


def with_pieces(docs: DataFrame, model: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array of ints), n_tokens, decoded_sha256 (of the text decoded from the ids), lossless (it is the text)."""
    import hashlib

    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _compiled(model)
        KEPT["spiece"] = _compiled.cache_clear
        for batch in batches:
            for part in chunks(batch, "body", operator="spiece"):
                texts = part.column("body").to_pylist()
                packed = [own.encode_packed(t) for t in texts]
                back = [own.decode(memoryview(x).cast("I")) for x in packed]
                size = np.fromiter(map(len, packed), np.int64, len(packed)) >> 2
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(np.frombuffer(b"".join(packed), "<i4")))
                columns = [part.column("doc_id"), lists, pa.array(size)]
                columns += [pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in back], pa.string()), pa.array([a == b for a, b in zip(texts, back, strict=True)], pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_tokens", "decoded_sha256", "lossless"])

    return rows.mapInArrow(run, f"doc_id {docs.schema[id_column].dataType.simpleString()}, ids array<int>, n_tokens long, decoded_sha256 string, lossless boolean")


def decoded(tokens: DataFrame, model: str, id_column: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, text of an array column of ids; null for null."""
    ship_package(tokens.sparkSession)
    rows = tokens.select(F.col(id_column).alias("doc_id"), F.col(ids).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _compiled(model)
        for batch in batches:
            texts = [None if x is None else own.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.mapInArrow(run, f"doc_id {tokens.schema[id_column].dataType.simpleString()}, text string")
