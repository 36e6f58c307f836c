"""SentencePiece encoding and decoding as weighted transducers.

The model's normaliser, its pieces and its byte fallback are compiled once; each input is composed with
them arc by arc, and the shortest path in the tropical semiring (sums of weights, least wins) is the
encoding. For unigram models an arc weighs minus its piece's score. In a byte-pair model the order of
merges decides, which weights of single pieces can't say; but a sequence is its encoding just if every
two neighbours are what their own string merges to. So its arcs weigh nothing, and the composition with
the acceptor of allowed neighbours, built as pairs turn up, leaves one path.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import zlib
from functools import cached_property

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from peoplemart.llm.common import mapped

MODEL = "piece_bpe_32k.model"
SPACE_MARK = "▁"
#: What the unknown piece costs beyond the worst score.
UNKNOWN_COST = 10.0
_START = -1
#: Stretches and pairs that a Python worker remembers, at most.
REMEMBERED = 500_000


codecs.register_error("each-byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))


class Transducer:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, trainer = model.normalizer_spec, model.trainer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or trainer.model_type not in (1, 2):
            raise ValueError("only models that keep characters as they are, unigram or byte-pair")
        self.prefix, self.marks, self.merges = spec.add_dummy_prefix, spec.escape_whitespaces, trainer.model_type == 2
        kind = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.names = [p.piece for p in model.pieces]
        self.scores = {p.piece: p.score for p in model.pieces if p.type in (kind.NORMAL, kind.USER_DEFINED)}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.piece in self.scores}
        self.bytes = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kind.UNKNOWN)
        self.controls = {i for i, p in enumerate(model.pieces) if p.type == kind.CONTROL}
        # pieces hold the mark at their head only, or nothing is cut
        self.cuts = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.scores)
        self.worst = min(self.scores.values()) - UNKNOWN_COST
        self.allowed: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}

    def normalised(self, text: str) -> str:
        if self.marks:
            text = text.replace(" ", SPACE_MARK)
        return (SPACE_MARK if self.marks else " ") + text if self.prefix and text else text

    def merged(self, text: str) -> list[str]:
        """What the merges make of a short string: the best pair first, then the leftmost."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        agenda: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(parts) and (both := parts[i] + parts[j]) in self.scores:
                heapq.heappush(agenda, (-self.scores[both], i, j, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while agenda:
            _, i, j, both = heapq.heappop(agenda)
            if parts[i] is None or parts[j] is None or parts[i] + parts[j] != both or after[i] != j:
                continue
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in parts if p is not None]

    def _name(self, state: int) -> str:
        """A piece, or the character that no piece is; the start has none."""
        return self.names[state] if state >= 0 else "" if state == _START else chr(-2 - state)

    def follows(self, left: int, right: int) -> bool:
        """Whether two pieces may stand side by side in a byte-pair model's encoding, or one at its head."""
        pair = (left, right)
        found = self.allowed.get(pair)
        if found is None:
            before, after = self._name(left), self._name(right)
            found = self.merged(before + after) == ([before, after] if before else [after])
            if len(self.allowed) < REMEMBERED:
                self.allowed[pair] = found
        return found

    @cached_property
    def pieces(self) -> dict:
        """The acceptor of pieces: arcs by character, a piece's id at the empty string."""
        root: dict = {}
        for piece, number in self.ids.items():
            node = root
            for char in piece:
                node = node.setdefault(char, {})
            node[""] = number
        return root

    def _arcs(self, text: str, begin: int):
        """The pieces of text from begin on, and where they end; the character itself if it is none."""
        node, single = self.pieces, False
        for end in range(begin, len(text)):
            node = node.get(text[end])
            if node is None:
                break
            number = node.get("")
            if number is not None:
                single = single or end == begin
                yield end + 1, number
        if not single:
            yield begin + 1, -2 - ord(text[begin])

    def shortest_path(self, text: str) -> list[int]:
        """The pieces' ids of a normalised text; for a character that no piece is, a number below -1."""
        n = len(text)
        cost, last, came = [0.0] + [np.inf] * n, [_START] + [None] * n, [0] * (n + 1)
        for begin in range(n):
            left = last[begin]
            if left is None:
                continue
            for end, number in self._arcs(text, begin):
                if self.merges:
                    if last[end] is None and self.follows(left, number):  # only one path ends at each place
                        last[end], came[end] = number, begin
                else:
                    total = cost[begin] - (self.scores[self.names[number]] if number >= 0 else self.worst)
                    if total < cost[end]:  # of equal paths, the longest last piece
                        cost[end], last[end], came[end] = total, number, begin
        found, end = [], n
        while end:
            found.append(last[end])
            end = came[end]
        return found[::-1]

    def _ids(self, stretch: str) -> bytes:
        """The ids of a stretch, as little-endian unsigned 32-bit integers."""
        found = self.known.get(stretch)
        if found is None:
            out: list[int] = []
            for number in self.shortest_path(stretch):
                if number >= 0:
                    out.append(number)
                elif self.bytes:
                    out += [self.bytes[b] for b in self._name(number).encode()]
                elif not out or out[-1] != self.unknown:  # unknown characters in a row are one
                    out.append(self.unknown)
            found = np.array(out, "<u4").tobytes()
            if len(self.known) < REMEMBERED:
                self.known[stretch] = found
        return found

    @cached_property
    def _stretches(self) -> re.Pattern:
        """Stretches of a normalised text that pieces don't cross: characters that stand side by side in
        some piece, directly or by way of others, with a run of marks at their head."""
        kin: dict[str, set[str]] = {}
        for piece in self.scores:
            if len(piece) > 1:
                chars = [c for c in piece if c != SPACE_MARK]
                joined = set(chars).union(*(kin[c] for c in chars if c in kin))
                for c in joined:
                    kin[c] = joined
        sets = {id(x): x for x in kin.values()}.values()
        runs = "|".join(f"[{''.join(re.escape(c) for c in sorted(x))}]+" for x in sorted(sets, key=lambda x: (-len(x), min(x))))
        return re.compile(f"{SPACE_MARK}*(?:{runs})|{SPACE_MARK}+|.", re.DOTALL)

    def encoded(self, text: str) -> bytes:
        """The ids of a text, as little-endian unsigned 32-bit integers."""
        text = self.normalised(text)
        if not self.cuts or not self.bytes:
            return self._ids(text)
        known, ids = self.known, self._ids
        return b"".join([known.get(x) or ids(x) for x in self._stretches.findall(text)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encoded(text), "<u4").tolist()

    @cached_property
    def outputs(self) -> list[bytes]:
        """The bytes that each id stands for; none for controls."""
        of_byte = {i: bytes([b]) for b, i in self.bytes.items()}
        return [b"" if i in self.controls else b" \xe2\x81\x87 " if i == self.unknown else of_byte.get(
            i, name.replace(SPACE_MARK, " ").encode()) for i, name in enumerate(self.names)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the prefix; each byte that is no UTF-8 becomes U+FFFD."""
        text = b"".join([self.outputs[i] for i in ids]).decode("utf-8", "each-byte")
        return text[1:] if self.prefix and text.startswith(" ") else text


_transducers: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One for each Python worker."""
    if path not in _transducers:
        _transducers[path] = Transducer(path)
    return _transducers[path]


def encoded(docs: DataFrame, text_col: str = "text", model: str | None = None) -> DataFrame:
    """docs with ids (array of int). A NULL text has NULL ids, an empty one none."""
    path = model or public_tokenizers.path(MODEL)
    return mapped(docs, text_col, {"ids": T.ArrayType(T.IntegerType())}, lambda texts: [
        [None if t is None else transducer(path).encode(t) for t in texts]])


def round_trip(docs: DataFrame, text_col: str = "text", model: str | None = None) -> DataFrame:
    """docs with n_ids, n_bytes (ids of single bytes), ids_crc32 (of the ids as little-endian unsigned
    32-bit integers) and decoded_sha256 (of the text decoded from them). A NULL text counts as empty."""
    path = model or public_tokenizers.path(MODEL)

    def run(texts: list[str | None]) -> list[list]:
        of, rows = transducer(path), []
        single = np.zeros(len(of.names), bool)
        single[list(of.bytes.values())] = True
        for text in texts:
            ids = of.encoded(text or "")
            array = np.frombuffer(ids, "<u4")
            rows.append((len(array), int(single[array].sum()), zlib.crc32(ids),
                         hashlib.sha256(of.decode(array.tolist()).encode()).hexdigest()))
        return [list(x) for x in zip(*rows, strict=True)]

    return mapped(docs, text_col, {"n_ids": T.LongType(), "n_bytes": T.LongType(), "ids_crc32": T.LongType(),
                                   "decoded_sha256": T.StringType()}, run)
