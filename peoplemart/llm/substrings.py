"""Removing passages that an earlier document has already: a count-min prefilter, then exact grouping.

First every block of documents counts its windows in a sketch of several rows of cells, of which only
the filled ones are sent; the merged sketch never counts less than the truth, so a window with fewer
than two counts in any row is surely unique. The rest are grouped by a 96-bit hash of their words; a
group's smallest doc_id goes back to the blocks, which drop the words covered by a window that a
smaller doc_id has. A window is sent once per block at most, however many documents share it.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from peoplemart.llm import exchange
from peoplemart.llm.common import (
    mixed, packed, packed_sorted, text_bytes, unpacked, unpacked_sorted)

WINDOW = 13
#: Rows of the sketch, and cells of each row per byte of text (words are longer than four bytes as a rule).
DEPTH = 2
CELLS_PER_BYTE = 0.75

_FIRST, _SECOND = exchange.Rolling(8), exchange.Rolling(80)
RESULTS = {"kept_text": T.StringType(), "n_words": T.LongType(), "n_removed": T.LongType(),
           "kept_sha256": T.StringType()}


def _in_order(t: pa.Table) -> pa.Table:
    """A block's rows by id and text, in which order places of words hold in every pass: a shuffle delivers a block's
    rows in another order each time it is read. Rows equal in both have the same words and the same windows."""
    return t.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _windows(t: pa.Table, size: int, exact: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: the first and second hash of each window, the row it is in, the place of its first
    word among all words of the block, and the words of each row. Rows without a doc_id have no window."""
    firsts, seconds, rows, places, counts, seen = [], [], [], [], [], 0
    texts = t["text"].combine_chunks()
    known = ~np.asarray(t["doc_id"].combine_chunks().is_null())
    for begin, end in exchange.batches(texts):
        data, starts, ends, n = exchange.word_bounds(texts.slice(begin, end - begin))
        row = np.repeat(np.arange(begin, end), n)
        ok = np.zeros(0, np.int64)
        if len(row) >= size:
            ok = np.flatnonzero((row[size - 1:] == row[: len(row) - size + 1]) & known[row[: len(row) - size + 1]])
        if len(ok):
            firsts.append(_FIRST.runs(_FIRST.words(data, starts, ends), size)[ok])
            if exact:
                seconds.append((_SECOND.runs(_SECOND.words(data, starts, ends), size)[ok] >> np.uint64(32)).astype(np.uint32))
            rows.append(row[ok].astype(np.int32))
            places.append((ok + seen).astype(np.int32))
        seen += len(row)
        counts.append(n)
    whole = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return (whole(firsts, np.uint64), whole(seconds, np.uint32), whole(rows, np.int32), whole(places, np.int32),
            whole(counts, np.int64))


def _cells(first: np.ndarray, depth: int, bits: int) -> list[np.ndarray]:
    return [mixed(first + np.uint64((2 * r + 1) * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(64 - bits) for r in range(depth)]


class _Sketch:
    def __init__(self, depth: int, bits: int, segments: int, size: int):
        self.depth, self.bits, self.segments, self.size = depth, bits, segments, size

    def ask(self, t: pa.Table):
        first, *_ = _windows(t, self.size, exact=False)
        for r, cells in enumerate(_cells(first, self.depth, self.bits)):
            cells, counts = np.unique(cells, return_counts=True)
            at = exchange.cuts(cells, self.segments, self.bits)
            for s in np.flatnonzero(np.diff(at)):
                part = slice(at[s], at[s + 1])
                twice = np.packbits(counts[part] > 1).tobytes()
                yield int(r * self.segments + s), len(twice).to_bytes(4, "little") + twice + packed_sorted(cells[part])

    @staticmethod
    def reply(payloads: list[bytes]) -> list[bytes]:
        """Of each block's cells, which have two counts or more."""
        cells, counts = [], []
        for p in payloads:
            n = int.from_bytes(p[:4], "little")
            cells.append(unpacked_sorted(p[4 + n:]))
            counts.append(1 + np.unpackbits(np.frombuffer(p[4: 4 + n], np.uint8), count=len(cells[-1])))
        every, order = np.unique(np.concatenate(cells), return_inverse=True)
        total = np.bincount(order, np.concatenate(counts), len(every))
        ends = np.cumsum([len(c) for c in cells])[:-1]
        return [np.packbits(x).tobytes() for x in np.split(total[order] > 1, ends)]

    def maybe_repeated(self, first: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
        found = np.ones(len(first), bool)
        for r, cells in enumerate(_cells(first, self.depth, self.bits)):
            every = np.unique(cells)
            n = np.diff(exchange.cuts(every, self.segments, self.bits))
            flags = [np.unpackbits(np.frombuffer(answers[r * self.segments + s], np.uint8), count=n[s]) for s in np.flatnonzero(n)]
            repeated = every[np.concatenate(flags).astype(bool)] if flags else every
            at = np.minimum(np.searchsorted(repeated, cells), max(0, len(repeated) - 1))
            found &= (repeated[at] == cells) if len(repeated) else False
        return found


class _Groups:
    """Of the windows that may repeat: the smallest doc_id by exact identity."""

    def __init__(self, sketch: _Sketch, segments: int):
        self.sketch, self.segments, self.size = sketch, segments, sketch.size

    def ask(self, t: pa.Table, answers: dict[int, bytes]):
        """The distinct windows that may repeat, sorted, each with its smallest doc_id here. With them go the places of all
        such windows in the block's words, for the answer to bring back: so no window is hashed again when it comes."""
        t = _in_order(t)
        first, second, rows, places, _ = _windows(t, self.size, exact=True)
        may = np.flatnonzero(self.sketch.maybe_repeated(first, answers))
        ids = t["doc_id"].combine_chunks().fill_null(0).to_numpy()[rows[may]]
        first, second, places = first[may], second[may], places[may]
        order = np.lexsort((ids, second, first))
        first, second, ids, places = first[order], second[order], ids[order], places[order]
        new = np.ones(len(first), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        at = exchange.cuts(first, self.segments, 64)
        for s in np.flatnonzero(np.diff(at)):
            part = slice(at[s], at[s + 1])
            own = np.flatnonzero(new[part]) + at[s]
            back = _joined([packed(places[part]), np.packbits(new[part]).tobytes()])
            yield int(s), _joined([packed_sorted(first[own]), packed(second[own]), packed(ids[own]), back])

    @staticmethod
    def reply(payloads: list[bytes]) -> list[bytes]:
        """The smallest doc_id of all for each of a block's windows, and what the block sent along."""
        firsts, seconds, ids, along = [], [], [], []
        for p in payloads:
            first, second, own, back = _split(p)
            firsts.append(unpacked_sorted(first))
            seconds.append(unpacked(second, np.uint32))
            ids.append(unpacked(own, np.int64))
            along.append(back)
        ends = np.cumsum([len(x) for x in firsts])[:-1]
        first, second, own = np.concatenate(firsts), np.concatenate(seconds), np.concatenate(ids)
        order = np.lexsort((own, second, first))
        new = np.ones(len(first), bool)
        new[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
        least = np.empty_like(own)
        least[order] = own[order][new][np.cumsum(new) - 1]
        return [_joined([packed(low), back]) for low, back in zip(np.split(least, ends), along, strict=True)]

    def finish(self, t: pa.Table, answers: dict[int, bytes]) -> pa.Table:
        t = _in_order(t)
        texts = t["text"].combine_chunks()
        counts = [exchange.word_bounds(texts.slice(begin, end - begin))[3] for begin, end in exchange.batches(texts)]
        counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        ends = np.cumsum(counts)
        doc_ids = t["doc_id"].combine_chunks().fill_null(0).to_numpy()
        covered = np.zeros(counts.sum() + 1, np.int32)
        for answer in answers.values():
            least, back = _split(answer)
            places, new = _split(back)
            places = unpacked(places, np.int32)
            which = np.cumsum(np.unpackbits(np.frombuffer(new, np.uint8), count=len(places)).astype(np.int32)) - 1
            begin = places[unpacked(least, np.int64)[which] < doc_ids[np.searchsorted(ends, places, "right")]]
            np.add.at(covered, begin, 1)
            np.add.at(covered, begin + self.size, -1)
        keep = np.cumsum(covered)[:-1] == 0
        kept_texts, removed, shas = [], [], []
        at = 0
        for text, words in zip(texts.to_pylist(), counts.tolist(), strict=True):
            own_words, flags = text.encode().split(), keep[at: at + words]
            if not flags.all():
                own_words = list(compress(own_words, flags.tolist()))
            kept = b" ".join(own_words)
            kept_texts.append(kept if len(own_words) < words else text.encode())
            removed.append(words - len(own_words))
            shas.append(hashlib.sha256(kept).hexdigest())
            at += words
        return pa.table({
            "row": t["row"], "kept_text": pa.array(kept_texts, pa.binary()).cast(pa.string()),
            "n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array(shas, pa.string())})


def _joined(parts: list[bytes]) -> bytes:
    """Parts after their number and sizes."""
    return np.array([len(parts), *map(len, parts)], "<u4").tobytes() + b"".join(parts)


def _split(data: bytes) -> list[bytes]:
    n = int(np.frombuffer(data, "<u4", 1)[0])
    ends = np.cumsum(np.frombuffer(data, "<u4", n, 4).astype(np.int64)) + 4 * (n + 1)
    return [data[end - size: end] for end, size in zip(ends.tolist(), np.frombuffer(data, "<u4", n, 4).tolist(), strict=True)]


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    depth: int = DEPTH, cells_per_byte: float = CELLS_PER_BYTE) -> DataFrame:
    """The rows of docs, the text replaced by kept_text, with n_words, n_removed and kept_sha256.

    Words are parted by blanks and 0x09 to 0x0D. Each word covered by a window (so many consecutive
    words of one text) that also starts in a row of a smaller id is removed. kept_text is the text as
    given if nothing is removed, else the words left, joined by blanks; kept_sha256 is always of the
    words left, joined by blanks. A NULL text has no words. Rows of the same id leave each other
    alone; a row without an id neither loses words nor takes them from others. Result columns take
    the place of columns of their names; other columns pass through.
    """
    total = text_bytes(docs, text_col)
    blocks = exchange.block_count(total)
    bits = max(10, int(np.ceil(np.log2(max(1, total * cells_per_byte)))))
    sketch = _Sketch(depth, bits, blocks, window)
    groups = _Groups(sketch, blocks)
    blocked = exchange.in_blocks(docs, id_col, text_col, blocks)
    counted = exchange.answered(exchange.sent(blocked, sketch.ask), sketch.reply)
    grouped = exchange.answered(exchange.sent(blocked, groups.ask, counted), groups.reply)
    found = exchange.finished(blocked, grouped, groups.finish, exchange.result_schema(docs, text_col, RESULTS))
    return exchange.unfolded(found, docs, text_col, RESULTS)
