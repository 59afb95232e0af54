"""SentencePiece encoding with merge-type vocabularies, from agendas of adjacent symbol pairs.

A text is normalised as the model says (spaces become the mark U+2581, one is put in front). Its
characters are the first symbols. An agenda holds the adjacent pairs whose joined text is a piece, the
best score first, of equal scores the leftmost: a pair is joined and the new neighbours join the
agenda, until it is empty. A symbol without a piece of its own is spelt as bytes, or is unknown if
the vocabulary has no bytes.

Two characters that stand side by side in no piece are never joined. Where "other character, mark"
is such a pair, as in most vocabularies, a text falls apart there into segments with agendas of their
own; equal segments have equal ids, and a worker keeps those of frequent ones. Otherwise, or if unknown
symbols are to be told, a text is one segment. The agendas of all short new segments are worked through
together, as one array of pairs: a round takes the best pair of each segment. A long segment's agenda is a heap,
whose pairs are passed over if a symbol has changed since.

Arrow batches are worked through in pieces of about a million bytes. In each, the ids of segments not
kept yet are compared with those that the sentencepiece library gives them; a text agrees if all of
its segments do. The library's decode(ids) gives the decoded text.

Defined cases: a null or empty text has no ids and decodes to an empty text; a text of any length is
encoded whole, a word of any length in time that grows as n log n; rows that repeat get the same
result each; other columns are ignored. Vocabularies of another type than merges, or with
user-defined or unused pieces, are refused.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsift.llm._text import chunks, worker_cache

MARK = "▁"
#: Fixed values of the model file: types of pieces, and that of a merge vocabulary.
NORMAL, UNKNOWN, USER_DEFINED, UNUSED, BYTE, MERGES = 1, 2, 4, 5, 6, 2
#: Segments kept with their ids by a worker (half of them used lately), and the longest of them, whose
#: agendas are worked through together.
CACHED_SEGMENTS, SHORT = 300_000, 32
NEVER = np.iinfo(np.int64).max


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value, at, shift = value | (byte & 127) << shift, at + 1, shift + 7
        if byte < 128:
            return value, at


def message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values (numbers, or bytes) of a protocol-buffers message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if key & 7 == 2 else ((4 if key & 7 == 5 else 8), at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class Vocabulary:
    """Pieces and scores of a model file, and the agenda over them."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        kinds, model_type = [], None
        for number, value in message(self.library.serialized_model_proto()):
            if number == 1:
                kinds.append(dict(message(value)).get(3, NORMAL))
            elif number == 2:
                model_type = dict(message(value)).get(3, 1)
        if model_type != MERGES:
            raise ValueError(f"{path} holds no merge-type vocabulary")
        if USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError(f"{path} has user-defined or unused pieces")
        pieces = [self.library.id_to_piece(i) for i in range(len(kinds))]
        self.ids = {p: i for i, (p, kind) in enumerate(zip(pieces, kinds)) if kind == NORMAL}
        self.order = {p: -self.library.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, (p, kind) in enumerate(zip(pieces, kinds)) if kind == BYTE}
        self.unknown = kinds.index(UNKNOWN)
        pairs = {pair for p in self.ids for pair in zip(p, p[1:])}
        whole = not self.bytes or any(right == MARK != left for left, right in pairs)
        self.segments = re.compile(".+" if whole else f"{MARK}*[^{MARK}]+|{MARK}+", re.DOTALL)
        self._tables(len(kinds))

    def _tables(self, size: int) -> None:
        """Symbols as numbers (pieces, then characters that are none), and of each pair of symbols whose
        joined text is a piece the piece and its place in order of scores."""
        self.pieces, self.base = size, size + 0x110000
        self.number_of = np.arange(size, self.base)
        number = self.ids | {c: size + ord(c) for c in {c for p in self.ids for c in p} - self.ids.keys()}
        for c, k in number.items():
            if len(c) == 1:
                self.number_of[ord(c)] = k
        places = {o: k for k, o in enumerate(sorted(set(self.order.values())))}
        rows = [
            (number[p[:k]] * self.base + number[p[k:]], i, places[self.order[p]])
            for p, i in self.ids.items()
            for k in range(1, len(p))
            if p[:k] in number and p[k:] in number
        ]
        self.pair, self.joined, self.place = np.array(sorted(rows), np.int64).reshape(-1, 3).T.copy()

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What pairs join to, and their places (NEVER: they don't)."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return self.joined[at], np.where(self.pair[at] == key, self.place[at], NEVER)

    def together(self, segments: list[str]) -> list[bytes]:
        """Ids of segments as 32-bit integers, from their agendas side by side."""
        symbol = self.number_of[np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)]
        owner = np.repeat(np.arange(len(segments)), [len(s) for s in segments])
        ready = []
        joined, place = self._look(symbol[:-1], symbol[1:])
        joined, place = np.append(joined, 0), np.append(place, NEVER)
        place[:-1][owner[:-1] != owner[1:]] = NEVER
        while len(symbol):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.minimum.reduceat(place, first)
            sizes = np.diff(np.append(first, len(symbol)))
            live = np.repeat(least < NEVER, sizes)
            if not live.all():
                ready.append((owner[~live], symbol[~live]))
                symbol, owner, joined, place = symbol[live], owner[live], joined[live], place[live]
                sizes, least = sizes[least < NEVER], least[least < NEVER]
                if not len(symbol):
                    break
            best = np.flatnonzero(place == np.repeat(least, sizes))
            best = best[np.append(True, owner[best[1:]] != owner[best[:-1]])]  # the leftmost of each segment
            symbol[best] = joined[best]
            stay = np.ones(len(symbol), bool)
            stay[best + 1] = False
            at = best - np.arange(len(best))  # where the joined symbols stand without those that are gone
            symbol, owner, joined, place = symbol[stay], owner[stay], joined[stay], place[stay]
            for left in (at[at + 1 < len(symbol)], at[at > 0] - 1):
                joined[left], place[left] = self._look(symbol[left], symbol[left + 1])
                place[left[owner[left] != owner[left + 1]]] = NEVER
            place[-1] = NEVER
        owner, symbol = (np.concatenate(x) for x in zip(*ready))
        order = np.argsort(owner, kind="stable")
        ids, owner, each = symbol[order], owner[order], np.ones(len(order), np.int64)
        if (odd := ids >= self.pieces).any():  # characters without a piece are spelt
            codes, which = np.unique(ids[odd], return_inverse=True)
            spelt = [[self.bytes[b] for b in chr(c - self.pieces).encode()] for c in codes.tolist()]
            each[odd] = np.array([len(x) for x in spelt])[which]
            ids = np.repeat(ids, each)
            ids[np.repeat(odd, each)] = [b for k in which.tolist() for b in spelt[k]]
        sizes = np.bincount(np.repeat(owner, each), minlength=len(segments))
        data, ends = ids.astype(np.int32).tobytes(), (4 * np.cumsum(sizes)).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def agenda(self, text: str) -> list[str]:
        """The symbols that are left of a normalised text once no pair can be joined."""
        symbols, end, order = list(text), len(text), self.order
        heap = [(o, k, k + 1, 2) for k in range(end - 1) if (o := order.get(symbols[k] + symbols[k + 1])) is not None]
        if not heap:
            return symbols
        heapq.heapify(heap)
        after, before, sizes = list(range(1, end + 1)), list(range(-1, end - 1)), [1] * end
        while heap:
            _, left, right, size = heapq.heappop(heap)
            if not sizes[left] or not sizes[right] or sizes[left] + sizes[right] != size:
                continue
            joined = symbols[left] = symbols[left] + symbols[right]
            sizes[left], sizes[right], symbols[right] = size, 0, ""
            after[left] = right = after[right]
            if right < end:
                before[right] = left
                if (o := order.get(joined + symbols[right])) is not None:
                    heapq.heappush(heap, (o, left, right, size + sizes[right]))
            if (first := before[left]) >= 0 and (o := order.get(symbols[first] + joined)) is not None:
                heapq.heappush(heap, (o, first, left, sizes[first] + size))
        return [x for x in symbols if x]

    def spelt(self, segment: str) -> bytes:
        """Ids of a segment as 32-bit integers, from a heap."""
        out: list[int] = []
        known = True
        for symbol in self.agenda(segment):
            piece = self.ids.get(symbol)
            if piece is not None:
                out.append(piece)
            elif self.bytes:
                out += [self.bytes[b] for b in symbol.encode()]
            elif known:  # neighbouring unknown symbols are one
                out.append(self.unknown)
            known = piece is not None
        return array("i", out).tobytes()

    def encode(self, segments: list[str]) -> list[bytes]:
        """Ids of segments of normalised text."""
        short = iter(self.together([s for s in segments if len(s) <= SHORT]) if self.bytes and segments and min(map(len, segments)) <= SHORT else ())
        return [next(short) if self.bytes and len(s) <= SHORT else self.spelt(s) for s in segments]

    def librarys(self, segments: list[str]) -> list[list[int]]:
        """What the library makes of segments, whose first mark it puts in front by itself."""
        front = len(self.library.normalize("a")) - 1
        found = self.library.encode([s[front:].replace(MARK, " ") for s in segments], num_threads=1)
        return [x if len(s) > front else [self.library.piece_to_id(s)] for s, x in zip(segments, found)]

    def encode_texts(self, texts: list[str], kept: dict[str, dict[str, bytes]], differ: set[str]) -> tuple[list[np.ndarray], list[bool]]:
        """Ids of texts, and whether the library's agree. kept (lately, before) and differ are of segments
        seen before, and are added to."""
        cut = [self.segments.findall(self.library.normalize(t)) for t in texts]
        lately, before = kept.setdefault("lately", {}), kept.get("before", {})
        new = []
        for s in {s for segments in cut for s in segments}:
            if s not in lately:
                if s in before:
                    lately[s] = before[s]
                else:
                    new.append(s)
        found = self.encode(new)
        differ.update(s for s, a, b in zip(new, found, self.librarys(new)) if a != array("i", b).tobytes())
        lately.update(zip(new, found))
        rows = [b"".join([lately[s] for s in segments]) for segments in cut]
        agree = [not differ or differ.isdisjoint(segments) for segments in cut]
        for s in new:
            if len(s) > SHORT:
                del lately[s]
        if len(lately) > CACHED_SEGMENTS // 2:
            kept["before"], kept["lately"] = lately, {}
        return [np.frombuffer(r, np.int32) for r in rows], agree


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids array<int>, decoded, agrees of every row of docs(doc_id, text)."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_cache(f"sentencepiece {path}")
        if "vocabulary" not in kept:
            kept["vocabulary"], kept["segments"], kept["differ"] = Vocabulary(path), {}, set()
        vocabulary, library = kept["vocabulary"], kept["vocabulary"].library
        for batch in batches:
            for c in chunks(batch.column(1)):
                texts = [c.buf[a:b].tobytes().decode() for a, b in zip(c.offsets[:-1], c.offsets[1:])]
                ids, agrees = vocabulary.encode_texts(texts, kept["segments"], kept["differ"])
                decoded = [library.decode(x.tolist()) for x in ids]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                columns = [batch.column(0).slice(c.first, c.rows), pa.ListArray.from_arrays(ends, np.concatenate(ids)), pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded", "agrees"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encoded, f"doc_id {kind}, ids array<int>, decoded string, agrees boolean")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, agrees of encoded rows."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "agrees",
    )
