"""Document likelihoods from a subword lattice.

A word's lattice has an arc for every vocabulary piece that matches some of its bytes, and one for
the whole word. Summing the products of arc weights over all paths (a log-space forward recursion)
gives the word's marginal probability, whatever its segmentation; a document's is the product over
its words and one end. Weights:

* Pieces come from an existing tokenizer vocabulary. Its scores weight them at first; then
  expectation-maximisation over the training words (a forward-backward pass over each distinct
  word) re-estimates them, with the first weights as a prior. The vocabulary
  itself isn't changed. Pieces that begin a word and pieces within are two distributions, and each
  piece is a word's last with a learned probability, so the piece paths sum to one over all words.
  They stand for words that training didn't see, so each training word counts once, not by use.
* The whole-word arc has the word's share in the training words less a discount, and the piece
  paths have what all discounts leave (absolute discounting; the discount follows from how many
  words occur once and twice). This is the one interpolation: `lattice_score` is the likelihood
  without it, of the pieces' segmentations alone.

Documents come in kinds (a column of the training rows, as their language). Each kind has its own
whole-word shares, which back off to those of all kinds in the same way, and a document's
probability is the sum over kinds of the kind's share times the document's probability in it; the
kind of a scored document is never looked at. The MAX_KINDS - 1 commonest kinds stand alone and all
others, and rows without one, are one more kind.

All words are counted and weighed in Spark. Words with at least 1 / FREQUENT of all occurrences are
FREQUENT at most, so their weights go to every task; occurrences of the others are joined with the
table of words, where none has more than that share.

A row is known by two 64-bit hashes of its doc_id and text, a rare word by two of its bytes; the
chance that two of 10^11 share both is below 10^-15. A frequent word is known by one.

Defined cases: null and empty texts are one end; without training documents every count is 0 and
the piece paths alone weigh; rows that repeat count and score each; a word of any length is read
whole, one beyond LONG_WORD bytes arc by arc in time and memory that grow with its length; other
columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsift.llm._space import written
from simsift.llm._text import LOWER, SPACES, chunks, powers, mix, span_hashes, spans

FREQUENT, PRIOR, ROUNDS, COUNT_BYTES, MAX_KINDS = 2_000_000, 200.0, 3, 2_000_000, 8
START, LONG_WORD = "▁", 1024
#: A second hash of a word is that of its bytes put through this permutation.
OTHER = np.random.default_rng(1).permutation(256).astype(np.uint8)


class Pieces:
    """A vocabulary's pieces: those that begin a word (START stripped) and those within, by hash."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        first, inner = {}, {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or START in piece[1:]:
                continue
            weight = 1 / (10 - model.get_score(i))
            (first if piece[0] == START else inner)[piece.removeprefix(START).encode()] = weight
        #: The empty beginning (START alone) and every single byte make all words possible.
        first.setdefault(b"", min(first.values()))
        least = min(inner.values())
        for b in range(256):
            inner.setdefault(bytes([b]), least)
        self.tables = []
        for part in (first, inner):
            names = sorted(part)
            buf = np.frombuffer(b"".join(names), np.uint8)
            ends = np.cumsum([len(x) for x in names])
            starts = ends - [len(x) for x in names]
            hashes = span_hashes(buf, starts, ends)
            order = np.argsort(hashes)
            weights = np.array([part[x] for x in names])
            self.tables.append((hashes[order], order.astype(np.int32), weights / weights.sum()))
        self.empty = sorted(first).index(b"")
        self.longest = max(len(x) for x in [*first, *inner])
        self.seen = [np.zeros(1 << 20, bool) for _ in self.tables]
        for seen, (hashes, _, _) in zip(self.seen, self.tables):
            seen[hashes >> np.uint64(44)] = True

    def find(self, which: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in hashes that are pieces, and the pieces."""
        table, names, _ = self.tables[which]
        at = np.flatnonzero(self.seen[which][hashes >> np.uint64(44)])
        k = np.minimum(np.searchsorted(table, hashes[at]), len(table) - 1)
        hit = table[k] == hashes[at]
        return at[hit], names[k[hit]]


class Weights:
    def __init__(self, first: np.ndarray, inner: np.ndarray, stop: float):
        self.first, self.inner = np.log(first), np.log(inner * (1 - stop))
        self.stop = math.log(stop)


class Lattice:
    """Arcs of words of one length: batches of (word, position, length, piece)."""

    def __init__(self, pieces: Pieces, buf: np.ndarray, starts: np.ndarray, length: int):
        self.n, self.length, self.pieces = len(starts), length, pieces
        up, down = powers(len(buf) + 1)
        sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=sums[1:])
        self.inner, self.first = [], []
        for k in range(1, min(length, pieces.longest) + 1):
            at = (starts[:, None] + np.arange(length - k + 1)[None]).ravel()
            hashes = mix((sums[at + k] - sums[at]) * down[at] + np.uint64(k))
            place, piece = pieces.find(1, hashes)
            self.inner.append((place // (length - k + 1), place % (length - k + 1), piece))
            place, piece = pieces.find(0, hashes[:: length - k + 1])
            self.first.append((place, piece))

    def _arcs(self, w: Weights) -> tuple:
        """Of one word: begins, ends, logs and pieces of the arcs within, ends, logs and pieces of those that begin it."""
        part = [(pos, pos + k, w.inner[piece], piece) for k, (_, pos, piece) in enumerate(self.inner, 1)]
        inner = [np.concatenate(x) for x in zip(*part)]
        part = [(np.full(len(piece), k), w.first[piece], piece) for k, (_, piece) in enumerate(self.first, 1)]
        return inner, [np.concatenate(x) for x in zip(*part)]

    def _long(self, w: Weights) -> tuple:
        """Forward and backward logs of one long word, and its arcs."""
        (begin, end, logs, piece), (stop, first_logs, first_piece) = arcs = self._arcs(w)
        given: dict = {0: [float(w.first[self.pieces.empty])]}
        for k, x in zip(stop.tolist(), first_logs.tolist()):
            given.setdefault(k, []).append(x)
        forward = sweep(self.length + 1, end, begin, logs, given)
        backward = sweep(self.length + 1, self.length - begin, self.length - end, logs, {0: [0.0]})[::-1]
        return forward, backward, arcs

    def _scores(self, w: Weights) -> list[np.ndarray]:
        """Of each piece length a words x positions array of log weights."""
        out = []
        for k, (word, pos, piece) in enumerate(self.inner, 1):
            s = np.full((self.n, self.length - k + 1), -np.inf)
            s[word, pos] = w.inner[piece]
            out.append(s)
        return out

    @staticmethod
    def _sum(terms: list[np.ndarray]) -> np.ndarray:
        top = np.max(terms, axis=0)
        safe = np.where(np.isfinite(top), top, 0)
        with np.errstate(divide="ignore"):
            return safe + np.log(np.exp(np.array(terms) - safe).sum(0))

    def forward(self, w: Weights, scores: list[np.ndarray]) -> np.ndarray:
        a = np.full((self.n, self.length + 1), -np.inf)
        a[:, 0] = w.first[self.pieces.empty]
        begin = np.full((self.n, self.length + 1), -np.inf)
        for k, (word, piece) in enumerate(self.first, 1):
            begin[word, k] = w.first[piece]
        for j in range(1, self.length + 1):
            terms = [a[:, j - k] + scores[k - 1][:, j - k] for k in range(1, min(j, len(scores)) + 1)]
            a[:, j] = self._sum([*terms, begin[:, j]])
        return a

    def log_probability(self, w: Weights) -> np.ndarray:
        if self.length > LONG_WORD:
            return np.array([self._long(w)[0][-1] + w.stop])
        return self.forward(w, self._scores(w))[:, -1] + w.stop

    def expected(self, w: Weights, first: np.ndarray, inner: np.ndarray) -> None:
        """Adds the expected uses of each piece."""
        if self.length > LONG_WORD:
            a, b, ((begin, end, logs, piece), (stop, first_logs, first_piece)) = self._long(w)
            inner += np.bincount(piece, np.exp(a[begin] + logs + b[end] - a[-1]), len(inner))
            first += np.bincount(first_piece, np.exp(first_logs + b[stop] - a[-1]), len(first))
            first[self.pieces.empty] += np.exp(w.first[self.pieces.empty] + b[0] - a[-1])
            return
        scores = self._scores(w)
        a = self.forward(w, scores)
        b = np.full((self.n, self.length + 1), -np.inf)
        b[:, -1] = 0
        for j in range(self.length - 1, -1, -1):
            b[:, j] = self._sum([scores[k - 1][:, j] + b[:, j + k] for k in range(1, min(self.length - j, len(scores)) + 1)])
        total = a[:, -1]
        for k, (word, pos, piece) in enumerate(self.inner, 1):
            share = np.exp(a[word, pos] + w.inner[piece] + b[word, pos + k] - total[word])
            inner += np.bincount(piece, share, len(inner))
        for k, (word, piece) in enumerate(self.first, 1):
            share = np.exp(w.first[piece] + b[word, k] - total[word])
            first += np.bincount(piece, share, len(first))
        first[self.pieces.empty] += (np.exp(w.first[self.pieces.empty] + b[:, 0] - total)).sum()


def sweep(n: int, to: np.ndarray, begin: np.ndarray, logs: np.ndarray, given: dict) -> np.ndarray:
    """Of positions 0..n-1 the log of the sum over all paths to them: arcs begin -> to, and given logs."""
    order = np.argsort(to, kind="stable")
    cuts = np.searchsorted(to[order], np.arange(n + 1)).tolist()
    begin, logs, out = begin[order].tolist(), logs[order].tolist(), [-math.inf] * n
    for j in range(n):
        terms = [out[begin[i]] + logs[i] for i in range(cuts[j], cuts[j + 1])] + given.get(j, [])
        if terms and (top := max(terms)) > -math.inf:
            out[j] = top + math.log(sum(math.exp(t - top) for t in terms))
    return np.array(out)


def lattices(pieces: Pieces, column: pa.Array, cells: int = 1 << 21) -> Iterator[tuple[np.ndarray, Lattice]]:
    """Rows of a column of words, by length, and their lattices; a batch has about so many cells."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(column.buffers()[2], np.uint8)
    lengths = np.diff(offsets)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for rows in np.split(order, cuts):
        n = int(lengths[rows[0]])
        step = 1 if n > LONG_WORD else max(1, cells // (n * min(n, pieces.longest)))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            take = (offsets[some][:, None] + np.arange(n)[None]).ravel()
            yield some, Lattice(pieces, buf[take], np.arange(len(some)) * n, n)


def word_counts(docs: DataFrame, kinds: int) -> DataFrame:
    """word (bytes), n (all occurrences), c (array: those in training rows of each kind) of
    docs(text, kind), kind null outside training."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = np.array(batch.column(1).fill_null(-1))
            for chunk in chunks(batch.column(0), COUNT_BYTES):
                buf = LOWER[chunk.buf]
                starts, ends, _ = spans(chunk, ~SPACES)
                if not len(starts):
                    continue
                own = kind[chunk.first + np.searchsorted(chunk.offsets, starts, "right") - 1]
                h = span_hashes(buf, starts, ends) + own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                _, first, n = np.unique(h, return_index=True, return_counts=True)
                data = buf.tobytes()
                names = [data[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(own[first].astype(np.int32)), pa.array(n)], names=["word", "kind", "n"])

    rows = docs.select("text", "kind").mapInArrow(run, "word binary, kind int, n long")
    each = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)) for k in range(kinds)]
    return written(rows.groupBy("word").agg(F.sum("n").alias("n"), F.array(*each).alias("c")), "word-counts")


def _all(c: str = "c"):
    return F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)


def learn(counts: DataFrame, pieces: Pieces, rounds: int = ROUNDS) -> Weights:
    """Piece weights from counts(word, c): rounds of expectation-maximisation over all words."""
    first, inner = pieces.tables[0][2], pieces.tables[1][2]
    w, spread = Weights(first, inner, 0.3), counts.sparkSession.sparkContext.broadcast(pieces)
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], w=w) -> Iterator[pa.RecordBatch]:
            ps, sums = spread.value, [np.zeros(len(first)), np.zeros(len(inner))]
            for batch in batches:
                for _, lattice in lattices(ps, batch.column(0)):
                    lattice.expected(w, *sums)
            for part, s in enumerate(sums):
                k = np.flatnonzero(s)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), part, np.int32)), pa.array(k.astype(np.int32)), pa.array(s[k])], names=["part", "piece", "uses"])

        uses = counts.where(_all() > 0).select("word").mapInArrow(run, "part int, piece int, uses double")
        got = [np.zeros(len(first)), np.zeros(len(inner))]
        for r in uses.groupBy("part", "piece").agg(F.sum("uses").alias("uses")).collect():
            got[r["part"]][r["piece"]] = r["uses"]
        stop = (got[0].sum() + 0.3) / (got[0].sum() + got[1].sum() + 1)
        made = [(g + PRIOR * p) / (g.sum() + PRIOR) for g, p in zip(got, (first, inner))]
        w = Weights(made[0], made[1], stop)
    return w


class Totals:
    """Training words, types and documents, of each kind and in all."""

    def __init__(self, words: list[int], types: list[int], documents: list[int], all_types: int, once: int, twice: int):
        self.kind_words, self.kind_types = np.array(words, float), np.array(types, float)
        self.kind_documents = np.array(documents, float)
        self.words, self.types, self.documents = sum(words), all_types, sum(documents)
        self.tokens, self.distinct = self.words + self.documents, all_types + (self.documents > 0)
        self.discount = min(0.95, max(0.3, once / max(1, once + 2 * twice)))
        self.end = np.log10((self.kind_documents + 1) / (self.kind_words + self.kind_documents + 2))
        self.share = np.log10((self.kind_documents + 1) / (self.documents + len(words)))

    def base(self, c):
        return np.log10((c + 0.1) / (self.tokens + 0.1 * (self.distinct + 1)))

    def weights(self, c: np.ndarray, path: np.ndarray) -> np.ndarray:
        """words x kinds of log10 probabilities, from counts (words x kinds) and the piece paths' logs."""
        d = self.discount
        new = d * self.types / self.words if self.words else 1.0
        every = np.maximum(c.sum(1) - d, 0) / max(1, self.words) + new * np.exp(path)
        rest = np.where(self.kind_words > 0, d * self.kind_types / np.maximum(1, self.kind_words), 1.0)
        own = np.maximum(c - d, 0) / np.maximum(1, self.kind_words) + rest * every[:, None]
        return np.log10(np.maximum(own, 1e-300)) + np.log10(1 - 10**self.end)

    def lattice_end(self) -> float:
        """log10 of the share of ends among training tokens."""
        return math.log10((self.documents + 1) / (self.words + self.documents + 2))


def weighed(counts: DataFrame, pieces: Pieces, w: Weights, totals: Totals) -> DataFrame:
    """h, h2 (hashes of the word), n, c (training occurrences), lattice (log10 probability by pieces
    alone), lp (log10 probability in each kind)."""
    spread, kinds = counts.sparkSession.sparkContext.broadcast(pieces), len(totals.kind_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            path, (h, h2) = np.empty(len(batch)), np.empty((2, len(batch)), np.uint64)
            for rows, lattice in lattices(spread.value, batch.column(0)):
                path[rows] = lattice.log_probability(w)
            for chunk in chunks(batch.column(0), rows=len(batch)):
                for to, buf in ((h, chunk.buf), (h2, OTHER[chunk.buf])):
                    to[chunk.first : chunk.first + chunk.rows] = span_hashes(buf, chunk.offsets[:-1], chunk.offsets[1:])
            c = np.array(batch.column(2).flatten()).reshape(-1, kinds)
            lp = totals.weights(c, path)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(h2.view(np.int64)), batch.column(1), pa.array(c.sum(1)), pa.array(path / math.log(10) + rest), *(pa.array(lp[:, k]) for k in range(kinds))], names=names
            )

    rest = math.log10(1 - 10 ** totals.lattice_end())
    names = ["h", "h2", "n", "c", "lattice", *(f"lp{k}" for k in range(kinds))]
    schema = "h long, h2 long, n long, c long, lattice double, " + ", ".join(f"lp{k} double" for k in range(kinds))
    return written(counts.select("word", "n", "c").mapInArrow(run, schema), "word-weights")


def kind_numbers(docs: DataFrame, column: str) -> tuple:
    """The expression that numbers a training row's kind, and how many there are."""
    counts = docs.where("NOT held_out").groupBy(column).count().where(F.col(column).isNotNull())
    names = [r[0] for r in counts.orderBy(F.desc("count"), column).limit(MAX_KINDS - 1).collect()]
    number = F.lit(len(names))
    for k, name in enumerate(names):
        number = F.when(F.col(column) == name, F.lit(k)).otherwise(number)
    return number, len(names) + 1


def score(docs: DataFrame, vocabulary: str, kind: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score of every row of
    docs(doc_id, text, held_out); rows with held_out aren't learned from.

    vocabulary is the path of a sentencepiece model; kind names a column of docs.
    """
    spark = docs.sparkSession
    number, kinds = kind_numbers(docs, kind) if kind else (F.lit(0), 1)
    own = docs.select("doc_id", "held_out", "text", F.when(~F.col("held_out"), number).alias("kind"))
    pieces = Pieces(vocabulary)
    counts = word_counts(own, kinds)
    each = range(kinds)
    t = counts.agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.get("c", F.lit(k))) for k in each]).alias("words"),
        F.array(*[F.count_if(F.get("c", F.lit(k)) > 0) for k in each]).alias("types"),
        *(F.count_if(_all() == k).alias(f"c{k}") for k in (1, 2)),
        F.count_if(_all() > 0).alias("v"),
    ).collect()[0]
    documents = dict(own.where("NOT held_out").groupBy("kind").count().collect())
    totals = Totals([x or 0 for x in t["words"]], [x or 0 for x in t["types"]], [documents.get(k, 0) for k in each], t["v"] or 0, t["c1"] or 0, t["c2"] or 0)
    table = weighed(counts, pieces, learn(counts, pieces), totals)
    limit = max(1, (t["n"] or 0) / FREQUENT)
    lps = [f"lp{k}" for k in each]
    often = table.where(F.col("n") >= limit).select("h", "c", "lattice", *lps).toArrow()
    order = np.argsort(often.column("h").to_numpy())
    lp = np.stack([often.column(x).to_numpy()[order] for x in lps], 1)
    common = spark.sparkContext.broadcast((*(often.column(x).to_numpy()[order] for x in ("h", "c", "lattice")), lp))
    # Rows that repeat share both hashes, and what their words add up to is divided.
    hashes = [F.xxhash64(F.lit(x), F.col("doc_id"), F.col("text")).alias(x) for x in ("row", "row2")]
    keyed = own.select("text", *hashes, "doc_id", "held_out")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ch, cc, ca, cl = common.value
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                n = chunk.rows
                starts, ends, first = spans(chunk, ~SPACES)
                h = span_hashes(LOWER[chunk.buf], starts, ends).view(np.int64)
                text = np.searchsorted(chunk.offsets, starts, "right") - 1
                found, at = np.zeros(len(h), bool), np.zeros(len(h), np.int64)
                if len(ch):
                    at = np.minimum(np.searchsorted(ch, h), len(ch) - 1)
                    found = ch[at] == h
                rows, at = text[found], at[found]
                known = np.bincount(rows, cc[at] > 0, n) + (totals.documents > 0)
                base = np.bincount(rows, totals.base(cc[at]), n) + totals.base(totals.documents)
                sums = [np.bincount(rows, ca[at], n) + totals.lattice_end(), *(np.bincount(rows, cl[at, k], n) + totals.end[k] for k in each)]
                row, row2 = (np.array(batch.column(k))[chunk.first : chunk.first + n] for k in (1, 2))
                # A document's own row joins nothing: it counts no occurrence of the word it names.
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (row, row2, row, row2, np.zeros(n, np.int32))] + [*(batch.column(k).slice(chunk.first, n) for k in (3, 4)), pa.array(np.diff(first) + 1), pa.array(known.astype(np.int64)), pa.array(base), *map(pa.array, sums)],
                    names=names,
                )
                rest = np.flatnonzero(~found)
                if len(rest):
                    rest = rest[np.lexsort((h[rest], text[rest]))]
                    new = np.ones(len(rest), bool)
                    new[1:] = (h[rest][1:] != h[rest][:-1]) | (text[rest][1:] != text[rest][:-1])
                    tf = np.diff(np.append(np.flatnonzero(new), len(rest)))
                    rest = rest[new]
                    m = len(rest)
                    h2 = span_hashes(OTHER[LOWER[chunk.buf]], starts[rest], ends[rest]).view(np.int64)
                    nulls = (pa.nulls(m, x) for x in (batch.column(3).type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), *(pa.float64() for _ in each)))
                    keys = [pa.array(x) for x in (row[text[rest]], row2[text[rest]], h[rest], h2, tf.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays([*keys, *nulls], names=names)

    id_type = own.schema["doc_id"].dataType.simpleString()
    schema = f"row long, row2 long, h long, h2 long, tf int, doc_id {id_type}, held_out boolean, n_tokens long, known long, base double, sa double, " + ", ".join(f"s{k} double" for k in each)
    names = [x.split()[0] for x in schema.split(", ")]
    rows = keyed.mapInArrow(run, schema)
    met = rows.join(table.where(F.col("n") < limit).select("h", "h2", "c", "lattice", *lps), ["h", "h2"], "left")
    c = F.coalesce("c", F.lit(0))
    base = F.log10((c + 0.1) / (totals.tokens + 0.1 * (totals.distinct + 1)))
    met = met.select(
        "row",
        "row2",
        "doc_id",
        "held_out",
        "n_tokens",
        F.coalesce("known", F.when(c > 0, F.col("tf")).otherwise(0).cast("long")).alias("known"),
        F.coalesce("base", F.col("tf") * base).alias("base"),
        F.coalesce("sa", F.col("tf") * F.col("lattice")).alias("sa"),
        *(F.coalesce(f"s{k}", F.col("tf") * F.col(f"lp{k}")).alias(f"s{k}") for k in each),
    )
    sums = met.groupBy("row", "row2").agg(
        F.count("n_tokens").alias("n"),
        F.first("doc_id", ignorenulls=True).alias("doc_id"),
        F.first("held_out", ignorenulls=True).alias("held_out"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum("known").alias("n_known"),
        F.sum("base").alias("base_score"),
        F.sum("sa").alias("sa"),
        *(F.sum(f"s{k}").alias(f"s{k}") for k in each),
    )
    sums = sums.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    in_kind = [F.col(f"s{k}") / F.col("n") + F.lit(float(totals.share[k])) for k in each]
    best = F.array_max(F.array(*in_kind))
    spread = F.aggregate(F.array(*in_kind), F.lit(0.0), lambda a, x: a + F.pow(F.lit(10.0), x - best))
    return sums.select(
        "doc_id",
        "held_out",
        (F.col("n_tokens") / F.col("n")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("n")).cast("long").alias("n_known"),
        F.lit(totals.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") / F.col("n")).alias("base_score"),
        (best + F.log10(spread)).alias("score"),
        (F.col("sa") / F.col("n")).alias("lattice_score"),
    )
