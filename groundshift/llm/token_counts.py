"""Token counts of a unigram model by dynamic programming over a trie of distinct pre-tokens.

A pre-token is a blank-marked word (or a line feed). Distinct ones are inserted in a trie; a node holds the best score of its prefix over all
segmentations into pieces and the number of pieces of that segmentation, from the nodes above it, so it is computed once for all pre-tokens
that share it. A terminal node's number is the pre-token's count. Ties go to fewer pieces. Characters outside the vocabulary
count their UTF-8 bytes.

The pieces are those of a vocabulary file, which is a parameter and is not changed. The file is of the merge type and holds ranks, not
probabilities; so the unigram model's log-probabilities are estimated here: each piece's share of all pieces in the file's own segmentation of every
pre-token of all documents.

Definite results: null and empty texts have 0 tokens; texts and pre-tokens of any length are counted whole; repeated rows give repeated rows (and count as
often in the estimate); an empty table gives an empty result; other columns play no part, whatever their names; ties do not depend on the order of rows.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundshift.llm.repeats import distinct
from groundshift.llm.shared import groups, small_batches, utf8

SPACE = "▁"
#: Nodes of a task's trie, after which it begins anew, and the length from which a pre-token is counted beside it.
NODES, LONG = 1_000_000, 4096
#: What a character outside the vocabulary costs below the least likely piece; count added to every piece.
PENALTY, SMOOTH = 10.0, 0.01


class Vocabulary:
    """Pieces of a file, numbered, and all that they begin with."""

    def __init__(self, path: str):
        m = self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        self.pieces = [m.id_to_piece(i) for i in normal]
        self.of_id = np.full(m.get_piece_size(), -1)
        self.of_id[normal] = np.arange(len(normal))
        self.number = {p: i for i, p in enumerate(self.pieces)}
        self.longest = max(map(len, self.pieces))
        #: all that pieces begin with
        self.beginning = {p[:k] for p in self.pieces for k in range(len(p) + 1)}
        self.feed = m.encode("\n")

    def segmented(self, tokens: list[str], n: np.ndarray) -> np.ndarray:
        """How often each piece stands in pre-tokens that occur n times each, by the file's own merges."""
        out = np.zeros(len(self.pieces))
        begins = np.array([t.startswith(SPACE) for t in tokens], bool)
        for own, head in ((begins, 0), (~begins, len(self.feed))):  # the library puts a blank before a text; a line feed keeps it apart
            some = [tokens[i] for i in np.flatnonzero(own)]
            ids = self.library.encode([t[1:] for t in some] if head == 0 else ["\n" + t for t in some])
            flat = np.fromiter((x for t in ids for x in t[head:]), np.int64)
            times = np.repeat(n[own], [len(t) - head for t in ids]) if len(ids) else n[:0]
            known = self.of_id[flat] >= 0
            out += np.bincount(self.of_id[flat][known], times[known], len(out))
        if SPACE in self.number:  # a blank alone is no text to the library
            out[self.number[SPACE]] += n[[t == SPACE for t in tokens]].sum()
        return out


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str | None) -> Vocabulary:
    path = path or default_model()
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


class Trie:
    """Best score and number of pieces of every prefix inserted so far.

    A node also holds its state: the longest end of its prefix that a piece begins with. A state knows the pieces that end there and, once asked, the state after each character,
    so that a node looks only at pieces that do end at it.
    """

    def __init__(self, v: Vocabulary, logp: np.ndarray):
        self.v, self.logp, self.unknown = v, logp.tolist(), float(logp.min()) - PENALTY
        #: a state: its text, the states after each character met so far, and (length, log-probability) of the pieces that end it, shortest first
        self.start: tuple[str, dict, list] = ("", {}, [])
        self.states = {"": self.start}
        self.clear()

    def clear(self) -> None:
        #: a node: best score and number of pieces of its prefix, the nodes below it by character, and its state
        self.root: tuple[float, int, dict, tuple] = (0.0, 0, {}, self.start)
        self.nodes = 1
        self.terminals: dict[bytes, int] = {}

    def _state(self, before: tuple[str, dict, list], c: str) -> tuple[str, dict, list]:
        """The state after a character, which before does not know yet."""
        text, beginning = before[0] + c, self.v.beginning
        while text not in beginning:
            text = text[1:]
        state = self.states.get(text)
        if state is None:
            number = self.v.number
            ends = [(n, self.logp[number[text[-n:]]]) for n in range(1, len(text) + 1) if text[-n:] in number]
            state = self.states[text] = (text, {}, ends)
        before[1][c] = state
        return state

    def _next(self, c: str, path: list[tuple[float, int, dict, tuple]]) -> tuple[float, int, dict, tuple]:
        """Node of a prefix that ends with c from those of shorter ones, the empty one first."""
        before = path[-1]
        state = before[3][1].get(c) or self._state(before[3], c)
        best, count = None, 0
        for n, logp in state[2]:
            node = path[-n]
            score = node[0] + logp
            if best is None or score > best or (score == best and node[1] + 1 < count):
                best, count = score, node[1] + 1
        if c not in self.v.number and (best is None or before[0] + self.unknown > best):
            best, count = before[0] + self.unknown, before[1] + len(c.encode())
        return best, count, {}, state

    def _alone(self, p: str) -> int:
        """Count of a long pre-token, of whose path only the last nodes are kept."""
        w, path = self.v.longest, [self.root]
        for c in p:
            if len(path) > 8 * w:
                del path[:-w]
            path.append(self._next(c, path))
        return path[-1][1]

    def count(self, token: bytes) -> int:
        """Number of pieces of a pre-token."""
        known = self.terminals.get(token)
        if known is not None:
            return known
        p = token.decode("utf-8", "replace").replace(" ", SPACE)
        if len(p) > LONG:
            return self._alone(p)
        if self.nodes > NODES:
            self.clear()
        node = self.root
        path = [node]
        for c in p:
            below = node[2]
            node = below.get(c)
            if node is None:
                node = below[c] = self._next(c, path)
                self.nodes += 1
            path.append(node)
        n = self.terminals[token] = node[1]
        return n


def _split(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For rows i to j of texts: i, j, their bytes, where pre-tokens begin (and the last one ends), the first equal one of each, and the index of each row's first (one more at the end)."""
    column = pc.replace_substring(column.cast(pa.large_string()).fill_null(""), SPACE, " ")
    b, off = utf8(pc.if_else(pc.equal(column, ""), column, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), column, pa.scalar("", pa.large_string()))))
    for i, j in groups(off):
        part, rows = b[off[i] : off[j]], off[i : j + 1] - off[i]
        feed = part == 10
        first = feed | (part == 32)
        first[1:] |= feed[:-1]
        first[rows[:-1][rows[:-1] < len(part)]] = True
        begin = np.r_[np.flatnonzero(first), len(part)]
        yield i, j, part, begin, distinct(part, begin, np.zeros(len(begin) - 1, np.int64)), np.searchsorted(begin, rows)


def estimated(docs: DataFrame, model: str | None = None) -> np.ndarray:
    """Log-probabilities of the vocabulary's pieces. What reaches the driver is one number for each piece."""
    small_batches(docs.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, total = vocabulary(model), 0
        counts: dict[bytes, int] = {}

        def closed():
            out = v.segmented([k.decode("utf-8", "replace").replace(" ", SPACE) for k in counts], np.array(list(counts.values()), np.int64))
            counts.clear()
            return out

        size = 0
        for batch in batches:
            for _, _, part, begin, rep, _ in _split(batch.column(0)):
                heads, n = np.unique(rep, return_counts=True)
                raw = part.tobytes()
                for s, e, k in zip(begin[heads].tolist(), begin[heads + 1].tolist(), n.tolist(), strict=True):
                    t = raw[s:e]
                    counts[t] = counts.get(t, 0) + k
                size += len(heads)
                if size > NODES:
                    total, size = total + closed(), 0
        total = np.rint(total + closed()).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["piece", "n"])

    texts = docs.select(F.col("text").cast("string").alias("text")).where("text is not null")
    got = texts.mapInArrow(pieces, "piece int, n bigint").groupBy("piece").agg(F.sum("n").alias("n")).toPandas()
    n = np.full(len(vocabulary(model).pieces), SMOOTH)
    n[got["piece"].astype(int)] += got["n"]
    return np.log(n / n.sum())


def counted(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens of each document. model: a vocabulary file that every executor has; None: the public one."""
    logp = estimated(docs, model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(vocabulary(model), logp)
        gc.disable()  # nodes hold no cycles, and going through a million of them again and again takes a quarter of the time
        try:
            for batch in batches:
                out = np.zeros(batch.num_rows, np.int64)
                for i, j, part, begin, rep, rows in _split(batch.column(1)):
                    heads, inverse = np.unique(rep, return_inverse=True)
                    raw = part.tobytes()
                    n = np.array([trie.count(raw[s:e]) for s, e in zip(begin[heads].tolist(), begin[heads + 1].tolist(), strict=True)], np.int64)
                    sums = np.r_[0, np.cumsum(n[inverse])] if len(n) else np.zeros(1, np.int64)
                    out[i:j] = sums[rows[1:]] - sums[rows[:-1]]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["doc_id", "n_tokens"])
        finally:
            gc.enable()

    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(task, "doc_id bigint, n_tokens bigint")
