"""SentencePiece encoding of merge-type (BPE) models by backtracking, and decoding.

A text is cut where no piece of the vocabulary can cross. In each segment an Aho-Corasick automaton gives the longest piece at
every place. Pieces are laid from the left; one may follow another only if re-merging both texts gives just these two. Where it
may not, shorter prefixes are tried, and a place from which nothing fits is marked in a bitfield, so that it is entered once. Characters
outside the vocabulary become bytes. Encoded segments are remembered in two generations of bounded size.

Definite results: null text is empty and has no ids; texts of any length are encoded whole; repeated rows give repeated rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundshift.llm.shared import freed, kept, small_batches

SPACE = "▁"
_NONE: dict = {}
#: Entries of one generation of remembered segments, and of remembered pairs.
REMEMBER, PAIRS = 300_000, 1_000_000


class Pieces:
    """A vocabulary, read with the sentencepiece library from a model file."""

    def __init__(self, path: str):
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        text = [m.id_to_piece(i) for i in range(n)]
        special = [m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i) for i in range(n)]
        self.ids = {t: i for i, t in enumerate(text) if not special[i]}
        self.score = {t: m.get_score(i) for t, i in self.ids.items()}
        self.byte = {int(t[3:5], 16): i for i, t in enumerate(text) if m.is_byte(i)}
        self.text = text
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.unknown = m.unk_id()
        self.matcher = ahocorasick.Automaton()
        for t in self.ids:
            self.matcher.add_word(t, len(t))
        self.matcher.make_automaton()
        self.shorter = {t: next((t[:k] for k in range(len(t) - 1, 0, -1) if t[:k] in self.ids), "") for t in self.ids}
        self.after: dict[str, dict[str, bool]] = {}
        self.known_pairs = 0
        inner = any(SPACE in t.lstrip(SPACE) for t in self.ids)
        line = any("\n" in t for t in self.ids)
        self.simple = not inner and not line  # blanks and line feeds end every piece
        self.cut = re.compile(".+" if inner else f"{SPACE}*[^{SPACE}]+|{SPACE}+" if line else f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+", re.DOTALL).findall

    def merged(self, s: str) -> list[str]:
        """The definition: join the best pair, the leftmost of equals, until none is a piece."""
        parts, score, low = list(s), self.score.get, float("-inf")
        worth = [score(a + b, low) for a, b in pairwise(parts)]
        while worth and (best := max(worth)) > low:
            i = worth.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del worth[i]
            if i:
                worth[i - 1] = score(parts[i - 1] + parts[i], low)
            if i < len(worth):
                worth[i] = score(parts[i] + parts[i + 1], low)
        return parts

    def fits(self, a: str, b: str) -> bool:
        """Whether b may follow a (nothing before: a is empty)."""
        after = self.after.get(a)
        if after is None:
            after = self.after[a] = {}
        known = after.get(b)
        if known is None:
            self.known_pairs += 1
            if self.known_pairs >= PAIRS:
                self.after.clear()
                self.known_pairs = 0
            known = after[b] = self.merged(a + b) == ([a, b] if a else [b])
        return known

    def segment(self, s: str) -> list[str]:
        """Pieces of a segment, and characters outside the vocabulary as they are."""
        n = len(s)
        longest = [1] * n
        for end, length in self.matcher.iter(s):
            start = end - length + 1
            if length > longest[start]:
                longest[start] = length
        failed = bytearray((n >> 3) + 1)
        out: list[str] = []
        at, piece, before, fits, shorter = 0, s[: longest[0]], "", self.fits, self.shorter
        while at < n:
            after = self.after.get(before, _NONE)
            while piece:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    known = after.get(piece)
                    if fits(before, piece) if known is None else known:
                        break
                piece = shorter.get(piece, "")
            if piece:
                out.append(piece)
                at, before = end, piece
                if at < n:
                    piece = s[at : at + longest[at]]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                if not out:
                    raise ValueError(f"no encoding of {s!r}")
                piece = out.pop()
                at -= len(piece)
                before = out[-1] if out else ""
        return out

    def numbers(self, parts: list[str]) -> list[int]:
        ids: list[int] = []
        for t in parts:
            i = self.ids.get(t)
            if i is not None:
                ids.append(i)
            elif self.byte:
                ids.extend(self.byte[b] for b in t.encode())
            else:
                ids.append(self.unknown)
        return ids

    def segments(self, text: str) -> list[str]:
        return self.cut(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for s in self.segments(text) for i in self.numbers(self.segment(s))]

    def spelled(self, ids: list[int]) -> str:
        """Text of ids with the leading blank still there."""
        out, held = [], bytearray()
        for i in [*ids, -1]:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            if i >= 0:
                out.append(" ⁇ " if i == self.unknown else self.text[i])
        return "".join(out).replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        return self.spelled(ids).removeprefix(" ")


class Remembered(dict):
    """Text between blanks to (ids joined by commas, number of ids, text); what a generation did not use again is forgotten.

    A key is a text that a blank precedes, or a line feed and the text behind it.
    """

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces, self.old = pieces, {}
        self.number = {t: str(i) for t, i in pieces.ids.items()}
        self.spelling = {t: pieces.spelled([i]) for t, i in pieces.ids.items()}

    def encoded(self, segments: list[str]) -> tuple[str, int, str]:
        parts = [p for s in segments for p in self.pieces.segment(s)]
        try:
            return ",".join([self.number[p] for p in parts]), len(parts), "".join([self.spelling[p] for p in parts])
        except KeyError:  # bytes
            ids = self.pieces.numbers(parts)
            return ",".join(map(str, ids)), len(ids), self.pieces.spelled(ids)

    def __missing__(self, key: str):
        got = self.old.pop(key, None)
        if got is None:
            got = self.encoded(["\n", *self.pieces.cut(key[1:])] if key[:1] == "\n" else self.pieces.cut(SPACE + key))
        if len(self) >= REMEMBER:
            self.old = dict(self)
            self.clear()
        if len(key) <= 64:
            self[key] = got
        return got

    def text(self, text: str) -> list[tuple[str, int, str]]:
        """Encoded parts of a text."""
        if not text:
            return []
        if self.pieces.simple:
            s = text.replace("\n", " \n")
            if "  " not in s and s[0] != " " and s[-1] != " " and SPACE not in s:
                return [self[k] for k in s.split(" ")]
        return [self.encoded([s]) for s in self.pieces.segments(text)]


def remembered(path: str) -> Remembered:
    return kept(f"pieces {path}", lambda: Remembered(Pieces(path)))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _encoded(docs: DataFrame, model: str | None, with_ids: bool) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = remembered(model or default_model())
        for batch in batches:
            n, ids_sha, text_sha, ids = [], [], [], []
            for text in batch.column(1).to_pylist():
                got = memory.text(text or "")
                n.append(sum([x[1] for x in got]))
                joined = ",".join([x[0] for x in got])
                ids_sha.append(hashlib.sha256(joined.encode()).hexdigest())
                text_sha.append(hashlib.sha256("".join([x[2] for x in got]).removeprefix(" ").encode()).hexdigest())
                if with_ids:
                    ids.append(np.array(joined.split(",") if joined else [], np.int32))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                ends = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    small_batches(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return d.mapInArrow(freed(task), DIGEST + (", ids array<int>" if with_ids else ""))


def digest(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document. model: a file that every executor has; None: the public one."""
    return _encoded(docs, model, False)


def encode_with_digest(docs: DataFrame, model: str | None = None) -> DataFrame:
    """As digest(), and the ids."""
    return _encoded(docs, model, True)


def encode(docs: DataFrame, model: str | None = None, column: str = "ids") -> DataFrame:
    """docs with a column of the ids of text (array of int); null for null texts. A column of that name is replaced."""

    @F.pandas_udf("array<int>")
    def ids_of(texts):
        memory = remembered(model or default_model())
        return texts.map(lambda t: None if t is None else np.array([int(i) for x in memory.text(t) for i in x[0].split(",")], np.int32))

    return docs.withColumn(column, ids_of(F.col("text")))
