"""Encoding of a corpus with a public byte-level BPE vocabulary (problem 6).

The merges are compiled into a finite-state transducer over bytes that is determinised lazily. Two facts about BPE make
this possible. A prefix of a correct tokenisation is the correct tokenisation of its text, so the last token of every
prefix of the input is unique. And a sequence of tokens is correct exactly if each adjacent pair of it is: the two tokens,
merged from their joint bytes, come out as they are. A state therefore keeps, for every start that a later token may still
have, the tokens from the last certain boundary up to that start. Tokens on which all these starts agree are certain and
are emitted; the number of starts is bounded by the length of the longest token, and so is the lookahead.
"""

from __future__ import annotations

import base64
import codecs
import gc
import json
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import spread

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"

# Fixed value: the pattern of the public vocabulary by which text is cut before the merges.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Entries after which a worker's memo tables are emptied; they hold work that can be done again, nothing else.
MEMO_LIMIT = 200_000
ROWS_PER_BATCH = 512


@dataclass(frozen=True)
class Merges:
    """A vocabulary: the bytes of each token, and the two tokens that it is merged from (-1 for single bytes)."""

    tokens: list[bytes]
    ids: list[int]
    left: list[int]
    right: list[int]


def _byte_letters() -> dict[str, int]:
    """The printable letters by which JSON vocabularies of this kind write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def load_merges(path: str = DEFAULT_VOCABULARY) -> Merges:
    """Read a vocabulary: a JSON file with its merges in order, or a rank file (base64 and rank on each line).

    Tokens are numbered here by their rank, single bytes first; ``ids`` has the vocabulary's own numbers."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters, number = _byte_letters(), model["vocab"]
        unwritten = {b: c for c, b in letters.items()}
        tokens = [bytes([b]) for b in range(256)]
        ids = [number[unwritten[b]] for b in range(256)]
        at, left, right = {unwritten[b]: b for b in range(256)}, [-1] * 256, [-1] * 256
        for pair in model["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            if a + b in at:
                continue
            left.append(at[a])
            right.append(at[b])
            at[a + b] = len(tokens)
            tokens.append(tokens[at[a]] + tokens[at[b]])
            ids.append(number[a + b])
        return Merges(tokens, ids, left, right)
    with open(path, "rb") as f:
        ranks = sorted((int(r), base64.b64decode(t)) for t, r in (line.split() for line in f if line.strip()))
    singles = {t[0]: r for r, t in ranks if len(t) == 1}
    tokens = [bytes([b]) for b in range(256)]
    ids = [singles[b] for b in range(256)]
    left, right = [-1] * 256, [-1] * 256
    pairs: dict[tuple[int, int], int] = {}
    for r, t in ranks:
        if len(t) > 1:
            a, b = _merge(list(t), pairs)
            pairs[a, b] = len(tokens)
            left.append(a)
            right.append(b)
            tokens.append(t)
            ids.append(r)
    return Merges(tokens, ids, left, right)


def _merge(parts: list[int], pairs: dict[tuple[int, int], int]) -> list[int]:
    """Merge the lowest pair, leftmost first, until none is left."""
    while len(parts) > 1:
        least, at = min((pairs.get(p, 1 << 60), n) for n, p in enumerate(zip(parts, parts[1:])))
        if least == 1 << 60:
            break
        parts[at : at + 2] = [least]
    return parts


class Transducer:
    """The lazily determinised transducer. ``encode(data)`` gives the ids of one piece of text as bytes."""

    def __init__(self, merges: Merges) -> None:
        self.m = merges
        self.pair = {(a, b): t for t, (a, b) in enumerate(zip(merges.left, merges.right)) if a >= 0}
        self.right_spines: dict[int, list[int]] = {}
        self.left_spines: dict[int, list[int]] = {}
        self.child: dict[int, int] = {}  # (trie node, byte) -> trie node
        self.token_at: dict[int, int] = {}  # trie node -> token that ends there
        nodes = 1
        for t, data in enumerate(merges.tokens):
            if not self._stands(t):
                continue
            node = 0
            for b in data:
                key = node << 8 | b
                node = self.child.get(key, 0)
                if not node:
                    node = self.child[key] = nodes
                    nodes += 1
            self.token_at[node] = t
        self.fits: dict[tuple[int, int], bool] = {}
        self.clear()

    def clear(self) -> None:
        start = (-1, ((0, ()),))
        self.state_of = {start: 0}
        self.states = [start]
        self.move: dict[int, tuple[int, tuple[int, ...]]] = {}

    def _stands(self, t: int) -> bool:
        """Whether the merges can make this token at all: both its parts stand and fit to each other before it is made."""
        return self.m.left[t] < 0 or self._beside(self.m.left[t], self.m.right[t]) == t

    def _beside(self, a: int, b: int) -> int:
        """The token that first joins a and b when both stand side by side, by the ranks of all merges that touch the border; -1: none.

        The tokens that come to stand at the border are a's right spine and b's left spine, in the order of their ranks."""
        xs, ys = self._spine(self.right_spines, self.m.right, a), self._spine(self.left_spines, self.m.left, b)
        x, y, get, never = 0, 0, self.pair.get, len(self.m.tokens)
        while True:
            joint = get((xs[x], ys[y]), never)
            grow_x, grow_y = xs[x + 1], ys[y + 1]
            # Of equal ranks the leftmost is merged first: x's own growth lies left of the border, y's right of it.
            if joint < grow_x and joint <= grow_y and joint < never:
                return joint
            if grow_x == grow_y == never:
                return -1
            if grow_x <= grow_y:
                x += 1
            else:
                y += 1

    def _spine(self, known: dict[int, list[int]], inner: list[int], t: int) -> list[int]:
        """The tokens at one end of a token as it is merged, from the single byte to the token itself, and then a rank beyond all."""
        spine = known.get(t)
        if spine is None:
            spine, part = [len(self.m.tokens)], t
            while part >= 0:
                spine.append(part)
                part = inner[part]
            spine.reverse()
            known[t] = spine
        return spine

    def _fit(self, a: int, b: int) -> bool:
        if a < 0:
            return True
        known = self.fits.get((a, b))
        if known is None:
            known = self.fits[a, b] = self._beside(a, b) < 0
        return known

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Determinise one transition: the next state and the tokens that it makes certain."""
        before, starts = self.states[state]
        going, ending = [], None
        for node, chain in starts:
            onward = self.child.get(node << 8 | byte)
            if onward is None:
                continue
            going.append((onward, chain))
            t = self.token_at.get(onward)
            if ending is None and t is not None and self._fit(chain[-1] if chain else before, t):
                ending = (*chain, t)
        going.append((0, ending))
        # What all sequences begin with is what the least and the greatest of them begin with.
        chains = [c for _, c in going]
        first, last, same = min(chains), max(chains), 0
        for x, y in zip(first, last):
            if x != y:
                break
            same += 1
        if same:
            before = first[same - 1]
            going = [(n, c[same:]) for n, c in going]
        if len(first) > same:  # no sequence is empty, so what stands before isn't looked at until the next token is certain
            before = -1
        following = (before, tuple(going))
        number = self.state_of.get(following)
        if number is None:
            number = self.state_of[following] = len(self.states)
            self.states.append(following)
        done = self.move[state << 8 | byte] = (number, tuple(first[:same]))
        return done

    def encode(self, data: bytes) -> list[int]:
        if len(self.move) > MEMO_LIMIT:
            self.clear()
        if len(self.fits) > 2 * MEMO_LIMIT:
            self.fits.clear()
        state, out, move = 0, [], self.move
        for byte in data:
            known = move.get(state << 8 | byte)
            state, certain = known if known is not None else self._step(state, byte)
            if certain:
                out += certain
        out += self.states[state][1][-1][1]
        ids = self.m.ids
        return [ids[t] for t in out]


class PieceIds(dict):
    """The ids of pieces of text as 32-bit numbers in bytes, made on first use."""

    def __init__(self, merges: Merges) -> None:
        self.transducer = Transducer(merges)

    def __missing__(self, piece: str) -> bytes:
        if len(self) > MEMO_LIMIT:
            self.clear()
        found = array("i", self.transducer.encode(piece.encode())).tobytes()
        if len(piece) <= 64:  # a longer piece hardly comes again
            self[piece] = found
        return found


_worker: dict[str, PieceIds] = {}  # by vocabulary, for as long as a Python worker lives


def encode_texts(df: DataFrame, text_col: str = "text", out_col: str = "ids", vocabulary: str = DEFAULT_VOCABULARY, keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``out_col`` ARRAY<INT>, the token ids of ``text_col`` without special tokens.

    Null and empty texts get an empty list. Strings of special tokens in a text are ordinary text. Texts of any length are
    encoded whole. Rows aren't joined, nor moved unless the table has fewer partitions than there are cores: repeated rows give repeated results, an empty table an empty one.
    Other columns of ``df`` aren't read. The vocabulary, of fixed size, is read on the driver and sent once to each executor."""
    keep = list(keep)
    if out_col in keep:
        raise ValueError(f"{out_col} is the name of a column that is kept")
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast(load_merges(vocabulary))
    chosen = spread(df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("__text")))
    schema = T.StructType([*(chosen.schema[c] for c in keep), T.StructField(out_col, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _worker.get(vocabulary)
        if pieces is None:
            pieces = _worker[vocabulary] = PieceIds(sent.value)
        find, ids_of = regex.compile(SPLIT_PATTERN).findall, pieces.__getitem__
        gc.disable()  # the memo tables hold many objects and no cycles, which the collector would look through again and again
        try:
            yield from encoded(batches, find, ids_of)
        finally:
            gc.enable()

    def encoded(batches: Iterator[pa.RecordBatch], find: Callable, ids_of: Callable) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_PER_BATCH):
                batch = whole.slice(at, ROWS_PER_BATCH)
                coded = [b"".join(map(ids_of, find(text))) if text else b"" for text in batch.column(len(keep)).to_pylist()]
                ends = np.zeros(len(coded) + 1, "i4")
                np.cumsum([len(c) // 4 for c in coded], out=ends[1:])
                values = pa.array(np.frombuffer(b"".join(coded), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(ends), values)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], lists], names=[*keep, out_col])

    return chosen.mapInArrow(run, schema)


class StreamDecoder:
    """Turn ids back into text piece by piece; bytes of a character that isn't complete yet wait in the UTF-8 decoder's state."""

    def __init__(self, bytes_of: dict[int, bytes]) -> None:
        self.bytes_of = bytes_of
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.utf8.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def close(self) -> str:
        return self.utf8.decode(b"", True)


def decode_ids(df: DataFrame, ids_col: str = "ids", out_col: str = "text", vocabulary: str = DEFAULT_VOCABULARY, keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and the text of ``ids_col``. Null and empty lists give an empty text; ids outside the vocabulary raise an error."""
    keep = list(keep)
    if out_col in keep:
        raise ValueError(f"{out_col} is the name of a column that is kept")
    m = load_merges(vocabulary)
    sent = df.sparkSession.sparkContext.broadcast(dict(zip(m.ids, m.tokens)))
    chosen = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids_col}`").alias("__ids"))
    schema = T.StructType([*(chosen.schema[c] for c in keep), T.StructField(out_col, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_PER_BATCH):
                batch, texts = whole.slice(at, ROWS_PER_BATCH), []
                for ids in batch.column(len(keep)).to_pylist():
                    decoder = StreamDecoder(sent.value)
                    texts.append(decoder.feed(ids or ()) + decoder.close())
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, out_col])

    return chosen.mapInArrow(run, schema)
