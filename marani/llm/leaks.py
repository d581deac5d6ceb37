"""Evaluation texts leaking into training text (problem 7).

A document holds an item if it holds at least ``LEAST`` words of the item's passage one after the other, of which at most one
in ``PER_EDIT`` is replaced, left out or added. The search is a containment search by MinHash. Its queries are all windows
of ``LEAST`` words of the passages, its domains windows of the documents twice as long, each overlapping the next by half, so
that every passage of the least length lies whole in one of them. The domains are partitioned by size; from the least
containment and the largest size of a partition follows the least Jaccard similarity, and from it the number of hash
functions by which a true case is missed with a chance of at most ``MISS``. Hits are verified by exact shingle containment
and then by aligning the words.

Shingles have three words here, not five: with one word in seven altered, a passage of 16 words is sure to keep 8 of its 14
shingles of three, but may keep only 2 of its 12 shingles of five.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..operators.membership import filter_of
from ..runtime import settle, spread
from .words import WORDS, WordHashes, hashed, plain

LEAST, PER_EDIT, SHINGLE, MISS = 16, 7, 3, 0.005
BLOCK = LEAST - SHINGLE + 2  # shingles; two blocks hold a passage of the least length with two words added, wherever it starts
KEPT = LEAST - SHINGLE + 1 - SHINGLE * (LEAST // PER_EDIT)  # shingles that the edits must leave
VERIFIED = KEPT - 2  # less, as a longer passage may have its edits close together
#: Words of items that are sent to the executors; with more, signatures are joined.
ITEM_WORDS_AT_ONCE = 200_000
#: Rows of one signature that one task takes; there are at most MOST_HOT with more.
ROWS_OF_A_SIGNATURE, MOST_HOT = 100_000, 1_000_000
INSTRUCTION_WORDS, INSTRUCTION_ITEMS = (4, 40), 3
AHEAD, RELATED_FUNCTIONS = 4, 12
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFTS = [np.uint64(k * int(_ODD) & int(_NONE)) for k in range(1000)]  # keep the values of different functions apart
ROWS_PER_BATCH = 2000


def functions_for(size: int) -> int:
    """The number of hash functions for domains of up to ``size`` shingles."""
    query = LEAST - SHINGLE + 1
    least = KEPT / (query + size - KEPT) if size + query > 2 * KEPT else 1.0
    return math.ceil(math.log(MISS) / math.log(1 - least)) if least < 1 else 1


#: The partitions: the largest size of each in shingles, and its number of hash functions.
PARTITIONS = [(size, functions_for(size)) for size in (KEPT + 2, BLOCK, 2 * BLOCK - 8, 2 * BLOCK)]
FUNCTIONS = PARTITIONS[-1][1]


def shingles(words: np.ndarray) -> np.ndarray:
    """A hash of each run of three words; the last two places, which have no run, are set to the largest value."""
    out = np.full(len(words), _NONE)
    if len(words) >= SHINGLE:
        a, b, c = words[:-2], words[1:-1], words[2:]
        x = (a * np.uint64(0xBF58476D1CE4E5B9)) ^ ((b << np.uint64(21)) | (b >> np.uint64(43))) * np.uint64(0x94D049BB133111EB) ^ (c >> np.uint64(7)) + c
        out[:-2] = (x ^ (x >> np.uint64(31))) * _ODD
    return out


def _function(base: np.ndarray, k: int) -> np.ndarray:
    x = (base ^ np.uint64(0xD6E8FEB86659FD93 * (2 * k + 1) & 0xFFFFFFFFFFFFFFFF)) * np.uint64((0xA0761D6478BD642F + 0x2545F4914F6CDD1D * 2 * k) & 0xFFFFFFFFFFFFFFFF | 1)
    return x ^ (x >> np.uint64(29))


def signatures(base: np.ndarray) -> Iterator[np.ndarray]:
    """The values by which a passage of so many shingles is looked up: the least ones of its windows, by each function."""
    for k in range(FUNCTIONS):
        yield np.unique(np.lib.stride_tricks.sliding_window_view(_function(base, k), LEAST - SHINGLE + 1).min(axis=1)) + _SHIFTS[k]


def _places(words: list[int]) -> dict[int, list[int]]:
    places = defaultdict(list)
    for n, w in enumerate(words):
        places[w].append(n)
    return dict(places)


class Items:
    """The queries of one block of items: a sorted table from hash values to items, and each item's words and shingles."""

    def __init__(self, rows: list[tuple[object, list[int]]]) -> None:
        self.ids, self.words, self.places, self.shingles, keys, owners = [], [], [], [], [], []
        for item_id, passage in rows:
            words = np.array(passage, np.int64).astype(np.uint64)
            if len(words) < LEAST:
                continue
            base = shingles(words)[: len(words) - SHINGLE + 1]
            for least in signatures(base):
                keys.append(least)
                owners.append(np.full(len(least), len(self.ids), np.int32))
            self.ids.append(item_id)
            self.words.append(len(words))
            self.places.append(_places(words.tolist()))
            self.shingles.append(np.unique(base))
        flat, owner = (np.concatenate(keys), np.concatenate(owners)) if keys else (np.empty(0, np.uint64), np.empty(0, np.int32))
        order = np.argsort(flat, kind="stable")
        self.keys, self.owner = flat[order], owner[order]
        self.bits = min(24, max(16, int(len(flat) * 32).bit_length()))
        self.filter = np.zeros(1 << self.bits, bool)
        self.filter[(self.keys >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def hits(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``values`` and the items that have the value there."""
        maybe = np.flatnonzero(self.filter[(values >> np.uint64(64 - self.bits)).astype(np.int64)])
        low = np.searchsorted(self.keys, values[maybe], "left")
        count = np.searchsorted(self.keys, values[maybe], "right") - low
        at = np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum()) if len(maybe) else np.empty(0, np.int64)
        return np.repeat(maybe, count), self.owner[at]


def holds(places: dict[int, list[int]], length: int, words: list[int]) -> bool:
    """Whether a run of the passage stands in ``words``: the earliest start of a chain of equal words, by its edits so far."""
    most = length // PER_EDIT
    far = most + 1
    ends: dict[int, list[tuple[int, list[int]]]] = {}
    for j, word in enumerate(words):
        own = places.get(word)
        if own is None:
            continue
        here = []
        for i in own:
            start = [i] * (most + 1)
            for gap in range(1, far + 1):
                for p, before in ends.get(j - gap, ()):
                    step = i - p
                    if 0 < step <= far:
                        cost = max(gap, step) - 1
                        for e in range(cost, most + 1):
                            if before[e - cost] < start[e]:
                                start[e] = before[e - cost]
            for e in range(most + 1):
                if i - start[e] + 1 >= max(LEAST, PER_EDIT * e):
                    return True
            here.append((i, start))
        ends[j] = here
    return False


class Windows:
    """The windows of some texts and the values by which passages are looked up in them."""

    def __init__(self, texts: list[str | None], memo: WordHashes) -> None:
        find = WORDS.findall
        each = [(n, w) for n, t in enumerate(texts) if t and len(w := find(plain(t))) >= LEAST - LEAST // PER_EDIT]
        self.texts = np.array([n for n, _ in each], np.int64)
        self.words = hashed([x for _, w in each for x in w], memo)
        length = np.array([len(w) for _, w in each], np.int64)
        self.begin = begin = np.r_[0, np.cumsum(length)]
        self.base = base = shingles(self.words)
        base[np.concatenate([begin[1:] - 2, begin[1:] - 1])] = _NONE  # no run goes on into the next document
        blocks = (length - SHINGLE) // BLOCK + 1
        first = np.r_[0, np.cumsum(blocks)]
        doc = np.repeat(np.arange(len(each)), blocks)
        self.block = begin[:-1][doc] + BLOCK * (np.arange(first[-1]) - first[:-1][doc])
        last = np.zeros(len(self.block), bool)
        last[first[1:] - 1] = True
        self.window = window = np.flatnonzero(~last | (blocks == 1)[doc])
        self.doc, self.at = doc[window], self.block[window]
        self.until = np.minimum(self.at + 2 * BLOCK, begin[1:][self.doc] - SHINGLE + 1)
        self.functions = np.array([f for _, f in PARTITIONS])[np.searchsorted([s for s, _ in PARTITIONS], self.until - self.at)]
        self.single = last[window]

    def values(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """By each function the windows that it is asked for, and their values."""
        if not len(self.texts):
            return
        following, empty = np.minimum(self.window + 1, len(self.block) - 1), self.base == _NONE
        for k in range(FUNCTIONS):
            value = _function(self.base, k)
            value[empty] = _NONE
            least = np.minimum.reduceat(value, self.block)
            least = np.where(self.single, least[self.window], np.minimum(least[self.window], least[following]))
            probed = np.flatnonzero(self.functions > k)
            yield probed, least[probed] + _SHIFTS[k]


def search(items: Items, texts: list[str | None], memo: WordHashes) -> list[tuple[int, int]]:
    """Pairs of a text's place and an item that it holds."""
    if not items.ids:
        return []
    w = Windows(texts, memo)
    found: set[tuple[int, int]] = set()
    for probed, values in w.values():
        place, item = items.hits(values)
        found.update(zip(probed[place].tolist(), item.tolist()))
    pairs: set[tuple[int, int]] = set()
    for n, item in sorted(found):
        d = int(w.doc[n])
        pair = (int(w.texts[d]), item)
        if pair in pairs:
            continue
        here = w.base[w.at[n] : w.until[n]]
        own = items.shingles[item]
        if (own[np.minimum(np.searchsorted(own, here), len(own) - 1)] == here).sum() < VERIFIED:
            continue
        low = max(int(w.begin[d]), int(w.at[n]) - items.words[item])
        high = min(int(w.begin[d + 1]), int(w.until[n]) + SHINGLE + items.words[item])
        if holds(items.places[item], items.words[item], w.words[low:high].tolist()):
            pairs.add(pair)
    return sorted(pairs)


def held_by(words: np.ndarray, passage: np.ndarray) -> bool:
    """Whether a text of these words holds the passage, looked for around the shingles that both have."""
    own = np.unique(shingles(passage)[: len(passage) - SHINGLE + 1])
    there = shingles(words)
    common = np.flatnonzero(own[np.minimum(np.searchsorted(own, there), len(own) - 1)] == there)
    if len(common) < VERIFIED:
        return False
    places, length = _places(passage.tolist()), len(passage)
    gaps = np.flatnonzero(np.diff(common) > 2 * length + SHINGLE)
    for a, b in zip(np.r_[0, gaps + 1], np.r_[gaps, len(common) - 1]):
        if holds(places, length, words[max(0, common[a] - length) : common[b] + SHINGLE + length].tolist()):
            return True
    return False


def passages(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item`` and ``words``, the word hashes of each item without the instruction.

    An instruction is a beginning that unrelated items continue in different ways: no next word holds more than three quarters
    of the items, and the continuations that differ in their next ``AHEAD`` words, and of which none has the least shingle of
    another, are at least the root of the items' number and more the longer the beginning is. So questions about one passage
    and near copies of it don't make an instruction of the passage. The shortest such beginning is taken, as words that many
    passages begin with continue in different ways too, and a longer one only if it has two words more and a quarter of the
    items. In doubt nothing is cut."""

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for b in batches:
            rows = [hashed(WORDS.findall(plain(t or "")), memo).astype(np.int64).tolist() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.int64()))], names=["item", "words"])

    chosen = items.select(F.col(f"`{id_col}`").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([chosen.schema["item"], T.StructField("words", T.ArrayType(T.LongType(), False))])
    split = settle(chosen.mapInArrow(words_of, schema).withColumn("row", F.monotonically_increasing_id()), "items")
    low, high = INSTRUCTION_WORDS
    size = F.size("words")
    starts = F.posexplode(F.transform(F.sequence(F.lit(low), F.least(F.lit(high), size - 1)), lambda k: F.xxhash64(F.slice("words", 1, k)))).alias("k", "start")
    each = split.where(size > low).select("words").distinct().select("words", starts).withColumn("k", F.col("k") + low)
    shared = each.groupBy("start").agg(F.count("*").alias("n")).where(F.col("n") >= INSTRUCTION_ITEMS)
    rest = F.slice("words", F.col("k") + 1, size)
    runs = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(rest) - (SHINGLE - 1)))
    ways = [F.element_at("words", F.col("k") + 1), F.xxhash64(F.slice("words", F.col("k") + 1, AHEAD))]
    ways += [F.array_min(F.transform(runs, lambda i, f=f: F.xxhash64(F.lit(f), F.slice(rest, i, SHINGLE)))) for f in range(RELATED_FUNCTIONS)]
    going_on = each.join(shared, "start").select("start", "k", "n", F.posexplode(F.array(*ways)).alias("kind", "value")).groupBy("start", "k", "n", "kind", "value").count()
    boundaries = (
        going_on.groupBy("start", "k", "n", "kind")
        .agg(F.count("*").alias("different"), F.max("count").alias("most"))
        .groupBy("start", "k", "n")
        .agg(F.max(F.when(F.col("kind") == 0, F.col("most"))).alias("most"), F.min(F.when(F.col("kind") > 0, F.col("different"))).alias("different"))
        .where("4 * most <= 3 * n AND different * different >= n")
        .where(F.col("different") >= F.greatest(F.lit(INSTRUCTION_ITEMS), F.col("k") - low))
        .select("start", "n")
    )
    at = F.struct(F.col("k") + low, F.col("n"))
    deeper = lambda cut, b: F.when((cut["k"] == 0) | ((b["k"] >= cut["k"] + 2) & (4 * b["n"] >= cut["n"])), b).otherwise(cut)
    none = F.struct(F.lit(0).alias("k"), F.lit(0).cast("long").alias("n"))
    cut = (
        split.where(size > low)
        .select("row", starts)
        .join(boundaries, "start")
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(at.cast("struct<k:int,n:bigint>"))).alias("boundaries"))
        .select("row", F.aggregate("boundaries", none, deeper)["k"].alias("cut"))
    )
    return split.join(cut, "row", "left").select("item", F.when(F.col("cut").isNull(), F.col("words")).otherwise(F.slice("words", F.col("cut") + 1, size)).alias("words"))


def _of_many_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc``, ``item`` for items of any number: nothing of theirs is sent but a filter of their signatures, of a bounded size.

    One pass over the documents puts out the signatures that may be those of an item; they are joined with the items'. Documents and
    passages that share one are fetched by it, and compared word by word. Hot signatures are salted by document."""
    spark = docs.sparkSession
    keyed = items.where(F.size("words") >= LEAST).select("item", "words", F.xxhash64("words").alias("c1"), F.xxhash64("words", F.lit(7)).alias("c2"))
    keyed = settle(keyed, "keyed")
    passage = ["c1", "c2"]
    texts = settle(keyed.groupBy(*passage).agg(F.first("words").alias("words")), "texts")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, words in enumerate(b.column(2).to_pylist()):
                base = shingles(np.array(words, np.int64).astype(np.uint64))[: len(words) - SHINGLE + 1]
                found = np.concatenate([*signatures(base)]).view(np.int64)
                at = pa.array(np.full(len(found), n))
                yield pa.RecordBatch.from_arrays([pa.array(found), b.column(0).take(at), b.column(1).take(at)], names=["sign", "c1", "c2"])

    of_items = settle(texts.select("c1", "c2", "words").mapInArrow(sign, "sign long, c1 long, c2 long"), "signatures")
    sent = spark.sparkContext.broadcast(filter_of(of_items.select("sign"), of_items.count()))
    doc_field = docs.schema["doc"]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_PER_BATCH):
                b = whole.slice(at, ROWS_PER_BATCH)
                w = Windows(b.column(1).to_pylist(), memo)
                pairs = []
                for probed, values in w.values():
                    maybe = sent.value.may_hold(values)
                    pairs.append(np.stack([w.texts[w.doc[probed[maybe]]], values[maybe].view(np.int64)]))
                if pairs and (both := np.unique(np.concatenate(pairs, axis=1), axis=1)).shape[1]:
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(both[0])), pa.array(both[1])], names=["doc", "sign"])

    matches = settle(docs.mapInArrow(match, T.StructType([doc_field, T.StructField("sign", T.LongType())])), "matches")
    hot = matches.groupBy("sign").count().where(F.col("count") > max(ROWS_OF_A_SIGNATURE, matches.count() // MOST_HOT))
    hot = F.broadcast(settle(hot.select("sign", F.ceil(F.col("count") / ROWS_OF_A_SIGNATURE).cast("int").alias("salts")), "hot"))  # at most MOST_HOT
    salts = F.coalesce("salts", F.lit(1))
    left = matches.join(hot, "sign", "left").select("doc", "sign", F.pmod(F.xxhash64("doc"), salts).cast("int").alias("salt"))
    right = of_items.join(hot, "sign", "left").select("sign", *passage, F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    candidates = settle(left.join(right, ["sign", "salt"]).select("doc", *passage).distinct(), "candidates")
    # A document's candidates in up to 64 lists, so that its text comes once for many of them and no list grows without bound.
    lists = candidates.join(texts, passage).groupBy("doc", F.pmod(F.xxhash64("c1"), F.lit(64)).alias("list")).agg(F.collect_list(F.struct(*passage, "words")).alias("passages"))
    wanted = candidates.select(F.xxhash64("doc"))
    held = spark.sparkContext.broadcast(filter_of(wanted, candidates.count()))

    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(held.value.may_hold(np.asarray(b.column(2)).view(np.uint64))))

    likely = docs.select("doc", "text", F.xxhash64("doc").alias("h")).where("text is not null")
    likely = likely.mapInArrow(only, T.StructType([doc_field, docs.schema["text"], T.StructField("h", T.LongType())])).select(F.col("doc").alias("of"), "text")
    fetched = likely.join(lists, F.col("of").eqNullSafe(F.col("doc"))).select("doc", "text", "passages")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for b in batches:
            for n, (text, passages_) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                words = hashed(WORDS.findall(plain(text)), memo)
                good = [p for p in passages_ if held_by(words, np.array(p["words"], np.int64).astype(np.uint64))]
                if good:
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([n] * len(good))), *(pa.array([p[c] for p in good], pa.int64()) for c in passage)], names=["doc", *passage])

    found = fetched.mapInArrow(verify, T.StructType([doc_field, *(T.StructField(c, T.LongType()) for c in passage)])).distinct()
    return found.join(keyed.select("item", *passage), passage).select("doc", "item")


def leaked(documents: DataFrame, items: DataFrame, doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_col``, ``item_col``: each document with each item that it holds, once.

    Whole documents of any length are searched in one pass over the table. Items of up to ``ITEM_WORDS_AT_ONCE`` words in all are
    sent to the executors, and nothing is shuffled but the result; more are joined by their signatures. Null and empty texts and
    passages of fewer than 16 words hold and are held by nothing. Repeated documents count each; repeated rows of one id count
    once. Other columns aren't read."""
    spark = documents.sparkSession
    prepared = passages(items, item_col, item_text_col)
    rows = settle(prepared, "passages")
    chosen = spread(documents.select(F.col(f"`{doc_col}`").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text")))
    if (rows.agg(F.sum(F.size("words"))).first()[0] or 0) > ITEM_WORDS_AT_ONCE:
        out = _of_many_items(chosen, rows)
    else:
        schema = T.StructType([chosen.schema["doc"], T.StructField("item", prepared.schema["item"].dataType)])
        item_type = to_arrow_type(prepared.schema["item"].dataType)
        sent = spark.sparkContext.broadcast([(r["item"], r["words"]) for r in rows.collect()])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            queries, memo = Items(sent.value), WordHashes()
            for whole in batches:
                for at in range(0, whole.num_rows, ROWS_PER_BATCH):
                    batch = whole.slice(at, ROWS_PER_BATCH)
                    pairs = search(queries, batch.column(1).to_pylist(), memo)
                    if pairs:
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([d for d, _ in pairs])), pa.array([queries.ids[i] for _, i in pairs], item_type)], names=["doc", "item"])

        out = chosen.mapInArrow(run, schema)
    return out.distinct().select(F.col("doc").alias(doc_col), F.col("item").alias(item_col))
