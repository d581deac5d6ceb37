"""Subject areas of documents (problem 8).

A sentence belongs to the subject whose linear classifier scores it highest, if that score passes the subject's threshold; a
document belongs to each subject that holds at least a quarter of its sentences with a subject. The classifiers are
one-versus-rest logistic regressions on hashed word n-grams. Their labels are weak: a hand-labelled document gives its
subjects to all its sentences, and a sentence with a typical word of one subject gets that subject. Four further rounds learn
from the classifiers' own sentence labels, also on documents without hand labels, and so reach words that no label names.
The thresholds are those with the best F1 on hand-labelled documents that no round has learnt from.

Georgian words are written in Latin letters and cut of their endings, so that both spellings and all cases share a feature.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import settle, spread
from .words import one_form, plain

# The national romanisation without apostrophes (the letter qar, in the one form of look-alikes, is y).
LETTERS = dict(zip("აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ", "a b g d e v z t i k l m n o p zh r s t u p k gh q sh ch ts dz ts ch kh j h".split())) | {"y": "q"}
# Endings of nouns in that spelling.
ENDINGS = sorted("ebisa ebidan ebistvis ebtan ebis ebma ebit ebad ebze ebshi ebs ebi eb idan dan istvis tan shi ze ma is it ad s i a e o d t m".split(), key=len, reverse=True)

SHARE = 0.25
#: The bounds of the samples that the classifiers are fitted on, in documents, taken by a hash of their id.
LABELLED_DOCS, UNLABELLED_DOCS = 12_000, 6_000
#: The bound of both together in words (64 MB on the driver). Documents are taken whole, labelled ones first; one that doesn't fit any more isn't.
SAMPLE_WORDS = 8_000_000
NGRAMS, LEAST_DOCS, HELD_OUT = 1, 2, 5  # longest n-gram; documents that a feature needs; one labelled document in so many is held out
SHRINKAGE = 20  # examples with which a subject's own threshold counts as much as the common one
ROWS_PER_BATCH = 4000
_END = np.int64(-1)
_latin = str.maketrans(LETTERS)
_pieces = re.compile(r"[^\W_]+|[.!?…;]|\n[ \t\r]*\n").findall


def stem(word: str) -> str:
    """A word in Latin letters without its endings, which are taken off until none is left or three letters would not remain."""
    word = word.translate(_latin)
    while True:
        for e in ENDINGS:
            if word.endswith(e) and len(word) - len(e) >= 3:
                word = word[: -len(e)]
                break
        else:
            return word


class Features(dict):
    """The hash of a word's stem, or -1 for the end of a sentence; a memo of bounded size."""

    def __missing__(self, piece: str) -> int:
        if len(self) > 500_000:
            self.clear()
        form = piece if piece[0] in ".!?…;\n" else stem(one_form(piece))
        found = self[piece] = -1 if piece[0] in ".!?…;\n" else xxhash.xxh3_64_intdigest(form.encode("utf-8", "surrogatepass")) >> 2
        return found


def pieces_of(text: str, memo: Features) -> np.ndarray:
    """The features of a text's words in their order, with -1 at each end of a sentence."""
    found = _pieces(plain(text))
    return np.fromiter(map(memo.__getitem__, found), np.int64, len(found))


def rows_of(pieces: np.ndarray, ngrams: int = NGRAMS) -> tuple[np.ndarray, np.ndarray, int]:
    """Features, the sentence of each, and the number of sentences."""
    word = pieces != _END
    sentence = np.cumsum(~word)
    feature, owner = [pieces[word]], [sentence[word]]
    run = pieces
    for n in range(2, ngrams + 1):
        run = np.where((run[:-1] == _END) | (pieces[n - 1 :] == _END), _END, (run[:-1] * 31 + pieces[n - 1 :] * 17 + n) & ((1 << 62) - 1))
        whole = run != _END
        feature.append(run[whole])
        owner.append(sentence[: len(run)][whole])
    return np.concatenate(feature), np.concatenate(owner), int(sentence[-1]) + 1 if len(pieces) else 0


@dataclass
class Model:
    subjects: list[str]
    features: np.ndarray  # sorted hashes
    weights: np.ndarray  # a row for each feature, a column for each subject
    bias: np.ndarray
    threshold: np.ndarray

    def scores(self, feature: np.ndarray, sentence: np.ndarray, count: int) -> np.ndarray:
        """A row for each sentence; without the bias, a sentence with no known feature has only zeros."""
        out = np.zeros((count, len(self.subjects)), np.float32)
        if len(self.features) and len(feature):
            at = np.minimum(np.searchsorted(self.features, feature), len(self.features) - 1)
            known = np.flatnonzero(self.features[at] == feature)
            for s in range(len(self.subjects)):
                out[:, s] = np.bincount(sentence[known], self.weights[at[known], s], count)
        return out

    def best(self, score: np.ndarray) -> np.ndarray:
        """The subject of each sentence, or -1."""
        score = score + self.bias
        top = score.argmax(axis=1)
        return np.where(score[np.arange(len(score)), top] > self.threshold[top], top, -1)


def shares(subject: np.ndarray, doc: np.ndarray, docs: int, subjects: int) -> np.ndarray:
    """Whether each document belongs to each subject, by its sentences' subjects."""
    own = subject >= 0
    count = np.bincount(doc[own] * subjects + subject[own], minlength=docs * subjects).reshape(docs, subjects)
    return (count > 0) & (count >= SHARE * count.sum(axis=1, keepdims=True))


def _fit(feature: np.ndarray, sentence: np.ndarray, target: np.ndarray, size: int, epochs: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """One-versus-rest logistic regressions by AdaGrad over blocks of sentences."""
    classes, rng = target.shape[1], np.random.default_rng(seed)
    w, past, bias = np.zeros((size, classes), np.float32), np.full((size, classes), 1e-3, np.float32), np.full(classes, -2.0, np.float32)
    order = np.argsort(sentence, kind="stable")
    feature, sentence = feature[order], sentence[order]
    begin = np.searchsorted(sentence, np.arange(len(target) + 1))
    length = np.diff(begin)
    filled = np.flatnonzero(length)
    for _ in range(epochs):
        mixed = rng.permutation(filled)
        for k in range(0, len(mixed), 512):
            rows = mixed[k : k + 512]
            size_of = length[rows]
            first = np.r_[0, np.cumsum(size_of)[:-1]]
            at = feature[np.repeat(begin[rows] - first, size_of) + np.arange(size_of.sum())]
            error = 1 / (1 + np.exp(-np.clip(np.add.reduceat(w[at], first, axis=0) + bias, -30, 30))) - target[rows]
            sorting = np.argsort(at, kind="stable")
            used, start = np.unique(at[sorting], return_index=True)
            gradient = np.add.reduceat(np.repeat(error, size_of, axis=0)[sorting], start, axis=0)
            past[used] += gradient * gradient
            w[used] -= 0.5 * gradient / np.sqrt(past[used])
            bias -= 0.05 * error.mean(axis=0)
    return w, bias


def fit(docs: list[tuple[np.ndarray, list[str] | None, bool]], subjects: list[str], terms: dict[int, int], ngrams: int = NGRAMS) -> Model:
    """``docs`` has each document's pieces, its hand labels if it has any, and whether it is held out for the thresholds.

    ``terms`` gives the subject of each feature that is a typical word of just one."""
    n = len(subjects)
    place = {s: k for k, s in enumerate(subjects)}
    feature, sentence, doc, count = [], [], [], 0
    for d, (pieces, _, _) in enumerate(docs):
        f, s, k = rows_of(pieces, ngrams)
        feature.append(f)
        sentence.append(s + count)
        doc.append(np.full(k, d))
        count += k
    feature = np.concatenate([np.empty(0, np.int64), *feature])
    sentence = np.concatenate([np.empty(0, np.int64), *sentence]).astype(np.int64)
    doc = np.concatenate([np.empty(0, np.int64), *doc]).astype(np.int64)
    hand = np.array([labels is not None and not held for _, labels, held in docs], bool)
    held = np.array([labels is not None and held for _, labels, held in docs], bool)
    given = np.zeros((len(docs), n), bool)
    for d, (_, labels, _) in enumerate(docs):
        for x in labels or ():
            if x in place:
                given[d, place[x]] = True
    # Features that too few documents have are left out: most are names, which say nothing about other documents.
    pairs = np.unique(np.stack([feature, doc[sentence]], axis=1), axis=0) if len(feature) else np.empty((0, 2), np.int64)
    names, docs_of = np.unique(pairs[:, 0], return_counts=True)
    names = names[docs_of >= LEAST_DOCS]
    at = np.minimum(np.searchsorted(names, feature), max(0, len(names) - 1))
    kept = names[at] == feature if len(names) else np.zeros(len(feature), bool)
    at, sentence = at[kept], sentence[kept]
    typical = np.zeros((count, n), bool)
    for f, s in terms.items():
        k = np.searchsorted(names, f)
        if k < len(names) and names[k] == f:
            typical[sentence[at == k], s] = True
    one = typical.sum(axis=1) == 1
    from_hand = hand[doc]
    target = np.where(from_hand[:, None], given[doc] if count else typical, typical).astype(np.float32)
    use = from_hand | (one & ~held[doc] if count else one)
    model = Model(subjects, names, np.zeros((len(names), n), np.float32), np.full(n, -2.0, np.float32), np.zeros(n, np.float32))
    for epochs in (5, 3, 3, 3, 3):
        chosen = use[sentence]
        model.weights, model.bias = _fit(at[chosen], sentence[chosen], target, len(names), epochs, seed=len(subjects))
        score = np.zeros((count, n), np.float32)
        for s in range(n):
            score[:, s] = np.bincount(sentence, model.weights[at, s], count)
        best = model.best(score)
        belongs = shares(best, doc, len(docs), n)
        # From now on a sentence has the subject that the classifiers give it, if its document's labels, its own or given, have it.
        target = np.zeros((count, n), np.float32)
        own = np.flatnonzero(best >= 0)
        right = (belongs | given)[doc[own], best[own]]
        target[own[right], best[own[right]]] = 1
        # A sentence in doubt counts half in a document whose only label the classifiers agree on, or of which they find only one subject, twice or more.
        twice = np.bincount(doc[own], minlength=len(docs)) >= 2
        sure = (belongs.sum(axis=1) == 1) & np.where(hand, (given == belongs).all(axis=1), twice & ~held)
        doubt = np.flatnonzero((best < 0) & sure[doc]) if count else np.empty(0, np.int64)
        only = belongs[doc[doubt]].argmax(axis=1)
        near = score[doubt, only] + model.bias[only] > -2
        target[doubt[near], only[near]] = 0.5
        use = ~held[doc] if count else use
    _calibrate(model, score, doc, given, held, len(docs))
    strong = np.abs(model.weights).max(axis=1, initial=0) > 0.1
    model.features, model.weights = names[strong], np.ascontiguousarray(model.weights[strong])
    return model


def _calibrate(model: Model, score: np.ndarray, doc: np.ndarray, given: np.ndarray, held: np.ndarray, docs: int) -> None:
    """Thresholds by F1 on the documents that were held out: one for all subjects, then one for each.

    A subject's own threshold is drawn towards the common one, the more the fewer examples it has."""

    def f1() -> float:
        found = shares(model.best(score), doc, docs, len(model.subjects))[held]
        hit = (found & given[held]).sum()
        return 2 * hit / max(1, found.sum() + given[held].sum())

    grid = np.array([-1.0, -0.5, 0.0, 0.5, 1.0, 1.5], np.float32)
    if not held.any():
        model.threshold[:] = 0.5
        return
    tried = []
    for x in grid:
        model.threshold[:] = x
        tried.append(f1())
    base = grid[int(np.argmax(tried))]
    model.threshold[:] = base
    for s in range(len(model.subjects)):
        best = (-1.0, 0.0, base)
        for x in grid:
            model.threshold[s] = x
            best = max(best, (f1(), -abs(x - base), x))
        examples = given[held][:, s].sum()
        model.threshold[s] = base + (best[2] - base) * examples / (examples + SHRINKAGE)


def train(documents: DataFrame, subjects: DataFrame, labels: DataFrame, labelled_docs: int = LABELLED_DOCS, unlabelled_docs: int = UNLABELLED_DOCS, ngrams: int = NGRAMS) -> Model:
    """Fit the classifiers on samples of bounded size, as said above; everything that is collected is bounded by them."""
    spark = documents.sparkSession
    rows = subjects.where("subject is not null").collect()  # a list of subjects, of fixed size
    names = sorted({r["subject"] for r in rows})
    memo = Features()
    owners = defaultdict(set)
    for r in rows:
        for t in [*(r["terms_ka"] or ()), *(r["terms_en"] or ())]:
            if t and len(words := pieces_of(t, memo)) == 1:
                owners[int(words[0])].add(names.index(r["subject"]))
    terms = {f: next(iter(s)) for f, s in owners.items() if len(s) == 1}
    said = labels.select("doc_id", F.lower(F.trim("subject")).alias("subject")).where("doc_id is not null and subject is not null")
    chosen = said.groupBy("doc_id").agg(F.collect_set("subject").alias("labels")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_docs)
    of_doc = {r["doc_id"]: r["labels"] for r in chosen.collect()}
    keys = spark.createDataFrame([(k,) for k in of_doc], "doc_id bigint").withColumn("hand", F.lit(True))
    share = min(1.0, unlabelled_docs / max(1, documents.count()))
    texts = spread(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null"))
    near = texts.join(F.broadcast(keys), "doc_id", "left").where(F.col("hand") | (F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 20)) < int(share * (1 << 20))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Features()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([pieces_of(t, memo).tobytes() for t in b.column(1).to_pylist()], pa.binary())], names=["doc_id", "pieces"])

    made = near.select("doc_id", "text").mapInArrow(run, "doc_id bigint, pieces binary").withColumn("row", F.monotonically_increasing_id())
    made = settle(made.withColumn("size", F.length("pieces") / 8), "sample")
    # Sizes of at most the sampled documents; the documents themselves only as far as they fit.
    sizes = sorted(made.select("row", "doc_id", "size").collect(), key=lambda r: (r["doc_id"] not in of_doc, xxhash.xxh3_64_intdigest(str(r["doc_id"])), r["row"]))
    left, fit_in = SAMPLE_WORDS, []
    for r in sizes:
        if r["size"] <= left:
            left -= r["size"]
            fit_in.append(r["row"])
    if len(fit_in) < len(sizes):
        made = made.join(F.broadcast(spark.createDataFrame([(n,) for n in fit_in], "row bigint")), "row")
    sample = made.select("doc_id", "pieces").toArrow()
    docs = sorted(zip(sample.column(0).to_pylist(), sample.column(1).to_pylist()), key=lambda x: (x[0] is None, x[0], x[1]))
    return fit([(np.frombuffer(p, np.int64), of_doc.get(d), xxhash.xxh3_64_intdigest(str(d)) % HELD_OUT == 0) for d, p in docs], names, terms, ngrams)


def assign(documents: DataFrame, model: Model, doc_col: str = "doc_id", text_col: str = "text", ngrams: int = NGRAMS) -> DataFrame:
    """``doc_col``, ``subject``: the subjects of each document, by all its sentences.

    One pass over the table without a shuffle. Null and empty texts, and texts without a sentence that belongs to a subject,
    give no row; repeated rows give repeated results; an empty table gives an empty one. Other columns aren't read."""
    chosen = spread(documents.select(F.col(f"`{doc_col}`").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text")))
    sent = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([chosen.schema["doc"], T.StructField("subject", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, memo = sent.value, Features()
        names = pa.array(m.subjects, pa.string())
        end = np.array([_END])
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_PER_BATCH):
                batch = whole.slice(at, ROWS_PER_BATCH)
                texts = batch.column(1).to_pylist()
                parts, docs = [], []
                for d, t in enumerate(texts):
                    if t:
                        parts += [pieces_of(t, memo), end]
                        docs.append(d)
                if not parts:
                    continue
                size = np.array([len(p) for p in parts]).reshape(-1, 2).sum(axis=1)
                pieces = np.concatenate(parts)
                feature, sentence, count = rows_of(pieces, ngrams)
                doc = np.zeros(count, np.int64)
                ends = np.flatnonzero(pieces == _END)
                doc[: len(ends)] = np.repeat(docs, size)[ends]
                belongs = shares(m.best(m.scores(feature, sentence, count)), doc, len(texts), len(m.subjects))
                where, subject = np.nonzero(belongs)
                if len(where):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(where)), names.take(pa.array(subject))], names=["doc", "subject"])

    return chosen.mapInArrow(run, schema).withColumnRenamed("doc", doc_col)


def subject_areas(documents: DataFrame, subjects: DataFrame, labels: DataFrame) -> DataFrame:
    return assign(documents, train(documents, subjects, labels))
