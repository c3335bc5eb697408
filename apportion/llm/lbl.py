"""Language-model scoring with a log-bilinear neural model.

Tokens are words (A-Z lowered) and one end per text. Spark counts every token
of the training texts; the counts are exact and stay distributed. The model
predicts a token's class from the classes of the tokens before it. The end and
every word that the training texts hold often enough (and the most
frequent ones of a small corpus) are classes of their own. Often enough is ``LEAST`` times, or the
root of the training tokens over ``ROOT`` where that is more, so the classes grow with the
corpus, about with the root of its tokens. The other words fall into rest classes, one for seven words with a
class: ranges of the words' last five bytes, read from the end, that hold
about equally many training tokens. Inside a rest class a smoothed unigram
shares out the class's probability (one share is kept for unseen words). The
probabilities of all words of a context sum to one.

The class model is log-bilinear: the predicted vector is the sum of the context
vectors, each weighted by its place, and a class's logit is its product with
the class vector plus a bias. Classes stand in groups, the frequent ones in small groups: a group's probability is normalised over the groups, a class's
over its group, so a token costs less than the root of the number of classes.
Groups have vectors and biases of their own. All learn by noise-contrastive
estimation in numpy from all training texts, in ``ROUNDS`` rounds that share
out the texts: each partition runs over its own texts from the same start with
noise of its own, and the partitions' changes of a vector are averaged by how
often each partition changed it.

A null or empty text is its end token alone. A null id hashes like the empty
text. Repeated rows are scored (and learned from) each. Without training
tokens all counts are zero and the class model is nearly uniform.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportion.llm.common import kept_in_worker, text_slices, texts, written

END = b""
#: Words whose counts each worker holds; the rest meets its counts in a join.
TOP_WORDS = 1 << 19
#: Classes and rest classes of a small corpus; least training tokens of a word with a class: LEAST, or root(tokens) / ROOT.
CLASSES, REST = 512, 64
LEAST, ROOT = 64, 30
#: Tokens of a trainer for each class, in a round.
PER_CLASS = 64
CONTEXT, WIDTH = 3, 16
#: Noise classes and noise groups for each NEAR tokens of a batch.
NOISE, GROUP_NOISE, NEAR = 48, 16, 256
BATCH, STEP, ROUNDS = 8192, 0.15, 4
#: Squared gradients that a vector has at the start of a round.
SEEN = 1e-4
#: Last bytes of a word that its rest class depends on.
ENDING = 5
#: Distinct words that a counting worker holds before it hands them on.
HELD_WORDS = 200_000


def tokens(text: bytes) -> list[bytes]:
    out = text.lower().split()
    out.append(END)
    return out


def endings(words: pa.Array) -> np.ndarray:
    """The last bytes of each word as a number, the last byte first; missing bytes are zero."""
    words = words.cast(pa.large_binary())
    if not len(words):
        return np.zeros(0, np.int64)
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    out = np.zeros(len(words), np.int64)
    for k in range(ENDING):
        has = np.diff(ends) > k
        out[has] += data[ends[1:][has] - k - 1].astype(np.int64) << 8 * (ENDING - 1 - k)
    return out


#: Where the second and later rest classes begin when nothing is counted.
EVEN = np.arange(1, REST) * (256**ENDING // REST)


def rest_class(word: bytes) -> int:
    """A word's rest class in the layout of a corpus without counts."""
    return CLASSES - REST + bisect_right(EVEN, int(endings(pa.array([word], pa.binary()))[0]))


def held_out_column() -> Column:
    """Rows kept from learning: crc32 of the id as text leaves 2 modulo 7."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2


def token_counts(train: DataFrame) -> DataFrame:
    """(word, n) over all training texts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for part in text_slices(batches):
            for text in texts(part):
                held.update(tokens(text))
            if len(held) > HELD_WORDS:
                yield rows()
                held.clear()
        if held:
            yield rows()

    return train.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def group_starts(share: np.ndarray) -> np.ndarray:
    """The first class of each group of consecutive classes.

    A token costs one product for each group and one for each member of its
    own group. That is least, in the mean, when a group about a class of share p has one over the
    root of p members: frequent classes stand in small groups.
    """
    root = np.sqrt(share)
    return np.flatnonzero(np.diff(np.floor(np.cumsum(root) - root / 2), prepend=-1))


def group_of(targets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each class's group."""
    return np.searchsorted(starts, targets, "right") - 1


@dataclass
class Params:
    """Context vectors, place weights, vectors of the classes and behind them of their groups (last column: bias)."""

    context: np.ndarray
    place: np.ndarray
    target: np.ndarray

    def rows(self) -> np.ndarray:
        narrow = np.concatenate([self.context, self.place])
        return np.concatenate([np.pad(narrow, ((0, 0), (0, 1))), self.target])

    @staticmethod
    def of(rows: np.ndarray, classes: int) -> Params:
        rows, n = rows.astype(np.float32), classes
        return Params(rows[:n, :WIDTH].copy(), rows[n : n + CONTEXT, :WIDTH].copy(), rows[n + CONTEXT :].copy())

    @staticmethod
    def start(share: np.ndarray) -> Params:
        rng, n = np.random.default_rng(10), len(share)
        every = with_groups(share)
        target = np.concatenate([rng.normal(0, 0.1, (len(every), WIDTH)), np.log(every)[:, None]], axis=1)
        return Params(rng.normal(0, 0.3, (n, WIDTH)).astype(np.float32), np.ones((CONTEXT, WIDTH), np.float32), target.astype(np.float32))


def with_groups(share: np.ndarray) -> np.ndarray:
    """The shares of the classes and behind them those of the groups."""
    return np.concatenate([share, np.add.reduceat(share, group_starts(share))])


def contexts(classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The classes of the CONTEXT tokens before each token; class 0 (the end) stands before a text."""
    out = np.zeros((CONTEXT, len(classes)), np.int64)
    at = np.arange(len(classes))
    for k in range(CONTEXT):
        inside = at - k - 1 >= first
        out[k, inside] = classes[at[inside] - k - 1]
    return out


class Trainer:
    """Noise-contrastive estimation with adaptive steps over a stream of (context, target) batches."""

    def __init__(self, params: Params, share: np.ndarray, seed: int | tuple[int, int] = 3) -> None:
        self.p = Params(*(x.astype(np.float32) for x in params.__dict__.values()))
        self.classes = len(share)
        self.group = group_of(np.arange(len(share)), group_starts(share))
        every = with_groups(share)
        self.upto, self.group_upto = np.cumsum(every[: self.classes]), np.cumsum(every[self.classes :])
        per = np.where(np.arange(len(every)) < self.classes, NOISE, GROUP_NOISE)
        self.log_noise = np.log(per * every).astype(np.float32)
        self.seen = Params(*(np.full_like(x, SEEN) for x in self.p.__dict__.values()))  # sums of squared gradients
        self.hits = Params(*(np.zeros(len(x), np.int64) for x in self.p.__dict__.values()))  # changes of each vector
        self.rng, self.n = np.random.default_rng(seed), 0

    def noise(self, blocks: int) -> np.ndarray:
        """Classes and groups by their shares, for each block of tokens."""
        own = np.minimum(np.searchsorted(self.upto, self.rng.random((blocks, NOISE))), self.classes - 1)
        group = np.minimum(np.searchsorted(self.group_upto, self.rng.random((blocks, GROUP_NOISE))), len(self.group_upto) - 1)
        return np.concatenate([own, group + self.classes], axis=1)

    def change(self, name: str, rows: np.ndarray, add: np.ndarray, n: int) -> None:
        """A step along the gradient sums of the rows (repeating)."""
        packed = (rows << 24) | np.arange(len(rows))  # row, then place: sorting numbers is faster than sorting places
        packed.sort()
        order, rows = packed & 0xFFFFFF, packed >> 24
        cuts = np.flatnonzero(np.diff(rows, prepend=-1))
        rows, g = rows[cuts], np.add.reduceat(add[order], cuts, axis=0) / np.float32(n)
        seen = getattr(self.seen, name)
        s = g * g
        s *= np.float32(n)  # steps follow the batch's own scale
        s += seen[rows]
        seen[rows] = s
        g *= np.float32(STEP * np.sqrt(n))
        g /= np.sqrt(s, out=s)
        getattr(self.p, name)[rows] += g
        getattr(self.hits, name)[rows] += 1

    def learn(self, ctx: np.ndarray, target: np.ndarray) -> None:
        p, n = self.p, len(target)
        blocks = -(-n // NEAR)
        noise = self.noise(blocks)
        vectors = [p.context[c] for c in ctx]
        q = np.zeros((blocks * NEAR, WIDTH + 1), np.float32)
        q[:n, :WIDTH] = sum(v * w for v, w in zip(vectors, p.place))
        q[:n, WIDTH] = 1
        dq = np.zeros((n, WIDTH + 1), np.float32)
        rows, adds = [noise.ravel()], []
        far = p.target[noise]
        near = q.reshape(blocks, NEAR, -1)
        fake = near @ far.transpose(0, 2, 1)
        fake -= self.log_noise[noise][:, None, :]
        np.clip(fake, -30, 30, out=fake)
        np.exp(np.negative(fake, out=fake), out=fake)
        np.divide(-1, np.add(fake, 1, out=fake), out=fake)  # -P(data)
        fake.reshape(blocks * NEAR, -1)[n:] = 0
        adds.append((fake.transpose(0, 2, 1) @ near).reshape(-1, WIDTH + 1))
        dq += (fake @ far).reshape(blocks * NEAR, -1)[:n]
        for unit in (target, self.classes + self.group[target]):
            own = p.target[unit]
            true = np.einsum("ij,ij->i", q[:n], own) - self.log_noise[unit]
            g = (1 / (1 + np.exp(np.clip(true, -30, 30))))[:, None]  # 1 - P(data)
            dq += g * own
            rows.append(unit)
            adds.append(g * q[:n])
        dq = dq[:, :WIDTH]
        place = [np.einsum("ij,ij->j", dq, v) for v in vectors]
        context = np.concatenate([dq * w for w in p.place])
        self.change("target", np.concatenate(rows), np.concatenate(adds), n)
        self.change("context", np.concatenate(list(ctx)), context, n)
        self.change("place", np.arange(CONTEXT), np.array(place), n)
        self.n += n


def log10_classes(params: Params, ctx: np.ndarray, target: np.ndarray, starts: np.ndarray | None = None, rows: int = 1024) -> np.ndarray:
    """log10 P(target class | context): of its group among the groups, and of the class inside its group
    (``starts``: those of the training; default: of equal shares)."""
    classes = len(params.context)
    starts = group_starts(np.full(classes, 1 / classes)) if starts is None else starts
    group = group_of(target, starts)
    order = np.argsort(group.astype(np.int16), kind="stable")
    out, bounds = np.empty(len(target), np.float64), np.searchsorted(group[order], np.arange(len(starts) + 1))
    ends = np.append(starts[1:], classes)
    own, groups = params.target[:classes], np.ascontiguousarray(params.target[classes:].T)
    most = np.abs(params.target).max(0)

    def part(q: np.ndarray, wide: np.ndarray, chosen: np.ndarray, far: bool) -> np.ndarray:
        z = q @ wide
        if far:
            np.clip(z, -80, 80, out=z)
        picked = z[np.arange(len(z)), chosen].astype(np.float64)
        return picked - np.log(np.exp(z, out=z) @ np.ones(z.shape[1], np.float32))

    for k in np.flatnonzero(np.diff(bounds)).tolist():
        wide = np.ascontiguousarray(own[starts[k] : ends[k]].T)
        for a in range(bounds[k], bounds[k + 1], rows):
            at = order[a : min(a + rows, bounds[k + 1])]
            q = np.ones((len(at), WIDTH + 1), np.float32)
            q[:, :WIDTH] = sum(params.context[c[at]] * w for c, w in zip(ctx, params.place))
            far = np.abs(q).max(0) @ most > 80  # exp would leave single precision
            out[at] = part(q, groups, np.full(len(at), k), far) + part(q, wide, target[at] - starts[k], far)
    return out / np.log(10)


@dataclass
class Vocabulary:
    """What every worker needs of the counts: TOP_WORDS words at most, and what is known of each class."""

    words: pa.Array  # frequent words, most frequent first
    counts: np.ndarray
    n: int  # training tokens
    v: int  # distinct training tokens
    share: np.ndarray  # smoothed share of each class in the training tokens
    rest_tokens: np.ndarray  # training tokens and distinct words of each rest class
    rest_words: np.ndarray
    edges: np.ndarray = field(default_factory=lambda: EVEN)  # the ending at which each rest class but the first begins

    @property
    def base_unit(self) -> float:
        return float(np.log10(self.n + (self.v + 1)))

    @property
    def own(self) -> int:
        """Words that are classes."""
        return len(self.share) - len(self.rest_tokens)

    def rest_classes(self, words: pa.Array) -> np.ndarray:
        return self.own + np.searchsorted(self.edges, endings(words), "right")

    def table(self) -> tuple[dict[bytes, int], np.ndarray, np.ndarray, np.ndarray]:
        """Word index, and by index the class, log10(count + 1) and the log10 share inside the class."""
        own = self.own
        of_class = self.rest_classes(self.words).astype(np.int32)
        of_class[:own] = np.arange(min(own, len(of_class)))
        logs = np.log10(self.counts + 1.0)
        inside = logs - self.log_rest()[of_class]
        inside[:own] = 0
        words = self.words.to_pylist()
        return dict(zip(words, range(len(words)))), of_class, logs, inside

    def log_rest(self) -> np.ndarray:
        """log10 of the smoothed token total of each class: every word of it has count + 1, and unseen words together 1."""
        out = np.zeros(len(self.share))
        out[self.own :] = np.log10(self.rest_tokens + self.rest_words + 1.0)
        return out


def _sums(counts: DataFrame, key) -> DataFrame:
    """(key, n, v): tokens and distinct words by a number that ``key`` makes of the words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, at = np.unique(key(batch.column("word")), return_inverse=True)
            n = np.bincount(at, np.asarray(batch.column("n")).astype(np.float64), len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64)), pa.array(np.bincount(at, minlength=len(keys)))], names=["key", "n", "v"])

    return counts.mapInArrow(run, "key long, n long, v long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))


def rest_edges(counts: DataFrame, taken: pa.Array, taken_counts: np.ndarray, rest: int, n: int) -> np.ndarray:
    """The endings that cut the tokens outside ``taken`` into ``rest`` ranges of about the same size."""
    left = n - float(taken_counts.sum())
    sums = _sums(counts, endings)
    for k in range(1, ENDING - 1):
        # endings of few tokens are told apart by a byte less, by two bytes at last: 66,000 rows and some for each class come back
        key = F.when(F.col("n") * 8 * rest >= left, F.col("key")).otherwise(F.col("key") - F.col("key") % 256**k)
        sums = sums.groupBy(key.alias("key")).agg(F.sum("n").alias("n"))
    got = sums.toArrow().sort_by("key")
    keys, tokens_of = np.asarray(got.column("key")), np.asarray(got.column("n")).astype(np.float64)
    if not len(keys):
        return EVEN
    of = endings(taken)
    for k in range(ENDING - 1):  # where the words with classes have been counted
        at = np.minimum(np.searchsorted(keys, of), len(keys) - 1)
        of = np.where(keys[at] == of, of, of - of % 256 ** (k + 1))
    np.subtract.at(tokens_of, at, taken_counts)
    before = np.cumsum(np.maximum(tokens_of, 0))
    cut = np.searchsorted(before, before[-1] * np.arange(1, rest) / rest, "left") + 1
    return np.unique(keys[np.unique(cut[cut < len(keys)])])


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals, frequent words and classes of (word, n) rows."""
    # words by steps of their counts: how far down may the frequent ones reach?
    step = F.floor(F.log2("n") * 16)
    left, least = TOP_WORDS - 1, None
    steps = sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect(), reverse=True)  # 64 * 16 rows at most
    for r in steps:
        left -= r.words
        if left < 0:
            break
        least = r.step
    frequent = F.col("word") == F.lit(END)
    top = counts.where(frequent if least is None else frequent | (step >= least)).toArrow()  # TOP_WORDS rows at most
    top = top.sort_by([("n", "descending"), ("word", "ascending")]).combine_chunks()
    order = sorted(range(len(top)), key=[w != END for w in top.column("word").to_pylist()].__getitem__)  # the end first
    top = top.take(pa.array(order, pa.int64()))
    words = top.column("word").combine_chunks() if len(top) else pa.array([], pa.binary())
    count = top.column("n").to_numpy().astype(np.float64) if len(top) else np.zeros(0)
    n, v = sum(r.n for r in steps), sum(r.words for r in steps)
    own = max(CLASSES - REST, 1 + int((count[1:] >= max(LEAST, np.sqrt(n) / ROOT)).sum()))
    taken, taken_counts = words.slice(0, own), count[:own]
    edges = rest_edges(counts, taken, taken_counts, max(REST, own * REST // (CLASSES - REST)), n)
    rest = len(edges) + 1
    tokens_of, words_of = np.zeros(rest), np.zeros(rest)
    for r in _sums(counts, lambda w: np.searchsorted(edges, endings(w), "right")).collect():
        tokens_of[r.key], words_of[r.key] = r.n, r.v
    of = np.searchsorted(edges, endings(taken), "right")
    np.subtract.at(tokens_of, of, taken_counts)
    np.subtract.at(words_of, of, 1)
    share = np.full(own + rest, 0.5)
    share[: len(taken)] += taken_counts
    share[own:] += tokens_of
    return Vocabulary(words, count, n, v, share / share.sum(), tokens_of, words_of, edges)


class _SameObject:
    """A key that is equal for one and the same object only, and keeps it alive."""

    def __init__(self, of) -> None:
        self.of = of

    def __eq__(self, other) -> bool:
        return isinstance(other, _SameObject) and other.of is self.of

    def __hash__(self) -> int:
        return id(self.of)


def _table(shared) -> tuple:
    """The broadcast vocabulary's table, built once in a worker process."""
    return kept_in_worker(_SameObject(shared.value), shared.value.table)


def train_round(train: DataFrame, vocab, params: Params, turn: int = 0) -> Params:
    """One pass of all partitions over their texts from the same parameters; a vector's mean change, weighted by how often it was changed."""
    spark = train.sparkSession
    start = spark.sparkContext.broadcast(params)
    columns = [f"x{k}" for k in range(WIDTH + 1)]

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, of_class, _, _ = _table(vocab)
        trainer = Trainer(start.value, vocab.value.share, (turn, TaskContext.get().partitionId()))
        for part in text_slices(batches):
            words, first = [], []
            for text in texts(part):
                own = tokens(text)
                first.append(np.full(len(own), len(words)))
                words += own
            at = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
            target = np.where(at >= 0, of_class[at] if len(of_class) else 0, 0).astype(np.int64)
            rare = np.flatnonzero(at < 0)
            target[rare] = vocab.value.rest_classes(pa.array([words[i] for i in rare.tolist()], pa.binary()))
            ctx = contexts(target, np.concatenate(first))
            for a in range(0, len(target), BATCH):
                trainer.learn(ctx[:, a : a + BATCH], target[a : a + BATCH])
        if trainer.n:
            hits = np.concatenate(list(trainer.hits.__dict__.values()))
            changed = np.flatnonzero(hits)
            moved = (trainer.p.rows()[changed].astype(np.float64) - start.value.rows()[changed]) * hits[changed, None]
            arrays = [pa.array(changed), pa.array(hits[changed]), *(pa.array(x.astype(np.float32)) for x in moved.T)]
            yield pa.RecordBatch.from_arrays(arrays, names=["i", "hits", *columns])

    trainers = max(1, round(vocab.value.n / ROUNDS / (PER_CLASS * len(vocab.value.share))))
    schema = "i long, hits long, " + ", ".join(f"{c} float" for c in columns)
    means = [(F.sum(c) / F.sum("hits")).alias(c) for c in columns]
    got = written(train.select("text").coalesce(trainers).mapInArrow(learn, schema).groupBy("i").agg(*means), "params").toArrow()
    rows = params.rows().astype(np.float64)
    if len(got):
        rows[np.asarray(got.column("i"))] += np.stack([np.asarray(got.column(c)) for c in columns], axis=1)
    return Params.of(rows, len(params.context))


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and the model's score of every document."""
    spark = docs.sparkSession
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").withColumn("held_out", held_out_column())
    train = rows.where(~F.col("held_out"))
    counts = written(token_counts(train), "token-counts")
    vocab_value = vocabulary(counts)
    vocab = spark.sparkContext.broadcast(vocab_value)
    params = Params.start(vocab_value.share)
    share_of = F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS))
    for turn in range(ROUNDS):
        params = train_round(train.where(share_of == turn), vocab, params, turn)
    final = spark.sparkContext.broadcast(params)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, of_class, logs, inside = _table(vocab)
        v, p, row = vocab.value, final.value, TaskContext.get().partitionId() << 40
        log_rest, groups = v.log_rest(), group_starts(v.share)
        for part in text_slices(batches):
            at, first, tails, unknown = [], [], [], []
            ends = np.empty(part.num_rows, np.int64)
            for i, text in enumerate(texts(part)):
                words = tokens(text)
                first.append(np.full(len(words), len(at)))
                got = list(map(index.get, words, repeat(-1)))
                rare = [w for w, k in zip(words, got) if k < 0]
                unknown += rare
                tails.append(Counter(rare))
                at += got
                ends[i] = len(at)
            at = np.array(at, np.int64)
            known = at >= 0
            target = np.empty(len(at), np.int64)
            target[known] = of_class[at[known]]
            target[~known] = v.rest_classes(pa.array(unknown, pa.binary()))
            model = log10_classes(p, contexts(target, np.concatenate(first)), target, groups)
            model[known] += inside[at[known]]
            model[~known] -= log_rest[target[~known]]
            base = np.where(known, logs[at] if len(logs) else 0.0, 0.0) - v.base_unit
            starts = np.concatenate([[0], ends[:-1]])
            sums = [np.add.reduceat(x, starts) for x in (base, model, known.astype(np.int64), np.ones(len(at), np.int64))]
            names = ["row", "doc_id", "held_out", "word", "k", "base", "model", "n_known", "n_tokens"]
            n = part.num_rows
            keys = [row + i for i in range(n)]
            # the document's own row: its word starts with a space, as none does, and so meets no count
            yield pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()), part.column("doc_id"), part.column("held_out"), pa.array([b" %d" % k for k in keys], pa.binary()), pa.array([0] * n, pa.int64()),
                pa.array(sums[0]), pa.array(sums[1]), pa.array(sums[2]), pa.array(sums[3]),
            ], names=names)
            words = [(key, w, k) for key, tail in zip(keys, tails) for w, k in tail.items()]
            if words:
                m = len(words)
                a, b, c = zip(*words)
                yield pa.RecordBatch.from_arrays([
                    pa.array(a, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), pa.array(b, pa.binary()), pa.array(c, pa.int64()),
                    pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()),
                ], names=names)
            row += n

    parts = rows.mapInArrow(score, "row long, doc_id long, held_out boolean, word binary, k long, base double, model double, n_known long, n_tokens long")
    joined = parts.join(counts, "word", "left")
    more = F.sum(F.col("k") * F.log10(F.col("n") + 1))  # the words outside TOP_WORDS: their counts come from the join
    found = F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0))
    return joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        (F.max("n_known") + found).alias("n_known"), F.lit(vocab_value.n).cast("long").alias("train_tokens"),
        (F.max("base") + F.coalesce(more, F.lit(0.0))).alias("base_score"), (F.max("model") + F.coalesce(more, F.lit(0.0))).alias("score"),
    ).drop("row")
