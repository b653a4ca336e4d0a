"""A hidden Markov language model over word classes.

The states are latent; a state emits the class of a word, and the class gives the word by its share of the
class's tokens. The most frequent words are classes of their own, all others share the class of their ending,
so the model stays small while every word of the corpus keeps its own probability:

    P(text) = [sum over state paths] prod P(state | state) P(class | state)  *  prod P(word | class)

Baum-Welch runs over the whole training corpus: each pass sums expected counts per task and then over all
tasks, and only those sums (classes x states) reach the driver. A text is scored by the scaled forward
recursion, which gives the exact likelihood. Word counts stay a distributed table; frequent words are looked up in a
list of fixed size, the others by a join.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.text import map_texts, written

STATES = 8
PASSES = 5
OWN_CLASSES = 4096
ENDING_CLASSES = 512
KNOWN_WORDS = 65_536
CLASSES = OWN_CLASSES + ENDING_CLASSES
ADD = 0.1
PRIOR = 5.0
COUNTED_WORDS = 200_000
CELLS = 1 << 18
PIECE = 1024
RESCALE = 8
# no word holds white space
END = b"\n"


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words and the end."""
    out = text.lower().split()
    out.append(END)
    return out


def ending_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDING_CLASSES


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, c) over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def flushed() -> pa.RecordBatch:
            words, counts = pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())
            found.clear()
            return pa.RecordBatch.from_arrays([words, counts], ["word", "n"])

        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                found.update(tokens(text.as_py() or b""))
                if len(found) >= COUNTED_WORDS:
                    yield flushed()
        yield flushed()

    return map_texts(rows.select("text"), count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Vocabulary:
    """The known words with their counts, and what the words of an ending have in common."""

    words: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    ending_tokens: np.ndarray
    ending_words: np.ndarray
    # words with fewer occurrences are not known
    least: int

    def __post_init__(self) -> None:
        own = min(OWN_CLASSES, len(self.words))
        endings = [ending_class(w) for w in self.words[own:]]
        # code of a known word is its place, of another one KNOWN_WORDS + its ending
        self.class_of = np.zeros(KNOWN_WORDS + ENDING_CLASSES, dtype=np.int16)
        self.class_of[:own] = np.arange(own)
        self.class_of[own : len(self.words)] = np.array(endings, dtype=np.int16) + OWN_CLASSES
        self.class_of[KNOWN_WORDS:] = np.arange(ENDING_CLASSES) + OWN_CLASSES
        norm = np.log10(self.ending_tokens + ADD * (self.ending_words + 1))
        self.count_log = np.zeros(KNOWN_WORDS + ENDING_CLASSES)
        self.count_log[: len(self.words)] = np.log10(self.counts + ADD)
        self.within = np.zeros(KNOWN_WORDS + ENDING_CLASSES)
        self.within[own : len(self.words)] = self.count_log[own : len(self.words)] - norm[endings]
        self.within[KNOWN_WORDS:] = -norm
        unigram = np.zeros(CLASSES)
        unigram[:own] = self.counts[:own]
        unigram[OWN_CLASSES:] = self.ending_tokens
        self.unigram = (unigram + ADD) / (unigram + ADD).sum()

    @property
    def base_norm(self) -> float:
        return float(np.log10(self.total + ADD * (self.distinct + 1)))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """At most ``KNOWN_WORDS`` words and one figure per ending reach the driver."""
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).head()
    least = _least_count(counts, KNOWN_WORDS)
    top = sorted(counts.where(F.col("c") >= least).collect(), key=lambda r: (-r["c"], bytes(r["word"])))
    own = frozenset(bytes(r["word"]) for r in top[:OWN_CLASSES])

    def by_ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, distinct = np.zeros(ENDING_CLASSES, np.int64), np.zeros(ENDING_CLASSES, np.int64)
        for batch in batches:
            for word, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if word not in own:
                    place = ending_class(word)
                    total[place] += c
                    distinct[place] += 1
        some = np.flatnonzero(distinct)
        columns = [pa.array(some, pa.int64()), pa.array(total[some]), pa.array(distinct[some])]
        yield pa.RecordBatch.from_arrays(columns, ["ending", "n", "v"])

    ending_tokens, ending_words = np.zeros(ENDING_CLASSES), np.zeros(ENDING_CLASSES)
    grouped = map_texts(counts.select("word", "c"), by_ending, "ending long, n long, v long")
    for r in grouped.groupBy("ending").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        ending_tokens[r["ending"]], ending_words[r["ending"]] = r["n"], r["v"]
    return Vocabulary(
        [bytes(r["word"]) for r in top],
        np.array([r["c"] for r in top], dtype=np.float64),
        sums["n"],
        sums["v"],
        ending_tokens,
        ending_words,
        least,
    )


def _least_count(counts: DataFrame, most: int) -> int:
    """The smallest count such that at most ``most`` words have it or more."""
    # different counts only: far fewer than words, and each of them stands for a word at least
    steps = counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("c").desc()).limit(most + 1).collect()
    total = 0
    for r in steps:
        total += r["n"]
        if total > most:
            return r["c"] + 1
    return 1


class Codes(dict):
    """Code of each known word; of any other word, by its ending, without keeping it."""

    def __missing__(self, word: bytes) -> int:
        return KNOWN_WORDS + ending_class(word)


ENCODED = (
    "uid string, doc_id long, held_out boolean, n_tokens long, n_known long, base double, within double, "
    "classes binary, rare array<struct<word binary, n long>>"
)


def encoded(rows: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Each text as a sequence of classes, with the sums over its known words and the list of its other words."""
    shared = rows.sparkSession.sparkContext.broadcast(vocab)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocab = shared.value
        codes = Codes((w, i) for i, w in enumerate(vocab.words))
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            uid, n_tokens, n_known, base, within, classes = [], [], [], [], [], []
            rare_words, rare_counts, ends = [], [], [0]
            for text in batch.column(2).cast(pa.binary()):
                found = tokens(text.as_py() or b"")
                coded = np.fromiter(map(codes.__getitem__, found), dtype=np.int32, count=len(found))
                other = np.flatnonzero(coded >= KNOWN_WORDS)
                rare = Counter([found[i] for i in other.tolist()])
                uid.append(f"{part}-{row}")
                n_tokens.append(len(found))
                n_known.append(len(found) - len(other))
                base.append(vocab.count_log[coded].sum() - len(found) * vocab.base_norm)
                within.append(vocab.within[coded].sum())
                classes.append(vocab.class_of[coded].tobytes())
                rare_words += rare.keys()
                rare_counts += rare.values()
                ends.append(len(rare_words))
                row += 1
            words = pa.StructArray.from_arrays(
                [pa.array(rare_words, pa.binary()), pa.array(rare_counts, pa.int64())], ["word", "n"]
            )
            columns = [
                pa.array(uid, pa.string()),
                batch.column(0),
                batch.column(1),
                pa.array(n_tokens, pa.int64()),
                pa.array(n_known, pa.int64()),
                pa.array(base, pa.float64()),
                pa.array(within, pa.float64()),
                pa.array(classes, pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words),
            ]
            names = [c.split()[0] for c in ENCODED.split(", ")[:8]] + ["rare"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return map_texts(rows.select("doc_id", "held_out", "text"), encode, ENCODED)


@dataclass
class Model:
    """Start, transition and emission probabilities; emission is classes x states."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @staticmethod
    def initial(unigram: np.ndarray, states: int = STATES) -> Model:
        """States that stay, with class probabilities near the unigram ones."""
        rng = np.random.default_rng(11)
        emit = unigram[:, None] * np.exp(rng.normal(0, 0.5, (len(unigram), states)))
        move = np.full((states, states), 0.1 / max(states - 1, 1))
        np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
        return Model(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


def _chunks(sequences: list[np.ndarray]) -> Iterator[list[int]]:
    """Places of sequences of similar length, of at most ``CELLS`` padded cells (or one sequence)."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    at = 0
    while at < len(order):
        many = max(1, CELLS // len(sequences[order[at]]))
        yield order[at : at + many]
        at += many


@dataclass
class Messages:
    """What pieces of texts get from their neighbours, a row each: ``before`` is the forward message at the end of the
    piece before (zero for a text's first piece), ``entering`` the states' prior at the first token, ``after`` the
    backward message at the last one."""

    before: np.ndarray
    entering: np.ndarray
    after: np.ndarray

    @staticmethod
    def alone(n: int, model: Model) -> Messages:
        """For whole texts."""
        states = len(model.start)
        return Messages(np.zeros((n, states)), np.tile(model.start, (n, 1)), np.ones((n, states)))

    def of(self, chosen: list[int]) -> Messages:
        return Messages(self.before[chosen], self.entering[chosen], self.after[chosen])


class Lattice:
    """Forward probabilities of a chunk of sequences, the longest first; rows are times."""

    def __init__(self, sequences: list[np.ndarray], model: Model, messages: Messages | None = None):
        lengths = np.array([len(s) for s in sequences])
        self.steps, self.model = int(lengths[0]), model
        self.messages = messages or Messages.alone(len(sequences), model)
        # how many sequences are still running at each time
        self.active = (lengths[None, :] > np.arange(self.steps)[:, None]).sum(axis=1)
        self.seen = np.zeros((self.steps, len(sequences)), dtype=np.int16)
        for i, s in enumerate(sequences):
            self.seen[: len(s), i] = s
        self.emitted = model.emit[self.seen]
        self.alpha = np.zeros_like(self.emitted)
        self.scale = np.ones(self.seen.shape)
        now = self.messages.entering * self.emitted[0]
        for t in range(self.steps):
            m = self.active[t]
            if t:
                now = (self.alpha[t - 1, :m] @ model.move) * self.emitted[t, :m]
            total = now.sum(axis=1)
            self.scale[t, :m] = total
            self.alpha[t, :m] = now / total[:, None]

    def expected(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, moves (those from the pieces before too) and emissions, summed over the chunk."""
        states = len(self.model.start)
        beta = self.messages.after.copy()
        gamma = self.alpha
        moves = np.zeros((states, states))
        for t in range(self.steps - 1, 0, -1):
            m = self.active[t]
            onward = self.emitted[t, :m] * beta[:m] / self.scale[t, :m, None]
            moves += self.alpha[t - 1, :m].T @ onward
            gamma[t, :m] *= beta[:m]
            beta[:m] = onward @ self.model.move.T
        moves += self.messages.before.T @ (self.emitted[0] * beta / self.scale[0][:, None])
        gamma[0] *= beta
        running = np.arange(self.seen.shape[1])[None, :] < self.active[:, None]
        classes, weights = self.seen[running], gamma[running]
        emitted = np.stack([np.bincount(classes, weights[:, k], len(self.model.emit)) for k in range(states)], axis=1)
        first = ~self.messages.before.any(axis=1)
        return gamma[0][first].sum(axis=0), moves * self.model.move, emitted


def transfers(sequences: list[np.ndarray], model: Model) -> np.ndarray:
    """For each sequence the matrix that takes the prior at its first token to the states at its last, up to a factor."""
    states = len(model.start)
    found = np.empty((len(sequences), states, states))
    for chunk in _chunks(sequences):
        lengths = np.array([len(sequences[i]) for i in chunk])
        seen = np.zeros((int(lengths[0]), len(chunk)), dtype=np.int16)
        for place, i in enumerate(chunk):
            seen[: lengths[place], place] = sequences[i]
        active = (lengths[None, :] > np.arange(len(seen))[:, None]).sum(axis=1)
        now = np.eye(states)[None] * model.emit[seen[0]][:, None, :]
        for t in range(1, len(seen)):
            m = active[t]
            step = (now[:m].reshape(-1, states) @ model.move).reshape(m, states, states)
            step *= model.emit[seen[t, :m]][:, None, :]
            # doubles have room for the probabilities of a few tokens
            now[:m] = step / step.sum(axis=(1, 2), keepdims=True) if t % RESCALE == 0 else step
        found[chunk] = now / now.sum(axis=(1, 2), keepdims=True)
    return found


def pieces_of(sequences: list[np.ndarray], model: Model) -> tuple[list[np.ndarray], Messages]:
    """Pieces of at most ``PIECE`` tokens with the messages over their cuts, so that they add up to whole texts.

    The pieces of a text run side by side: their transfer matrices, one after the other, give every cut's
    forward and backward message exactly. Memory is bounded by the piece, whatever the text's length.
    """
    cuts = [[s[at : at + PIECE] for at in range(0, len(s), PIECE)] for s in sequences]
    pieces = [p for cut in cuts for p in cut]
    messages = Messages.alone(len(pieces), model)
    starts = np.cumsum([0] + [len(cut) for cut in cuts])
    several = [i for i, cut in enumerate(cuts) if len(cut) > 1]
    takes = transfers([p for i in several for p in cuts[i]], model)
    at = 0
    for i in several:
        n, first = len(cuts[i]), starts[i]
        take = takes[at : at + n]
        for k in range(1, n):
            ends = messages.entering[first + k - 1] @ take[k - 1]
            messages.before[first + k] = ends / ends.sum()
            messages.entering[first + k] = messages.before[first + k] @ model.move
        for k in range(n - 1, 0, -1):
            after = model.move @ (take[k] @ messages.after[first + k])
            messages.after[first + k - 1] = after / (messages.before[first + k] @ after)
        at += n
    return pieces, messages


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b, dtype=np.int16) for b in column.to_pylist()]


def log_likelihoods(sequences: list[np.ndarray], model: Model) -> np.ndarray:
    """Exact log10 likelihood of each sequence: the sum of the logarithms of the forward recursion's scales.

    All sequences advance a token at a time; only their current states are kept, however long they are.
    """
    order = np.argsort([-len(s) for s in sequences], kind="stable")
    lengths = np.array([len(sequences[i]) for i in order])
    scores = np.zeros(len(order))
    if not len(order):
        return scores
    flat = np.concatenate([sequences[i] for i in order])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    # the shorter ones are done first and stand last
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    alpha = np.broadcast_to(model.start, (len(order), len(model.start)))
    logs = np.zeros(len(order))
    for t in range(int(lengths[0])):
        m = active[t]
        alpha = (alpha[:m] @ model.move if t else alpha[:m]) * model.emit[flat[starts[:m] + t]]
        total = alpha.sum(axis=1)
        alpha = alpha / total[:, None]
        logs[:m] += np.log10(total)
    scores[order] = logs
    return scores


def improved(sequences: DataFrame, model: Model, vocab: Vocabulary) -> Model:
    """One pass of Baum-Welch over all sequences, each as a whole; emissions lean on the unigram distribution."""
    states = len(model.start)
    shared = sequences.sparkSession.sparkContext.broadcast(model)
    columns = ", ".join(f"s{k} double" for k in range(states))

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        # one row for the starts, then the moves, then the classes
        total = np.zeros((1 + states + len(model.emit), states))
        for batch in batches:
            found, messages = pieces_of(_sequences(batch.column(0)), model)
            for chunk in _chunks(found):
                start, moves, emitted = Lattice([found[i] for i in chunk], model, messages.of(chunk)).expected()
                total[0] += start
                total[1 : 1 + states] += moves
                total[1 + states :] += emitted
        some = np.flatnonzero(total.sum(axis=1))
        arrays = [pa.array(some, pa.int64())] + [pa.array(np.ascontiguousarray(total[some, k])) for k in range(states)]
        yield pa.RecordBatch.from_arrays(arrays, ["at"] + [f"s{k}" for k in range(states)])

    sums = map_texts(sequences.select("classes"), expect, f"at long, {columns}").groupBy("at")
    total = np.zeros((1 + states + len(model.emit), states))
    for r in sums.agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(states)]).collect():
        total[r["at"]] = [r[f"s{k}"] for k in range(states)]
    start = total[0] + ADD
    move = total[1 : 1 + states] + ADD
    emit = total[1 + states :] + PRIOR * vocab.unigram[:, None]
    shared.unpersist()
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def trained(sequences: DataFrame, vocab: Vocabulary, states: int = STATES, passes: int = PASSES) -> Model:
    model = Model.initial(vocab.unigram, states)
    for _ in range(passes):
        model = improved(sequences, model, vocab)
    return model


def class_scores(sequences: DataFrame, model: Model) -> DataFrame:
    """The sequences with ``path_score``: log10 of the likelihood of their classes."""
    shared = sequences.sparkSession.sparkContext.broadcast(model)

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = log_likelihoods(_sequences(batch.column(batch.num_columns - 1)), model)
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores)], [*batch.schema.names[:-1], "path_score"])

    kept = [c for c in sequences.columns if c != "classes"]
    kinds = ", ".join(f"{c} {sequences.schema[c].dataType.simpleString()}" for c in kept)
    return map_texts(sequences.select(*kept, "classes"), forward, f"{kinds}, path_score double")


def language_scores(docs: DataFrame, states: int = STATES, passes: int = PASSES) -> DataFrame:
    """Train on the documents that are not held out and score all.

    Returns doc_id, held_out (crc32 of the id as text is divisible by 10), n_tokens, n_known (seen in
    training), train_tokens, base_score and score, both log10. NULL and empty texts are just the end;
    a NULL id counts as an empty text, whose crc32 is 0: it is held out. Repeated rows are scored each; further
    columns are ignored. Without training texts every word is unknown.
    """
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10 == 0
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    counts = written(word_counts(rows.where(~F.col("held_out"))), "word-counts")
    vocab = vocabulary(counts)
    found = written(encoded(rows, vocab), "encoded")
    model = trained(found.where(~F.col("held_out")).select("classes"), vocab, states, passes)
    scored = class_scores(
        found.select("uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "within", "classes"), model
    )
    # the other words: their own counts, a word that was never seen has none
    rare = found.select("uid", F.explode("rare").alias("r")).select("uid", "r.word", "r.n")
    looked_up = rare.join(counts.where(F.col("c") < vocab.least), "word", "left")
    sums = looked_up.groupBy("uid").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(ADD))).alias("rare_log"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
    )
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return scored.join(sums, "uid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + rare_log).alias("base_score"),
        (F.col("path_score") + F.col("within") + rare_log).alias("score"),
    )
