"""Scores of whole documents by a gated recurrent language model.

Tokens are lower-cased words and one end.  The most frequent words of the
training documents are the lexicon; its words lie in classes by frequency, and
the output is a softmax over classes times one over the words of the class.  A
word outside the lexicon is one class, shared out by its count over the whole
training corpus.  The state runs through a document from its first token to its
end, window by window; training carries it too but stops gradients at a window's
start.

Training is data-parallel: each task runs over its documents from common
weights, and the weights are averaged, weighted by tokens, on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvec.llm.common import in_chunks, keyed, write_table
from flowvec.llm.wordhash import hash_words, in_groups, mix

# The end of a document as a token.
END = np.uint64(0x8F1BBCDCA62C1D6B)
# Words whose counts every task has at hand; counts of the others are joined.
FREQUENT = 131_072
# Bytes of text for each bucket of counts.
BUCKET_BYTES = 32_000_000


@dataclass(frozen=True)
class Shape:
    """Size of the model and its training."""

    classes: int = 16
    per_class: int = 64
    hidden: int = 8
    window: int = 32
    train_rows: int = 512
    score_rows: int = 2048
    rounds: int = 2
    rate: float = 0.1
    seed: int = 7

    @property
    def words(self) -> int:
        return self.classes * self.per_class


HALF = np.float32(0.5)
# Far above any useful logit, and safe to take the exponential of.
MOST = np.float32(60)


def sigmoid(x: np.ndarray) -> np.ndarray:
    x = np.tanh(x * HALF)
    x += 1
    x *= HALF
    return x


class Model:
    """Weights by name; symbol ``words`` stands for all words outside the lexicon."""

    NAMES = ("inputs", "recurrent", "class_out", "class_bias", "word_out", "word_bias")

    def __init__(self, shape: Shape, weights: dict[str, np.ndarray]):
        self.shape, self.w = shape, weights

    @classmethod
    def start(cls, shape: Shape, counts: np.ndarray, outside: int) -> Model:
        """Small random weights; biases that give the unigram model."""
        random = np.random.default_rng(shape.seed)
        h = shape.hidden
        draw = lambda *size: random.normal(0, 0.1, size).astype(np.float32)
        n = np.maximum(counts.astype(float), 0.1).reshape(shape.classes, shape.per_class)
        by_class = np.append(n.sum(1), max(outside, 0.1))
        return cls(
            shape,
            {
                "inputs": draw(shape.words + 1, 3 * h),
                "recurrent": draw(h, 3 * h) * 2,
                "class_out": np.zeros((h, shape.classes + 1), np.float32),
                "class_bias": np.log(by_class / by_class.sum()).astype(np.float32),
                "word_out": np.zeros((shape.words, h), np.float32),
                "word_bias": np.log(n / n.sum(1, keepdims=True)).astype(np.float32).ravel(),
            },
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w[name].ravel() for name in self.NAMES])

    def with_flat(self, values: np.ndarray) -> Model:
        weights, at = {}, 0
        for name in self.NAMES:
            size = self.w[name].size
            weights[name] = values[at : at + size].reshape(self.w[name].shape).astype(np.float32)
            at += size
        return Model(self.shape, weights)

    def run(self, ids: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, list]:
        """States after each input of a window (time, rows), and what backpropagation needs."""
        h, recurrent, inputs = self.shape.hidden, self.w["recurrent"], self.w["inputs"]
        states = np.empty((*ids.shape, h), np.float32)
        kept = []
        given = inputs[ids]
        for t in range(len(ids)):
            x, s = given[t], state @ recurrent
            gates = sigmoid(x[:, : 2 * h] + s[:, : 2 * h])
            reset, update = gates[:, :h], gates[:, h:]
            new = np.tanh(x[:, 2 * h :] + reset * s[:, 2 * h :])
            kept.append((state, reset, update, new, s[:, 2 * h :]))
            state = new + update * (state - new)
            states[t] = state
        return states, kept

    def outputs(self, states: np.ndarray, target: np.ndarray, learn: bool) -> tuple[np.ndarray, dict | None, np.ndarray | None]:
        """Natural-log probability of each target; the gradients of their sum if ``learn``."""
        shape, w = self.shape, self.w
        group = np.minimum(target // shape.per_class, shape.classes)
        logits = states @ w["class_out"]
        logits += w["class_bias"]
        rows = np.arange(len(target))
        out = logits[rows, group]
        share = np.exp(np.minimum(logits, MOST, out=logits), out=logits)
        total = share @ np.ones(share.shape[1], np.float32)
        out -= np.log(total)
        grads, back = None, None
        if learn:
            step = np.multiply(share, (-1 / total)[:, None], out=share)
            step[rows, group] += 1
            grads = {"class_out": states.T @ step, "class_bias": step.sum(0), "word_out": np.zeros_like(w["word_out"]), "word_bias": np.zeros_like(w["word_bias"])}
            back = step @ w["class_out"].T
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(shape.classes + 1))
        for c in range(shape.classes):
            mine = order[cuts[c] : cuts[c + 1]]
            if not len(mine):
                continue
            words = slice(c * shape.per_class, (c + 1) * shape.per_class)
            s = states[mine]
            logits = s @ w["word_out"][words].T
            logits += w["word_bias"][words]
            place, r = target[mine] - words.start, np.arange(len(mine))
            chosen = logits[r, place]
            share = np.exp(np.minimum(logits, MOST, out=logits), out=logits)
            total = share @ np.ones(share.shape[1], np.float32)
            out[mine] += chosen - np.log(total)
            if learn:
                step = np.multiply(share, (-1 / total)[:, None], out=share)
                step[r, place] += 1
                grads["word_out"][words] = step.T @ s
                grads["word_bias"][words] = step.sum(0)
                back[mine] += step @ w["word_out"][words]
        return out, grads, back

    def gradients(self, ids: np.ndarray, kept: list, back: np.ndarray) -> dict:
        """Backpropagation through the window; nothing flows into the state it began with."""
        h = self.shape.hidden
        recurrent = np.zeros_like(self.w["recurrent"])
        steps = np.empty((*ids.shape, 3 * h), np.float32)
        carried = np.zeros_like(kept[0][0])
        for t in reversed(range(len(ids))):
            state, reset, update, new, s = kept[t]
            d = back[t] + carried
            d_new = d * (1 - update) * (1 - new * new)
            d_update = d * (state - new) * update * (1 - update)
            d_reset = d_new * s * reset * (1 - reset)
            into = np.concatenate([d_reset, d_update, d_new * reset], 1)
            recurrent += state.T @ into
            carried = d * update + into @ self.w["recurrent"].T
            steps[t, :, : 2 * h], steps[t, :, 2 * h :] = into[:, : 2 * h], d_new
        flat, rows = ids.ravel(), steps.reshape(-1, 3 * h)
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.append(True, flat[order][1:] != flat[order][:-1]))
        inputs = np.zeros_like(self.w["inputs"])
        inputs[flat[order][first]] = np.add.reduceat(rows[order], first)
        return {"recurrent": recurrent, "inputs": inputs}


def batches_of(lengths: np.ndarray, rows: int) -> Iterator[np.ndarray]:
    """Documents of about one length together, the longest first."""
    order = np.argsort(-lengths, kind="stable")
    for at in range(0, len(order), rows):
        yield order[at : at + rows]


def windows(model: Model, symbols: list[np.ndarray], end: int) -> Iterator[tuple]:
    """The windows of documents sorted by falling length: the running rows, inputs, targets, which are real."""
    width = model.shape.window
    lengths = np.array([len(s) for s in symbols])
    padded = np.full((len(symbols), -(-int(lengths[0]) // width) * width + 1), end, np.int32)
    for i, s in enumerate(symbols):
        padded[i, 1 : 1 + len(s)] = s
    for at in range(0, int(lengths[0]), width):
        n = int(np.searchsorted(-lengths, -at, "left"))
        real = at + np.arange(width)[:, None] < lengths[None, :n]
        yield n, padded[:n, at : at + width].T, padded[:n, at + 1 : at + width + 1].T, real


def score(model: Model, symbols: list[np.ndarray], end: int) -> np.ndarray:
    """Natural-log probability of each whole document."""
    out = np.zeros(len(symbols))
    lengths = np.array([len(s) for s in symbols])
    for rows in batches_of(lengths, model.shape.score_rows):
        state = np.zeros((len(rows), model.shape.hidden), np.float32)
        for n, ids, target, real in windows(model, [symbols[i] for i in rows], end):
            states, _ = model.run(ids, state[:n])
            state = states[-1]
            at = real.ravel()
            logs, _, _ = model.outputs(states.reshape(-1, model.shape.hidden)[at], target.ravel()[at], False)
            each = np.zeros(real.shape)
            each[real] = logs
            out[rows[:n]] += each.sum(0)
    return out


class Trainer:
    """Adaptive steps up the gradient of the mean log probability, window by window."""

    def __init__(self, model: Model):
        self.model, self.seen = model, 0
        self.squares = {name: np.full_like(w, 1e-6) for name, w in model.w.items()}

    def learn(self, symbols: list[np.ndarray], end: int) -> None:
        model = self.model
        lengths = np.array([len(s) for s in symbols])
        for rows in batches_of(lengths, model.shape.train_rows):
            state = np.zeros((len(rows), model.shape.hidden), np.float32)
            for n, ids, target, real in windows(model, [symbols[i] for i in rows], end):
                states, kept = model.run(ids, state[:n])
                state = states[-1]
                at = real.ravel()
                _, grads, back = model.outputs(states.reshape(-1, model.shape.hidden)[at], target.ravel()[at], True)
                spread = np.zeros(states.shape, np.float32)
                spread[real] = back
                grads |= model.gradients(ids, kept, spread)
                self._step(grads, int(real.sum()))

    def _step(self, grads: dict, tokens: int) -> None:
        self.seen += tokens
        # A window of few tokens moves the weights less.
        weight = min(1.0, tokens / (self.model.shape.window * 64))
        for name, g in grads.items():
            g = g / tokens * weight
            self.squares[name] += g * g
            self.model.w[name] += self.model.shape.rate * g / np.sqrt(self.squares[name])


@dataclass(frozen=True)
class Counts:
    """What every task knows of the training corpus."""

    words: np.ndarray  # hashes of frequent words, sorted
    counts: np.ndarray
    symbols: np.ndarray  # of each frequent word: its place in the lexicon, or the outside symbol
    end: int
    tokens: int
    distinct: int
    outside_tokens: int
    outside_distinct: int


def is_training(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 7 != 2


def _hashed(texts: list[bytes | None]) -> Iterator[np.ndarray]:
    """Tokens of each text as hashes, the end last."""
    for group in in_groups(texts):
        words, first, _, _ = hash_words([t.lower() for t in group])
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            yield np.append(words[a:b], END)


def _split(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    for x, y in zip(cuts, np.append(cuts[1:], len(bucket))[: len(cuts)], strict=True):
        yield int(bucket[x]), *(c[order[x:y]].tobytes() for c in columns)


def count_words(rows: DataFrame, buckets: int) -> DataFrame:
    """``bucket, words, counts, n, distinct``: counts of all tokens of ``rows``, by hash."""

    def local(table: pa.Table) -> pa.Table:
        words, n = np.unique(np.concatenate(list(_hashed(table["text"].cast(pa.binary()).to_pylist()))), return_counts=True)
        parts = list(_split((mix(words) % np.uint64(buckets)).astype(np.int64), words, n.astype(np.int64)))
        columns = list(zip(*parts, strict=True)) or [[], [], []]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], names=["bucket", "words", "counts"])

    def total(table: pa.Table) -> pa.Table:
        words = np.concatenate([np.frombuffer(b, np.uint64) for b in table["words"].to_pylist()])
        n = np.concatenate([np.frombuffer(b, np.int64) for b in table["counts"].to_pylist()])
        words, at = np.unique(words, return_inverse=True)
        n = np.bincount(at, n).astype(np.int64)
        return pa.table({"bucket": [table["bucket"][0].as_py()], "words": pa.array([words.tobytes()], pa.binary()), "counts": pa.array([n.tobytes()], pa.binary()), "n": [int(n.sum())], "distinct": [len(words)]})

    parts = rows.select("text").mapInArrow(in_chunks(local), "bucket long, words binary, counts binary")
    return parts.groupBy("bucket").applyInArrow(total, "bucket long, words binary, counts binary, n long, distinct long")


def frequent(counts: DataFrame, shape: Shape) -> Counts:
    """The ``FREQUENT`` most frequent tokens with their counts; a size that does not follow the corpus."""

    def best(batches):
        for batch in batches:
            for w, c in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                words, n = np.frombuffer(w, np.int64), np.frombuffer(c, np.int64)
                top = np.argsort(-n, kind="stable")[:FREQUENT]
                yield pa.RecordBatch.from_arrays([pa.array(words[top], pa.int64()), pa.array(n[top], pa.int64())], names=["word", "n"])

    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    top = counts.select("words", "counts").mapInArrow(best, "word long, n long").orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    words = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    n = np.array([r["n"] for r in top], np.int64)
    if END not in words[: shape.words]:
        # The end is a word of the lexicon in any case.
        known = n[words == END]
        rest = words != END
        words, n = np.insert(words[rest], 0, END), np.insert(n[rest], 0, known[0] if len(known) else 0)
    rank = np.arange(len(words))
    symbols = np.where(rank < shape.words, rank, shape.words)
    order = np.argsort(words)
    inside = min(len(words), shape.words)
    return Counts(words[order], n[order], symbols[order], int(np.flatnonzero(words == END)[0]), tokens, distinct, int(tokens - n[:inside].sum()), max(0, distinct - inside))


def look_up(counts: Counts, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each word among the frequent ones, and whether it is one."""
    at = np.minimum(np.searchsorted(counts.words, words), len(counts.words) - 1)
    return at, counts.words[at] == words


def symbols_of(counts: Counts, words: np.ndarray, outside: int) -> np.ndarray:
    at, there = look_up(counts, words)
    return np.where(there, counts.symbols[at], outside).astype(np.int32)


def trained(rows: DataFrame, counts: Broadcast, shape: Shape) -> Model:
    """Rounds over all training documents, each starting from the mean of the last round's weights."""
    known: Counts = counts.value
    lexicon = np.zeros(shape.words, np.int64)
    inside = known.symbols < shape.words
    lexicon[known.symbols[inside]] = known.counts[inside]
    model = Model.start(shape, lexicon, known.outside_tokens)
    context = rows.sparkSession.sparkContext
    part = 4096

    def mean(table: pa.Table) -> pa.Table:
        weight = table["tokens"].to_numpy().astype(float)
        values = np.stack([np.frombuffer(b, np.float32) for b in table["weights"].to_pylist()]).astype(float)
        return pa.table({"part": table["part"].slice(0, 1), "weights": pa.array([((weight / weight.sum()) @ values).astype(np.float32).tobytes()], pa.binary())})

    for turn in range(shape.rounds):
        shipped = context.broadcast(model.flat())

        def learn(batches, shipped=shipped, base=model):
            trainer = Trainer(base.with_flat(shipped.value.copy()))

            def work(table: pa.Table) -> pa.Table:
                c = counts.value
                texts = [symbols_of(c, w, shape.words) for w in _hashed(table["text"].cast(pa.binary()).to_pylist())]
                trainer.learn(texts, c.end)
                return pa.table({"text": pa.array([], pa.string())})

            for _ in in_chunks(work)(batches):
                pass
            if trainer.seen:
                flat = trainer.model.flat()
                parts = [flat[i : i + part].tobytes() for i in range(0, len(flat), part)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(parts)), pa.int32()), pa.array([trainer.seen] * len(parts), pa.int64()), pa.array(parts, pa.binary())], names=["part", "tokens", "weights"]
                )

        mine = rows.where(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(shape.rounds)) == turn).select("text")
        learned = mine.mapInArrow(learn, "part int, tokens long, weights binary")
        found = {r["part"]: r["weights"] for r in learned.groupBy("part").applyInArrow(mean, "part int, weights binary").collect()}
        if found:
            model = model.with_flat(np.concatenate([np.frombuffer(found[i], np.float32) for i in sorted(found)]))
    return model


_SCORED = (
    "key long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, "
    "bucket long, words binary, keys binary, ns binary"
)


def _scored(counts: Broadcast, weights: Broadcast, start: Model, buckets: int):
    """Scores but for rare words, and the rare words of each document, by bucket."""

    def work(table: pa.Table) -> pa.Table:
        c: Counts = counts.value
        model = start.with_flat(weights.value)
        shape, log_counts = model.shape, np.log10(c.counts + 1.0)
        texts, known, base, inside, rare_words, rare_rows = [], [], [], [], [], []
        for row, words in enumerate(_hashed(table["text"].cast(pa.binary()).to_pylist())):
            at, there = look_up(c, words)
            symbols = np.where(there, c.symbols[at], shape.words).astype(np.int32)
            texts.append(symbols)
            found = at[there]
            known.append(int((c.counts[found] > 0).sum()))
            base.append(float(log_counts[found].sum()))
            outside = symbols == shape.words
            spread = float(log_counts[at[outside & there]].sum())
            inside.append(spread - int(outside.sum()) * np.log10(c.outside_tokens + c.outside_distinct + 1.0))
            rare_words.append(words[~there])
            rare_rows.append(np.full(len(rare_words[-1]), row))
        logs = score(model, texts, c.end) / np.log(10) + np.array(inside) if texts else np.zeros(0)
        keys = table["key"].to_numpy()
        n = [len(t) for t in texts]
        out = [(*r, None, None, None, None) for r in zip(keys.tolist(), table["doc_id"].to_pylist(), table["held_out"].to_pylist(), n, known, base, logs.tolist(), strict=True)]
        if rare_words:
            word, row = np.concatenate(rare_words), np.concatenate(rare_rows)
            order = np.lexsort((row, word))
            word, row = word[order], row[order]
            first = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (row[1:] != row[:-1]))[: len(word)])
            count = np.diff(np.append(first, len(word)))
            word, row = word[first], row[first]
            bucket = (mix(word) % np.uint64(buckets)).astype(np.int64)
            out += [(None,) * 7 + r for r in _split(bucket, word, keys[row], count.astype(np.int32))]
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()] + [pa.binary()] * 3
        columns = list(zip(*out, strict=True)) or [[] for _ in kinds]
        names = [x.split()[0] for x in _SCORED.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return work


_ANSWER = "part long, keys binary, logs binary, knowns binary"


def _answer(parts: int):
    """Log counts of the rare words asked for in a bucket, summed by document: a row for each part of the documents."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        words, keys, ns = _read(left, "words", np.uint64), _read(left, "keys", np.int64), _read(left, "ns", np.int32)
        known, counts = _read(right, "words", np.uint64), _read(right, "counts", np.int64)
        c = np.zeros(len(words))
        if len(known) and len(words):
            at = np.minimum(np.searchsorted(known, words), len(known) - 1)
            c = np.where(known[at] == words, counts[at], 0)
        key, at = np.unique(keys, return_inverse=True)
        logs = np.bincount(at, ns * np.log10(c + 1.0), len(key))
        knowns = np.bincount(at, ns * (c > 0), len(key)).astype(np.int64)
        part = (mix(key.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        columns = list(zip(*_split(part, key, logs, knowns), strict=True)) or [[] for _ in range(4)]
        kinds = [pa.int64()] + [pa.binary()] * 3
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "keys", "logs", "knowns"])

    return work


def _read(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(b, kind) for b in table[name].to_pylist())])


def _by_document(table: pa.Table) -> pa.Table:
    """The answers of all buckets to a part of the documents, summed by document."""
    key, at = np.unique(_read(table, "keys", np.int64), return_inverse=True)
    return pa.table(
        {
            "key": pa.array(key, pa.int64()),
            "rare_log": pa.array(np.bincount(at, _read(table, "logs", np.float64), len(key)), pa.float64()),
            "rare_known": pa.array(np.bincount(at, _read(table, "knowns", np.int64), len(key)).astype(np.int64), pa.int64()),
        }
    )


def score_documents(docs: DataFrame, shape: Shape = Shape(), training: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Scores are log10 probabilities of whole texts.  Without ``training`` the rows
    whose crc32 of the id as text leaves 2 modulo 7 are held out; a null id counts
    as the empty text, and trains.  Null and empty texts are one end.  Rows with
    repeated ids are scored one by one.  Without training rows every count is
    zero and the model keeps its first weights.  Other columns are not read.
    """
    learns = is_training(F.col("doc_id")) if training is None else training
    rows = keyed(docs).withColumn("held_out", ~learns)
    context = rows.sparkSession.sparkContext
    n_bytes = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    buckets = int(n_bytes // BUCKET_BYTES + 1)
    train = rows.where(~F.col("held_out"))
    table = write_table(count_words(train, buckets), "word-counts")
    known = frequent(table, shape)
    counts = context.broadcast(known)
    model = trained(train, counts, shape)
    weights = context.broadcast(model.flat())
    scored = rows.select("key", "doc_id", "held_out", "text").mapInArrow(in_chunks(_scored(counts, weights, model, buckets)), _SCORED)
    scored = write_table(scored, "scored")
    asked = scored.where("bucket is not null").select("bucket", "words", "keys", "ns").groupBy("bucket")
    answers = asked.cogroup(table.select("bucket", "words", "counts").groupBy("bucket")).applyInArrow(_answer(buckets), _ANSWER)
    rare = answers.groupBy("part").applyInArrow(_by_document, "key long, rare_log double, rare_known long")
    each = scored.where("bucket is null").join(rare, "key", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return each.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + rare_log - F.col("n_tokens") * F.lit(float(np.log10(known.tokens + known.distinct + 1)))).alias("base_score"),
        (F.col("score") + rare_log).alias("score"),
    )
