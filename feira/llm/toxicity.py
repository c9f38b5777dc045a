"""Toxicity scores by a convolutional text classifier, trained here in numpy.

A word is the mean of the embeddings of its hash and of the hashes of its first bytes, so
that inflected forms share what they have in common. Filters of several widths run over
the words of the whole text, the maximum of each filter is pooled, and a logistic unit
turns the pooled values into a probability. Text is all that a score sees.

The classifier is fitted to all labelled rows, where they lie. In each pass every task takes its
own gradient steps over its rows, from the same numbers; what the tasks changed is averaged, and
the driver, which holds the model alone, sends out the result for the next pass. Rows that were
kept out of the fit, all of them, then calibrate its probabilities and a threshold for each
language.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.llm.text import Words, map_arrow, slices, words
from feira.plans.tables import staged

BUCKETS = 1 << 16
SIZE = 8  # numbers in an embedding
PREFIXES = (3, 4, 5, 6)  # bytes
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
EPOCHS = 8
FITTED_BYTES = 1 << 20  # of text whose order is mixed, or one longer text
TASK_BYTES = 128 << 20  # of text that a task fits to in a pass
FEW_TASKS, FEW_BYTES = 8, 16 << 20  # so many tasks share less text, if each has that much
BLOCK = 1024  # rows of numbers that are averaged at once
BATCH = 50
RATE = 0.05
NEUTRAL = 10
CALIBRATION = 5  # one row in so many calibrates
NEWTON = 30  # steps of the calibration, at most
THRESHOLD = 0.3
GRID = np.round(np.arange(0.1, 0.91, 0.05), 2)
#: What follows the embedding in an array of all numbers of a model.
REST = [*[(k, FILTERS, SIZE) for k in WIDTHS], *[(len(WIDTHS), FILTERS)] * 2, (1,)]
ROWS = BUCKETS + math.ceil(sum(map(math.prod, REST)) / SIZE)
MESSAGE = "block int, task int, weight double, places binary, numbers binary"


@dataclass
class Model:
    embedding: np.ndarray  # (BUCKETS, SIZE)
    filters: list[np.ndarray]  # of each width: (width, FILTERS, SIZE)
    biases: np.ndarray  # (widths, FILTERS)
    out: np.ndarray  # (widths, FILTERS)
    offset: float | np.ndarray
    scale: float = 1.0  # calibration: probability = logistic(scale * logit + shift)
    shift: float = 0.0
    constant: float | None = None  # score of every text, if there was nothing to learn
    thresholds: dict[str, float] = field(default_factory=dict)


def buckets(w: Words) -> np.ndarray:
    """(features, words): embedding rows of each word."""
    kinds = [w.hashes, *[w.prefixes(n) for n in PREFIXES]]
    salted = [(h + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48) for k, h in enumerate(kinds)]
    return np.stack(salted).astype(np.int64)


PAD = max(WIDTHS)  # no filter that starts in a text, or just behind it, reaches the next


def padded(rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with PAD rows of -1 after each text, and where each text begins and ends, its
    first row of padding included."""
    count = np.diff(first)
    starts = first[:-1] - first[0] + PAD * np.arange(len(count))
    out = np.full((rows.shape[0], int(count.sum()) + PAD * len(count)), -1, np.int64)
    out[:, np.arange(int(count.sum())) + PAD * np.repeat(np.arange(len(count)), count)] = rows
    return out, np.stack([starts, starts + count + 1], axis=1)


def embed(model: Model, rows: np.ndarray) -> np.ndarray:
    x = model.embedding.take(rows[0], axis=0, mode="clip")
    for r in rows[1:]:
        x += model.embedding.take(r, axis=0, mode="clip")
    x *= np.float32(1 / len(rows))
    x[rows[0] < 0] = 0
    return x


def responses(model: Model, x: np.ndarray) -> Iterator[np.ndarray]:
    """For each width the filters' values (FILTERS, words)."""
    parts = np.concatenate(model.filters).reshape(-1, SIZE) @ x.T
    for width, bias in zip(WIDTHS, model.biases):
        y, *rest = parts[:width * FILTERS].reshape(width, FILTERS, -1)
        parts = parts[width * FILTERS:]
        y += bias[:, None]
        for k, more in enumerate(rest, 1):
            y[:, :-k] += more[:, k:]
        yield y


def pooled(model: Model, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(texts, widths, FILTERS)"""
    # Every second segment is the padding between two texts.
    return np.stack(
        [np.maximum.reduceat(y, bounds.ravel(), axis=1)[:, ::2].T for y in responses(model, x)], axis=1
    )


def logits(model: Model, pool: np.ndarray) -> np.ndarray:
    return np.einsum("twf,wf->t", np.maximum(pool, 0), model.out) + model.offset


def score_slice(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    if model.constant is not None:
        return np.full(n, model.constant)
    w = words(data, offsets)
    rows, bounds = padded(buckets(w), w.first)
    z = logits(model, pooled(model, embed(model, rows), bounds))
    return 1 / (1 + np.exp(-np.clip(model.scale * z + model.shift, -50, 50).astype(np.float64)))


def shaped(numbers: np.ndarray) -> Model:
    """The model whose numbers are those of an array (ROWS, SIZE); it shares their memory."""
    rest, found = numbers[BUCKETS:].reshape(-1), []
    for shape in REST:
        found.append(rest[:math.prod(shape)].reshape(shape))
        rest = rest[math.prod(shape):]
    *filters, biases, out, offset = found
    return Model(numbers[:BUCKETS], filters, biases, out, offset)


def log_odds(seen: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """For each bucket how much more often texts of class 1 hold it, as log odds, smoothed
    by NEUTRAL texts of either class in their proportion. seen: (2, BUCKETS) texts of each class
    that hold a bucket; texts: those of each class."""
    share = texts[:, None] / texts.sum()
    seen = seen + NEUTRAL * share
    return np.log(seen[1] / share[1]) - np.log(seen[0] / share[0])


def started(odds: np.ndarray, seed: int = 7) -> np.ndarray:
    """The numbers that the fit starts from."""
    rng = np.random.default_rng(seed)
    numbers = np.zeros((ROWS, SIZE), np.float32)
    model = shaped(numbers)
    model.embedding[:] = rng.normal(0, 0.05, (BUCKETS, SIZE))
    # The first number starts as the bucket's log odds, and one filter of each width reads it.
    model.embedding[:, 0] = odds
    for f in model.filters:
        f[:] = rng.normal(0, 0.3, f.shape)
        f[:, 0] = 0
        f[:, 0, 0] = 1
    model.out[:] = rng.normal(0, 0.1, model.out.shape)
    return numbers


def descend(model: Model, squares: Model, data_rows: list[np.ndarray], y: np.ndarray) -> None:
    """One gradient step over some texts, with rates adapted to each number."""

    def step(value, s, gradient, at=slice(None)):
        s[at] += gradient**2
        value[at] -= RATE * gradient / np.sqrt(s[at])

    shape = model.biases.shape
    rows, bounds = padded(
        np.concatenate(data_rows, axis=1), np.cumsum([0, *[r.shape[1] for r in data_rows]])
    )
    x = embed(model, rows)
    tops = np.empty((len(y), *shape), np.int64)
    pool = np.empty((len(y), *shape), np.float32)
    for k, v in enumerate(responses(model, x)):
        for t, (lo, hi) in enumerate(bounds):
            tops[t, k] = lo + v[:, lo:hi].argmax(axis=1)
            pool[t, k] = v[np.arange(FILTERS), tops[t, k]]
    p = 1 / (1 + np.exp(-np.clip(logits(model, pool), -30, 30)))
    error = ((p - y) / len(y)).astype(np.float32)
    active = np.maximum(pool, 0)
    g_pool = error[:, None, None] * model.out * (pool > 0)
    g_out = np.einsum("t,twf->wf", error, active) + 1e-4 * model.out
    g_x = {}
    for k, width in enumerate(WIDTHS):
        g_f = np.zeros_like(model.filters[k])
        for j in range(width):
            at = tops[:, k] + j
            g_f[j] = np.einsum("tf,tfs->fs", g_pool[:, k], x[at])
            g_x[k, j] = (at, g_pool[:, k][..., None] * model.filters[k][j])
        step(model.filters[k], squares.filters[k], g_f + 1e-4 * model.filters[k])
    step(model.biases, squares.biases, g_pool.sum(0))
    step(model.out, squares.out, g_out)
    model.offset -= np.float32(0.1) * error.sum()
    at = np.concatenate([a.ravel() for a, _ in g_x.values()])
    g = np.concatenate([v.reshape(-1, SIZE) for _, v in g_x.values()])
    real = (rows[0, at] >= 0) & (np.abs(g).sum(1) > 0)
    touched, where = np.unique(rows[:, at[real]], return_inverse=True)
    if len(touched):
        total = np.zeros((len(touched), SIZE), np.float32)
        np.add.at(total, where.reshape(len(rows), -1), g[real][None] / len(rows))
        step(model.embedding, squares.embedding, total, touched)


def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """(buckets of each text, classes) of batches of (text, class), a slice at a time."""
    for batch in batches:
        labels = batch.column(1).to_numpy(zero_copy_only=False)
        for low, high, data, offsets in slices(batch.column(0), FITTED_BYTES):
            w = words(data, offsets)
            b = buckets(w)
            yield [b[:, lo:hi] for lo, hi in zip(w.first[:-1], w.first[1:])], labels[low:high]


def messages(numbers: np.ndarray, used: np.ndarray, weight: float) -> Iterator[pa.RecordBatch]:
    """The used rows of an array, in blocks."""
    task, names = TaskContext.get().partitionId(), [c.split()[0] for c in MESSAGE.split(", ")]
    for block in range(math.ceil(len(numbers) / BLOCK)):
        places = np.flatnonzero(used[block * BLOCK:(block + 1) * BLOCK])
        if len(places):
            yield pa.RecordBatch.from_arrays([
                pa.array([block], pa.int32()), pa.array([task], pa.int32()), pa.array([weight], pa.float64()),
                pa.array([places.astype(np.int32).tobytes()]), pa.array([numbers[block * BLOCK + places].tobytes()]),
            ], names)


def averaged(sent: DataFrame, shape: tuple[int, int], mean: bool = True) -> np.ndarray:
    """The weighted mean of each row over the tasks that sent it, or the sum; 0 if none did.

    Blocks are added up by tasks, in the order of the tasks that sent them; the driver gets one
    array of the shape.
    """
    width = shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, weights = None, np.empty(0), np.empty(0)

        def done() -> pa.RecordBatch:
            found = total / np.maximum(weights, 1e-300)[:, None] if mean else total
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), pa.array([found.astype(np.float32 if mean else np.float64).tobytes()])],
                ["block", "numbers"],
            )

        for batch in batches:
            for block, _, weight, places, numbers in zip(*[c.to_pylist() for c in batch.columns]):
                if block != now:
                    if now is not None:
                        yield done()
                    now, total, weights = block, np.zeros((BLOCK, width)), np.zeros(BLOCK)
                at = np.frombuffer(places, np.int32)
                total[at] += np.frombuffer(numbers, np.float32).reshape(-1, width) * (weight if mean else 1)
                weights[at] += weight
        if now is not None:
            yield done()

    blocks = sent.repartition("block").sortWithinPartitions("block", "task")
    out = np.zeros((math.ceil(shape[0] / BLOCK) * BLOCK, width), np.float32 if mean else np.float64)
    for r in map_arrow(blocks, add, "block int, numbers binary").collect():
        out[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = np.frombuffer(r["numbers"], out.dtype).reshape(-1, width)
    return out[:shape[0]]


def buckets_seen(rows: DataFrame) -> np.ndarray:
    """(2, BUCKETS): how many texts of each class hold a bucket, of rows of (text, class)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((BUCKETS, 2), np.float32)
        n = 0
        for data_rows, y in texts_of(batches):
            for r, label in zip(data_rows, y):
                seen[np.unique(r), label] += 1
            n += len(y)
            if n >= 1 << 23:  # far below where such a number stops counting
                yield from messages(seen, seen.any(axis=1), 1.0)
                seen[:], n = 0, 0
        yield from messages(seen, seen.any(axis=1), 1.0)

    return averaged(map_arrow(rows, count, MESSAGE), (BUCKETS, 2), mean=False).T


def fit(rows: DataFrame, texts: np.ndarray, seed: int = 7) -> Model:
    """The classifier fitted to rows of (text, class) by stochastic gradient steps. texts: how
    many there are of each class; each partition is one task's."""
    numbers = started(log_odds(buckets_seen(rows), texts), seed)
    squares = np.full((ROWS, SIZE), 1e-3, np.float32)
    for epoch in range(EPOCHS):
        shared = rows.sparkSession.sparkContext.broadcast((numbers, squares))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rng = np.random.default_rng([seed, epoch, TaskContext.get().partitionId()])
            own, own_squares = (a.copy() for a in shared.value)
            model, model_squares, n = shaped(own), shaped(own_squares), 0
            for data_rows, y in texts_of(batches):
                for some in np.array_split(rng.permutation(len(y)), math.ceil(len(y) / BATCH)):
                    descend(model, model_squares, [data_rows[i] for i in some], y[some])
                n += len(y)
            if n:
                change = np.concatenate([own - shared.value[0], own_squares - shared.value[1]], axis=1)
                yield from messages(change, change.any(axis=1), float(n))

        change = averaged(map_arrow(rows, run, MESSAGE), (ROWS, 2 * SIZE))
        shared.destroy()
        numbers, squares = numbers + change[:, :SIZE], squares + change[:, SIZE:]
    model = shaped(numbers)
    model.offset = float(model.offset[0])
    return model


def probability(z: Column, scale: float, shift: float, most: int = 50) -> Column:
    z = F.lit(scale) * z + F.lit(shift)
    return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(float(most))), F.lit(float(-most)))))


def calibrate(model: Model, rows: DataFrame) -> None:
    """Fit scale and shift to rows of (_z, _y, _weight) by Newton steps; a prior keeps them near
    1 and 0. Each step is one aggregate over all rows."""
    a = np.array([1.0, 0.0])
    z, w = F.col("_z"), F.col("_weight")
    for _ in range(NEWTON):
        p = probability(z, float(a[0]), float(a[1]), 30)
        d, h = w * (p - F.col("_y")), w * p * (1 - p) + F.lit(1e-9)
        sums = rows.agg(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in (d * z, d, h * z * z, h * z, h)]).first()
        gradient = np.array([sums[0] + (a[0] - 1), sums[1] + 0.1 * a[1]])
        hessian = np.array([[sums[2] + 1, sums[3]], [sums[3], sums[4] + 0.1]])
        step = np.clip(np.linalg.solve(hessian, gradient), -1, 1)
        a = a - step
        if np.abs(step).max() < 1e-9:
            break
    model.scale, model.shift = float(max(a[0], 0.05)), float(a[1])


def thresholds(model: Model, rows: DataFrame) -> dict[str, float]:
    """For each language the cut with the fewest weighted errors; of equals, the nearest to
    THRESHOLD. rows: (_z, _y, _weight, _lang)."""
    score = probability(F.col("_z"), model.scale, model.shift)
    wrong = [F.sum(F.when((score >= t) != (F.col("_y") == 1), F.col("_weight")).otherwise(0.0)) for t in GRID.tolist()]
    found = rows.where(F.col("_lang") != "").groupBy("_lang").agg(*wrong).collect()  # one row of each language
    return {lang: float(min(zip(errors, np.abs(GRID - THRESHOLD), GRID))[2]) for lang, *errors in found}


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", column: str = "text",
    label: str = "toxic", lang: str = "lang",
) -> Model:
    """A classifier from all labelled documents, whole texts.

    labels may repeat a key (the highest label counts) and hold nulls (skipped); of documents
    that repeat a key the smallest text counts. The labelled rows are written to the shared
    folder once; each pass reads them there. Without rows of both classes every text gets the
    share of class 1 as its score, 0 if there are no labels.
    """
    by_key = labels.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{label}`").cast("int").alias("_y")).where(
        F.col("_key").isNotNull() & F.col("_y").isin(0, 1)
    ).groupBy("_key").agg(F.max("_y").alias("_y"))
    counts = {r["_y"]: r["n"] for r in by_key.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return Model(*[np.empty(0)] * 4, 0.0, constant=float(1 in counts))
    language = F.col(f"`{lang}`") if lang in docs.columns else F.lit(None)
    found = docs.select(
        F.col(f"`{key}`").alias("_key"), F.coalesce(F.col(f"`{column}`"), F.lit("")).alias("_text"),
        language.cast("string").alias("_lang"),
    ).join(by_key, "_key").groupBy("_key").agg(
        F.min(F.struct("_text", "_lang")).alias("_row"), F.max("_y").alias("_y")
    )
    rows = staged(found.select(
        "_row._text", "_y", "_row._lang", (F.pmod(F.xxhash64("_key"), F.lit(CALIBRATION)) == 0).alias("_kept_out"),
        F.octet_length("_row._text").cast("long").alias("_bytes"),
    ), "toxicity-labelled")
    sizes = rows.groupBy("_y", "_kept_out").agg(F.count(F.lit(1)).alias("n"), F.sum("_bytes").alias("bytes")).collect()
    matched = np.array([sum(r["n"] for r in sizes if r["_y"] == y) for y in (0, 1)], np.float64)
    share = counts[1] / (counts[0] + counts[1])
    if not matched.all():
        return Model(*[np.empty(0)] * 4, 0.0, constant=share)
    fitted, own = rows.where(~F.col("_kept_out")), [r for r in sizes if not r["_kept_out"]]
    if len(own) < 2:  # too few rows to keep some out
        fitted, own = rows, sizes
    texts = np.array([sum(r["n"] for r in own if r["_y"] == y) for y in (0, 1)], np.float64)
    size = sum(r["bytes"] for r in own)
    tasks = max(math.ceil(size / TASK_BYTES), min(math.ceil(size / FEW_BYTES), FEW_TASKS), 1)
    model = fit(fitted.select("_text", "_y").coalesce(tasks), texts)
    # Each class weighs as much as it has rows among all that are labelled.
    weight = np.array([1 - share, share]) * matched.sum() / matched
    scored = score(rows.where("_kept_out").select("_text", "_y", "_lang"), model, "_text", "_p")
    p = F.greatest(F.least("_p", F.lit(1 - 1e-12)), F.lit(1e-12))
    odds = staged(scored.select(
        F.log(p / (1 - p)).alias("_z"), "_y", "_lang",
        F.when(F.col("_y") == 1, float(weight[1])).otherwise(float(weight[0])).alias("_weight"),
    ), "toxicity-calibration")
    calibrate(model, odds)
    model.thresholds = thresholds(model, odds)
    return model


def score(docs: DataFrame, model: Model, column: str = "text", name: str = "score") -> DataFrame:
    """docs with the score of each whole text as the last column, in place of one of its name.

    A null text scores as an empty one; a very long one is scored by itself, all its words;
    repeated rows score each; other columns pass through. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c.lower() != name]
    carried = docs.select(*[F.col(f"`{c}`") for c in kept])
    at, schema = kept.index(column), T.StructType([*carried.schema, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [score_slice(shared.value, d, o) for _, _, d, o in slices(batch.column(at))]
            scores = np.concatenate(scores) if scores else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], schema.names)

    return map_arrow(carried, run, schema)


def remove_toxic(docs: DataFrame, model: Model, column: str = "text", lang: str = "lang") -> DataFrame:
    """docs without those whose score reaches their language's threshold."""
    own = [f"c{i}" for i in range(len(docs.columns))]  # clear of the name of the score
    scored = score(docs.toDF(*own), model, own[docs.columns.index(column)])
    language = F.col(own[docs.columns.index(lang)]) if lang in docs.columns else F.lit(None).cast("string")
    return scored.where(~rejected(model, language, F.col("score"))).select(*own).toDF(*docs.columns)


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def rejected(model: Model, lang: Column, score: Column) -> Column:
    """Whether a score reaches the threshold of the row's language."""
    if not model.thresholds:
        return score >= THRESHOLD
    table = F.create_map(*[F.lit(x) for pair in sorted(model.thresholds.items()) for x in pair])
    return score >= F.coalesce(F.try_element_at(table, F.coalesce(lang, F.lit(""))), F.lit(THRESHOLD))
