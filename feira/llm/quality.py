"""Quality scores by a sparse ensemble of rules over statistics of a text.

Statistics (shares of kinds of characters, repetition of words and lines, lengths) are
computed in the tasks from whole texts. Small boosted trees are grown on the statistics of a
bounded sample of labelled rows; every path from a root to a node is a rule, a conjunction of
bounds on statistics. A logistic model over all rules is fitted under a lasso penalty, which
leaves few of them, and compiled into one Spark column expression over the statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.llm.text import IS_WORD, Words, free_name, map_arrow, mix, slices, words

SAMPLE = 5000  # labelled rows of either class whose statistics are fitted to, at most
SLICE = 1 << 17  # bytes of texts handled at once, or one longer text
TREES = 24
DEPTH = 3
CUTS = 32  # candidate bounds of a statistic
LEAST = 0.004  # share of the sample's weight that a node must have
RATE = 0.3
PENALTIES = (0.03, 0.01, 0.003, 0.001, 0.0003)
STEPS = 400
VALIDATION = 5  # one row in so many chooses the penalty
THRESHOLD = 0.3

_CODES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "marks": b".,;:?'\"()-",
    "symbols": b"!#$%&*+/<=>@[\\]^_`{|}~", "spaces": b" \t\n\r",
}
STATISTICS = (
    "words", "word_bytes", "longest_word", *_CODES, "distinct_words", "repeated_words",
    "distinct_pairs", "lines", "line_words", "distinct_lines",
)

Rule = tuple[tuple[int, float, float], ...]  # (statistic, above, at most) for each it bounds


@dataclass
class Model:
    rules: list[Rule] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    offset: float = 0.0


def distinct(keys: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """How many different keys each of n texts has."""
    if not len(keys):
        return np.zeros(n, np.int64)
    order = np.argsort(keys)
    order = order[np.argsort(text[order], kind="stable")]
    keys, text = keys[order], text[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    return np.bincount(text[new], minlength=n)


def lines_of(w: Words, text: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of each line with words."""
    if not len(text):
        return np.empty(0, np.uint64), text
    line = np.searchsorted(np.flatnonzero(data == 0x0A), w.starts)
    begins = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (text[1:] != text[:-1])]))
    place = np.arange(len(line)) - np.repeat(begins, np.diff(np.append(begins, len(line))))
    placed = mix(w.hashes + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.add.reduceat(placed, begins), text[begins]


def statistics_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The statistics of a slice of texts (UTF-8 bytes), one row each; all 0 without words."""
    n, w = len(offsets) - 1, words(data, offsets)
    count = np.diff(w.first)
    text = np.repeat(np.arange(n), count)
    some = np.maximum(count, 1)
    size = (w.ends - w.starts).astype(np.int64)

    def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return np.diff(total[bounds])

    letters = np.maximum(sums(IS_WORD[data], offsets), 1)
    kinds = {}
    for name, codes in _CODES.items():
        member = np.zeros(256, bool)
        member[list(codes)] = True
        kinds[name] = sums(member[data], offsets) / letters
    again = np.zeros(len(text), bool)
    again[1:] = (w.hashes[1:] == w.hashes[:-1]) & (text[1:] == text[:-1])
    pairs = np.flatnonzero(text[1:] == text[:-1])
    pair_keys = mix(w.hashes[pairs] * np.uint64(3) + w.hashes[pairs + 1])
    line, line_text = lines_of(w, text, data)
    lines = np.bincount(line_text, minlength=n)
    longest = np.zeros(n)
    np.maximum.at(longest, text, size)
    found = {
        "words": count, "word_bytes": sums(size, w.first) / some, "longest_word": longest, **kinds,
        "distinct_words": distinct(w.hashes, text, n) / some,
        "repeated_words": sums(again, w.first) / some,
        "distinct_pairs": distinct(pair_keys, text[pairs], n) / np.maximum(count - 1, 1),
        "lines": lines, "line_words": count / np.maximum(lines, 1),
        "distinct_lines": distinct(line, line_text, n) / np.maximum(lines, 1),
    }
    out = np.stack([np.asarray(found[s], np.float64) for s in STATISTICS], axis=1)
    out[count == 0] = 0
    return out


def statistics(docs: DataFrame, column: str = "text", name: str = "statistics") -> DataFrame:
    """docs with a struct of STATISTICS in place of the text; see `score` for odd rows."""
    kept = [c for c in docs.columns if c != column and c.lower() != name]
    carried = docs.select(
        *[F.col(f"`{c}`") for c in kept], F.col(f"`{column}`").alias(free_name(kept, "_text"))
    )
    struct = T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS])
    schema = T.StructType([*carried.schema[:-1], T.StructField(name, struct)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics_of(d, o) for _, _, d, o in slices(batch.column(batch.num_columns - 1), SLICE)]
            table = np.concatenate([np.empty((0, len(STATISTICS))), *rows])
            values = [pa.array(np.ascontiguousarray(c)) for c in table.T]
            struct = pa.StructArray.from_arrays(values, list(STATISTICS))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], struct], schema.names)

    return map_arrow(carried, run, schema)


def candidates(x: np.ndarray) -> list[np.ndarray]:
    """Bounds to try for each statistic: between different neighbours of its quantiles."""
    out = []
    for values in x.T:
        q = np.unique(np.quantile(values, np.linspace(0, 1, CUTS + 1)))
        out.append((q[1:] + q[:-1]) / 2)
    return out


def grow(
    x: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, curvature: np.ndarray, weight: np.ndarray,
) -> list[tuple[dict[int, tuple[float, float]], float]]:
    """The nodes of a tree that follows the gradient: (bounds of its path, step), root first."""
    nodes = []

    def split(own: np.ndarray, path: dict[int, tuple[float, float]], depth: int) -> None:
        g, h = gradient[own].sum(), curvature[own].sum()
        nodes.append((path, -g / (h + 1e-3), depth == DEPTH))
        if depth == DEPTH:
            return
        best = (1e-6, None)
        for s, bounds in enumerate(cuts):
            if not len(bounds):
                continue
            slot = np.searchsorted(bounds, x[own, s], "left")  # values at most a bound lie below it
            size = len(bounds) + 1
            gl = np.cumsum(np.bincount(slot, gradient[own], size))[:-1]
            hl = np.cumsum(np.bincount(slot, curvature[own], size))[:-1]
            wl = np.cumsum(np.bincount(slot, weight[own], size))[:-1]
            gain = gl**2 / (hl + 1e-3) + (g - gl) ** 2 / (h - hl + 1e-3) - g**2 / (h + 1e-3)
            gain[(wl < LEAST) | (weight[own].sum() - wl < LEAST)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), (s, float(bounds[k])))
        if best[1] is None:
            nodes[-1] = (*nodes[-1][:2], True)
            return
        s, bound = best[1]
        low, high = path.get(s, (-np.inf, np.inf))
        below = x[own, s] <= bound
        split(own[below], {**path, s: (low, min(high, bound))}, depth + 1)
        split(own[~below], {**path, s: (max(low, bound), high)}, depth + 1)

    split(np.arange(len(x)), {}, 0)
    return nodes


def as_rule(path: dict[int, tuple[float, float]]) -> Rule:
    return tuple((s, *path[s]) for s in sorted(path))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for s, above, most in rule:
        out &= (x[:, s] > above) & (x[:, s] <= most)
    return out


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def loss(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    return float((weight * (np.logaddexp(0, z) - y * z)).sum() / weight.sum())


def boosted_rules(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[Rule]:
    """The different paths of boosted trees."""
    cuts, rules = candidates(x), {}
    share = float((weight * y).sum() / weight.sum())
    z, unit = np.full(len(x), np.log(share / (1 - share))), weight / weight.sum()
    for _ in range(TREES):
        p = logistic(z)
        for path, step, leaf in grow(x, cuts, unit * (p - y), unit * p * (1 - p), unit):
            if path:
                rules[as_rule(path)] = None
            if leaf:
                z[holds(as_rule(path), x)] += RATE * np.clip(step, -4, 4)
    return list(rules)


def lasso(
    a: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, start: np.ndarray,
) -> np.ndarray:
    """Weights (the offset last, unpenalized) of a logistic model on the columns of a, each
    penalized by its scale, by accelerated proximal gradient steps."""
    unit = weight / weight.sum()
    bound = 0.25 * np.linalg.norm(a * np.sqrt(unit)[:, None], 2) ** 2 + 1e-9
    cost = np.append(np.full(a.shape[1] - 1, penalty), 0.0)
    b, ahead, t = start.copy(), start.copy(), 1.0
    for _ in range(STEPS):
        step = ahead - a.T @ (unit * (logistic(a @ ahead) - y)) / bound
        new = np.sign(step) * np.maximum(np.abs(step) - cost / bound, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - b)
        if np.abs(new - b).max() < 1e-6:
            b = new
            break
        b, t = new, t_new
    return b


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Model:
    """The ensemble for statistics x (rows), labels y (0, 1) and row weights."""
    kept_out = np.arange(len(y)) % VALIDATION == 0
    fitted = ~kept_out
    if len(set(y[fitted].tolist())) < 2 or len(set(y[kept_out].tolist())) < 2:
        fitted = kept_out = np.ones(len(y), bool)
    rules = boosted_rules(x[fitted], y[fitted], weight[fitted])
    if not rules:
        share = float((weight * y).sum() / weight.sum())
        return Model(offset=float(np.log(share / (1 - share))))
    a = np.stack([holds(r, x) for r in rules], axis=1).astype(np.float64)
    scale = np.maximum(np.sqrt((weight[:, None] * (a - a.mean(0)) ** 2).sum(0) / weight.sum()), 0.02)
    a = np.column_stack([a / scale, np.ones(len(x))])
    b, best, chosen = np.zeros(a.shape[1]), None, None
    for penalty in PENALTIES:  # from sparse to dense, each from the one before
        b = lasso(a[fitted], y[fitted], weight[fitted], penalty, b)
        off = loss(a[kept_out] @ b, y[kept_out], weight[kept_out])
        if best is None or off < best * 0.99:
            best, chosen = off, b
    used = np.flatnonzero(chosen[:-1])
    return Model([rules[i] for i in used], [float(chosen[i] / scale[i]) for i in used], float(chosen[-1]))


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", column: str = "text",
    label: str = "quality", sample: int = SAMPLE,
) -> Model:
    """An ensemble from the labelled documents.

    labels may repeat a key (the highest label counts) and hold nulls (skipped). Of each
    class, the `sample` keys of smallest hash are fitted to, whole texts; only their statistics
    reach the driver. Each class weighs as much as it has among all labels. Without rows of
    both classes every text gets the share of class 1, 0.5 if there are no labels.
    """
    by_key = labels.select(
        F.col(f"`{key}`").alias("_key"), F.col(f"`{label}`").cast("int").alias("_y")
    ).where(F.col("_key").isNotNull() & F.col("_y").isin(0, 1)).groupBy("_key").agg(F.max("_y").alias("_y"))
    counts = {r["_y"]: r["n"] for r in by_key.groupBy("_y").agg(F.count("*").alias("n")).collect()}

    def constant() -> Model:
        share = np.clip(counts.get(1, 0) / max(sum(counts.values()), 1), 1e-6, 1 - 1e-6) if counts else 0.5
        return Model(offset=float(np.log(share / (1 - share))))

    if len(counts) < 2:
        return constant()
    first = [by_key.where(F.col("_y") == y).orderBy(F.xxhash64("_key"), "_key").limit(sample) for y in (0, 1)]
    chosen = first[0].unionByName(first[1])  # at most 2 * sample rows
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{column}`").alias("_text")).join(
        F.broadcast(chosen), "_key"
    )
    found = statistics(rows, "_text").dropDuplicates(["_key"]).collect()
    found.sort(key=lambda r: repr(r["_key"]))
    y = np.array([r["_y"] for r in found], np.int64)
    if len(set(y.tolist())) < 2:
        return constant()
    x = np.array([tuple(r["statistics"]) for r in found], np.float64)
    share = counts[1] / (counts[0] + counts[1])
    weight = np.where(y == 1, share / (y == 1).mean(), (1 - share) / (y == 0).mean())
    return fit(x, y, weight)


def compiled(model: Model, name: str = "statistics") -> Column:
    """The probability of label 1 as an expression over the struct of statistics."""
    z = F.lit(model.offset)
    for rule, weight in zip(model.rules, model.weights):
        conditions = []
        for s, above, most in rule:
            value = F.col(name)[STATISTICS[s]]
            conditions += [value > above] * bool(np.isfinite(above)) + [value <= most] * bool(np.isfinite(most))
        both = conditions[0]
        for more in conditions[1:]:
            both = both & more
        z = z + F.when(both, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-z))


def described(model: Model) -> list[str]:
    """The rules as text, strongest first."""
    def bounds(rule: Rule) -> str:
        return " and ".join(
            (f"{above:.4g} < " if np.isfinite(above) else "") + STATISTICS[s]
            + (f" <= {most:.4g}" if np.isfinite(most) else "")
            for s, above, most in rule
        )

    ranked = sorted(zip(model.weights, model.rules), key=lambda p: -abs(p[0]))
    return [f"{weight:+.3f} if {bounds(rule)}" for weight, rule in ranked]


def score(docs: DataFrame, model: Model, column: str = "text", name: str = "score") -> DataFrame:
    """docs with the score of each whole text as the last column, in place of the text and of a
    column of its name.

    A null text scores as an empty one: all its statistics are 0, as are those of a text without
    words. Very long texts are slices of their own. Repeated rows score each; other columns,
    but for one named like the score, pass through. An empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c == column or c.lower() != name.lower()]
    own = free_name(kept, "_statistics")
    found = statistics(docs.select(*[F.col(f"`{c}`") for c in kept]), column, own)
    return found.withColumn(name, compiled(model, own)).drop(own)


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0
