"""Quality of documents by a linear-chain conditional random field over their lines.

Every line is good or bad. What speaks for either are features of the line and of the lines before and after it, and
the labels of neighbouring lines. A training document's label is taken for all of its lines. A document's quality is
the mean probability of its lines to be good (forward-backward marginals), weighted by their lengths, brought to a
probability by a logistic curve.

The model is fitted on the driver from a bounded sample of labelled documents: at most ``SAMPLE_DOCS`` per label, chosen
by a hash of their id, of which a window of at most ``SAMPLE_LINES`` lines each is looked at. It has about a hundred numbers and
goes to the executors with the job; every document is scored where it lies, over all its lines.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlift.llm.arrow_rows import text_slices
from leadlift.sources.shipping import ship

SAMPLE_DOCS = 1500
SAMPLE_LINES = 200
STEPS, RATE, PENALTY = 120, 0.1, 1e-3
HELD_OUT_MOD = 5
THRESHOLD = 0.3

LOWER, UPPER, DIGIT, SPACE, STOP, SYMBOL, BREAK = range(7)
_STOPS = ".,;:'\"?()-…–—’“”«»¿¡"


def _classes() -> np.ndarray:
    table = np.full(0x3000, LOWER, dtype=np.int64)
    for point in range(len(table)):
        c = chr(point)
        if c == "\n":
            table[point] = BREAK
        elif c in _STOPS:
            table[point] = STOP
        elif c.isspace():
            table[point] = SPACE
        elif c.isdigit():
            table[point] = DIGIT
        elif c.isupper():
            table[point] = UPPER
        elif not c.isalpha():
            table[point] = SYMBOL
    return table


_CLASS = _classes()
FEATURES = 16


def lines_of(text: str) -> list[str]:
    """Lines that are not blank; a text without any is one empty line."""
    return [line for line in text.split("\n") if line.strip()] or [""]


def line_features(docs: list[list[str]]) -> np.ndarray:
    """One row of ``FEATURES`` numbers, about 0 to 1 each, for every line of every document, in order."""
    lines = [line for doc in docs for line in doc]
    points = np.frombuffer("\n".join(lines).encode("utf-32-le"), dtype="<u4")
    kinds = _CLASS[np.minimum(points, len(_CLASS) - 1)]
    number = np.cumsum(kinds == BREAK)
    counts = np.bincount(number * 8 + kinds, minlength=8 * len(lines)).reshape(-1, 8)[: len(lines)].astype(np.float64)
    length = np.array([len(line) for line in lines], dtype=np.float64)
    rows = np.zeros((len(lines), 8))
    at = 0
    for doc in docs:
        again = len(set(doc)) < len(doc)
        times: dict[str, int] = {}
        if again:
            for line in doc:
                times[line] = times.get(line, 0) + 1
        for line in doc:
            words = line.split()
            row = rows[at]
            if words:
                row[0] = len(words)
                row[1] = len(set(words))
                row[2] = sum(map(eq, words, words[1:]))
            row[3], row[4] = line.count("|"), line.count("!")
            row[5] = line[:1].isupper()
            row[6] = line.rstrip()[-1:] in (".", "?", "!", "”", '"')
            row[7] = again and times[line] > 1
            at += 1
    words = np.maximum(rows[:, 0], 1)
    size = np.maximum(length, 1)
    letters = np.maximum(counts[:, LOWER] + counts[:, UPPER], 1)
    out = np.stack(
        [
            np.log1p(length) / 8,
            np.log1p(rows[:, 0]) / 6,
            counts[:, UPPER] / letters,
            counts[:, DIGIT] / size,
            counts[:, STOP] / size * 4,
            counts[:, SYMBOL] / size * 2,
            np.minimum(counts[:, SYMBOL] / words, 2) / 2,
            np.minimum(length / words / 20, 2),
            rows[:, 1] / words,
            rows[:, 2] / words,
            (rows[:, 0] > 3) * (1 - rows[:, 1] / words),
            np.minimum(rows[:, 3] / words, 1),
            np.minimum(rows[:, 4] / words, 2) / 2,
            rows[:, 5],
            rows[:, 6],
            rows[:, 7],
        ],
        axis=1,
    )
    return out.astype(np.float32)


def with_neighbours(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each line's features, those of the lines before and after it (zeros at the ends), end marks and a constant."""
    ends = np.cumsum(sizes)
    first, last = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
    first[ends - sizes] = True
    last[ends - 1] = True
    before, after = np.roll(rows, 1, axis=0), np.roll(rows, -1, axis=0)
    before[first], after[last] = 0, 0
    marks = np.stack([first, last, np.ones(len(rows))], axis=1)
    return np.concatenate([rows, before, after, marks], axis=1)


def padded_groups(sizes: np.ndarray, cells: int = 400_000):
    """Documents of like length together: lists of their numbers, padded to at most twice their lines."""
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        most = 2 * sizes[order[at]] + 4
        end = at
        while end < len(order) and sizes[order[end]] <= most and (end == at or (end - at) * sizes[order[end]] < cells):
            end += 1
        yield order[at:end]
        at = end


def chain(odds: np.ndarray, sizes: np.ndarray, moves: np.ndarray):
    """Forward-backward over padded chains.

    ``odds`` (documents, lines) is each line's log-odds of good; ``moves`` (2, 2) the log-weights of label pairs, bad
    first. Returns the log partition, the probability of good per line and the expected label pairs per document.
    """
    docs, width = odds.shape
    live = np.arange(width)[None, :] < sizes[:, None]
    pull = np.exp(moves - moves.max())
    top = np.maximum(odds, 0)
    emit = np.stack([np.exp(-top), np.exp(odds - top)], axis=2)  # scaled by exp(top)
    alpha = np.zeros((docs, width, 2))
    scale = np.ones((docs, width))
    now = emit[:, 0]
    for t in range(width):
        if t:
            now = (alpha[:, t - 1] @ pull) * emit[:, t]
        total = now.sum(1)
        scale[:, t] = np.where(live[:, t], total, 1)
        alpha[:, t] = np.where(live[:, t, None], now / np.maximum(total, 1e-300)[:, None], alpha[:, t - 1] if t else now)
    beta = np.ones((docs, width, 2))
    pairs = np.zeros((docs, 2, 2))
    for t in range(width - 2, -1, -1):
        later = emit[:, t + 1] * beta[:, t + 1]
        on = live[:, t + 1]
        step = (later @ pull.T) / scale[:, t + 1, None]
        beta[:, t] = np.where(on[:, None], step, 1)
        joint = alpha[:, t, :, None] * pull[None] * later[:, None, :] / scale[:, t + 1, None, None]
        pairs += np.where(on[:, None, None], joint, 0)
    good = alpha[:, :, 1] * beta[:, :, 1]
    bad = alpha[:, :, 0] * beta[:, :, 0]
    logz = (np.log(np.maximum(scale, 1e-300)) + np.where(live, top, 0)).sum(1) + (sizes - 1) * moves.max()
    return logz, np.where(live, good / np.maximum(good + bad, 1e-300), 0), pairs


@dataclass(frozen=True)
class Model:
    """Weights of the line features, log-weights of label pairs, slope and shift of the final curve."""

    weights: np.ndarray
    moves: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, docs: list[list[str]]) -> np.ndarray:
        """Length-weighted mean probability of good lines, per document."""
        sizes = np.array([len(d) for d in docs])
        lengths = np.array([max(1, len(line.strip())) for d in docs for line in d], dtype=np.float64)
        odds = with_neighbours(line_features(docs), sizes) @ self.weights
        return mean_good(odds, sizes, lengths, self.moves)

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.curve(self.raw([lines_of(t) for t in texts]))

    def curve(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * log_odds(raw) + self.shift)))


def log_odds(share: np.ndarray) -> np.ndarray:
    inside = np.clip(share, 1e-4, 1 - 1e-4)
    return np.log(inside / (1 - inside))


def mean_good(odds: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(len(sizes))
    for group in padded_groups(sizes):
        width = int(sizes[group].max())
        at = np.minimum(starts[group][:, None] + np.arange(width)[None, :], len(odds) - 1)
        live = np.arange(width)[None, :] < sizes[group][:, None]
        _, good, _ = chain(np.where(live, odds[at], 0), sizes[group], moves)
        weight = np.where(live, lengths[at], 0)
        out[group] = (good * weight).sum(1) / weight.sum(1)
    return out


def fit(docs: list[tuple[int, np.ndarray, np.ndarray]], share_good: float) -> Model | None:
    """Model from (label, features (lines, FEATURES), line lengths) of documents; None unless both labels occur.

    ``share_good`` is the share of good documents that the final curve should expect.
    """
    labels = np.array([d[0] for d in docs], dtype=np.int64)
    if len(set(labels.tolist())) < 2:
        return None
    sizes = np.array([len(d[1]) for d in docs])
    rows = with_neighbours(np.concatenate([d[1] for d in docs]), sizes).astype(np.float64)
    lengths = np.concatenate([d[2] for d in docs])
    starts = np.cumsum(sizes) - sizes
    gold = np.repeat(labels, sizes).astype(np.float64)
    groups = list(padded_groups(sizes))
    weights, moves = np.zeros(rows.shape[1]), np.zeros((2, 2))
    state = [np.zeros(rows.shape[1] + 4), np.zeros(rows.shape[1] + 4)]
    for step in range(1, STEPS + 1):
        odds = rows @ weights
        expected, pairs = np.zeros(len(rows)), np.zeros((2, 2))
        for group in groups:
            width = int(sizes[group].max())
            at = np.minimum(starts[group][:, None] + np.arange(width)[None, :], len(rows) - 1)
            live = np.arange(width)[None, :] < sizes[group][:, None]
            # every document counts as one, however many lines it has
            _, good, joint = chain(np.where(live, odds[at], 0), sizes[group], moves)
            each = 1 / sizes[group]
            expected[at[live]] = (good * each[:, None])[live]
            pairs += (joint * each[:, None, None]).sum(0)
        same = (sizes - 1) / sizes
        found = np.array([[same[labels == 0].sum(), 0], [0, same[labels == 1].sum()]])
        slope = rows.T @ (expected - gold / np.repeat(sizes, sizes)) / len(docs) + PENALTY * weights
        lean = (pairs - found) / len(docs) + 10 * PENALTY * moves
        gradient = np.concatenate([slope, lean.ravel()])
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.999 * state[1] + 0.001 * gradient**2
        change = RATE * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        weights = weights - change[:-4]
        moves = moves - change[-4:].reshape(2, 2)
    raw = mean_good(rows @ weights, sizes, lengths, moves)
    importance = np.where(labels == 1, share_good / (labels == 1).mean(), (1 - share_good) / (labels == 0).mean())
    slope, shift = fit_curve(log_odds(raw), labels, importance)
    return Model(weights, moves, slope, shift)


def fit_curve(x: np.ndarray, labels: np.ndarray, importance: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a weighted logistic curve, by Newton steps with a small penalty on the slope."""
    at = np.array([1.0, 0.0])
    columns = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(columns @ at, -30, 30)))
        gradient = columns.T @ (importance * (p - labels)) + np.array([0.05 * at[0], 0])
        curvature = (columns * (importance * p * (1 - p))[:, None]).T @ columns + np.diag([0.05, 1e-3])
        move = np.linalg.solve(curvature, gradient)
        at = at - np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-8:
            break
    return float(max(at[0], 1e-3)), float(at[1])


def held_out(doc_id: Column) -> Column:
    """Whether the remainder of crc32 of the id's text is zero; a missing id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % HELD_OUT_MOD == 0


def window(doc_id: int, lines: int) -> slice:
    """The lines of a labelled text that are learnt from: all, or ``SAMPLE_LINES`` in a row from a place by the id."""
    start = zlib.crc32(str(doc_id).encode()) % max(1, lines - SAMPLE_LINES + 1)
    return slice(start, start + SAMPLE_LINES)


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Model from ``labels(doc_id, quality, ..)`` of documents that are not held out.

    Labels other than 0 and 1 and those without a row in ``docs`` are ignored, before any are picked. Repeated labels
    count once; of rows with one doc_id the smallest text counts. Features are those of whole texts; of a text with more
    than ``SAMPLE_LINES`` lines a window of that many is learnt from, which begins anywhere, by the hash of its id.
    """
    ship(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    known = known.distinct().join(ids, "doc_id", "left_semi")
    counts = {row["quality"]: row["count"] for row in known.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return None
    # 2 * SAMPLE_DOCS rows at most: small enough for every executor
    picked = [
        known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS) for q in (0, 1)
    ]
    texts = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
        .groupBy("doc_id", "quality")
        .agg(F.min("text").alias("text"))
    )

    def features(batches):
        for batch in batches:
            for start, end, found in text_slices(batch):
                whole = [lines_of(t) for t in found]
                rows = line_features(whole)
                ends = np.cumsum([len(c) for c in whole])
                ids = batch.column(2).slice(start, end - start).to_pylist()
                windows = [window(i, len(c)) for i, c in zip(ids, whole, strict=True)]
                parts = [p[w] for p, w in zip(np.split(rows, ends[:-1]), windows, strict=True)]
                cut = [c[w] for c, w in zip(whole, windows, strict=True)]
                lengths = [[float(max(1, len(line.strip()))) for line in c] for c in cut]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array([p.ravel().tolist() for p in parts], pa.list_(pa.float32())),
                        pa.array(lengths, pa.list_(pa.float32())),
                        batch.column(2).slice(start, end - start),
                    ],
                    ["quality", "features", "lengths", "doc_id"],
                )

    rows = (
        texts.select("quality", "text", "doc_id")
        .mapInArrow(features, "quality int, features array<float>, lengths array<float>, doc_id bigint")
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["quality"]))
    sample = [
        (r["quality"], np.array(r["features"], np.float32).reshape(-1, FEATURES), np.array(r["lengths"])) for r in rows
    ]
    return fit(sample, counts[1] / (counts[0] + counts[1]))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) for every row of ``docs(doc_id, text, ..)``; 0.5 without a model. Null texts count as empty."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for start, end, texts in text_slices(batch):
                found = model.scores(texts) if model else np.full(len(texts), 0.5)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array(found)], ["doc_id", "score"]
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    scored = score(docs, learn(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text scores below ``threshold``; same columns."""
    ship(docs.sparkSession)
    model = learn(docs, labels)
    if model is None:
        return docs
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for start, end, texts in text_slices(batch, at):
                keep = model.scores(texts) >= threshold
                yield batch.slice(start, end - start).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
