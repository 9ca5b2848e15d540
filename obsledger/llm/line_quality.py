"""Quality classifier: a linear-chain conditional random field labels every line good or bad."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from obsledger.llm.rolling import running_sums, span_hashes
from obsledger.llm.shingles import SPACE
from obsledger.llm.tables import add_columns, map_rows, texts_of

SAMPLE_DOCS = 1500
"""Labelled documents of each class that the model is fitted on at most, the first by a hash of the id."""
SAMPLE_LINES = 200
"""Labelled documents of more lines are not drawn for fitting; scoring takes every document whole."""
EPOCHS = 80
ACCEPTED = 0.3
GROUP_BYTES = 1 << 20
"""Texts are turned into features together up to about this size."""
FEATURES = (
    "one", "length", "upper", "digits", "symbols", "marks", "short words", "long words",
    "repeated words", "top word", "equal neighbours", "no words",
)
UPPER, DIGIT, MARK, SYMBOL = (np.zeros(256, np.int64) for _ in range(4))
UPPER[65:91] = 1
DIGIT[48:58] = 1
MARK[[33, 63]] = 1
SYMBOL[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:!?'\"()-"]] = 1


def _sums(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return (total[end] - total[begin]).astype(float)


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(one row of numbers about 0 to 1 for each line, its bytes plus one, lines of each text).

    Nothing but the text goes in. Lines end at line feeds, words at ASCII white space.
    """
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n".join(coded) + b"\n", np.uint8)
    end = np.flatnonzero(raw == 10)
    begin = np.concatenate([[0], end[:-1] + 1])
    lines = np.array([t.count(b"\n") + 1 for t in coded])
    size = (end - begin).astype(float)

    edge = np.diff(np.concatenate([[0], (~SPACE[raw]).view(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    word = span_hashes(running_sums(raw), first, last)
    line = np.searchsorted(end, first)
    count = np.bincount(line, minlength=len(end)).astype(float)
    letters = np.bincount(line, last - first, minlength=len(end))
    single = np.bincount(line, last - first == 1, minlength=len(end))
    same = np.bincount(line[1:], (word[1:] == word[:-1]) & (line[1:] == line[:-1]), minlength=len(end))
    order = np.lexsort((word, line))
    new = np.ones(len(word), bool)
    new[1:] = (word[order][1:] != word[order][:-1]) | (line[order][1:] != line[order][:-1])
    at = np.flatnonzero(new)
    kinds = np.bincount(line[order][at], minlength=len(end))
    top = np.zeros(len(end))
    np.maximum.at(top, line[order][at], np.diff(np.append(at, len(word))))

    n, m = np.maximum(size, 1), np.maximum(count, 1)
    columns = [
        np.ones(len(end)),
        np.minimum(1, np.log1p(size) / 10),
        _sums(UPPER[raw], begin, end) / np.maximum(letters, 1),
        _sums(DIGIT[raw], begin, end) / n,
        np.minimum(1, 4 * _sums(SYMBOL[raw], begin, end) / n),
        np.minimum(1, 4 * _sums(MARK[raw], begin, end) / n),
        single / m,
        np.minimum(1, letters / m / 20),
        np.where(count > 0, 1 - kinds / m, 0),
        top / m,
        same / m,
        (count == 0).astype(float),
    ]
    return np.column_stack(columns), size + 1, lines


def document_features(texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """By text: features of each line beside those of the lines around it, and line lengths."""
    if not texts:
        return [], []
    own, size, lines = line_features(texts)
    cuts = np.cumsum(lines)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[np.concatenate([[0], cuts[:-1]])] = 0
    after[cuts - 1] = 0
    return np.split(np.hstack([own, before, after]), cuts[:-1]), np.split(size, cuts[:-1])


def groups(texts: list[str]) -> Iterator[list[str]]:
    """Neighbouring texts of about GROUP_BYTES together; a longer text stands alone."""
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > GROUP_BYTES:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


class Model(NamedTuple):
    """Weights of the features for label good, of the four label pairs, and of the final logistic step."""

    weights: np.ndarray
    pairs: np.ndarray
    slope: float
    offset: float


def _padded(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences side by side: values (step, document) and the lengths."""
    sizes = np.array([len(d) for d in docs])
    out = np.zeros((sizes.max(), len(docs)))
    for i, d in enumerate(docs):
        out[: len(d), i] = d
    return out, sizes


def alike(sizes: list[int]) -> list[np.ndarray]:
    """Numbers of sequences that are padded together: their lengths have the same power of two."""
    power = np.array([int(n).bit_length() for n in sizes])
    return [np.flatnonzero(power == p) for p in np.unique(power)]


def _add(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def forward_backward(scores: list[np.ndarray], pairs: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """P(good) of every line, expected count of each label pair (bad/good to bad/good), and log Z by document.

    ``scores`` are the lines' scores for good; bad scores 0. All documents take a step together.
    """
    node, sizes = _padded(scores)
    steps, count = node.shape
    unary = np.stack([np.zeros_like(node), node], axis=2)
    forward, backward = np.zeros((steps, count, 2)), np.zeros((steps, count, 2))
    forward[0] = unary[0]
    for t in range(1, steps):
        on = sizes > t
        forward[t, on] = unary[t, on] + _add(forward[t - 1, on][:, :, None] + pairs, 1)
    for t in range(steps - 2, -1, -1):
        on = sizes > t + 1
        ahead = unary[t + 1, on] + backward[t + 1, on]
        backward[t, on] = _add(pairs[None] + ahead[:, None, :], 2)
    total = _add(forward[sizes - 1, np.arange(count)], 1)
    good = np.exp(forward[:, :, 1] + backward[:, :, 1] - total[None])
    expected = np.zeros((2, 2))
    for t in range(1, steps):
        on = sizes > t
        joint = forward[t - 1, on][:, :, None] + pairs + (unary[t, on] + backward[t, on])[:, None, :]
        expected += np.exp(joint - total[on][:, None, None]).sum(axis=0)
    return [good[:n, i] for i, n in enumerate(sizes)], expected, total


def fit(features: list[np.ndarray], lengths: list[np.ndarray], labels: list[int], epochs: int = EPOCHS) -> Model:
    """Maximum likelihood, each line labelled as its document, then a logistic step from the
    length-weighted share of good to the document's label. Without both labels the model says 1/2 or the one label."""
    width = 3 * len(FEATURES)
    theta = np.zeros(width + 4)
    if len(set(labels)) < 2:
        share = (sum(labels) + 0.5) / (len(labels) + 1)
        return Model(theta[:width], theta[width:].reshape(2, 2), 0.0, float(np.log(share / (1 - share))))
    y = np.array(labels)
    # Classes weigh the same, however many documents or lines they have.
    sizes = np.array([len(f) for f in features])
    weight = np.where(y == 1, 1 / sizes[y == 1].sum(), 1 / sizes[y == 0].sum()) / 2
    stacked = np.vstack(features)
    ends = np.cumsum(sizes)
    observed = stacked.T @ np.repeat(weight * y, sizes)
    seen = np.zeros((2, 2))
    seen[1, 1], seen[0, 0] = ((sizes - 1) * weight * y).sum(), ((sizes - 1) * weight * (1 - y)).sum()
    together = [rows[y[rows] == c] for rows in alike(sizes) for c in (0, 1) if (y[rows] == c).any()]
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for epoch in range(1, epochs + 1):
        pairs = theta[width:].reshape(2, 2)
        scores = np.split(stacked @ theta[:width], ends[:-1])
        gradient = -1e-4 * theta
        gradient[:width] += observed
        gradient[width:] += seen.ravel()
        for rows in together:
            good, expected, _ = forward_backward([scores[i] for i in rows], pairs)
            w = weight[rows[0]]
            at = np.concatenate([np.arange(ends[i] - sizes[i], ends[i]) for i in rows])
            gradient[:width] -= w * (stacked[at].T @ np.concatenate(good))
            gradient[width:] -= w * expected.ravel()
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + 0.1 * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
    model = Model(theta[:width], theta[width:].reshape(2, 2), 1.0, 0.0)
    share = shares(features, lengths, model)
    a, b = 1.0, 0.0
    balance = np.where(y == 1, 1 / (y == 1).sum(), 1 / (y == 0).sum()) / 2
    for _ in range(2000):
        error = balance * (1 / (1 + np.exp(-(a * (share - 0.5) + b))) - y)
        a, b = a - 5 * ((error * (share - 0.5)).sum() + 1e-4 * a), b - 5 * error.sum()
    return Model(model.weights, model.pairs, float(a), float(b - a / 2))


def shares(features: list[np.ndarray], lengths: list[np.ndarray], model: Model) -> np.ndarray:
    """Length-weighted mean of the lines' marginals, by document."""
    out = np.zeros(len(features))
    for rows in alike([len(f) for f in features]):
        good, _, _ = forward_backward([features[i] @ model.weights for i in rows], model.pairs)
        for i, g in zip(rows, good, strict=True):
            out[i] = (g * lengths[i]).sum() / lengths[i].sum()
    return np.clip(out, 0, 1)


def score_texts(texts: list[str], model: Model) -> np.ndarray:
    found = [np.empty(0)]
    for some in groups(texts):
        x = model.slope * shares(*document_features(some), model) + model.offset
        found.append(1 / (1 + np.exp(-x)))
    return np.concatenate(found)


def held_out(doc_id) -> F.Column:
    """True for the fifth of ids that no model learns from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def fit_on_labels(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = SAMPLE_DOCS,
    max_lines: int = SAMPLE_LINES,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """The model of ``labels`` outside the held-out ids, fitted on at most ``per_class`` documents of each label.

    Documents of fewer than ``max_lines`` lines come first, by a hash of the id; longer ones are taken where these are
    too few, whole, as long as the label's lines are at most per_class x max_lines. Only the sample's line features
    come to the driver: at most 2 x per_class x max_lines rows of 36 numbers. Null ids and labels are left
    out; of rows with one id, one text counts, once for each of its labels.
    A label that the table has but the sample misses, since its documents are longer than that, is a ValueError.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)))
    usable = usable.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).distinct()
    text = F.coalesce(F.col(text_col), F.lit(""))
    n_lines = F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    # What stands for a document: its lines and the hash of its text; of several rows the shortest.
    rows = docs.select(F.col(id_col).alias("_id"), F.struct(n_lines.alias("n"), F.xxhash64(text).alias("h")).alias("_row"))
    rows = usable.join(rows, "_id").groupBy("_id", "_label").agg(F.min("_row").alias("_row"))
    order = [F.col("_row.n") > max_lines, F.xxhash64("_id"), F.col("_id")]
    picks = None
    for label in (0, 1):
        some = rows.where(F.col("_label") == label).orderBy(*order).limit(per_class)
        picks = some if picks is None else picks.unionByName(some)
    lines = F.sum("_row.n").over(Window.partitionBy("_label").orderBy(*order))  # of at most per_class rows
    picks = picks.withColumn("_lines", lines).where(F.col("_lines") <= per_class * max_lines)
    picks = picks.select("_id", "_label", F.col("_row.h").alias("_h"))
    sample = (
        docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_h"))
        .join(F.broadcast(picks), ["_id", "_h"])  # at most 2 x per_class rows
        .dropDuplicates(["_id", "_label"])
        .drop("_h")
    )
    numbers = T.ArrayType(T.DoubleType())
    schema = T.StructType(
        [
            T.StructField("_id", T.LongType()),
            T.StructField("_label", T.IntegerType()),
            T.StructField("features", numbers),
            T.StructField("lengths", numbers),
        ]
    )

    def make():
        def columns(batch: pa.RecordBatch) -> list:
            both = [x for some in groups(texts_of(batch, "_text")) for x in zip(*document_features(some), strict=True)]
            flat = pa.list_(pa.float64())
            return [
                batch.column(batch.schema.get_field_index("_id")).cast(pa.int64()),
                batch.column(batch.schema.get_field_index("_label")).cast(pa.int32()),
                pa.array([f.ravel().tolist() for f, _ in both], flat),
                pa.array([n.tolist() for _, n in both], flat),
            ]

        return columns

    rows = map_rows(sample, schema, make).toArrow().sort_by([("_id", "ascending"), ("_label", "ascending")])
    lost = {0, 1} - set(rows.column("_label").to_pylist())
    known = usable.where(F.col("_label").isin(*lost)).join(docs.select(F.col(id_col).alias("_id")), "_id", "left_semi")
    if lost and known.limit(1).count():
        raise ValueError(f"all documents of label {lost} have more than {per_class * max_lines} lines")
    width = 3 * len(FEATURES)
    features = [np.array(x.as_py()).reshape(-1, width) for x in rows.column("features")]
    lengths = [np.array(x.as_py()) for x in rows.column("lengths")]
    return fit(features, lengths, rows.column("_label").to_pylist())


SCORES = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def score_documents(docs: DataFrame, model: Model, text_col: str = "text", accepted: float = ACCEPTED) -> DataFrame:
    """``docs`` with score (0 to 1, higher: likelier of label 1) and predicted (1 if score >= accepted, else 0).

    Every line of every text counts, by its length. A null or empty text is one empty line. Rows and
    further columns pass through; columns score and predicted are replaced.
    """

    def make():
        def columns(batch: pa.RecordBatch) -> list:
            found = score_texts(texts_of(batch, text_col), model)
            return [pa.array(found), pa.array((found >= accepted).astype(np.int32))]

        return columns

    return add_columns(docs, SCORES, make)
