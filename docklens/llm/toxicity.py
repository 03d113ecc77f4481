"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of three hashed embeddings: of the whole word and of its
first four and five bytes, so inflected and unseen forms of a stem share weights. Filters
of width 1, 2 and 3 run over the words; the largest response of each filter over the whole
text decides through one dense layer. Embeddings start from the log-odds of their words in
the training texts and are trained with the filters by Adam.

The model is fitted on the driver from a bounded sample of labelled texts (``Fit.rows``).
All labelled texts outside the sample calibrate a threshold for each language: Spark counts
them by language and binned logit. The language is read off the text by its function words,
so neither a language column nor any other column is an input of a score: ``score`` is 0.5
at the threshold of the text's language.

Scoring is row by row and needs no shuffle; texts are scored whole, in runs of words.

Cases: a null or empty text has no words: its score follows from the bias alone; repeated
rows are scored alike; an empty table gives an empty result; with no labelled texts, or of
one class only, nothing is toxic (score 0) or everything (score 1) as that class says;
other columns pass through, and one named like a result is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docklens.llm import words
from docklens.llm.batches import Result, add_columns, set_aside
from docklens.llm.words import LOWER, NOT_ALNUM, mix

HEADS = (4, 5)
WIDTHS = (1, 2, 3)
SCHEMA = "score double, predicted int"

#: Frequent function words that tell the languages apart.
FUNCTION_WORDS = {
    "en": "the of and to in that is was for it with as on be by this are from or an",
    "de": "der die und das den von ist des mit sich dem nicht ein eine auf für im zu als auch",
    "fr": "le les et des est une du dans qui pour que au sur par pas avec ce son la de",
    "es": "el los y del se las por un con no una su para es al lo como más en que",
}
LANGUAGES = (*FUNCTION_WORDS, "other")


@dataclass(frozen=True)
class Fit:
    """Size of the model and its training. ``rows`` bounds the labelled sample, ``longest`` the
    bytes of a text in it.

    ``calibration`` is the least share of the labelled texts that is kept from the fit for
    the thresholds. A language's own threshold weighs as many texts as its smaller class
    has, the common threshold ``pull`` texts.
    """

    rows: int = 8000
    longest: int = 1 << 16
    buckets: int = 1 << 16
    size: int = 8
    filters: int = 8
    epochs: int = 4
    least_steps: int = 300
    batch: int = 64
    rate: float = 0.01
    calibration: float = 0.25
    pull: float = 20.0
    seed: int = 5


@dataclass(frozen=True)
class Model:
    embedding: np.ndarray  # (tables, buckets, size)
    filters: list[np.ndarray]  # for each width (width * size, filters)
    bias: np.ndarray
    dense: np.ndarray
    offset: float
    thresholds: np.ndarray  # for each language


_FUNCTION_KEYS: list[np.ndarray] = []


def _function_keys() -> tuple[np.ndarray, np.ndarray]:
    """(sorted word hashes, language bits) of the function words."""
    if not _FUNCTION_KEYS:
        bits: dict[int, int] = {}
        for n, line in enumerate(FUNCTION_WORDS.values()):
            raw = np.frombuffer(line.encode(), np.uint8)
            run = words.spans(raw, np.array([0, len(raw)]), NOT_ALNUM)
            for key in words.hashes(raw, run)[0].tolist():
                bits[key] = bits.get(key, 0) | 1 << n
        keys = np.array(sorted(bits), np.uint64)
        _FUNCTION_KEYS.extend([keys, np.array([bits[k] for k in keys.tolist()], np.int64)])
    return _FUNCTION_KEYS[0], _FUNCTION_KEYS[1]


def _scan(values: np.ndarray, offsets: np.ndarray, buckets: int):
    """(features (words, tables), first word of each text, language of each text)."""
    lower = LOWER[values]
    run = words.spans(lower, offsets, NOT_ALNUM)
    found = words.hashes(lower, run, HEADS)
    kind = np.uint16 if buckets <= 1 << 16 else np.int32
    features = np.stack(
        [(mix(h + np.uint64(k)) % np.uint64(buckets)).astype(kind) for k, h in enumerate(found)],
        axis=1,
    )
    keys, bits = _function_keys()
    at = np.minimum(np.searchsorted(keys, found[0]), len(keys) - 1)
    hit = np.where(keys[at] == found[0], bits[at], 0)
    votes = np.stack([words.per_text((hit >> n) & 1, run.of) for n in range(len(FUNCTION_WORDS))], axis=1)
    language = np.where(votes.max(axis=1) > 0, votes.argmax(axis=1), len(LANGUAGES) - 1)
    return features, run.of, language


def _responses(model: Model, features: np.ndarray, of: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """Largest response of each filter in each text, 0 at least; in runs of ``step`` words."""
    n = len(of) - 1
    width = sum(f.shape[1] for f in model.filters)
    best = np.zeros((n, width), np.float32)
    row = np.repeat(np.arange(n), np.diff(of))
    for first in range(0, len(features), step):
        last = min(first + step, len(features))
        part = features[first : min(last + max(WIDTHS) - 1, len(features))]
        x = model.embedding[0][part[:, 0]]
        for k in range(1, len(model.embedding)):
            x = x + model.embedding[k][part[:, k]]
        of_part = row[first : first + len(part)]
        column = 0
        for w, filters in zip(WIDTHS, model.filters):
            size = x.shape[1]
            m = min(last - first, len(part) - w + 1)
            if m > 0:
                response = x[:m] @ filters[:size]
                for k in range(1, w):
                    response += x[k : k + m] @ filters[k * size : (k + 1) * size]
                response += model.bias[column : column + filters.shape[1]]
                if w > 1:
                    response[of_part[:m] != of_part[w - 1 : w - 1 + m]] = -np.inf
                edges = np.flatnonzero(np.concatenate([[True], of_part[1:m] != of_part[: m - 1]]))
                top = np.maximum.reduceat(response, edges, axis=0)
                texts = of_part[edges]
                own = best[texts, column : column + filters.shape[1]]
                best[texts, column : column + filters.shape[1]] = np.maximum(own, top)
            column += filters.shape[1]
    return best


def _logits(model: Model, features: np.ndarray, of: np.ndarray) -> np.ndarray:
    return _responses(model, features, of) @ model.dense + model.offset


def fit(texts: pa.Array, toxic: np.ndarray, options: Fit = Fit()) -> Model:
    """A model from labelled texts; the same for the same texts in the same order."""
    tables = 1 + len(HEADS)
    empty = Model(
        np.zeros((tables, options.buckets, options.size), np.float32),
        [np.zeros((w * options.size, options.filters), np.float32) for w in WIDTHS],
        np.zeros(options.filters * len(WIDTHS), np.float32),
        np.zeros(options.filters * len(WIDTHS), np.float32),
        50.0 if len(toxic) and toxic.all() else -50.0,
        np.zeros(len(LANGUAGES)),
    )
    if not len(toxic) or toxic.all() or not toxic.any():
        return empty
    scans = [_scan(v, o, options.buckets) for _, v, o in words.slices(texts)]
    features = np.concatenate([f for f, _, _ in scans])
    counts = np.concatenate([np.diff(o) for _, o, _ in scans])
    language = np.concatenate([g for _, _, g in scans])
    del scans
    of = np.concatenate([[0], np.cumsum(counts)])
    y = toxic.astype(np.float32)
    random = np.random.default_rng(options.seed)
    held = random.random(len(y)) < options.calibration
    if not (y[~held].any() and (1 - y[~held]).any()):
        held[:] = False
    learn = np.flatnonzero(~held)

    embedding = random.normal(0, 0.05, (tables, options.buckets, options.size)).astype(np.float32)
    for k in range(tables):
        embedding[k, :, 0] = _log_odds(features[:, k], of, y, learn, options.buckets)
    filters = [
        random.normal(0, 0.3 / w, (w * options.size, options.filters)).astype(np.float32)
        for w in WIDTHS
    ]
    for f in filters:
        f[0, : options.filters // 2] = 0.5  # half of them start from the log-odds
    model = Model(
        embedding, filters,
        np.zeros(options.filters * len(WIDTHS), np.float32),
        np.full(options.filters * len(WIDTHS), 0.1, np.float32),
        0.0, np.zeros(len(LANGUAGES)),
    )
    model = _train(model, features, of, y, learn, options, random)
    check = np.flatnonzero(held) if held.any() else learn
    bins = _bins(_logits(model, *_rows(features, of, check)))
    hit = y[check] > 0
    return replace(
        model, thresholds=_thresholds(bins, language[check], hit, ~hit, options.pull)
    )


def _rows(features: np.ndarray, of: np.ndarray, rows: np.ndarray):
    """The features of some texts, in their order."""
    counts = of[rows + 1] - of[rows]
    edge = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(edge[-1]) + np.repeat(of[rows] - edge[:-1], counts)
    return features[at], edge


def _log_odds(feature, of, y, learn, buckets: int) -> np.ndarray:
    """How much likelier a text with the bucket is toxic, drawn to 0 for rare buckets."""
    yes, no = np.zeros(buckets), np.zeros(buckets)
    for first in range(0, len(learn), 500):  # in parts: the driver's memory is small
        part = learn[first : first + 500]
        own, edge = _rows(feature, of, part)
        row = np.repeat(np.arange(len(part)), np.diff(edge))
        seen = np.unique(row * buckets + own)
        toxic = y[part][seen // buckets] > 0
        yes += np.bincount(seen[toxic] % buckets, minlength=buckets)
        no += np.bincount(seen[~toxic] % buckets, minlength=buckets)
    n_yes = max(1.0, float(y[learn].sum()))
    n_no = max(1.0, len(learn) - n_yes)
    odds = np.log((yes + 0.5) / (n_yes + 1)) - np.log((no + 0.5) / (n_no + 1))
    return (odds * (yes + no) / (yes + no + 5.0)).astype(np.float32)


def _train(model: Model, features, of, y, learn, options: Fit, random) -> Model:
    size, n_filters = options.size, options.filters
    width = n_filters * len(WIDTHS)
    dense, bias, offset = model.dense.copy(), model.bias.copy(), np.zeros(1, np.float32)
    small = [*model.filters, bias, dense, offset]
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in small]
    deep = (np.zeros_like(model.embedding), np.zeros_like(model.embedding))
    share = y[learn].mean()
    step = 0

    def adam(p, g, m, v):
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        return options.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    epochs = max(options.epochs, -(-options.least_steps * options.batch // len(learn)))
    for _ in range(epochs):
        order = random.permutation(learn)
        for first in range(0, len(order), options.batch):
            step += 1
            rows = order[first : first + options.batch]
            own, edge = _rows(features, of, rows)
            if not len(own):
                continue
            x = sum(model.embedding[k][own[:, k]] for k in range(len(model.embedding)))
            row = np.repeat(np.arange(len(rows)), np.diff(edge))
            best = np.zeros((len(rows), width), np.float32)
            place = np.full((len(rows), width), -1, np.int64)
            column = 0
            for w, f in zip(WIDTHS, model.filters):
                m = len(own) - w + 1
                if m > 0:
                    response = sum(x[k : k + m] @ f[k * size : (k + 1) * size] for k in range(w))
                    response = response + bias[column : column + n_filters]
                    if w > 1:
                        response[row[:m] != row[w - 1 : w - 1 + m]] = -np.inf
                    starts = np.flatnonzero(np.diff(row[:m], prepend=-1))
                    ends = np.append(starts[1:], m)
                    for a, b in zip(starts.tolist(), ends.tolist()):
                        t = row[a]
                        at = response[a:b].argmax(axis=0)
                        top = response[a:b][at, np.arange(n_filters)]
                        on = top > 0
                        best[t, column : column + n_filters] = np.where(on, top, 0)
                        place[t, column : column + n_filters] = np.where(on, a + at, -1)
                column += n_filters
            logit = best @ dense + offset[0]
            weight = np.where(y[rows] > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
            error = weight * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[rows]) / len(rows)
            to_best = error[:, None] * dense[None] * (place >= 0)
            to_x: dict = {"at": [], "g": []}
            grads = []
            column = 0
            for w, f in zip(WIDTHS, model.filters):
                g = np.zeros_like(f)
                t, c = np.nonzero(place[:, column : column + n_filters] >= 0)
                at, e = place[t, column + c], to_best[t, column + c]
                for k in range(w):
                    spread = np.zeros((len(t), n_filters), np.float32)
                    spread[np.arange(len(t)), c] = e
                    g[k * size : (k + 1) * size] += x[at + k].T @ spread
                    to_x["at"].append(at + k)
                    to_x["g"].append(e[:, None] * f[k * size : (k + 1) * size, c].T)
                grads.append(g)
                column += n_filters
            grads += [to_best.sum(axis=0), best.T @ error + 1e-4 * dense, error.sum(keepdims=True)]
            at, g = np.concatenate(to_x["at"]), np.concatenate(to_x["g"])
            for p, gr, (m1, v1) in zip(small, grads, state):
                p -= adam(p, gr, m1, v1)
            for k in range(len(model.embedding)):
                bucket, inverse = np.unique(own[at, k], return_inverse=True)
                bucket = bucket.astype(np.int64)
                total = np.zeros((len(bucket), size), np.float32)
                np.add.at(total, inverse, g)
                m1, v1 = deep[0][k][bucket], deep[1][k][bucket]
                model.embedding[k][bucket] -= adam(None, total, m1, v1)
                deep[0][k][bucket], deep[1][k][bucket] = m1, v1
    return Model(model.embedding, model.filters, bias, dense, float(offset[0]), model.thresholds)


#: Bins of a logit, and the largest bin either way; texts are counted by bin.
BINS = 64
_MOST_BIN = 64 * BINS


def _bins(logits: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(logits * BINS), -_MOST_BIN, _MOST_BIN - 1).astype(np.int32)


def _threshold(bins: np.ndarray, yes: np.ndarray, no: np.ndarray) -> float:
    """The cut of the best F1 of counts by bin, in the middle of the gap where it lies."""
    values, at = np.unique(-bins, return_inverse=True)
    hits, others = (np.cumsum(np.bincount(at, n, len(values))) for n in (yes, no))
    k = int((2 * hits / (hits + others + hits[-1])).argmax())
    edge = -values[k] / BINS
    if k + 1 == len(values):
        return float(edge - 1)
    return float((edge + (1 - values[k + 1]) / BINS) / 2)


def _thresholds(bins, language, yes, no, pull: float) -> np.ndarray:
    """A threshold for each language, drawn to the common one where a class has few texts.

    ``yes`` and ``no`` count the toxic and other texts of a language and bin.
    """
    common = _threshold(bins, yes, no) if yes.any() else (bins.max(initial=0) + 1) / BINS + 1
    out = np.full(len(LANGUAGES), float(common))
    for n in range(len(LANGUAGES)):
        own = language == n
        weight = min(yes[own].sum(), no[own].sum())
        if weight:
            cut = _threshold(bins[own], yes[own], no[own])
            out[n] = (weight * cut + pull * common) / (weight + pull)
    return out


def calibrate(model: Model, docs: DataFrame, given: DataFrame, pull: float) -> Model:
    """``model`` with thresholds from all of ``docs`` (id, text) that ``given`` (id, y) labels.

    Texts are never shuffled: documents are counted by id, language and bin before they meet
    the labels, counted by id. The driver gets one row for each language and bin. Without
    toxic or without other texts the thresholds stay.
    """

    def compute(texts: pa.Array) -> Result:
        parts = []
        for _, values, offsets in words.slices(texts):
            features, of, language = _scan(values, offsets, model.embedding.shape[1])
            parts.append((language.astype(np.int32), _bins(_logits(model, features, of))))
        language, bins = zip(*parts) if parts else ([np.zeros(0, np.int32)],) * 2
        return {"language": np.concatenate(language), "bin": np.concatenate(bins)}

    found = add_columns(docs.where("id is not null"), ["text"], "language int, bin int", compute, ["id"])
    found = found.groupBy("id", "language", "bin").agg(F.count("*").alias("n"))
    labelled = given.groupBy("id").agg(
        F.sum((F.col("y") > 0).cast("long")).alias("yes"),
        F.sum((F.col("y") <= 0).cast("long")).alias("no"),
    )
    counts = found.join(labelled, "id").groupBy("language", "bin").agg(
        F.sum(F.col("n") * F.col("yes")).cast("double").alias("yes"),
        F.sum(F.col("n") * F.col("no")).cast("double").alias("no"),
    ).toArrow()
    language, bins, yes, no = (
        counts.column(c).to_numpy() for c in ("language", "bin", "yes", "no")
    )
    if not yes.any() or not no.any():
        return model
    return replace(model, thresholds=_thresholds(bins, language, yes, no, pull))


def fit_documents(
    docs: DataFrame,
    labels: DataFrame,
    use: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    options: Fit = Fit(),
) -> Model:
    """A model fitted on about ``options.rows`` labelled documents, calibrated on the others.

    Each class gives up to half of them, so a rare class is there whenever it has a label. The
    hash of the id tells which are fitted. ``use`` tells which labels may be learned,
    as a condition on the id.
    """
    given = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    given = given.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    if use is not None:
        given = given.where(use)
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    share = F.pmod(F.xxhash64("id", F.lit(options.seed)), F.lit(1 << 30)) / float(1 << 30)
    given = given.withColumns({"y": (F.col("y") > 0).cast("int"), "share": share})
    # half of the sample from each class, and the first text of each, however rare it is
    limits = {
        r["y"]: max(r["least"], min(1 - options.calibration, options.rows / 2 / r["n"]))
        for r in given.groupBy("y").agg(F.count("*").alias("n"), F.min("share").alias("least")).collect()
    }
    limit = F.when(F.col("y") == 1, limits.get(1, 1.0)).otherwise(limits.get(0, 1.0))
    chosen = F.col("share") <= limit
    rows = _sample(read.where(F.octet_length("text") <= options.longest), given.where(chosen))
    model = fit(
        rows.column("text"), rows.column("y").to_numpy() > 0, replace(options, calibration=0.0)
    )
    fitted = not _one_class(rows)
    del rows
    pa.default_memory_pool().release_unused()
    if fitted:
        model = calibrate(model, read, given.where(~chosen), options.pull)
    return model


def _sample(docs: DataFrame, given: DataFrame) -> pa.Table:
    """The documents (id, text) of ``given``, which has at most about ``Fit.rows`` ids."""
    rows = docs.join(F.broadcast(given.select("id", "y")), "id").select("id", "text", "y").toArrow()
    return rows.sort_by([("id", "ascending"), ("text", "ascending")])


def _one_class(rows: pa.Table) -> bool:
    toxic = rows.column("y").to_numpy() > 0
    return toxic.all() or not toxic.any()


def score(
    docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` (columns ``keep``) with ``score`` and ``predicted`` (1 from a score of 0.5)."""

    def compute(texts: pa.Array) -> Result:
        parts = []
        for _, values, offsets in words.slices(texts):
            features, of, language = _scan(values, offsets, model.embedding.shape[1])
            above = _logits(model, features, of) - model.thresholds[language]
            parts.append(1 / (1 + np.exp(-np.clip(above.astype(np.float64), -500, 500))))
        made = np.concatenate(parts or [np.zeros(0)])
        return {"score": made, "predicted": (made >= 0.5).astype(np.int32)}

    return add_columns(docs, [text_col], SCHEMA, compute, keep)


def clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that are not toxic, in the columns of ``docs``."""
    aside, own = set_aside(docs, SCHEMA)
    scored = score(aside, model, own[text_col]).where("predicted = 0")
    return scored.select(*(F.col(f"`{own[c]}`").alias(c) for c in docs.columns))


def held_out(id_col: str | Column) -> Column:
    """Whether labels of a document are kept from training: a fifth, by the id's crc32."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(column.cast("string").cast("binary")) % 5 == 0
