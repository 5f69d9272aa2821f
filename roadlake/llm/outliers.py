"""Quality rules: text statistics, hard rules, and robust multivariate outliers.

`text_statistics` counts words, symbols and repetition of whole texts. `fit` estimates, for
each language and source, centre and scatter of the transformed statistics by minimum
covariance determinant: from two robust starts, concentration steps keep the 75 % of rows
with the smallest Mahalanobis distances and estimate again; the start with the smaller
determinant wins. `judge` rejects rows that fail the hard rules or lie farther from their
group's centre than a chi-square bound.

Every step is a map-side reduced aggregation over a narrow table of statistics, so a
language and source with a third of all rows is no hot spot. Groups with fewer than
MIN_ROWS sound rows are judged by their language, and languages with fewer by all rows.

Defined results: a null or empty text has zero counts and fails the hard rules; null
language or source is a group of its own; repeated rows count and are judged each; if no
row is sound there is no model and only the hard rules decide; other columns pass through.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from roadlake.llm.tables import column, free_name, stored
from roadlake.llm.textbytes import NOT_SPACE, constants, hashes, mix, slices, word_spans

MIN_WORDS = 50
MIN_ROWS = 200
KEPT_SHARE = 0.75
STEPS = 3
# The bound holds for 1 - 1e-4 of normal rows; language statistics have heavier tails, so the
# scatter in any direction is at least what ordinary prose varies by.
TAIL = 1e-4
FLOORS = (0.8, 0.08, 0.35, 0.12, 0.6)
P = len(FLOORS)
MARKS = np.zeros(256, bool)
MARKS[[ord(c) for c in "#*$%&|<>"]] = True
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_WINDOW = constants(3, 6)


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[bounds])


def _seen_before(text: np.ndarray, h: np.ndarray) -> np.ndarray:
    """For each (text, hash): 0 for a single one, 1 for the first of several, 2 for later ones."""
    key = h ^ mix(text.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), bool)
    same[1:] = key[order][1:] == key[order][:-1]
    state = np.zeros(len(key), np.int8)
    state[order[same]] = 2
    first = np.flatnonzero(~same[:-1] & same[1:]) if len(key) else np.zeros(0, int)
    state[order[first]] = 1
    return state


def _statistics(s) -> list[np.ndarray]:
    starts, ends, counts = word_spans(s, NOT_SPACE)
    prefix = s.prefix()
    letters = (s.data & 0xC0) != 0x80
    word_chars = _per_text(letters & NOT_SPACE[s.data], s.bounds)
    symbols = _per_text(MARKS[s.data], s.bounds)

    breaks = np.flatnonzero(s.data == 10)
    line_starts = np.union1d(s.bounds[:-1], breaks + 1)
    line_starts = line_starts[line_starts < len(s.data)]
    line_text = s.text_of(line_starts)
    line_ends = np.minimum(np.append(line_starts[1:], len(s.data)), s.bounds[line_text + 1])
    line_ends = line_ends - ((line_ends > line_starts) & (s.data[line_ends - 1] == 10) & np.isin(line_ends - 1, breaks))
    worded = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, line_text = line_starts[worded], line_ends[worded], line_text[worded]
    later = _seen_before(line_text, hashes(prefix, line_starts, line_ends)) == 2
    dup_lines = np.bincount(line_text[later], minlength=s.n)

    text = np.repeat(np.arange(s.n), counts)
    repeats = np.zeros(len(starts), bool)
    if len(starts) > 2:
        w = hashes(prefix, starts, ends)
        h = mix(w[:-2] * _WINDOW[0] + w[1:-1] * _WINDOW[1] + w[2:] * _WINDOW[2])
        at = np.flatnonzero(text[:-2] == text[2:])
        at = at[_seen_before(text[at], h[at]) > 0]
        for k in range(3):
            repeats[at + k] = True
    return [counts, word_chars, symbols, dup_lines, np.bincount(text[repeats], minlength=s.n)]


@arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in STATISTICS]))
def text_statistics(texts: pa.Array) -> pa.Array:
    parts = [_statistics(s) for s in slices(texts)]
    columns = [np.concatenate([p[k] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64) for k in range(P)]
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], names=list(STATISTICS))


# Else a filter on the result would be moved below it and count every text a second time.
text_statistics = text_statistics.asNondeterministic()


def base_failed(stats: Column) -> Column:
    return (stats.n_words < MIN_WORDS) | (100 * stats.n_repeat_words > 50 * stats.n_words)


def features(stats: Column) -> Column:
    """The transformed statistics: length, word length, symbol rate, repetition, repeated lines."""
    words = F.greatest(stats.n_words, F.lit(1)).cast("double")
    chars = F.greatest(stats.word_chars, F.lit(1)).cast("double")
    return F.array(
        F.log(words), F.log(chars / words), F.log1p(200 * stats.n_symbols / chars),
        F.sqrt(stats.n_repeat_words / words), F.log1p(stats.n_dup_lines.cast("double")),
    )


def chi_square_bound(tail: float = TAIL, p: int = P) -> float:
    """Upper chi-square quantile (Wilson-Hilferty, with a bisected normal quantile)."""
    from math import erfc, sqrt

    low, high = 0.0, 40.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if erfc(middle / sqrt(2)) / 2 > tail else (low, middle)
    return p * (1 - 2 / (9 * p) + low * sqrt(2 / (9 * p))) ** 3


_ROW = T.ArrayType(T.DoubleType())


@arrow_udf(T.StructType([T.StructField("mu", _ROW), T.StructField("inv", _ROW), T.StructField("logdet", T.DoubleType())]))
def _solve(n: pa.Array, sums: pa.Array, products: pa.Array) -> pa.Array:
    """Centre, inverse scatter and log determinant from moments; floors keep it regular."""
    rows = []
    for k, s, q in zip(n.to_pylist(), sums.to_pylist(), products.to_pylist(), strict=True):
        mu = np.asarray(s, float) / k
        cov = np.zeros((P, P))
        cov[np.triu_indices(P)] = np.asarray(q, float) / k
        cov = (cov + cov.T - np.diag(np.diag(cov)) - np.outer(mu, mu)) / np.outer(FLOORS, FLOORS)
        values, axes = np.linalg.eigh(cov)
        cov = (axes * np.maximum(values, 1.0)) @ axes.T * np.outer(FLOORS, FLOORS)
        rows.append({"mu": mu.tolist(), "inv": np.linalg.inv(cov).ravel().tolist(), "logdet": float(np.linalg.slogdet(cov)[1])})
    row = pa.list_(pa.float64())
    return pa.array(rows, pa.struct([("mu", row), ("inv", row), ("logdet", pa.float64())]))


def distance(x: Column, mu: Column, inv: Column) -> Column:
    """Squared Mahalanobis distance, spelled out so that it stays in generated code."""
    d = [x[i] - mu[i] for i in range(P)]
    total = F.lit(0.0)
    for i in range(P):
        for j in range(i, P):
            total = total + inv[i * P + j] * d[i] * d[j] * (1 if i == j else 2)
    return total


def _moments(x: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(x[i]) for i in range(P)]).alias("sums"),
        F.array(*[F.sum(x[i] * x[j]) for i in range(P) for j in range(i, P)]).alias("products"),
    ]


def fit(sound: DataFrame) -> DataFrame:
    """Models of every language and source, every language, and all rows together: columns
    level, lang, source, rows, mu, inv, scale. `sound` has lang, source and features x."""
    keys = ["level", "lang", "source"]
    own = F.struct(F.lit(0).alias("level"), "lang", "source")
    of_lang = F.struct(F.lit(1).alias("level"), "lang", F.lit(None).cast("string").alias("source"))
    of_all = F.struct(F.lit(2).alias("level"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"))
    rows = sound.select(F.explode(F.array(own, of_lang, of_all)).alias("k"), "x").select("k.*", "x")
    x = F.col("x")

    def paired(left: DataFrame, right: DataFrame, *more: str) -> DataFrame:
        right = right.withColumnsRenamed({k: f"_{k}" for k in (*keys, *more)})
        on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in (*keys, *more)]
        return left.join(right, on).drop(*[f"_{k}" for k in (*keys, *more)])

    middle = rows.groupBy(*keys).agg(
        *[F.percentile_approx(x[i], F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"q{i}") for i in range(P)],
        *_moments(x),
    )
    spread = [F.greatest(F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2), F.lit(FLOORS[i] ** 2)) for i in range(P)]
    quartiles = F.struct(
        F.lit(0).alias("start"),
        F.array(*[F.col(f"q{i}")[1] for i in range(P)]).alias("mu"),
        F.array(*[1 / spread[i] if i == j else F.lit(0.0) for i in range(P) for j in range(P)]).alias("inv"),
    )
    moments = F.struct(F.lit(1).alias("start"), F.col("m.mu").alias("mu"), F.col("m.inv").alias("inv"))
    both = middle.withColumn("m", _solve("n", "sums", "products")).select(
        *keys, F.col("n").alias("rows"), F.explode(F.array(quartiles, moments)).alias("s")
    )
    models = stored(both.select(*keys, "rows", "s.*"), "models")
    for _ in range(STEPS):
        measured = paired(rows, models).select(*keys, "rows", "start", "x", distance(x, F.col("mu"), F.col("inv")).alias("d"))
        bound = stored(measured.groupBy(*keys, "start").agg(F.percentile_approx("d", F.lit(KEPT_SHARE), 1000).alias("near")), "bounds")
        near = paired(measured, bound, "start").where("d <= near").groupBy(*keys, "start", "rows").agg(*_moments(x))
        models = stored(near.withColumn("m", _solve("n", "sums", "products")).select(*keys, "rows", "start", "m.*"), "models")
    best = models.groupBy(*keys).agg(F.min_by(F.struct("rows", "mu", "inv"), F.struct("logdet", "start")).alias("m")).select(*keys, "m.*")
    best = stored(best, "models")
    # Median distance of normal rows: a consistent scale for the scatter of the nearest rows.
    measured = paired(rows, best).select(*keys, distance(x, F.col("mu"), F.col("inv")).alias("d"))
    middle = measured.groupBy(*keys).agg(F.percentile_approx("d", F.lit(0.5), 1000).alias("middle"))
    scale = F.greatest(F.col("middle") / chi_square_bound(0.5), F.lit(1.0))
    return stored(paired(best, middle).select(*keys, "rows", "mu", "inv", scale.alias("scale")), "models")


def judge(rows: DataFrame, models: DataFrame, stats: str, verdict: str) -> DataFrame:
    """Adds the verdict (true: keep) to rows that carry lang, source and the statistics struct."""
    own = free_name(rows, "_model")
    for level, names in enumerate((["lang", "source"], ["lang"])):
        model = models.where((F.col("level") == level) & (F.col("rows") >= MIN_ROWS)).select(
            *[F.col(c).alias(f"{own}{level}{c}") for c in names], F.struct("mu", "inv", "scale").alias(f"{own}{level}")
        )
        on = [column(c).eqNullSafe(F.col(f"{own}{level}{c}")) for c in names]
        rows = rows.join(model, on, "left").drop(*[f"{own}{level}{c}" for c in names])
    overall = models.where("level = 2").first()  # one row at most
    if overall is None:
        return rows.withColumn(verdict, ~base_failed(column(stats))).drop(own + "0", own + "1")
    whole = F.struct(
        F.array(*map(F.lit, overall.mu)).alias("mu"), F.array(*map(F.lit, overall.inv)).alias("inv"), F.lit(overall.scale).alias("scale")
    )
    model = F.coalesce(F.col(f"{own}0"), F.col(f"{own}1"), whole)
    far = distance(features(column(stats)), model.mu, model.inv) / model.scale > chi_square_bound()
    rows = rows.withColumn(verdict, ~base_failed(column(stats)) & ~F.coalesce(far, F.lit(False)))
    return rows.drop(own + "0", own + "1")


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns only."""
    stats, verdict = free_name(docs, "_stats"), free_name(docs, "_kept")
    narrow = docs.select("lang", "source", text_statistics("text").alias("stats"))
    models = fit(_sound(narrow))
    rows = judge(docs.withColumn(stats, text_statistics("text")), models, stats, verdict)
    return rows.where(column(verdict)).select(*[column(c) for c in docs.columns])


def _sound(rows: DataFrame) -> DataFrame:
    s = F.col("stats")
    return stored(rows.where(~base_failed(s)).select(F.col("lang").cast("string"), F.col("source").cast("string"), features(s).alias("x")), "features")


def outlier_report(docs: DataFrame) -> DataFrame:
    """Statistics and verdict of every document."""
    measured = stored(docs.select("doc_id", "lang", "source", text_statistics("text").alias("stats")), "statistics")
    judged = judge(measured, fit(_sound(measured)), "stats", "kept")
    return judged.select("doc_id", "stats.*", base_failed(F.col("stats")).alias("base_failed"), "kept")
