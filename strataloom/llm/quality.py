"""Quality classifier: a sparse ensemble of rules.

Shallow trees are grown on statistics of labelled texts; each path from a root is a rule, a
conjunction of thresholds. A lasso logistic regression gives most rules no weight; the others
become one Spark column expression. Labels, ids, languages and sources are never inputs.

The fit runs on at most `MAX_LABELLED` labelled rows, those with the smallest hash of their id;
scoring covers every whole text. Defined results: a null or empty text has all statistics 0 and
gets a score; without usable labels, or with one class only, the score is the share of label 1
(one half without any); null labels and labels other than 0 and 1 are not used; a null id is
kept; repeated rows are scored each, and count each in the fit; an empty table gives an empty
table; the statistics have reserved names, so extra columns may have any other.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import GAPS, let, without, words

MAX_LABELLED = 20_000
TREES = 30
DEPTH = 3
ROWS_PER_TREE = 3000
CUTS = 24
PENALTIES = (0.02, 0.005, 0.001)

# Frequent short words of the four languages, in lower case.
FREQUENT = ("the of and to in that is was for on with der die und das von den ist le la les de des et un une du en "
            "est que el los y del por con su para").split()


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text, as struct fields on one pass over its words and lines."""
    chars = F.length(text)

    def share(of: str) -> Column:
        return F.coalesce((chars - F.length(without(text, of))) / F.nullif(chars, F.lit(0)), F.lit(0.0))

    def of_words(w: Column) -> Column:
        n = F.nullif(F.size(w), F.lit(0))
        return F.struct(
            F.size(w).cast("double").alias("n_words"),
            F.coalesce(F.length(without(text, GAPS)) / n, F.lit(0.0)).alias("word_length"),
            F.coalesce(F.size(F.array_distinct(w)) / n, F.lit(0.0)).alias("distinct_words"),
            F.coalesce(F.size(F.filter(w, lambda x: F.lower(x).isin(FREQUENT))) / n, F.lit(0.0)).alias("frequent_words"),
        )

    def of_lines(lines: Column) -> Column:
        n = F.nullif(F.size(lines), F.lit(0))
        return F.struct(
            F.size(lines).cast("double").alias("n_lines"),
            F.coalesce(F.size(F.array_distinct(lines)) / n, F.lit(0.0)).alias("distinct_lines"),
        )

    capitals = F.length(F.regexp_replace(text, r"[^\p{Lu}]++", ""))
    filled = F.filter(F.split(text, "\n"), lambda x: F.length(without(x, GAPS)) > 0)
    return {
        "words": let(words(text), of_words),
        "lines": let(filled, of_lines),
        "chars": F.struct(
            chars.cast("double").alias("n_chars"), share("#*$%&").alias("symbols"), share("|<>").alias("bars"),
            share("!").alias("exclamations"), share(".,;:?").alias("stops"), share("0123456789").alias("digits"),
            F.coalesce(capitals / F.nullif(chars, F.lit(0)), F.lit(0.0)).alias("capitals"),
        ),
    }


FEATURES = ("words.n_words", "words.word_length", "words.distinct_words", "words.frequent_words", "lines.n_lines",
            "lines.distinct_lines", "chars.n_chars", "chars.symbols", "chars.bars", "chars.exclamations", "chars.stops",
            "chars.digits", "chars.capitals")
STATISTICS = "__quality_"


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumns({STATISTICS + name: found for name, found in statistics(text).items()})


Rule = tuple[tuple[int, bool, float], ...]  # conditions: number of the feature, above or not, threshold


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]

    def score(self) -> Column:
        """The score as an expression on the columns of `with_statistics`."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            holds = F.lit(True)
            for feature, above, cut in rule:
                value = F.col(STATISTICS + FEATURES[feature])
                holds = holds & ((value > F.lit(cut)) if above else (value <= F.lit(cut)))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def describe(self) -> list[str]:
        lines = [" and ".join(f"{FEATURES[f]} {'>' if above else '<='} {cut:.6g}" for f, above, cut in rule)
                 for rule in self.rules]
        return [f"{w:+.3f} if {line}" for w, line in zip(self.weights, lines)]


def _grow(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], rng, depth: int, path: Rule, out: set[Rule]) -> None:
    """Best split by squared error among a random half of the features; adds the paths of both sides."""
    if depth == 0 or len(y) < 20 or y.min() == y.max():
        return
    best, chosen = 1e-9, None
    total, n = y.sum(), len(y)
    for f in rng.permutation(x.shape[1])[: (x.shape[1] + 1) // 2]:
        above = x[:, f, None] > cuts[f][None, :]
        na = above.sum(0)
        sa = y @ above
        ok = (na >= 5) & (n - na >= 5)
        if ok.any():
            gain = np.where(ok, sa**2 / np.maximum(na, 1) + (total - sa)**2 / np.maximum(n - na, 1), -1.0) - total**2 / n
            at = int(gain.argmax())
            if gain[at] > best:
                best, chosen = gain[at], (int(f), float(cuts[f][at]))
    if chosen is None:
        return
    f, cut = chosen
    for side in (True, False):
        rows = (x[:, f] > cut) == side
        longer = _joined(path, (f, side, cut))
        out.add(longer)
        _grow(x[rows], y[rows], cuts, rng, depth - 1, longer, out)


def _joined(path: Rule, condition: tuple[int, bool, float]) -> Rule:
    """The path with one more condition; of two on the same side of a feature the tighter stays."""
    f, side, _ = condition
    rest = tuple(c for c in path if c[:2] != (f, side))
    return tuple(sorted((*rest, condition)))


def _holds(x: np.ndarray, rule: Rule) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, above, cut in rule:
        out &= (x[:, f] > cut) == above
    return out


def _lasso(r: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 150) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient for the logistic loss with an absolute penalty on the weights."""
    n, k = r.shape
    step = 4.0 / max(1.0, np.linalg.norm(r, 2)**2 / n + 1.0)
    w, b = np.zeros(k, r.dtype), 0.0
    v, c, t = w, b, 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(r @ v + c, -30, 30))) - y
        moved = v - step * (error @ r) / n
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        b_new = c - step * error.mean()
        t_new = (1 + (1 + 4 * t * t)**0.5) / 2
        v, c = new + (t - 1) / t_new * (new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = new, b_new, t_new
    return float(b), w


def fit_rules(x: np.ndarray, y: np.ndarray, seed: int = 11) -> RuleEnsemble:
    """Trees, their paths as rules, and lasso weights; the penalty is chosen on a fifth of the rows."""
    if len(y) < 40 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        return RuleEnsemble(float(np.log(share / (1 - share))), (), ())
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.02, 0.98, CUTS), method="lower")) for f in range(x.shape[1])]
    # Groups of equal classes, so that a rare class is seen by each tree.
    one, zero = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    rules: set[Rule] = set()
    for _ in range(TREES):
        half = ROWS_PER_TREE // 2
        rows = np.concatenate([rng.choice(g, min(half, len(g)), replace=False) for g in (one, zero)])
        _grow(x[rows], y[rows].astype(float), cuts, rng, DEPTH, (), rules)
    named = sorted(rules)
    held = np.stack([_holds(x, rule) for rule in named], axis=1)
    _, first = np.unique(held, axis=1, return_index=True)  # one of the rules that hold for the same rows
    keep = [k for k in sorted(first) if 0 < held[:, k].sum() < len(y)]
    if not keep:
        return fit_rules(x[:0], y[:0])
    named, r = [named[k] for k in keep], held[:, keep].astype(np.float32)
    test = rng.random(len(y)) < 0.2
    found = []
    for penalty in PENALTIES:
        b, w = _lasso(r[~test], y[~test].astype(np.float32), penalty)
        p = np.clip(1 / (1 + np.exp(-(r[test] @ w + b))), 1e-6, 1 - 1e-6)
        found.append((-(y[test] * np.log(p) + (1 - y[test]) * np.log(1 - p)).mean(), -penalty))
    b, w = _lasso(r, y.astype(np.float32), -min(found)[1])
    used = np.flatnonzero(np.abs(w) > 1e-4)
    return RuleEnsemble(b, tuple(named[k] for k in used), tuple(float(w[k]) for k in used))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> RuleEnsemble:
    """Fit on labelled rows that are not held out."""
    sample = (
        labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__label"))
        .where(F.col("__label").isin(0, 1) & ~held_out(F.col("__id")))
        .orderBy(F.xxhash64("__id"), "__id", "__label").limit(max_labelled)
    )
    texts = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("__text"))
    rows = texts.join(F.broadcast(sample), F.col("__doc") == F.col("__id"))  # at most max_labelled rows
    found = with_statistics(rows, "__text").select(
        "__label", *[F.col(STATISTICS + f).alias(f"f{i}") for i, f in enumerate(FEATURES)])
    # Rows of the documents with a sampled id; a limit on them, too, for ids that many documents share.
    table = found.orderBy(F.xxhash64(*found.columns)).limit(max_labelled).toPandas().sort_values(
        [f"f{i}" for i in range(len(FEATURES))] + ["__label"])
    y = table["__label"].to_numpy(dtype=np.int8)
    return fit_rules(table.drop(columns="__label").to_numpy(dtype=np.float64), y)


def with_score(docs: DataFrame, model: RuleEnsemble, text_col: str = "text", name: str = "score") -> DataFrame:
    """All columns of the input and the score."""
    return with_statistics(docs, text_col).withColumn(name, model.score()).select(*[f"`{c}`" for c in docs.columns], name)


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with a score of one half or more."""
    model = fit_quality(docs, labels, text_col=text_col)
    scored = with_score(docs, model, text_col, "__quality_score")
    return scored.where(F.col("__quality_score") >= 0.5).drop("__quality_score")
