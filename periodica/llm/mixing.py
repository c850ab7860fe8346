"""Mixing sources to target weights: raking of token weights, then calibrated sampling.

Every document falls into a cell of source, language and topic; values that a target doesn't list
form the class `*`. Spark counts the tokens of each cell over all documents. Iterative proportional
fitting scales the cells' token weights to the target share of each source, then language, then
topic, again and again until all three hold. There are at most as many cells as the targets' lists
allow, (sources + 1) x (languages + 1) x (topics + 1), whatever the corpus, so the fit runs on the
driver.

A cell's rate is its share of the token budget over the tokens it has. With repeats a document is
taken floor(rate) times, and once more with the remaining probability; without, the fit keeps every cell's
weight at or below the tokens it has (raking with bounds), so that rates are probabilities. The draw is a keyed hash of id and text: it doesn't depend on order, partitions or other documents.

Defined results: a null value, or one not listed, is of class `*`. Its target may be OBSERVED: it keeps
the share of the tokens that it has, and the listed targets are scaled to the rest. `unlisted` sets that
for each dimension without a target for `*`, and holds for the production mix unless switched off, so
that no source, language or topic is left out for not being listed. A class with a target but without
tokens gives its share to the others; a class with tokens but without a target (or with weight 0) is
left out. Texts without words are never taken. If empty or bounded cells make the targets contradict
each other, the fit ends after `MAX_ROUNDS` with what is nearest, and the column `error` tells the
largest deviation of a share; above `REPORTED` it is logged too. Equal rows share one
draw. Empty tables give empty tables; added columns are named so that none of `docs` is hidden.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm.common import free_name, table

OTHER = "*"
#: As a target of `*`: the share of the tokens that it has.
OBSERVED = None
#: Deviations above this are logged.
REPORTED = 0.01
Targets = Mapping[str, Mapping[str, float | None]]
LOG = logging.getLogger(__name__)
MAX_ROUNDS = 500
TOLERANCE = 1e-9
SEED = 20

# The production mix. The source with most tokens is held at a fifth; what isn't listed
# keeps its share.
SOURCES = {"src0": 0.20} | {f"src{i}": 0.80 / 19 for i in range(1, 20)}
LANGUAGES = {"en": 0.55, "de": 0.17, "fr": 0.17, "es": 0.11}
TOPICS = {"prose": 0.60, "long": 0.20, "short": 0.05, "table": 0.08, "marked": 0.07}
PRODUCTION = {"source": SOURCES, "lang": LANGUAGES, "topic": TOPICS}
LONG, SHORT = 1000, 50


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def form_topic(text: Column, words: Column) -> Column:
    """The form of a text stands for its topic where documents carry none."""
    bars = F.char_length(text) - F.char_length(F.replace(text, F.lit("|"), F.lit("")))
    marks = F.regexp_count(text, F.lit(r"[#$%&]{3}|!!"))
    return (
        F.when(4 * bars >= words, F.lit("table"))
        .when(4 * marks >= words, F.lit("marked"))
        .when(words >= LONG, F.lit("long"))
        .when(words < SHORT, F.lit("short"))
        .otherwise(F.lit("prose"))
    )


def class_of(value: Column, target: Mapping[str, float | None]) -> Column:
    listed = value.isin([x for x in target if x != OTHER])
    return F.when(F.coalesce(listed, F.lit(False)), value).otherwise(F.lit(OTHER))


def raked(
    cells: np.ndarray, targets: list[np.ndarray], most: np.ndarray | None = None
) -> tuple[np.ndarray, float]:
    """Cell shares with the margins of `targets`, by proportional fitting of `cells`; the error left.
    No share exceeds `most`."""
    shares = cells.astype(float)
    goals = []
    for axis, target in enumerate(targets):
        others = tuple(i for i in range(cells.ndim) if i != axis)
        goal = np.where(cells.sum(axis=others) > 0, target, 0.0)
        goals.append((axis, others, goal / goal.sum() if goal.sum() else goal))
    error = np.inf
    for _ in range(MAX_ROUNDS):
        for axis, others, goal in goals:
            now = shares.sum(axis=others)
            factor = np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)
            shares = shares * np.expand_dims(factor, others)
            if most is not None:
                shares = np.minimum(shares, most)
        error = max(float(np.abs(shares.sum(axis=o) - g).max()) for _, o, g in goals)
        if error < TOLERANCE:
            break
    return shares, error


@dataclass
class Mix:
    """Rates per cell: (class of each dimension, tokens, share, rate)."""

    rows: list[tuple]
    error: float
    budget: float


def goal_of(names: list[str], target: Mapping[str, float | None], tokens: np.ndarray) -> np.ndarray:
    """The target share of each class; an OBSERVED one from the tokens of the classes."""
    goal = np.array([target.get(x) or 0.0 for x in names])
    if OTHER not in target or target[OTHER] is not OBSERVED:
        return goal
    goal = np.where(tokens > 0, goal, 0.0)
    kept = tokens[-1] / tokens.sum()
    goal = goal * (1 - kept) / goal.sum() if goal.sum() else goal
    goal[-1] = kept
    return goal


def fit(
    cells: list[tuple],
    targets: Targets,
    budget_share: float = 1.0,
    repeats: bool = True,
    unlisted: bool | None = None,
) -> Mix:
    """`cells` are (class per dimension..., tokens); without repeats no rate exceeds one. `unlisted`: `*`
    without a target keeps its share; None: for the production mix."""
    if unlisted or (unlisted is None and targets is PRODUCTION):
        targets = {d: {OTHER: OBSERVED} | t for d, t in targets.items()}
    names = [[*(x for x in t if x != OTHER), OTHER] for t in targets.values()]
    counts = np.zeros([len(x) for x in names])
    for *at, tokens in cells:
        counts[tuple(names[i].index(v) for i, v in enumerate(at))] += tokens
    if not counts.sum():
        return Mix([], 0.0, 0.0)
    margins = [counts.sum(axis=tuple(set(range(len(names))) - {i})) for i in range(len(names))]
    goals = [goal_of(n, t, m) for n, t, m in zip(names, targets.values(), margins, strict=True)]
    budget = budget_share * float(counts.sum())
    shares, error = raked(counts, goals, None if repeats or not budget else counts / budget)
    rates = np.divide(budget * shares, counts, out=np.zeros_like(shares), where=counts > 0)
    rows = [
        (*(names[i][k] for i, k in enumerate(at)), int(counts[at]), float(shares[at]), float(rates[at]))
        for at in zip(*np.nonzero(counts), strict=True)
    ]
    return Mix(rows, error, budget)


def with_cells(docs: DataFrame, targets: Targets) -> tuple[DataFrame, list]:
    """`docs` with the number of tokens and the class of each dimension; the new columns' names."""
    new: list[str] = []
    for wish in ["n_tokens", *(f"class_{d}" for d in targets)]:
        new.append(free_name([*docs.columns, *new], wish))
    text = F.coalesce(F.col("`text`"), F.lit(""))
    rows = docs.withColumn(new[0], word_count(text))
    for name, (dimension, target) in zip(new[1:], targets.items(), strict=True):
        own = dimension in docs.columns
        value = F.col(f"`{dimension}`").cast("string") if own else form_topic(text, F.col(new[0]))
        rows = rows.withColumn(name, class_of(value, target))
    return rows, new


def mixed(
    docs: DataFrame,
    targets: Targets = PRODUCTION,
    budget_share: float = 1.0,
    repeats: bool = True,
    seed: int = SEED,
    unlisted: bool | None = None,
) -> DataFrame:
    """`docs` with n_tokens, the classes, cell_tokens, share, rate, error (of the whole fit) and copies
    (how often it is taken).

    `budget_share` times the corpus's tokens is the budget. A dimension that `docs` has no column for
    is the topic, told from the text's form."""
    rows, new = with_cells(docs, targets)
    n_tokens, classes = new[0], new[1:]
    cells = rows.groupBy(*classes).agg(F.sum(n_tokens).alias("tokens"))
    # as many rows as the targets' lists allow
    found = [tuple(r) for r in cells.filter("tokens > 0").collect()]
    mix = fit(found, targets, budget_share, repeats, unlisted)
    if mix.error > REPORTED:
        LOG.warning("mixing: the targets can't be reached, a share is off by %.4f", mix.error)
    named = [f"{c}_at" for c in classes]
    schema = ", ".join([*(f"`{c}` string" for c in named), "cell_tokens long, share double, rate double"])
    rates = F.broadcast(docs.sparkSession.createDataFrame(mix.rows, schema))
    match = [F.col(c) == F.col(a) for c, a in zip(classes, named, strict=True)]
    last = {x: free_name(rows.columns, x) for x in ("cell_tokens", "share", "rate", "error", "copies")}
    for x in ("cell_tokens", "share", "rate"):
        rates = rates.withColumnRenamed(x, f"{last[x]}_new")
    rows = rows.join(rates, match, "left").drop(*named)
    for x in ("cell_tokens", "share", "rate"):
        rows = rows.withColumnRenamed(f"{last[x]}_new", last[x])
    rate = F.coalesce(F.col(last["rate"]), F.lit(0.0))
    draw = F.xxhash64(F.lit(seed), F.col("`doc_id`"), F.col("`text`"))
    unit = F.shiftrightunsigned(draw, 11) / F.lit(float(1 << 53))
    once_more = (unit < rate - F.floor(rate)).cast("long")
    taken = F.floor(rate) + once_more
    return rows.withColumn(last["error"], F.lit(mix.error)).withColumn(
        last["copies"], F.when(F.col(n_tokens) > 0, taken).otherwise(0).cast("int")
    )


def sampled(
    docs: DataFrame,
    targets: Targets = PRODUCTION,
    budget_share: float = 0.8,
    seed: int = SEED,
    unlisted: bool | None = None,
) -> DataFrame:
    """The rows of `docs`, all columns, of a sample with the target shares; no row is repeated."""
    rows = mixed(docs, targets, budget_share, False, seed, unlisted)
    copies = [c for c in rows.columns if c not in docs.columns][-1]
    return rows.filter(F.col(copies) > 0).select([F.col(f"`{c}`") for c in docs.columns])


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixed(docs, budget_share=0.8).drop("text")


QUERIES = {"op4_mixing": op4_mixing}
ORACLE: dict[str, str] = {}
