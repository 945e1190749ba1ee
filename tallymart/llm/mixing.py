"""Mixing to target weights with soft membership, in DataFrame functions alone.

1. A naive Bayes classifier is fitted on a bounded sample of a labelled table (the ``sample`` rows
   of least hash): normal densities of four text statistics, and the presence of ``lexicon`` words,
   in turn the best of each domain by mutual information with it, so that a rare domain has its
   words too. It gives every document a probability for each domain.
2. Each document gets a rate r >= 0, so that the expected tokens of each domain, the sum of
   r * tokens * probability, match ``targets``. Of the rates of least squared error those nearest to
   1 are wanted, and they are 1 less a product of the document's probabilities with a multiplier of
   each domain, cut to the bounds. The multipliers solve a smooth convex dual by Newton steps: every
   step is one distributed aggregation, which tries some lengths of the step and yields a vector and
   a matrix of the size of the domains for each. A document's rate is a function of its own
   probabilities and of the multipliers, so nothing else is kept.

A null text has no tokens and the probabilities of the other terms. Labelled rows with a null domain
or a domain without a target are not used; without any usable label all domains are equally likely.
If a target cannot be met, the rates are those of least squared error. Repeated rows get equal rates;
a null doc_id is a document like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import itertools
import warnings
from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallymart.sources.staging import stage

SAMPLE = 4000
LEXICON = 256
STATISTICS = ("log_words", "word_length", "symbols", "distinct")
SOFTNESS = 0.5
STEPS, TOLERANCE = 400, 1e-6
#: Weights of the change of rates beside the squared error, taken in turn, and how near each is
#: followed; the last bounds what the squared error, in shares of all tokens, is above the least.
WEIGHTS, CLOSE = [10.0**-e for e in range(1, 10)], 1e-3
GRID = np.array([1 / 256, 1 / 64, 1 / 16, 1 / 4, 1 / 2, 1.0])  # shares of a step, tried in one pass

#: Domains of the labelled table and what each should have of all tokens.
TARGETS = {"good": 0.9, "poor": 0.08, "toxic": 0.02}


def label_domains(labels: DataFrame) -> DataFrame:
    """doc_id and domain from the columns quality and toxic."""
    domain = (
        F.when(F.col("toxic") == 1, "toxic")
        .when(F.col("quality") == 1, "good")
        .when(F.col("quality") == 0, "poor")
    )
    return labels.select("doc_id", domain.alias("domain"))


def _described(docs: DataFrame) -> DataFrame:
    """Adds _words, n_tokens and the statistics."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[ \t\n\x0b\f\r]+"), lambda w: w != "")
    symbols = F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))
    n = F.greatest(F.col("n_tokens"), F.lit(1))
    return docs.withColumn("_words", words).withColumns(
        {"n_tokens": F.size("_words").cast("long"), "_kinds": F.array_distinct("_words")}
    ).withColumns({
        "log_words": F.log1p("n_tokens"),
        "word_length": F.coalesce(F.length("text") / n, F.lit(0.0)),
        "symbols": F.coalesce(symbols / F.greatest(F.length("text"), F.lit(1)), F.lit(0.0)),
        "distinct": F.size("_kinds") / n,
    })


def _summed(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _looked_up(table: Column) -> Callable[[Column], Column]:
    return lambda word: table[word]


def _told(having: Column, all_having: Column, n: int, total: int) -> Column:
    """What a word tells of a domain of ``n`` of ``total`` rows; below 0 if the others have it more.

    The mutual information from the smoothed counts of rows of the domain and of the others, with
    and without the word, as a sum over the rows.
    """
    cells = [[having, n - having], [all_having - having, (total - n) - (all_having - having)]]
    cells = [[cell + 0.5 for cell in row] for row in cells]
    by_word = [a + b for a, b in zip(*cells)]
    gain = sum(
        cell * F.log(cell * (total + 2.0) / (sum(row) * by_word[j]))
        for row in cells for j, cell in enumerate(row)
    )
    return F.when(cells[0][0] * cells[1][1] > cells[0][1] * cells[1][0], gain).otherwise(-gain)


def _in_turn(rows: list[Row], most: int) -> list[Row]:
    """The best word of each domain, then the second of each, and so on, each word once."""
    by: dict[int, list[Row]] = {}
    for row in sorted(rows, key=lambda r: (-r["gain"], r["word"])):
        by.setdefault(row["domain"], []).append(row)
    turns = itertools.zip_longest(*(by[d] for d in sorted(by)))
    once: dict[str, Row] = {}
    for row in (r for turn in turns for r in turn if r):
        once.setdefault(row["word"], row)
    return list(once.values())[:most]


def _classifier(
    docs: DataFrame, labelled: DataFrame, domains: list[str], sample: int, lexicon: int
) -> dict[str, Column]:
    """Log-likelihood of each domain as an expression over described documents."""
    usable = labelled.select("doc_id", "domain").filter(F.col("domain").isin(domains))
    chosen = usable.dropDuplicates().orderBy(F.xxhash64("doc_id", "domain"), "doc_id", "domain").limit(sample)
    learnt = stage(
        _described(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
        .select("domain", "_kinds", *STATISTICS),
        "labelled",
    )
    rows = learnt.groupBy("domain").agg(
        F.count("*").alias("n"),
        *(F.avg(s).alias(f"{s}_mean") for s in STATISTICS),
        *(F.stddev_pop(s).alias(f"{s}_dev") for s in STATISTICS),
    ).collect()
    seen = {r["domain"]: r for r in rows}
    total = sum(r["n"] for r in rows)

    # for each domain, words by the mutual information of having the word and being of the domain
    counts = [F.count_if(F.col("domain") == d).cast("double").alias(f"_{i}") for i, d in enumerate(domains)]
    found = learnt.select("domain", F.explode("_kinds").alias("word")).groupBy("word").agg(*counts)
    shares = [
        (F.col(f"_{i}") + 0.5) / (seen[d]["n"] + 1.0) if d in seen else F.lit(0.5)
        for i, d in enumerate(domains)
    ]
    overall = sum(F.col(f"_{i}") for i in range(len(domains)))
    weights = [F.log(s).alias(f"_{i}") for i, s in enumerate(shares)]
    listed = [
        found.select("word", _told(F.col(f"_{i}"), overall, seen[d]["n"], total).alias("gain"), *weights)
        .filter("gain > 0").orderBy(F.desc("gain"), "word").limit(lexicon)
        .withColumn("domain", F.lit(i))
        for i, d in enumerate(domains) if d in seen
    ]
    rows = functools.reduce(DataFrame.unionAll, listed).collect() if listed else []
    best = _in_turn(rows, lexicon)
    hits = F.array_intersect("_kinds", F.array(*(F.lit(r["word"]) for r in best)).cast("array<string>"))
    out = {}
    for i, d in enumerate(domains):
        score = F.lit(float(np.log((seen[d]["n"] if d in seen else 0.0) + 1.0) - np.log(total + len(domains))))
        if d in seen:
            for s in STATISTICS:
                dev = max(seen[d][f"{s}_dev"], 1e-3)
                off = (F.col(s) - F.lit(seen[d][f"{s}_mean"])) / F.lit(dev)
                # beyond five deviations nothing more can be told
                score = score - 0.5 * F.least(off * off, F.lit(25.0)) - F.lit(float(np.log(dev)))
        if best:
            weight = F.create_map(*(F.lit(x) for r in best for x in (r["word"], float(r[f"_{i}"]))))
            score = score + _summed(F.transform("_hits", _looked_up(weight)))
        out[d] = score
    return {"_hits": hits, **out}


def domain_probabilities(
    docs: DataFrame, labelled: DataFrame, domains: list[str], sample: int = SAMPLE,
    lexicon: int = LEXICON, carry: Sequence[str] = ("*",),
) -> DataFrame:
    """_document (the columns to carry), n_tokens and an array _p of probabilities."""
    scores = _classifier(docs, labelled, domains, sample, lexicon)
    # columns of the documents that bear a working name here step aside
    own = docs.select(F.struct(*carry).alias("_document"), "text")
    described = _described(own).withColumn("_hits", scores.pop("_hits"))
    scored = described.withColumn("_scores", F.array(*scores.values()))
    likely = F.transform("_scores", lambda s: F.exp(SOFTNESS * (s - F.array_max("_scores"))))
    return scored.withColumn("_likely", likely).select(
        "_document", "n_tokens", F.transform("_likely", lambda x: x / _summed(F.col("_likely"))).alias("_p")
    )


def _rate(steps: list[np.ndarray], domains: int, most: float) -> Column:
    """The rate after all steps, each projected to 0 <= r <= ``most``."""
    if not steps:
        return F.lit(min(1.0, most))
    path = F.array(*(F.array(*(F.lit(float(x)) for x in step)) for step in steps))

    def after(rate: Column, step: Column) -> Column:
        moved = rate - sum(F.col("_p")[i] * step[i] for i in range(domains))
        return F.least(F.greatest(F.lit(0.0), moved), F.lit(most))

    return F.aggregate(path, F.lit(min(1.0, most)), after)


Measured = list[tuple[np.ndarray, np.ndarray]]


def least_squares(
    measure: Callable[[list[np.ndarray]], Measured], goal: np.ndarray
) -> tuple[np.ndarray, bool]:
    """Multipliers whose rates have the least squared error, and whether the search ended there.

    ``measure`` gives for each of some multipliers, as shares of all tokens, the tokens of each
    domain, and the sum of tokens * p * p over the rows at no bound.
    """
    k = len(goal)
    at = np.zeros(k)
    [(tokens, curve)] = measure([at])
    error = tokens - goal
    weight, grid, done = WEIGHTS[0], GRID, 0
    for _ in range(STEPS):
        while np.abs(error - weight * at).max() <= weight * CLOSE * max(1.0, np.abs(at).max()):
            if done + 1 == len(WEIGHTS) or np.abs(error).max() <= TOLERANCE * goal.sum():
                return at, True
            done += 1
            weight = WEIGHTS[done]
        away = error - weight * at
        step = np.linalg.solve(curve + weight * np.eye(k), away)
        found = [(tokens - goal, curve) for tokens, curve in measure([at + t * step for t in grid])]
        # the dual is convex, so the slopes at the ends of the cells bound what it falls by
        slopes = [-(e - weight * (at + t * step)) @ step for t, (e, _) in zip(grid, found)]
        falls = np.cumsum(np.diff(grid, prepend=0.0) * slopes)
        if falls.min() >= 0:
            grid = grid * grid[0]  # a bend nearer than the least step
            continue
        best = np.flatnonzero(falls <= 0.9 * falls.min())[-1]
        at, (error, curve), grid = at + grid[best] * step, found[best], GRID
    return at, False


def fit_rates(
    narrow: DataFrame, wanted: dict[str, float], hold: str | None, most: float,
    fixed: Column | None = None,
) -> list[np.ndarray]:
    """Step vectors for rows of n_tokens and _p; ``hold`` keeps that domain's tokens as they are.

    The rates of ``fixed`` rows are not fitted: they stay at the start.
    """
    domains = list(wanted)
    k = len(domains)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    share = np.array([wanted[d] for d in domains], float)
    share = share / share.sum()
    start = min(1.0, most)
    held = F.lit(False) if fixed is None else fixed

    tokens = [F.col("n_tokens") * F.col("_p")[i] for i in range(k)]
    row = narrow.agg(
        *(F.sum(t).alias(f"t{i}") for i, t in enumerate(tokens)),
        *(F.sum(F.when(held, t)).alias(f"f{i}") for i, t in enumerate(tokens)),
    ).first()
    totals = start * np.array([row[f"t{i}"] or 0.0 for i in range(k)])
    kept = start * np.array([row[f"f{i}"] or 0.0 for i in range(k)])
    size = totals.sum()
    if size == 0:
        return []
    goal = share * (totals[domains.index(hold)] / share[domains.index(hold)] if hold else size)
    open_rows = narrow.filter(~held).select(
        *(F.col("_p")[i].alias(f"p{i}") for i in range(k)), *(t.alias(f"n{i}") for i, t in enumerate(tokens))
    )

    moved = F.lit(start) - sum(F.col(f"p{i}") * F.col(f"at.l{i}") for i in range(k))
    rate, inside = F.least(F.greatest(F.lit(0.0), F.col("m")), F.lit(most)), (F.col("m") > 0) & (F.col("m") < most)
    sums = [F.sum(rate * F.col(f"n{i}")).alias(f"t{i}") for i in range(k)] + [
        F.sum(F.when(inside, F.col(f"n{i}") * F.col(f"p{j}"))).alias(f"g{i}_{j}") for i, j in pairs
    ]

    def measure(tried: list[np.ndarray]) -> Measured:
        # one constant array, so that every pass runs the code that the first has compiled
        each = F.explode(F.array(*(
            F.struct(F.lit(c).alias("c"), *(F.lit(float(x)).alias(f"l{i}") for i, x in enumerate(at)))
            for c, at in enumerate(tried)
        )))
        rated = open_rows.select("*", each.alias("at")).withColumn("m", moved)
        rows = {r["c"]: r for r in rated.groupBy(F.col("at.c").alias("c")).agg(*sums).collect()}
        found = []
        for c in range(len(tried)):
            totals, curve = np.zeros(k), np.zeros((k, k))
            if c in rows:  # else no row is open
                totals = np.array([rows[c][f"t{i}"] or 0.0 for i in range(k)])
                for i, j in pairs:
                    curve[i, j] = curve[j, i] = (rows[c][f"g{i}_{j}"] or 0.0) / size
            found.append(((kept + totals) / size, curve))
        return found

    multipliers, settled = least_squares(measure, goal / size)
    if not settled:
        warnings.warn(f"the rates are short of the least squared error after {STEPS} steps", stacklevel=2)
    return [multipliers]


def mix(
    docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float] = TARGETS,
    hold: str | None = None, most: float = float("inf"), sample: int = SAMPLE,
    lexicon: int = LEXICON, carry: Sequence[str] = ("*",),
) -> DataFrame:
    """_document (the columns to carry), n_tokens, _p in order of ``targets``, and rate.

    With ``hold``, documents likeliest of that domain stay as they are, its expected tokens are the
    measure, and the other documents are fitted to them; without, all domains together do. Rates go
    up to ``most``.
    """
    if not targets or min(targets.values()) <= 0:
        raise ValueError("every domain needs a target above 0")
    domains = list(targets)
    rated = domain_probabilities(docs, labelled, domains, sample, lexicon, carry)
    rated = stage(rated, "memberships")
    fixed = F.col("_p")[domains.index(hold)] >= F.array_max("_p") if hold else F.lit(False)
    steps = fit_rates(rated.select("n_tokens", "_p"), dict(targets), hold, most, fixed)
    rate = F.when(fixed, F.lit(min(1.0, most))).otherwise(_rate(steps, len(domains), most))
    return rated.withColumn("rate", rate)


def repeat_by_rate(mixed: DataFrame) -> DataFrame:
    """The documents, each as often as its rate says; the part below 1 is decided by a hash."""
    even = F.pmod(F.xxhash64("_document.doc_id", "_document.text"), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor(F.col("rate") + even).cast("int")
    kept = mixed.select("_document", copies.alias("_copies")).filter("_copies > 0")
    return kept.select("_document", F.explode(F.sequence(F.lit(1), "_copies"))).select("_document.*")
