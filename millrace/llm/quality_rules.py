"""Quality rules: fixed limits and robust multivariate outliers per language and source, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD_GAP, materialise, packed, unpacked

#: Fixed values of the base rules.
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
SYMBOLS = "#*$%&|<>"
#: Share of a group that the estimates rest on, and refinements of the subset.
SHARE, STEPS = 0.75, 4
#: The estimate of a language and source with n documents counts n / (n + LENT), that of the language the rest.
LENT = 50
#: Parts that a range of values is cut into to count them, and how many rows of a part are counted value by value.
CELLS, LISTED = 1024, 10_000
#: Least standard deviation of each transformed statistic: closer values count as equal.
FLOOR = {"length": 0.05, "symbols": 0.06, "capitals": 0.05, "repeats": 0.12, "lines": 0.15, "marks": 0.04}
#: A document is an outlier beyond this squared distance: the chi-squared quantile of 6 degrees at 1 - 1e-9, doubled,
#: since the statistics of short texts spread wider than those of a normal distribution.
CUTOFF = 110.0
NAMES = list(FLOOR)
#: Measures of the base rules, and those that only the outliers need.
COUNTS, MORE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), ("n_lines", "n_capitals", "n_marks")


def measured(rows: DataFrame) -> DataFrame:
    """The statistics of the column `text` beside what is there, for whole texts; null counts as empty.

    A repeated window is found by sorting window hashes within the row and looking at the neighbours of each.
    """
    text = F.coalesce("text", F.lit(""))
    rows = rows.withColumn("words", F.array_remove(F.split(text, WORD_GAP), ""))
    rows = rows.withColumn("hashes", F.expr("transform(words, w -> xxhash64(w))"))
    rows = rows.withColumn("windows", F.expr(f"""
        if(size(words) < {WINDOW}, cast(array() as array<struct<h: bigint, at: int>>),
           array_sort(transform(sequence(0, size(words) - {WINDOW}), i ->
               struct(xxhash64({", ".join(f"hashes[i + {k}]" for k in range(WINDOW))}) as h, i as at))))"""))
    rows = rows.withColumn("again", F.expr("""
        array_sort(transform(filter(transform(windows, (w, i) ->
            if(windows[i - 1].h = w.h or windows[i + 1].h = w.h, w.at, null)), a -> a is not null), a -> a))""".replace(
                "windows[i - 1].h", "get(windows, i - 1).h").replace("windows[i + 1].h", "get(windows, i + 1).h")))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return rows.withColumn("lines", lines).select(
        *[c for c in rows.columns if c not in ("words", "hashes", "windows", "again", "text")],
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.translate(text, " \t\n\x0b\f\r", "")).cast("bigint").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr(f"""aggregate(transform(again, (a, i) -> least({WINDOW}, coalesce(get(again, i + 1) - a, {WINDOW}))),
                             0L, (s, n) -> s + n)""").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        (F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).alias("n_capitals"),
        (F.char_length(text) - F.char_length(F.translate(text, ".,;:!?", ""))).alias("n_marks"),
    )


def _transformed() -> dict[str, Column]:
    """The statistics on scales where good texts of all lengths spread alike: logarithms of means, roots of shares."""
    chars, words, lines = (F.greatest(F.lit(1), F.col(c)).cast("double") for c in ("word_chars", "n_words", "n_lines"))
    return {
        "length": F.log(chars / words),
        "symbols": F.sqrt(F.col("n_symbols") / words),
        "capitals": F.sqrt(F.col("n_capitals") / chars),
        "repeats": F.sqrt(F.col("n_repeat_words") / words),
        "lines": F.sqrt(F.col("n_dup_lines") / lines),
        "marks": F.sqrt(F.col("n_marks") / chars),
    }


def _failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _moments(points: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and covariance of each group, from sums that are aggregated before the shuffle, with the factor of `_factored`.

    The floors are added to the diagonal, so the factor exists for groups of one point or of equal points as well.
    """
    d = range(len(NAMES))
    floor = lambda i, j: F.lit(FLOOR[NAMES[i]] ** 2 if i == j else 0.0)
    sums = points.groupBy(*keys).agg(
        F.array(*[F.avg(name) for name in NAMES]).alias("mean"),
        F.array(*[F.covar_pop(NAMES[i], NAMES[j]) + floor(i, j) for i in d for j in range(i + 1)]).alias("covariance"))
    return _factored(sums, keys)


def _factored(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Adds the inverse Cholesky factor of the `covariance`, row by row without the zeros above its diagonal, and the
    logarithm of the determinant."""
    d = range(len(NAMES))
    steps, at = [], {(i, j): n for n, (i, j) in enumerate((i, j) for i in d for j in range(i + 1))}
    for i in d:
        for j in range(i + 1):
            rest = " - ".join([f"covariance[{at[i, j]}]", *(f"l{i}{k} * l{j}{k}" for k in range(j))])
            steps.append(f"sqrt(greatest({rest}, 1e-12D)) as l{i}{i}" if i == j else f"({rest}) / l{j}{j} as l{i}{j}")
    for i in d:
        for j in range(i):
            steps.append(f"-({' + '.join(f'l{i}{k} * v{k}{j}' for k in range(j, i))}) / l{i}{i} as v{i}{j}")
        steps.append(f"1 / l{i}{i} as v{i}{i}")
    out = [f"{' + '.join(f'ln(l{i}{i})' for i in d)} as determinant",
           f"array({', '.join(f'v{i}{j}' for i in d for j in range(i + 1))}) as factor"]
    return frame.selectExpr(*keys, "mean", "covariance", *steps, *out).select(*keys, "determinant", "mean", "covariance", "factor")


def _distance(points: DataFrame) -> DataFrame:
    """The squared Mahalanobis distance of each point to the `mean` and inverse `factor` beside it.

    It goes through a generator: filters on it would copy it, which makes code that is too long to be compiled.
    """
    terms, at = [], 0
    for i in range(len(NAMES)):
        part = " + ".join(f"factor[{at + k}] * ({NAMES[k]} - mean[{k}])" for k in range(i + 1))
        terms.append(f"power({part}, 2)")
        at += i + 1
    return points.select("*", F.explode(F.array(F.expr(" + ".join(terms)))).alias("distance"))


def _matched(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join in which null equals null."""
    renamed = right.select(*[F.col(k).alias(f"{k}_") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"{k}_" for k in keys])


def _holding(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Of the counted `cells` of each group the one in which the place `rank` lies, with the place within it."""
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return cells.withColumn("upto", upto).where("rank > upto - n and rank <= upto").select(
        *keys, "total", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), "n", "low", "high")


def percentiles(values: DataFrame, keys: list[str], shares: list[float]) -> DataFrame:
    """`keys`, `share`, `value` and `total`: for each group of `keys` and each share the least `value` that so large a share
    of the group does not exceed, and the rows of the group. No value may be negative.

    All rows are counted, and the result is one of them, however they are dealt. The cells of a logarithmic grid are
    counted first, with partial aggregates; then the values of the one cell that holds the place, or parts of it as long
    as it has more than LISTED rows. What meets in a task grows with the cells and not with the rows. The driver sees
    one number a round.
    """
    counts = [F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")]
    cells = values.groupBy(*keys, F.floor(CELLS * F.log2(1 + CELLS * F.col("value"))).alias("cell")).agg(*counts)
    cells = cells.withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
    cells = cells.withColumn("share", F.explode(F.array(*map(F.lit, shares)))).withColumn("rank", F.ceil(F.col("share") * F.col("total")))
    by_share = [*keys, "share"]
    found = materialise(_holding(cells, by_share), "percentiles")
    while most := found.where("low < high").agg(F.max("n")).first()[0]:
        inside = _matched(values, found.drop("n"), keys).where("value >= low and value <= high")
        part = "value" if most <= LISTED else f"coalesce(floor((value - low) / nullif(high - low, 0D) * {CELLS}), 0)"
        cells = inside.groupBy(*by_share, "total", "rank", F.expr(part).alias("cell")).agg(*counts)
        found = _holding(cells, by_share)
        if most <= LISTED:
            break
        found = materialise(found, "percentiles")
    return found.select(*by_share, F.col("low").alias("value"), "total")


def estimates(points: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant mean and factor for each `lang` and `source` of `points`, and of each `lang`
    (source null and `own` false).

    Two starts per group, as starting with random subsets would not be repeatable: the points nearest the medians in
    units of the median deviation, and the points nearest the mean. Each step takes the SHARE of points nearest to the
    last estimate (the limit is the exact percentile of all of them) and estimates anew; the start with the smaller
    determinant wins. The covariance of the subset is scaled to that of the whole by the distance in its middle.
    At the end the estimate of a source leans on that of its language, the less the more documents it has, without a
    size from which it would change all at once.
    """
    both = points.select(*NAMES, F.explode(F.array(F.struct("lang", "source", F.lit(True).alias("own")),
                                                   F.struct("lang", F.lit(None).cast("string").alias("source"), F.lit(False).alias("own")))
                                           ).alias("g")).select(*NAMES, "g.*")
    group = ["lang", "source", "own"]

    named = both.select(*group, F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in NAMES])).alias("v"))
    centre = percentiles(named.select(*group, "v.*"), [*group, "name"], [0.25, 0.5, 0.75]).groupBy(*group).agg(
        F.map_from_entries(F.collect_list(F.struct(F.struct("name", "share"), "value"))).alias("at"))
    at = lambda i, share: F.col("at")[F.struct(F.lit(NAMES[i]), F.lit(share))]
    d = range(len(NAMES))
    robust = centre.select(*group, F.lit("median").alias("start"), F.array(*[at(i, 0.5) for i in d]).alias("mean"), F.array(*[
        1 / F.greatest((at(i, 0.75) - at(i, 0.25)) / 1.349, F.lit(FLOOR[NAMES[i]])) if i == j else F.lit(0.0)
        for i in d for j in range(i + 1)]).alias("factor"))
    plain = _moments(both, group).select(*group, F.lit("mean").alias("start"), "mean", "factor")
    current = materialise(robust.union(plain), "estimates")
    keys = [*group, "start"]
    for _ in range(STEPS):
        near = _distance(_matched(both, current.select(*keys, "mean", "factor"), group))
        limits = percentiles(near.select(*keys, F.col("distance").alias("value")), keys, [SHARE])
        # Written first: a list of known size is sent to the points, which would be shuffled by group to meet it otherwise.
        limits = materialise(limits.select(*keys, F.col("value").alias("limit")), "estimates")
        inside = _matched(near.drop("mean", "factor"), limits, keys).filter("distance <= limit")
        current = materialise(_moments(inside, keys), "estimates")
    best = current.groupBy(*group).agg(F.min_by(F.struct("mean", "covariance", "factor"), F.struct("determinant", "start")).alias("e")).select(
        *group, "e.*")
    sizes = percentiles(_distance(_matched(both, best, group)).select(*group, F.col("distance").alias("value")), group, [0.5]).select(
        *group, F.col("total").alias("n"), F.col("value").alias("middle"))
    # The median of the chi-squared distribution of 6 degrees is 5.348; the floors must not shrink.
    scaled = _matched(best, sizes, group).select(*group, "n", "mean", F.transform(
        "covariance", lambda c: c * F.greatest(F.lit(1.0), F.col("middle") / 5.348)).alias("covariance"))
    scaled = materialise(scaled, "estimates")
    general = scaled.where("not own").select("lang", F.struct("mean", "covariance").alias("general"))
    share = F.when(F.col("own"), F.col("n") / (F.col("n") + LENT)).otherwise(1.0)
    lent = lambda name: F.zip_with(name, f"general.{name}", lambda a, b: share * a + (1 - share) * b)
    blended = _matched(scaled, general, ["lang"]).select(*group, lent("mean").alias("mean"), lent("covariance").alias("covariance"))
    # Written first, as the factor asks for each element of the covariance many times.
    blended = materialise(blended, "estimates")
    return materialise(_factored(blended, group).select(*group, "mean", "factor"), "estimates")


def fitted(rows: DataFrame) -> DataFrame:
    """The estimates for measured rows, from those that the base rules pass.

    The measures are written before they are filtered: a filter on them would move below the measuring of rows that are
    not written yet, and measure there for each of its conditions.
    """
    measures = materialise(rows.select("lang", "source", *COUNTS, *MORE), "points")
    points = measures.filter(~_failed()).select("lang", "source", *[c.alias(n) for n, c in _transformed().items()])
    return estimates(points)


def judged(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Measured rows with base_failed, distance and kept. Needs `lang` and `source`, of which null is a value like any other."""
    # A source of which no document passes the base rules has no estimate; that of its language gives the distances.
    own = found.filter("own").select("lang", "source", F.struct("mean", "factor").alias("own_"))
    general = found.filter("not own").select("lang", F.struct("mean", "factor").alias("general_"))
    used = F.coalesce("own_", "general_")
    with_both = _matched(_matched(rows, own, ["lang", "source"], "left"), general, ["lang"], "left")
    placed = with_both.withColumns({"mean": used["mean"], "factor": used["factor"], **_transformed()})
    far = _distance(placed).withColumn("base_failed", _failed())
    # One comparison of values from both sides: a filter on it can't be taken apart and measure texts a second time.
    limit = F.when(F.col("base_failed"), F.lit(1e300)).otherwise(F.lit(0.0))
    return far.withColumn("kept", F.greatest(F.coalesce("distance", F.lit(0.0)), limit) <= CUTOFF).drop(
        "own_", "general_", "mean", "factor", *NAMES)


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and distance of every document.

    Null and empty texts have no words and fail the base rules. Repeated rows stay repeated, an empty table gives an
    empty result, and null languages or sources form groups of their own.
    """
    rows = materialise(measured(docs.select("doc_id", "lang", "source", "text")), "measured")
    return judged(rows, fitted(rows)).select("doc_id", *COUNTS, "base_failed", "kept", "distance")


def passing(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, unchanged. Each is measured once, and written with its measures: fitting reads
    the measures alone."""
    rows = packed(docs).select("row", F.col("row.lang").alias("lang"), F.col("row.source").alias("source"), F.col("row.text").alias("text"))
    rows = materialise(measured(rows), "measured")
    return unpacked(judged(rows, fitted(rows)).filter("kept"))
