"""Quality rules: base rules, and robust multivariate outliers per language and source.

Each text gives a vector of transformed statistics; shares enter by their empirical
log-odds.  Per group of language and source the minimum-covariance-determinant estimates
are found by concentration steps: mean and covariance are taken anew over the half of the
rows nearest by Mahalanobis distance.  Rows with equal vectors, as exact copies have,
count once there.  There are three starts around the medians: quartile spreads only, and
the covariances of the rows' directions and of their squashed values.  After ``TRIES``
steps the start with the smallest determinant goes on until that stops falling.  Every
step is two aggregations over narrow rows (an approximate quantile of the distances, then
moments), so a group may hold any share of the rows.  Distances come from a Cholesky
factor written out as columns.  Rows beyond ``cutoff`` are rejected; the distance is
rescaled so that its median over different vectors is that of a normal sample.

Many shares are zero in most texts and then vary by the length only.  ``FLOORS`` add to
each spread about half of what a first hit changes, which keeps the matrix invertible;
each statistic alone can still pass the cutoff.

Groups with fewer than ``LEAST`` rows are pooled by language, and what is still short over
all languages; a pool below ``TOO_FEW`` rows rejects nothing.

Cases.  Null text: no words, which fails the base rule, as does the empty text.  Null
language or source is a value of its own.  Rows that fail the base rules take no part in
the estimates.  Ties at the quantile are all taken.  Repeated rows are judged alike.  Empty
table: empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from duskwatch.llm.common import SPACE_CHARS, stored, text_of, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COVER, TRIES = 0.5, 2
LEAST, TOO_FEW = 60, 12
VECTOR = ("word_length", "symbols", "repeated_lines", "repeated_words", "capitals", "marks")
# Added standard deviation of each, and by how much a log determinant has to fall.
FLOORS = (0.35, 0.5, 0.5, 0.5, 0.5, 0.5)
FALL = 0.01
# One normal row in so many is rejected.
ONE_IN = 10 ** 7


def chi_square(tail: float, half: int = len(VECTOR) // 2) -> float:
    """What a chi-square number of 2 * half degrees of freedom exceeds with probability tail."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        x = (low + high) / 2
        above = math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(half))
        low, high = (x, high) if above > tail else (low, x)
    return low


MEDIAN, CUTOFF = chi_square(0.5), chi_square(1 / ONE_IN)


def _removed(text: Column, chars: str) -> Column:
    """How many characters of a text are among chars."""
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def repeated_words(df: DataFrame, column: str, name: str, width: int = WINDOW) -> DataFrame:
    """Add how many words lie in windows of ``width`` words found at least twice in the row.

    ``column`` holds the words' hashes.  Windows are hashed and sorted; only rows with
    equal neighbours look for the places.
    """
    rest = [c for c in df.columns if c != column]
    at = F.sequence(F.lit(1), F.size(column) - (width - 1))
    hashed = F.when(F.size(column) >= width, F.transform(
        at, lambda i: F.xxhash64(F.slice(F.col(column), i, F.lit(width)))))
    out = df.select(*rest, hashed.alias("__windows"))
    out = out.select("*", F.sort_array("__windows").alias("__sorted"))
    twice = F.exists(F.sequence(F.lit(1), F.size("__sorted") - 1),
                     lambda i: F.get("__sorted", i) == F.get("__sorted", i - 1))
    out = out.select(*rest, F.when((F.size("__sorted") > 1) & twice, F.sort_array(F.transform(
        "__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("__pairs"))
    same = lambda x, k: F.get("__pairs", k)["h"] == x["h"]
    out = out.select(*rest, F.sort_array(F.transform(F.filter(
        "__pairs", lambda x, k: F.coalesce(same(x, k + 1), F.lit(False)) | F.coalesce(
            same(x, k - 1), F.lit(False))), lambda x: x["i"])).alias("__starts"))
    width_at = F.transform("__starts", lambda p, k: F.least(
        F.lit(width), F.coalesce(F.get("__starts", k + 1) - p, F.lit(width))))
    return out.select(*rest, F.coalesce(F.aggregate(width_at, F.lit(0), lambda a, x: a + x),
                                        F.lit(0)).cast("long").alias(name))


def base_rules(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the base statistics, base_failed, and further statistics."""
    text = F.col("text")
    df = docs.select("doc_id", "lang", "source", text_of().alias("text"))
    df = df.select("*", F.filter(F.split("text", "\n", -1), lambda x: F.char_length(
        F.trim(x, F.lit(SPACE_CHARS))) > 0).alias("__lines"), words(text).alias("__words"))
    df = df.select(
        "doc_id", "lang", "source", F.size("__words").cast("long").alias("n_words"),
        (F.char_length("text") - _removed(text, SPACE_CHARS)).cast("long").alias("word_chars"),
        _removed(text, SYMBOLS).cast("long").alias("n_symbols"),
        F.size("__lines").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        _removed(text, UPPER).alias("n_upper"), _removed(text, "!?=_{}[]").alias("n_marks"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__hashes"))
    df = repeated_words(df, "__hashes", "n_repeat_words")
    return df.withColumn("base_failed", (F.col("n_words") < 20)
                         | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def _odds(hits: str, of: str, least: int = 1) -> Column:
    """Log-odds of a share, with half of the least possible hit added on either side."""
    return F.log((F.col(hits) + least / 2) / (F.greatest(F.col(of) - F.col(hits), F.lit(0)) + least / 2))


def vector() -> list[Column]:
    """The transformed statistics."""
    return [F.col("word_chars") / F.greatest("n_words", F.lit(1)), _odds("n_symbols", "word_chars"),
            _odds("n_dup_lines", "n_lines"), _odds("n_repeat_words", "n_words", WINDOW + 1),
            _odds("n_upper", "word_chars"), _odds("n_marks", "word_chars")]


def _x(i: int) -> str:
    return f"x{i}"


D = range(len(VECTOR))


def _factor(moments: DataFrame) -> DataFrame:
    """Columns m<i>, c<i>_<j> to m<i> and the Cholesky factor l<i>_<j>, step by step."""
    for j in D:
        for i in D[j:]:
            s = F.col(f"c{i}_{j}") + (F.lit(FLOORS[i] ** 2) if i == j else F.lit(0.0))
            for k in range(j):
                s = s - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            moments = moments.withColumn(
                f"l{i}_{j}", F.sqrt(F.greatest(s, F.lit(1e-9))) if i == j else s / F.col(f"l{j}_{j}"))
    spread = sum((2 * F.log(f"l{i}_{i}") for i in D), F.lit(0.0))
    return moments.select("grp", "start", spread.alias("det"), *[f"m{i}" for i in D],
                          *[f"l{i}_{j}" for i in D for j in range(i + 1)])


def _distances(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows with d2, the squared Mahalanobis distance in their group (null without one)."""
    out = rows.join(state, "grp", "left")
    for i in D:
        s = F.col(_x(i)) - F.col(f"m{i}")
        for k in range(i):
            s = s - F.col(f"l{i}_{k}") * F.col(f"z{k}")
        out = out.withColumn(f"z{i}", s / F.col(f"l{i}_{i}"))
    total = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in D), F.lit(0.0))
    return out.select(*rows.columns, "start", total.alias("d2"))


def _starts(rows: DataFrame) -> DataFrame:
    """Per group three centres and factors to begin with."""
    quart = rows.groupBy("grp").agg(*[F.percentile_approx(_x(i), [0.25, 0.5, 0.75]).alias(f"q{i}")
                                      for i in D])
    quart = quart.select("grp", *[F.col(f"q{i}")[1].alias(f"m{i}") for i in D],
                         *[((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349).alias(f"s{i}") for i in D])
    quart = stored(quart, "quartiles")
    at = rows.join(quart, "grp").select("grp", *[
        ((F.col(_x(i)) - F.col(f"m{i}")) / F.sqrt(F.col(f"s{i}") ** 2 + FLOORS[i] ** 2)).alias(f"z{i}")
        for i in D])
    square = F.greatest(sum((F.col(f"z{i}") ** 2 for i in D), F.lit(0.0)), F.lit(1e-9))
    pairs = [(i, j) for i in D for j in range(i + 1)]
    at = at.select("*", square.alias("square")).groupBy("grp").agg(
        *[(len(D) * F.avg(F.col(f"z{i}") * F.col(f"z{j}") / F.col("square"))).alias(f"u{i}_{j}")
          for i, j in pairs],
        *[F.avg(F.tanh(f"z{i}") * F.tanh(f"z{j}")).alias(f"t{i}_{j}") for i, j in pairs])
    scaled = lambda k, i, j: F.col(f"s{i}") * F.col(f"s{j}") * (
        F.lit(float(i == j)) if k == "q" else F.col(f"{k}{i}_{j}"))
    both = quart.join(at, "grp")
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("start"), *[
        scaled(k, i, j).alias(f"c{i}_{j}") for i, j in pairs]) for k in "qut"]))
    moments = both.select("grp", *[f"m{i}" for i in D], each.alias("of"))
    return stored(_factor(moments.select("grp", *[f"m{i}" for i in D], "of.*")), "mcd")


def _step(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Centres and factors over the rows nearest by those given."""
    far = stored(_distances(rows, state), "distances")
    near = far.groupBy("grp", "start").agg(F.percentile_approx("d2", COVER, 1000).alias("cut"))
    return stored(_factor(far.join(near, ["grp", "start"]).where("d2 <= cut").groupBy("grp", "start").agg(
        *[F.avg(_x(i)).alias(f"m{i}") for i in D],
        *[F.covar_pop(_x(i), _x(j)).alias(f"c{i}_{j}") for i in D for j in range(i + 1)])), "mcd")


def estimates(rows: DataFrame) -> DataFrame:
    """Per group: centre and factor of the least covariance.  rows: grp, x0, x1, ..."""
    rows = stored(rows.distinct(), "vectors")
    state = _starts(rows)
    for _ in range(TRIES):
        state = _step(rows, state)
    best = lambda df: (df.groupBy("grp").agg(F.min_by(F.struct(*state.columns), "det").alias("of"))
                       .select("of.*"))
    state = stored(best(state), "mcd")
    going = state
    while True:      # only groups whose determinant fell go on; it is bounded by the floors
        new = _step(rows.join(going.select("grp"), "grp", "left_semi"), going)
        last = going.select("grp", F.col("det").alias("last"))
        going = stored(new.join(last, "grp").where(F.col("det") < F.col("last") - FALL).drop("last"), "mcd")
        if not going.head(1):
            return state
        state = stored(best(state.union(going)), "mcd")


def quality_rules(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Base statistics, base_failed, kept and the squared robust distance of every row."""
    base = stored(base_rules(docs).select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", *[x.cast("double").alias(_x(i)) for i, x in enumerate(vector())]),
        "rules")
    good = base.where(~F.col("base_failed"))
    sizes = good.groupBy("lang", "source").count()
    by_lang = (sizes.where(F.col("count") < LEAST).groupBy("lang").agg(F.sum("count").alias("pool")))
    own = F.to_json(F.struct("lang", "source"))
    groups = (sizes.join(by_lang.withColumnRenamed("lang", "l"), F.col("lang").eqNullSafe(F.col("l")), "left")
              .select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"),
                      F.when(F.col("count") >= LEAST, own)
                      .when(F.col("pool") >= LEAST, F.to_json(F.struct("lang")))
                      .otherwise("all").alias("grp")))
    placed = stored(base.join(groups, F.col("lang").eqNullSafe(F.col("g_lang"))
                              & F.col("source").eqNullSafe(F.col("g_source")), "left")
                    .drop("g_lang", "g_source"), "grouped")
    good = placed.where(~F.col("base_failed"))
    state = estimates(good.select("grp", *[_x(i) for i in D]))
    far = stored(_distances(placed, state), "distances")
    tested = far.where(~F.col("base_failed"))
    scale = tested.select("grp", *[_x(i) for i in D], "d2").distinct().groupBy("grp").agg(
        F.greatest(F.percentile_approx("d2", 0.5) / MEDIAN, F.lit(1.0)).alias("scale"))
    counts = tested.groupBy("grp").agg(F.count("*").alias("rows"))
    judged = far.join(scale.join(counts, "grp"), "grp", "left")
    outlier = (F.col("rows") >= TOO_FEW) & (F.col("d2") > cutoff * F.col("scale"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & ~F.coalesce(outlier, F.lit(False))).alias("kept"),
                         (F.col("d2") / F.col("scale")).alias("distance"))
