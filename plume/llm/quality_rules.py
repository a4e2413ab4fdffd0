"""Quality rules: counts of each text, and robust multivariate outliers.

Counts are array expressions inside the row.  Windows of three words that may
be repeated are found by sorting numbers that hold a window's hash above its
position; only those are then sorted and compared by their words, so counts are
exact and the work of a text is linear but for the sorts.

The verdict is a minimum-covariance-determinant estimate per language and
source over transformed statistics: from coordinate-wise medians, concentration
steps keep the share ``core`` of a group's rows with the smallest Mahalanobis
distances and re-estimate mean and covariance from them, until no group's
determinant falls any more; then the covariance is made consistent by the
median distance, rows within the usual bound reweight the estimate once, and
rows beyond ``cutoff``, a chi-square quantile, are rejected.  A floor under
each variance is the deviation that is still ordinary in a group where a
statistic is constant: most groups have no repeats at all, and without it every
document with a repeated phrase would be an outlier.  Medians and distance quantiles are exact over a fixed grid,
so results do not depend on how rows are partitioned and the state of a group
is bounded; rows of a group are only ever summed.  Estimates (one row a group)
are broadcast to the rows if there are at most ``MOST_BROADCAST`` groups, and
otherwise joined by salted keys.

Cases: a null or empty text has no words and fails the base rule; null lang or
source is a group like any other; groups under ``least_rows`` rows use the
estimate of their language, and if that has too few rows as well, the estimate
over all documents, however few they are.
Repeated rows count each; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TEXT_TABLE, written

SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: Statistics and the standard deviation taken at least for each.
FLOORS = {"x_length": 0.15, "x_symbols": 0.05, "x_repeats": 0.15, "x_lines": 0.2}
#: Chi-square with four degrees of freedom: median, 0.975 and 0.999 quantiles.  Fixed values.
CHI_MEDIAN, CHI_REWEIGHT, CHI_REJECT = 3.3567, 11.1433, 18.4668
#: A smaller fall of the determinant ends the concentration steps of a group.
_LEAST_FALL = 1e-9
_SHARED = "\x00all"
#: Groups whose estimates (under 200 bytes each) are broadcast at most; beyond it they are joined by salted keys.
MOST_BROADCAST = 50_000
_SALTS = 32


def word_counts(docs: DataFrame, whole: bool = False) -> DataFrame:
    """doc_id, lang, source and the counts of every whole text, with n_lines (lines with a word).

    ``whole``: with the row itself as the struct ``row``.
    """
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole else []
    own = docs.select(*row, *[F.col(f"`{c}`").cast("long" if c == "doc_id" else "string").alias(c)
                              for c in ("doc_id", "text", "lang", "source")])
    own = own.withColumn("text", F.coalesce("text", F.lit("")))
    carried = [c for c in own.columns if c != "text"]
    words = own.select(
        *carried, F.array_remove(F.split("text", SPACE), "").alias("w"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"))
    windows = words.select(
        "*", F.size("w").alias("size"), F.length(F.bin(F.size("w").cast("long"))).alias("bits"),
        F.when(F.size("w") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("w") - 3),
            lambda i: _shift_left(F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)),
                                  F.length(F.bin(F.size("w").cast("long")))).bitwiseOR(i.cast("long"))))
        .otherwise(F.array().cast("array<long>")).alias("marks"))
    ordered = windows.withColumn("marks", F.sort_array("marks"))
    window = lambda i: _shift_right(F.get("marks", i), F.col("bits"))
    alike = ordered.withColumn("alike", F.transform(
        F.filter("marks", lambda x, i: (_shift_right(x, F.col("bits")) == window(i - 1))
                 | (_shift_right(x, F.col("bits")) == window(i + 1))),
        lambda x: x.bitwiseAND(_shift_left(F.lit(1).cast("long"), F.col("bits")) - 1).cast("int")))
    # equal hashes are only candidates: words hold no blank, so joined windows are equal if and only if their words are
    named = alike.withColumn("named", F.sort_array(F.transform("alike", lambda p: F.struct(
        F.concat_ws(" ", F.get("w", p), F.get("w", p + 1), F.get("w", p + 2)).alias("words"), p.cast("long").alias("at")))))
    repeated = named.withColumn("places", F.sort_array(F.transform(
        F.filter("named", lambda x, i: (x["words"] == F.get("named", i - 1)["words"])
                 | (x["words"] == F.get("named", i + 1)["words"])), lambda x: x["at"])))
    covered = F.aggregate(
        "places", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-9).cast("long").alias("at")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3).cast("long"), p - a["at"])).alias("n"), p.alias("at")),
        lambda a: a["n"])
    return repeated.select(
        *carried, F.col("size").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"), "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"), F.size("lines").cast("long").alias("n_lines"))


def _shift_left(x: Column, n: Column) -> Column:
    return F.call_function("shiftleft", x, n)


def _shift_right(x: Column, n: Column) -> Column:
    return F.call_function("shiftright", x, n)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def statistics(counts: DataFrame) -> DataFrame:
    """The counts with the transformed statistics (zero for texts without words)."""
    angle = lambda part, whole: F.coalesce(F.asin(F.sqrt(F.least(F.lit(1.0), F.try_divide(F.col(part), F.col(whole))))), F.lit(0.0))
    return counts.withColumns({
        "x_length": F.coalesce(F.ln(F.try_divide("word_chars", "n_words")), F.lit(0.0)),
        "x_symbols": F.coalesce(F.log1p(F.try_divide("n_symbols", "n_words")), F.lit(0.0)),
        "x_repeats": angle("n_repeat_words", "n_words"),
        "x_lines": angle("n_dup_lines", "n_lines")})


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _estimate(rows: DataFrame, names: list[str]) -> DataFrame:
    """Mean m_i and Cholesky factor l_i_j of the covariance (floors added) of each group's rows, and ln_det of the factor."""
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    sums = rows.groupBy("g_lang", "g_source").agg(
        F.count("*").alias("n"), *[F.avg(x).alias(f"m_{i}") for i, x in enumerate(names)],
        *[(F.covar_pop(names[i], names[j]) + F.lit(FLOORS[names[i]] ** 2 if i == j else 0.0)).alias(f"c_{i}_{j}") for i, j in pairs])
    for i, j in pairs:  # Cholesky, row by row
        rest = F.col(f"c_{i}_{j}") - (_sum([F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)]) if j else F.lit(0.0))
        sums = sums.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l_{j}_{j}"))
    return sums.withColumn("ln_det", _sum([F.ln(f"l_{i}_{i}") for i in range(len(names))])).drop(*[f"c_{i}_{j}" for i, j in pairs])


def _better(old: DataFrame, new: DataFrame) -> DataFrame:
    """Of each group the estimate with the smaller determinant, and in ``fell`` whether that is the new one."""
    was = old.select(F.col("g_lang").alias("e_lang"), F.col("g_source").alias("e_source"),
                     F.struct(*[c for c in new.columns if not c.startswith("g_")]).alias("old"))
    both = new.join(was, new["g_lang"].eqNullSafe(was["e_lang"]) & new["g_source"].eqNullSafe(was["e_source"]))
    fell = F.col("ln_det") < F.col("old.ln_det") - _LEAST_FALL
    return both.select("g_lang", "g_source", fell.alias("fell"), *[
        F.when(fell, F.col(c)).otherwise(F.col(f"old.{c}")).alias(c) for c in new.columns if not c.startswith("g_")])


def _with_group(rows: DataFrame, table: DataFrame, few: bool, keys: tuple[str, str] = ("g_lang", "g_source")) -> DataFrame:
    """Rows with the columns of their group's row of ``table``; ``few``: the table is broadcast.

    Otherwise rows and a copy of the table for every salt are joined by group and salt, so no group is one task.
    """
    known = table.withColumnsRenamed({k: f"e_{k}" for k in keys})
    same = rows[keys[0]].eqNullSafe(known[f"e_{keys[0]}"]) & rows[keys[1]].eqNullSafe(known[f"e_{keys[1]}"])
    if few:
        return rows.join(F.broadcast(known), same).drop(*[f"e_{k}" for k in keys])
    known = known.withColumn("e_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS)).cast("int"))
    same = salted[keys[0]].eqNullSafe(known[f"e_{keys[0]}"]) & salted[keys[1]].eqNullSafe(known[f"e_{keys[1]}"])
    return salted.join(known, same & (salted["salt"] == known["e_salt"])).drop("salt", "e_salt", *[f"e_{k}" for k in keys])


def _distance(rows: DataFrame, estimate: DataFrame, names: list[str], few: bool) -> DataFrame:
    """Rows with d2, their squared Mahalanobis distance under their group's estimate."""
    out = _with_group(rows, estimate, few)
    for i, x in enumerate(names):
        rest = F.col(x) - F.col(f"m_{i}") - (_sum([F.col(f"l_{i}_{k}") * F.col(f"z_{k}") for k in range(i)]) if i else F.lit(0.0))
        out = out.withColumn(f"z_{i}", rest / F.col(f"l_{i}_{i}"))
    return out.select(*rows.columns, _sum([F.col(f"z_{i}") ** 2 for i in range(len(names))]).alias("d2"))


_STEP = 1000  # grid of ln(1 + d2), on which distance quantiles are exact


def _grid() -> Column:
    return F.round(F.log1p("d2") * _STEP).cast("long")


def _cut(rows: DataFrame, share: float, few: bool) -> DataFrame:
    """The ``share`` of each group's rows with the smallest distances (and their ties on the grid)."""
    bound = rows.groupBy("g_lang", "g_source").agg(F.percentile(_grid(), F.lit(share)).alias("top"))
    return _with_group(rows, bound, few).where(_grid() <= F.col("top")).drop("top")


def mcd(rows: DataFrame, core: float = 0.75, few: bool = True) -> DataFrame:
    """Reweighted MCD estimate (n, m_i, l_i_j) of each group (g_lang, g_source) of ``rows``; ``few``: see ``_with_group``.

    The steps end: each but the last makes a determinant smaller, and a group has finitely many subsets.
    """
    names = list(FLOORS)
    own = rows.select("g_lang", "g_source", *names)
    middle = [F.percentile(F.round(F.col(x), 4), F.lit(0.5)) for x in names]
    start = own.groupBy("g_lang", "g_source").agg(F.count("*").alias("n"), *[m.alias(f"m_{i}") for i, m in enumerate(middle)])
    for i in range(len(names)):
        for j in range(i + 1):
            start = start.withColumn(f"l_{i}_{j}", F.lit(FLOORS[names[i]] if i == j else 0.0))
    step = lambda known: _estimate(_cut(_distance(own, known, names, few), core, few), names)
    falling, settled = written(step(written(start, "mcd-start")), "mcd-step"), []
    while not falling.isEmpty():  # only groups whose determinant still falls take another step
        better = written(_better(falling, step(falling)), "mcd-step")
        falling = better.where("fell").drop("fell")
        settled.append(better.where("NOT fell").drop("fell"))
    estimate = written(reduce(DataFrame.unionByName, settled, falling), "mcd-settled")
    # consistency: the median distance of all rows becomes the chi-square median (never a narrower estimate)
    near = _distance(own, estimate, names, few)
    scale = near.groupBy("g_lang", "g_source").agg(
        F.greatest(F.lit(1.0), F.expm1(F.percentile(_grid(), F.lit(0.5)) / _STEP) / CHI_MEDIAN).alias("s"))
    good = _with_group(near, scale, few).where(F.col("d2") <= F.col("s") * CHI_REWEIGHT).select(*own.columns)
    return written(_estimate(good, names), "mcd")


def _groups(passed: DataFrame, least_rows: int) -> DataFrame:
    """lang, source, the group g_lang, g_source whose estimate judges their rows, and ``parts``: the groups that they are in.

    A language's group holds the rows of all its sources, the group of all every row; both exist only if they judge some.
    """
    sizes = written(passed.groupBy("lang", "source").agg(F.count("*").alias("n")), "quality-sizes")
    langs = sizes.groupBy(F.col("lang").alias("of_lang")).agg(F.sum("n").alias("n_lang"), F.min("n").alias("n_least"))
    level = F.when(F.col("n") >= least_rows, "own").when(F.col("n_lang") >= least_rows, "lang").otherwise("all")
    levels = sizes.join(langs, sizes["lang"].eqNullSafe(langs["of_lang"])).withColumn("level", level)
    some = levels.agg(F.bool_or(F.col("level") == "all").alias("some_all"))  # one row
    group = lambda a, b: F.struct(a.alias("g_lang"), b.alias("g_source"))
    own, of_lang = group(F.col("lang"), F.col("source")), group(F.col("lang"), F.lit(_SHARED))
    every = group(F.lit(_SHARED), F.lit(_SHARED))
    judge = F.when(F.col("level") == "own", own).when(F.col("level") == "lang", of_lang).otherwise(every)
    none = F.when(F.lit(False), own)
    parts = F.filter(F.array(F.when(F.col("level") == "own", own).otherwise(none),
                             F.when((F.col("n_lang") >= least_rows) & (F.col("n_least") < least_rows), of_lang).otherwise(none),
                             F.when(F.col("some_all"), every).otherwise(none)), lambda x: x.isNotNull())
    return written(levels.crossJoin(F.broadcast(some)).select("lang", "source", judge.alias("g"), parts.alias("parts"))
                   .select("lang", "source", "g.g_lang", "g.g_source", "parts"), "quality-groups")


def judged(docs: DataFrame, cutoff: float = CHI_REJECT, core: float = 0.75, least_rows: int = 100,
           whole: bool = False) -> DataFrame:
    """The counts of every row with base_failed, kept and d2 (null where the base rule failed); ``whole`` as in ``word_counts``."""
    rows = written(statistics(word_counts(docs, whole)).withColumn("base_failed", base_failed()), "quality-counts",
                   **(TEXT_TABLE if whole else {}))
    names = list(FLOORS)
    passed = rows.where("NOT base_failed")
    groups = _groups(passed, least_rows)
    few = groups.count() <= MOST_BROADCAST
    parts = _with_group(passed.select("lang", "source", *names), groups.select("lang", "source", "parts"), few, ("lang", "source"))
    parts = written(parts.select(F.explode("parts").alias("g"), *names).select("g.g_lang", "g.g_source", *names), "quality-parts")
    estimate = mcd(parts, core, few)
    known = _with_group(groups.drop("parts"), estimate, few).drop("g_lang", "g_source").withColumnsRenamed(
        {"lang": "g_lang", "source": "g_source", "n": "n_group"})  # the estimate that judges each lang and source
    far = _distance(passed.withColumns({"g_lang": F.col("lang"), "g_source": F.col("source")}), known, names, few)
    d2 = far.select(*rows.columns, (F.col("d2") <= cutoff).alias("kept"), "d2")
    return d2.unionByName(rows.where("base_failed").select(
        *rows.columns, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("d2")))


def quality(docs: DataFrame, cutoff: float = CHI_REJECT, core: float = 0.75, least_rows: int = 100) -> DataFrame:
    """doc_id, n_words, the four base counts, base_failed, kept, and d2 (null where the base rule failed).

    ``cutoff``: squared distance beyond which a row is rejected, by default the
    0.999 quantile of the normal model.
    """
    return judged(docs, cutoff, core, least_rows).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")


def kept_documents(docs: DataFrame, cutoff: float = CHI_REJECT, core: float = 0.75, least_rows: int = 100) -> DataFrame:
    """The rows of ``docs``, all columns, that ``quality`` keeps; they travel with their counts, no text is shuffled."""
    return judged(docs, cutoff, core, least_rows, whole=True).where("kept").select("row.*")
