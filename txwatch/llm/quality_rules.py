"""Quality rules with risk-controlled cutoffs (DataFrame functions only).

Every rule is a ratio of a document; at or above its cutoff the document is
rejected. Cutoffs are not guessed: for each stratum (language) and rule, the
documents labelled good are a holdout, and a cutoff is certified if an exact
binomial test shows that it rejects at most ``alpha / rules`` of them, that is
if P(Binomial(n, alpha / rules) <= false rejections) is at most the level. So a
stratum loses at most ``alpha`` of its good documents to the rules together.

Multiple testing: the error ``delta`` is divided by strata x rules
(Bonferroni); within one, the cutoffs of the grid are tested from the most
lenient to the strictest and the first failure ends it (fixed sequence), which
needs no further correction. A stratum with too few labels gets no cutoff and
loses nothing. All labelled documents take part.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwatch.llm.common import free_prefix, let, words
from txwatch.session import materialize

SYMBOLS = "#*$%&|<>"
GRAM = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Largest share of a stratum's good documents that the rules may reject, and the chance that this fails.
ALPHA, DELTA = 0.02, 0.05
#: The cutoffs tried for every rule.
GRID = [0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8, 1.0]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_shouts"]
#: Rule: (count, divided by).
RULES = {"symbols": ("n_symbols", "n_words"), "capitals": ("n_upper", "word_chars"),
         "repeated_lines": ("n_dup_lines", "n_lines"), "repeated_words": ("n_repeat_words", "n_words"),
         "shouts": ("n_shouts", "n_words")}


def occurrences(text: Column, chars: str) -> Column:
    """How often the characters stand in the text."""
    return F.length(text) - F.length(reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), chars, text))


def repeat_words(ws: Column, k: int = GRAM) -> Column:
    """Words inside a window of ``k`` words that the text has twice or more.

    Windows are compared by 64-bit hashes within one text. Sorting them puts
    equal ones side by side, so a long text costs n log n."""

    def starts(grams: Column) -> Column:
        tagged = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        return let(tagged, lambda t: F.array_sort(F.transform(
            F.filter(t, lambda x, i: (x.g == F.get(t, i - 1).g) | (x.g == F.get(t, i + 1).g)), lambda x: x.i)))

    def covered(at: Column) -> Column:
        zero = F.struct(F.lit(-k).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(at, zero, lambda a, p: F.struct(
            p.alias("last"), (a.n + F.least(F.lit(k), p - a.last)).cast("long").alias("n")), lambda a: a.n)

    grams = F.transform(F.sequence(F.lit(0), F.size(ws) - k),
                        lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(k)]))
    count = let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long"))
                .otherwise(covered(starts(g))))
    return F.when(F.size(ws) < k, F.lit(0).cast("long")).otherwise(count)


def measures(text: Column) -> Column:
    """A struct of COUNTS of a text (null: no words)."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def all_of(ws: Column, ls: Column, joined: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"), F.length(joined).cast("long").alias("word_chars"),
            occurrences(joined, SYMBOLS).cast("long").alias("n_symbols"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            repeat_words(ws).alias("n_repeat_words"), F.size(ls).cast("long").alias("n_lines"),
            F.regexp_count(joined, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
            occurrences(joined, "!").cast("long").alias("n_shouts"))

    return let(words(text), lambda ws: let(lines, lambda ls: let(F.array_join(ws, ""), lambda j: all_of(ws, ls, j))))


def base_failed(m: Callable[[str], Column]) -> Column:
    return (m("n_words") < MIN_WORDS) | (100 * m("n_repeat_words") > MAX_REPEAT_PERCENT * m("n_words"))


def ratio(m: Callable[[str], Column], rule: str) -> Column:
    above, below = RULES[rule]
    return F.when(m(below) > 0, m(above) / m(below)).otherwise(F.lit(0.0))


def binomial_cdf(k: Column, n: Column, p: Column) -> Column:
    """P(Binomial(n, p) <= k), summed term by term; 1 above the mean, where no test passes."""
    step = F.log(p / (1 - p))
    zero = F.struct((n * F.log(1 - p)).alias("logp"), F.exp(n * F.log(1 - p)).alias("sum"))

    def add(a: Column, i: Column) -> Column:
        logp = a.logp + F.log((n - i + 1) / i) + step
        return F.struct(logp.alias("logp"), (a["sum"] + F.exp(logp)).alias("sum"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.aggregate(terms, zero, add, lambda a: a["sum"]))


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``stratum`` and, for each rule, its strictest certified cutoff (null: none).

    ``measured``: ``doc_id, stratum`` and COUNTS; ``labels``: ``doc_id, quality``
    (1: good). A document with several labels is good if one of them says so."""
    good = labels.groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1")
    held = measured.join(good, "doc_id", "left_semi").where(~base_failed(F.col))
    wrong = [F.count_if(ratio(F.col, r) >= c).alias(f"{r}_{i}") for r in RULES for i, c in enumerate(GRID)]
    counts = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *wrong)
    strata = counts.select(F.count(F.lit(1)).cast("double")).scalar()
    tests = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"{r}_{i}").alias("k"))
                      for r in RULES for i, c in enumerate(GRID)])
    tested = counts.select("stratum", "n", (F.lit(delta) / (strata * len(RULES))).alias("level"),
                           F.explode(tests).alias("t")).select("stratum", "n", "level", "t.*")
    tested = tested.withColumn("passes", binomial_cdf(F.col("k"), F.col("n"), F.lit(alpha / len(RULES))) <= F.col("level"))
    # from the most lenient cutoff on, all up to the first that fails are certified
    failed = F.max(F.when(~F.col("passes"), F.col("cutoff")))
    ends = tested.groupBy("stratum", "rule").agg(failed.alias("failed"), F.sort_array(F.collect_list("cutoff")).alias("grid"))
    cut = ends.withColumn("cut", F.get(F.filter("grid", lambda c: F.col("failed").isNull() | (c > F.col("failed"))), 0))
    return cut.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cut"))).alias(f"cut_{r}") for r in RULES])


def _verdict(m: Callable[[str], Column], cut: str = "cut_") -> Column:
    rejected = reduce(lambda a, b: a | b, [F.coalesce(ratio(m, r) >= F.col(cut + r), F.lit(False)) for r in RULES])
    return ~base_failed(m) & ~rejected


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  stratum_col: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per input row: ``doc_id``, COUNTS, ``base_failed``, ``kept``.

    A null text has no words and fails the base. Null strata form one stratum,
    a null id has no label. Without labels no cutoff is certified and the base
    alone decides. Repeated rows are judged alike; an empty table gives no rows;
    other columns are not read.
    """
    m = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"),
                    measures(F.col(text_col)).alias("m")).select("doc_id", "stratum", "m.*")
    m = materialize(m, "quality-measures")
    found = materialize(cutoffs(m, labels, alpha, delta), "quality-cutoffs")
    out = m.join(found.withColumnRenamed("stratum", "s"), F.col("stratum").eqNullSafe(F.col("s")), "left")
    return out.select("doc_id", *COUNTS, base_failed(F.col).alias("base_failed"), _verdict(F.col).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              stratum_col: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns, whatever their names.
    The texts do not move: cutoffs come from the labelled rows, the verdict is a filter.

    A null text has no words, so its row goes. Null strata are one stratum.
    Repeated rows are judged each. An empty table gives no rows; without labels
    only the base rule rejects."""
    own = free_prefix(docs.columns)
    labelled = docs.join(labels.select(F.col("doc_id").alias(own + "id")).distinct(),
                         F.col(id_col).cast("long") == F.col(own + "id"), "left_semi")
    m = labelled.select(F.col(id_col).cast("long").alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"),
                        measures(F.col(text_col)).alias("m")).select("doc_id", "stratum", "m.*")
    found = materialize(cutoffs(materialize(m, "quality-measures"), labels, alpha, delta), "quality-cutoffs")
    found = found.select(*[F.col(c).alias(own + c) for c in found.columns])
    marked = docs.withColumn(own + "m", measures(F.col(text_col)))
    joined = marked.join(found, F.col(stratum_col).cast("string").eqNullSafe(F.col(own + "stratum")), "left")
    return (joined.where(_verdict(lambda c: F.col(f"{own}m.{c}"), own + "cut_"))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
