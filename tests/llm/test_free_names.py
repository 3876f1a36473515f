"""The pipeline's forms keep the columns of ``docs``, whatever these are called."""
import pytest
from pyspark.sql import functions as F

from txwatch.llm import exact_dedup, ngram_join, quality_rules, substring_dedup

NAMES = ["__id", "__sha", "__digest", "__m", "__stratum", "__again", "__text", "__key", "__kept", "__body", "__cut_upper", "___id", "n", "row", "batch", "a.b"]
PASSAGE = " ".join(f"w{i}" for i in range(40))
TEXTS = ["one two three four five six seven eight nine ten eleven twelve", "One two three four five six seven eight nine ten eleven twelve",
         f"alpha {PASSAGE} beta gamma", f"delta epsilon {PASSAGE} zeta", None, "", "few words", "same same same same same same same same same same same same same"]
FORMS = {
    "quality": lambda spark, d: quality_rules.keep_good(d, spark.createDataFrame([(0, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")),
    "exact": lambda spark, d: exact_dedup.drop_copies(d),
    "near": lambda spark, d: ngram_join.keep_one(d),
    "passages": lambda spark, d: substring_dedup.drop_repeats(d)}


@pytest.mark.parametrize("form", FORMS)
def test_columns_of_any_name_keep_their_values(spark, form):
    rows = [(i, t, "en" if i % 2 else None) for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], "en"), (None, "no id here", None)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    named = plain.select("*", *[F.concat(F.lit(f"{i}-"), F.coalesce("doc_id", F.lit(-1)).cast("string")).alias(c) for i, c in enumerate(NAMES)])
    got = FORMS[form](spark, named)
    assert got.columns == named.columns
    values = got.collect()
    want = sorted((tuple(r) for r in FORMS[form](spark, plain).collect()), key=str)
    assert sorted((tuple(r)[:3] for r in values), key=str) == want
    for r in values:
        assert tuple(r)[3:] == tuple(f"{i}-{-1 if r[0] is None else r[0]}" for i in range(len(NAMES)))


@pytest.mark.parametrize("form", FORMS)
def test_empty_table(spark, form):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, __id int")
    got = FORMS[form](spark, empty)
    assert got.count() == 0 and got.columns == empty.columns
