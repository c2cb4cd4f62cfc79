"""Finding odd item texts, classing them, and describing families by their words."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmart.functions import columns as fn
from tillmart.functions.vocabulary import ADDED_TEXTS, CATEGORIES, CATEGORY_RULES, OTHER_CATEGORY
from tillmart.operators.dimensions import literal_table
from tillmart.operators.grouped import join_texts, number_in_groups
from tillmart.schemas import FLAGS

MISSING_TEXT = "nan"
SHORT_TEXT = 13
#: Texts of a family that make one part.
PER_PART = 4


def description_order(items: DataFrame, missing: str = MISSING_TEXT) -> DataFrame:
    """Texts of each normal item from longest to shortest, numbered."""
    text = F.col("item_description")
    described = items.filter(~F.col("is_operational_item")).select(
        "item_id", F.coalesce(text, F.lit(missing)).alias("item_description")
    )
    described = described.withColumns(
        {
            "is_all_uppercase": fn.is_all_uppercase(text),
            "description_len": F.length(text),
        }
    )
    return number_in_groups(
        described,
        ["item_id"],
        [F.desc("description_len"), F.asc("item_description")],
        "description_order",
    )


def weird_items(ordered: DataFrame) -> DataFrame:
    """Short texts beside a longer one, and texts not all in upper case."""
    short = (F.col("description_order") > 1) & (F.col("description_len") < SHORT_TEXT)
    return ordered.filter(short | ~F.col("is_all_uppercase"))


def keyword_classes(weird: DataFrame) -> DataFrame:
    """Each odd text once, with the class its keywords give or NULL."""
    return (
        weird.select("item_description")
        .distinct()
        .withColumn("item_class", fn.keyword_class(F.col("item_description")))
    )


def _added_texts(spark: SparkSession) -> DataFrame:
    rows = [(name, text) for name, texts in ADDED_TEXTS.items() for text in texts]
    return literal_table(spark, rows, ["item_class", "item_description"])


def vocabulary(spark: SparkSession, classes: DataFrame) -> DataFrame:
    """Texts classed by keyword together with those added by hand, each once per class."""
    classed = classes.filter(F.col("item_class").isNotNull())
    return classed.unionByName(_added_texts(spark)).distinct()


def unclassified(spark: SparkSession, classes: DataFrame) -> DataFrame:
    """Odd texts that the vocabulary lacks: with no class by keyword and not added by hand."""
    rest = classes.filter(F.col("item_class").isNull()).select("item_description")
    return rest.join(_added_texts(spark), "item_description", "left_anti")


def plain_items(items: DataFrame) -> DataFrame:
    """Items with a family and a text, and without any flag."""
    flagged = F.lit(False)
    for flag in FLAGS:
        flagged = flagged | F.col(flag)
    return items.filter(
        ~flagged & F.col("item_family_id").isNotNull() & F.col("item_description").isNotNull()
    )


def family_text(items: DataFrame, per_part: int = PER_PART) -> DataFrame:
    """Texts of each family in order, joined, ``per_part`` to a part."""
    texts = plain_items(items).select("item_family_id", "item_description", "item_uuid", "item_id")
    return join_texts(texts, "item_family_id", "item_description", "family_text", per_part, ["item_uuid", "item_id"])


def family_words(items: DataFrame) -> DataFrame:
    """Most frequent words of each family, all that tie, one per row."""
    counts = (
        plain_items(items)
        .select("item_family_id", F.explode(fn.words(F.col("item_description"))).alias("word"))
        .groupBy("item_family_id", "word")
        .agg(F.count("*").alias("n"))
    )
    most = counts.groupBy("item_family_id").agg(F.max("n").alias("n"))
    return counts.join(most, ["item_family_id", "n"]).select("item_family_id", "word", "n")


def family_top_words(items: DataFrame, per_part: int = PER_PART) -> DataFrame:
    """Family description: its most frequent words, in order, ``per_part`` to a part."""
    return join_texts(family_words(items), "item_family_id", "word", "item_family_description", per_part)


def family_category(
    spark: SparkSession, words: DataFrame, rules: list[tuple[str, str]] = CATEGORY_RULES
) -> DataFrame:
    """Category of each family by the first rule with one of its words, else ``OTHERS``."""
    outside = {category for _, category in rules} - set(CATEGORIES)
    if outside:
        raise ValueError(f"not in the category domain: {sorted(outside)}")
    table = literal_table(
        spark,
        [(number, keyword, category) for number, (keyword, category) in enumerate(rules, 1)],
        ["rule_no", "keyword", "item_category"],
    )
    first = (
        words.join(table, F.upper("word") == F.col("keyword"), "left")
        .groupBy("item_family_id")
        .agg(F.min("rule_no").alias("rule_no"))
    )
    return first.join(table.drop("keyword"), "rule_no", "left").select(
        "item_family_id", F.coalesce("item_category", F.lit(OTHER_CATEGORY)).alias("item_category")
    )
