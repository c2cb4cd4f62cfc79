from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.feed import sales
from tillmart.functions.vocabulary import CLASS_KEYWORDS
from tillmart.operators import dimensions as dim, mining, staging

TEXTS = {
    "22423": ["REGENCY CAKE STAND 3 TIER", "CAKE STAND", "damages", "faulty", None],
    "22424": ["SMALL  CAKE TIN", "BIG CAKE BOX", "?"],
    "22424A": ["CAKE TIN"],
    "85123A": ["Hanging Heart", "HEART"],
    "POST": ["POSTAGE", "x"],
}


@pytest.fixture(scope="module")
def items(spark):
    rows = [{"StockCode": code, "Description": text} for code, texts in TEXTS.items() for text in texts]
    return dim.dim_items(staging.stg_transactions(sales(spark, *rows)))


def test_weird_items(items):
    ordered = mining.description_order(items)
    found = {(r.item_id, r.item_description): r.description_order for r in ordered.collect()}
    assert found["22423", "REGENCY CAKE STAND 3 TIER"] == 1 and found["22423", "nan"] == 5
    assert not any(code == "POST" for code, _ in found)
    weird = {(r.item_id, r.item_description) for r in mining.weird_items(ordered).collect()}
    assert weird == {
        ("22423", "CAKE STAND"), ("22423", "damages"), ("22423", "faulty"), ("22423", "nan"),
        ("22424", "BIG CAKE BOX"), ("22424", "?"), ("85123A", "Hanging Heart"), ("85123A", "HEART"),
    }


def test_classes(spark, items):
    classes = mining.keyword_classes(mining.weird_items(mining.description_order(items)))
    found = {r.item_description: r.item_class for r in classes.collect()}
    assert found["damages"] == found["faulty"] == "error" and found["CAKE STAND"] is None
    known = mining.vocabulary(spark, classes)
    assert known.filter("item_description = 'damages'").count() == 1
    assert known.filter("item_description = 'MIA'").first().item_class == "special"
    rest = {r.item_description for r in mining.unclassified(spark, classes).collect()}
    assert rest == {"CAKE STAND", "nan", "BIG CAKE BOX", "?", "Hanging Heart", "HEART"}


def test_first_class_wins(spark):
    texts = ["Amazon damage", "sold as set on DOTCOM", "sold as 1", "plain", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    from tillmart.functions import columns as fn

    def expected(text):
        if text is None:
            return None
        return next((c for c, words in CLASS_KEYWORDS.items() if any(w in text.lower() for w in words)), None)

    rows = df.select("t", fn.keyword_class(F.col("t")).alias("c")).collect()
    assert {r.t: r.c for r in rows} == {t: expected(t) for t in texts}


def test_family_words(spark, items):
    plain = {}
    for code, texts in TEXTS.items():
        if code != "POST":
            plain.setdefault(int("".join(filter(str.isdigit, code))), []).extend(
                t for t in texts if t not in (None, "damages", "faulty", "?")
            )
    want = {}
    for family, texts in plain.items():
        counts = Counter(word for text in texts for word in text.split())
        want[family] = {word for word, n in counts.items() if n == max(counts.values())}
    for per_part in (1, 2, 100):
        found, texts = {}, {}
        for r in mining.family_top_words(items, per_part).collect():
            found.setdefault(r.item_family_id, {})[r.part] = r.item_family_description
        for r in mining.family_text(items, per_part).collect():
            texts.setdefault(r.item_family_id, {})[r.part] = r.family_text
        joined = lambda parts: " ".join(parts[part] for part in sorted(parts))
        assert {family: joined(parts).split() for family, parts in found.items()} == {f: sorted(w) for f, w in want.items()}
        assert {family: joined(parts) for family, parts in texts.items()} == {f: " ".join(sorted(t)) for f, t in plain.items()}
    categories = mining.family_category(spark, mining.family_words(items)).collect()
    assert {r.item_family_id: r.item_category for r in categories} == {
        22423: "KITCHENWARE", 22424: "KITCHENWARE", 85123: "HOME DECOR",
    }


def test_category_outside_the_domain(spark, items):
    with pytest.raises(ValueError):
        mining.family_category(spark, mining.family_words(items), [("CAKE", "FOOD")])
    none = mining.family_category(spark, mining.family_words(items), [("ZEBRA", "TOYS")])
    assert {r.item_category for r in none.collect()} == {"OTHERS"}
