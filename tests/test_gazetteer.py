"""Names found in labels by a trie of words, against a search by hand."""

import random
import re

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.functions import labels as rules
from tallystar.operators import gazetteer

NAMES = "name string, place int"


def by_hand(label, names, prefer):
    """Every start, longest name there; then the wanted one."""
    words = re.findall(r"[^\W_]+", label)
    split = {}
    for name, place in sorted(names, key=lambda n: (n[1], n[0])):
        split.setdefault(tuple(re.findall(r"[^\W_]+", name)), (place, name))
    hits = []
    for start in range(len(words)):
        for n in range(len(words) - start, 0, -1):
            if found := split.get(tuple(words[start:start + n])):
                hits.append((n, found[0], start, found[1]))
                break
    if not hits:
        return None, 0
    key = (lambda h: (-h[0], h[1], h[2])) if prefer == "longest" else (lambda h: (h[1], h[2]))
    return min(hits, key=key)[3], len(hits)


@pytest.mark.parametrize("prefer", ["longest", "listed"])
def test_against_a_search_by_hand(spark, prefer):
    rng = random.Random(3)
    words = ["North", "Bay", "New", "York", "Île", "St", "John", "s", "1"]
    names = {" ".join(rng.choices(words, k=rng.randrange(1, 5))) for _ in range(60)}
    names = [(name, rng.randrange(40)) for name in sorted(names)]
    texts = {", ".join([" ".join(rng.choices([*words, "of", "the"], k=rng.randrange(0, 9)))] * 2)
             for _ in range(150)} | {"", "--", "north bay"}
    frame = spark.createDataFrame([(t,) for t in [*texts, *texts, None]], "t string")
    listed = spark.createDataFrame([*names, (None, 0), ("...", 1)], NAMES)
    got = {r["label"]: (r["name"], r["mentions"]) for r in
           gazetteer.named_in(frame, "t", listed, "name", "place", prefer).collect()}
    assert got.pop(None) == (None, 0)
    assert got == {t: by_hand(t, names, prefer) for t in texts}


def test_a_list_of_thousands_is_a_few_joins(spark):
    listed = spark.range(5000).select(
        F.concat(F.lit("Town "), F.col("id")).alias("name"), F.col("id").cast("int").alias("place"))
    frame = spark.range(0, 20000, 7).select(F.concat(F.lit("Greater Town "), "id", F.lit(", East")).alias("t"))
    found = gazetteer.named_in(frame, "t", listed, "name", "place")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 3  # two words deep, and labels without a mention
    assert found.filter("name IS NOT NULL").count() == len(range(0, 5000, 7))
    assert found.filter("name IS NULL").count() == len(range(0, 20000, 7)) - len(range(0, 5000, 7))


def test_listed_order_equals_the_rules(spark):
    """The first province of the list that a label mentions, as the chain of rules has it."""
    texts = [
        "Ottawa-Gatineau, Ontario part, Ontario/Quebec", "Ottawa-Gatineau, Quebec/Ontario",
        "Toronto, Ontario", "St. John's, Newfoundland and Labrador", "Nowhere", "Canada",
        "Charlottetown (Prince Edward Island)", "Alberta excluding Calgary",
    ]
    listed = spark.createDataFrame(list(zip(vocab.PROVINCES, range(20), strict=False)), NAMES)
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    named = gazetteer.named_in(frame, "t", listed, "name", "place", "listed")
    anywhere = rules._first_match(list(vocab.PROVINCES), F.col("t").contains)
    assert tuples(named, "label", "name") == tuples(frame.select("t", anywhere))


def test_edges(spark):
    none = spark.createDataFrame([], NAMES)
    frame = spark.createDataFrame([("a b",)], "t string")
    assert tuples(gazetteer.named_in(frame, "t", none, "name", "place")) == [("a b", None, 0)]
    assert gazetteer.named_in(frame.limit(0), "t", none, "name", "place").count() == 0
    long = spark.createDataFrame([("a " * 40, 1)], NAMES)
    with pytest.raises(ValueError, match="40 words"):
        gazetteer.named_in(frame, "t", long, "name", "place")
    with pytest.raises(ValueError, match="prefer"):
        gazetteer.named_in(frame, "t", none, "name", "place", "best")
