"""Traits against plain Python on texts that are hard on the patterns, traits filled from sisters, and media collection."""

import random
import re

from pyspark.sql import functions as F

from catalens.operators import media, text
from catalens.plans import media as media_plans


def slow_colors(low):
    """The colour rules a word and a window at a time."""
    windows = [m[0] for m in re.finditer(text.FLOWER_WINDOW, low)] or [low]
    codes, best = set(), 0.0
    for w in windows:
        if "yellow-green" in w or "yellowish-green" in w:
            codes |= {2, 5}
            best = max(best, 0.8)
        for code, words in text.COLOR_WORDS.items():
            for word in words:
                if word in ("yellow", "green") and "yellow-green" in w or not re.search(rf"\b{word}\b", w):
                    continue
                if (code == 2 and re.search(text.WHITE_RAYS, w)) or (code == 3 and re.search(text.RED_TIPS, w)) or (code == 5 and re.search(text.GREEN_LEAVES, w)):
                    continue
                if re.search(rf"\b{word}\b{text.MARKS_BEHIND}", w) or re.search(rf"{text.MARKED_WITH}\b{word}\b", w):
                    continue
                codes.add(code)
                best = max(best, 0.7)
    return sorted(codes), best


def test_colors_equal_a_word_at_a_time(spark):
    rng = random.Random(5)
    parts = [w for ws in text.COLOR_WORDS.values() for w in ws] + ["flowers", "petals", "with", "veined with", "marked", "lined", "spots", "veins", "white ray", "tinged red", "dark green leaves", "the", "and then some more words", "-", ".", "\n"]
    texts = ["".join(rng.choice(parts) + rng.choice((" ", " ", "-", ", ", "")) for _ in range(rng.randrange(1, 14))) for _ in range(400)]
    texts += ["", "flowers green-yellow-green", "yellow-green-yellow petals", "off-white-cream flowers", "blue", "flowers marked with red marked with blue", "petals cream-white veined", "flower red" + " x" * 12 + " spots"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", text.infer_color(F.col("t")).alias("a")).collect()
    for r in got:
        assert (r.a["values"], r.a["confidence"]) == slow_colors(texts[r.i]), texts[r.i]


def test_words_in_order_of_the_list(spark):
    one = lambda t, **k: spark.range(1).select(text.words_in(F.lit(t), ["red", "green", "green-red"], **k)).first()[0]
    assert one("green-red") == ["red", "green", "green-red"] and one("redgreen") == [] and one("green red") == ["red", "green"]
    assert one("red x dots", behind=".{0,3}dots") == ["red"] and one("with red", before="(with) ") == ["red"]


CATALOG = "item_id int, name string, color array<int>, habitat array<int>, height_from int, height_to int, flowering_from int, flowering_to int"


def test_gaps_are_filled_from_sisters(spark):
    told = spark.createDataFrame([(1, "A plant.", "tree", None, None, None, None), (2, "Flowers white in May-June.", None, None, None, 30, 40), (3, "A plant.", None, None, None, None, None)], "item_id int, text string, lifeform string, family string, color_ids array<string>, low_cm int, high_cm int")
    catalog = spark.createDataFrame([(7, "G a", [4], [1], 10, 30, 4, 5), (8, "G b", [4, 4, 1], [], 21, None, 5, 6), (9, "G c", [3], None, None, None, None, None), (6, "G d", None, [2, 1], 40, 45, None, 8), (5, "G e", [], [], None, None, None, None)], CATALOG)
    sisters = spark.createDataFrame([(i, s, n) for i in (1, 2) for n, s in enumerate((8, 7, 9, 6, 5), 1)], "item_id int, sister_id int, n int")
    one, two, three = text.complete_traits(text.infer_traits(told), sisters, catalog).orderBy("item_id").collect()
    assert (one.color["values"], one.color["confidence"], one.color["ok"]) == ([4], 0.5, True) and one.habitat["values"] == [6]
    assert (one.height_from, one.height_to, one.flowering_from, one.flowering_to) == (21, 38, 4, 6) and one.filled == "from G b, G a, G c, G d"
    assert two.color["values"] == [1] and two.habitat["values"] == [1] and (two.height_from, two.height_to, two.flowering_from, two.flowering_to) == (30, 40, 5, 6) and two.filled
    assert three.color["values"] == [] and not three.color["ok"] and three.height_from is None and three.filled is None


def test_media_steps(spark):
    fields = "item_id int, step int, pos int, title string, role_hint string, ok boolean"
    rows = [
        (1, 0, 1, "A a x", "leaf", True), (1, 1, 2, "A a x", None, True), (1, 2, 3, "A a y", "leaf", True), (1, 2, 4, "A a z", "fruit", True), (1, 2, 5, "A a x", "habit", True), (1, 3, 6, "A a w", None, True),
        (2, 0, 1, "A a x", "leaf", False), (2, 2, 2, "A a x", "leaf", True), (2, 2, 3, "A a x", "leaf", True),
        (3, 3, 1, "A a q", None, True), (3, 3, 2, "A a q", None, True), (3, 3, 0, "", None, True), (3, 0, 3, "A a q", "leaf", False),
        (4, 2, 1, "A a n", None, True), (4, 1, 2, "A a m", "leaf", True), (4, 2, 0, "A a m", "fruit", True), (4, 2, 3, "A a k", "leaf", True),
    ]
    df = spark.createDataFrame(rows, fields).select("*", F.lit("u").alias("url"), F.when(F.col("ok"), "CC0").otherwise("NC").alias("license"), F.lit("image/png").alias("mime"), F.lit(900).alias("width"), F.lit(900).alias("height"), F.lit("d").alias("description"), F.lit("o").alias("object_name"), F.lit("c").alias("categories"), F.lit("A a").alias("latin"))
    found = media.media_collect(df)
    assert sorted((r.item_id, r.pos) for r in found.collect()) == [(1, 1), (1, 4), (2, 2), (3, 1), (4, 1), (4, 2)]
    assert found.columns == [*df.columns, "score"] and media.media_collect(df.limit(0)).count() == 0


def test_media_are_read_once(spark):
    data = "/root/testdata/sf0.001"
    packed = media.media_pack(media_plans.files(spark, data), media_plans.items(spark, data))
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1


def _named(df, word):
    return df._jdf.queryExecution().optimizedPlan().toString().count(word)


def test_colors_are_read_once(spark):
    axis = text.infer_color(F.col("t"), F.col("q")).alias("a")
    df = spark.createDataFrame([("red flowers", ["Q943"])], "t string, q array<string>").select(axis).select("a.values", "a.confidence", "a.evidence")
    # the windows, and words in them: plain and hyphened, of either kind of window, before and behind marks
    assert _named(df, "regexp_extract_all(") <= 9


def test_described_items_are_dealt(spark):
    from catalens.plans import text as text_plans

    assert text_plans.described(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_traits_are_worked_out_once(spark):
    from catalens.plans import text as text_plans

    assert _named(text_plans.infer_traits(spark, "/root/testdata/sf0.001"), "lambdafunction(") < 100


def test_media_tokens_are_one_pattern(spark):
    title = F.concat(F.initcap("t"), F.lit("'"))
    df = spark.createDataFrame([("Pollen map",)], "t string").select(title.alias("title")).filter(media._any(F.lower("title"), media.REJECTED))
    assert _named(df, "initcap(") == 2  # the row's title and one test of it


def test_seasons_are_patterns_made_once(monkeypatch):
    def slow(t):
        low = t.lower()
        blooms = bool(text._IN_FLOWER.search(low))
        return next(((a, b, phrase) for phrase, a, b in text.SEASONS if (" " in phrase or blooms) and re.search(rf"\b{phrase}\b", low)), None)

    rng = random.Random(6)
    parts = [phrase for phrase, _, _ in text.SEASONS] + ["In Fall", "flowers", "Blooming", "early", "late", "falls", "springs", "the", "midsummer", "."]
    some = ["".join(rng.choice(parts) + rng.choice((" ", " ", "", ", ")) for _ in range(rng.randrange(6))) for _ in range(2000)]
    want = [slow(t) for t in some]
    monkeypatch.setattr(text, "_word", None)  # no text makes patterns of its own
    assert [text.flowering_in(t) for t in some] == want and len(set(want)) == len(text.SEASONS) + 1
    assert text.height_in("reaches a metre") is None and text.height_in("Reaches 2 m") == (200, 200, "Reaches 2 m")
