"""Operators on small cases: the catalog's own schema, edge cases and the rules of ties."""

import json
import random

import pytest
from pyspark.sql import functions as F

from catalens.functions import strings
from catalens.operators import catalog, facets, media, names, numbering, records, search, stats, taxonomy, text
from catalens.sources import checklist, dumps, payloads

DOMAINS = {"color": "12345", "habitat": "123456", "petal": "1234", "region": [str(x) for x in (*range(10, 15), *range(20, 30), *range(30, 39), *range(40, 44), 50, 51, *range(60, 64), *range(70, 80), *range(80, 86), 90, 91)]}
HEADER = "item_id int, color array<int>, habitat array<int>, petal array<int>, region array<int>"


def test_facets_of_two_plants(spark):
    items = spark.createDataFrame([(0, [5, 2], [6], [2], [10, 11]), (1, [3], [1, 4, 8], [2], [11]), (2, None, [], None, None)], HEADER)
    counts = {r.key: r.n for r in facets.facet_counts(items, "item_id", DOMAINS).collect()}
    assert len(counts) == 11_130
    assert counts["___"] == 3 and counts["5_6_2_10"] == 1 and counts["1_2_3_91"] == 0
    lists = {r.key: r.ids for r in facets.facet_lists(items, "item_id", DOMAINS).select("key", facets.list_ids(F.col("places"), F.col("block")).alias("ids")).collect()}
    assert lists["__2_11"] == [0, 1] and "1_2_3_91" not in lists
    assert facets.matching_keys(items.filter("item_id = 0"), "item_id", DOMAINS).count() == 36


def test_posting_blocks(spark):
    ids = [0, 1, 4095, 4096, 9000, -1, 5, 5]
    items = spark.createDataFrame([(i, [i % 5 + 1, 9], [1], None, []) for i in ids] + [(None, [1], None, None, None)], HEADER)
    lists = facets.facet_lists(items, "item_id", DOMAINS, 64)
    decode = lambda df, n: sorted((r.key, i) for r in facets.read_lists(facets.stored_lists(df)).select("key", facets.list_ids(F.col("places"), F.col("block"), n).alias("ids")).collect() for i in r.ids)
    want = sorted({(r.key, r.item_id) for r in facets.matching_keys(items.filter("item_id is not null"), "item_id", DOMAINS).collect()})
    assert decode(lists, 64) == want
    assert {r.block for r in lists.filter("key = '___'").collect()} == {-1, 0, 63, 64, 140}
    old, new = (facets.facet_lists(items.filter(c), "item_id", DOMAINS, 64) for c in ("item_id < 5", "item_id > 1"))
    twice = facets.merge_lists(facets.merge_lists(old, new), new)
    assert decode(twice, 64) == want
    counts = {r.key: r.n for r in facets.list_counts(twice, facets.facet_keys(spark, DOMAINS)).collect()}
    assert len(counts) == 11_130 and counts["___"] == 7 and counts["5_1__"] == 1 and counts["1___"] == len({i for i in ids if i % 5 == 0})
    assert decode(facets.facet_lists(items.limit(0), "item_id", DOMAINS), 64) == []


def test_wildcard_list_is_spread(spark):
    """The wildcard's blocks come from several tasks, vectors and not items are exploded, and gaps are smaller than ids."""
    items = spark.range(100_000).select(F.col("id").alias("item_id"), F.array((F.col("id") % 5 + 1).cast("int")).alias("color"), *[F.array().cast("array<int>").alias(a) for a in ("habitat", "petal", "region")])
    lists = facets.facet_lists(items, "item_id", DOMAINS, 1024)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else small partitions are joined
    try:
        assert lists.filter("key = '___'").select(F.spark_partition_id()).distinct().count() == 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert lists.agg(F.max(F.size("places"))).first()[0] <= 1024
    assert facets.stored_lists(lists).agg(F.max(F.array_max("gaps"))).first()[0] <= 5
    vectors = facets.explode_keys(facets.axis_vectors(items, "item_id", DOMAINS).groupBy(*DOMAINS).agg(F.count("*").alias("items")), list(DOMAINS))
    assert vectors.count() == 10


def test_facet_counts_equal_the_predicate(spark):
    items = spark.createDataFrame([(0, [5, 2], [6], [2], [10, 11]), (1, [3, 5], [1, 4], [2], [11])], HEADER)
    keys = facets.facet_keys(spark, DOMAINS)
    slow = keys.crossJoin(items).filter(facets.facet_match(F.col("key"), [F.col(a) for a in DOMAINS])).groupBy("key").count()
    fast = facets.facet_counts(items, "item_id", DOMAINS).filter("n > 0")
    assert sorted(map(tuple, slow.collect())) == sorted(map(tuple, fast.collect()))


def test_search_label_of_first_hit(spark):
    t = spark.createDataFrame([("en", 0, 7, "Field Maple", ["Hedge Maple", "field maple"]), ("en", 1, 8, None, ["St. Maple", "hedge maple", ""])], "lang string, pos int, item_id int, label string, names array<string>")
    hits = search.name_hits(t)
    found = {r.name: (r.is_label, r.ids) for r in search.search_index(hits).collect()}
    assert found == {"field maple": (True, [7]), "hedge maple": (False, [7, 8])}
    assert [r.name for r in search.search_warnings(hits).collect()] == ["st. maple"]


def test_photo_index_prefers_items_then_taxa(spark):
    items = spark.createDataFrame([(0, "Rosa", None), (1, "Acer", None)], "item_id int, name string, external string")
    taxa = spark.createDataFrame([("Rosa", "Genus", 2.5, "x/Rosa/list", 1, "/m/1"), ("Tilia", "Genus", 3.5, "x/Tilia/list", 2, None), ("Odd", "Rank", 1.0, "x", 3, None)], "name string, rank string, count double, path string, seq int, external string")
    synonyms = spark.createDataFrame([(0, 0, "Tilia", "Rosa"), (1, 0, "Maple", "Acer"), (0, 1, "Maple", "Rosa")], "item_id int, pos int, synonym string, name string")
    found = {r.key: (r["count"], r.path) for r in search.photo_index(items, taxa, synonyms).collect()}
    assert found == {"rosa": (1, "Rosa"), "acer": (1, "Acer"), "tilia": (4, "x/Tilia/list"), "maple": (1, "Rosa")}


def test_checklist_from_raw_rows(spark, tmp_path):
    (tmp_path / "names.csv").write_text("plant_name_id|ipni_id|taxon_rank|taxon_status|family|genus|species|lifeform_description|taxon_name|taxon_authors|accepted_plant_name_id|powo_id\n1|a|Species|Accepted|F|Acer|c|tree|Acer campestre|L.|1|p\n2||Species|Synonym|F|Euacer|c||Euacer × campestre||1|\n3||Species||||||||\n")
    found = checklist.checklist_names(checklist.read_pipes(spark, str(tmp_path / "names.csv")))
    assert {(r.name_id, r.norm, r.accepted_id) for r in found.collect()} == {(1, "acer campestre", 1), (2, "euacer x campestre", 1)}
    n = found.select("name_id", "name", F.col("taxon_status").alias("status"), F.col("taxon_rank").alias("rank"), "accepted_id")
    d = spark.createDataFrame([(1, 10, "DEN", False, False, False, 1), (1, 74, "X", True, True, False, 2), (1, 12, "SPA", True, False, False, 3), (1, 10, "DEN", False, False, False, 4)], "name_id long, l2 int, l3 string, introduced boolean, extinct boolean, doubtful boolean, pos int")
    r = names.checklist_lookup(spark.createDataFrame([("EUACER ×  campestre",), ("none",)], "query string"), n, d).collect()
    assert len(r) == 1 and r[0].accepted_name == "Acer campestre" and r[0].l2 == [10, 12] and r[0].l3 == ["DEN", "DEN", "SPA"] and r[0].synonyms == ["Euacer × campestre"]


def test_region_file(spark, tmp_path):
    (tmp_path / "r.csv").write_text("1,L1,1,Europe\n2,L2,10,North\n3,L3,den,Denmark\n4,L4,x,y\n5,L2,11,Mid\n6,L3,GER,Germany\n")
    regions = checklist.region_hierarchy(checklist.read_regions(spark, str(tmp_path / "r.csv")))
    assert {(r.code, r.name, r.l2) for r in regions.collect()} == {("DEN", "Denmark", 10), ("GER", "Germany", 11)}
    values = spark.createDataFrame([(1, "den"), (1, " Germany "), (1, "nowhere"), (2, "denmark")], "item_id int, value string")
    assert {(r.item_id, tuple(r.l2)) for r in names.region_rollup(values, regions).collect()} == {(1, (10, 11)), (2, (10,))}


def test_majority_and_median(spark):
    lists = spark.createDataFrame([("a", [2]), ("a", [2]), ("a", [3, 4]), ("a", []), ("b", [1]), ("b", [2])], "k string, codes array<int>")
    assert {r.k: r.codes for r in stats.majority_codes(lists, "k", "codes").collect()} == {"a": [2], "b": [1, 2]}
    assert spark.createDataFrame([(2,), (3,)], "x int").agg(stats.group_median_int("x")).first()[0] == 2


def test_ranks_break_ties_by_first_key(spark):
    obs = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c"), (4, "c")], "obs_key int, observer string")
    assert {r.observer: r.rank for r in stats.observer_rank(obs).collect()} == {"c": 1, "b": 2, "a": 3}


def test_numbers_are_dense_and_spread(spark):
    """A hot count or prefix that all rows share doesn't gather them in one task."""
    rows = spark.range(20_000).select(F.concat(F.lit("customer#"), F.lpad((F.col("id") * 7919 % 20_000).cast("string"), 6, "0")).alias("name"))
    got = numbering.numbered(rows, "name", base=5).select("name", "number", F.spark_partition_id().alias("part"))
    found = got.collect()
    assert [r.number for r in sorted(found, key=lambda r: r.name)] == list(range(5, 20_005))
    observed = spark.range(20_000).select(F.col("id").alias("obs_key"), F.col("id").cast("string").alias("observer"))
    assert sorted((r["rank"], r.observer) for r in stats.observer_rank(observed).collect()) == [(i + 1, str(i)) for i in range(20_000)]
    dealt = rows.repartitionByRange(4, "name").groupBy(F.spark_partition_id().alias("p")).count().collect()
    sizes = sorted(r["count"] for r in dealt)
    assert len(sizes) == 4 and sizes[-1] <= 2 * sizes[1]
    assert numbering.numbered(rows.limit(0), "name").count() == 0


def test_new_ids_follow_the_catalog(spark):
    known = spark.createDataFrame([(0, "b"), (1, "b"), (2, "c")], "item_id long, name string")
    found = names.already_in_catalog(spark.createDataFrame([("a",), ("b",), ("d",), ("a",)], "name string"), known)
    assert sorted(map(tuple, found.collect())) == [("a", 3, False), ("a", 3, False), ("b", 0, True), ("d", 4, False)]


def test_a_chain_of_a_thousand_levels(spark):
    chain = spark.range(1000).select(F.concat(F.lit("t"), "id").alias("name"), F.when(F.col("id") == 0, "").otherwise(F.concat(F.lit("t"), (F.col("id") - 1))).alias("parent"), F.lit("R").alias("rank"))
    joins = []
    found = taxonomy.taxon_flatten(chain, "", save=lambda df: joins.append(1) or df.checkpoint())
    low = found.orderBy(F.desc("level")).first()
    assert found.count() == 1000 and low.level == 999 and low.path == "/".join(f"t{i}" for i in range(1000)) and len(joins) <= 12


def test_trees_with_two_parents_loose_ends_and_rings(spark):
    edges = [("A", "", "x"), ("B", "A", "y"), ("C", "A", "y"), ("D/E", "B", "z"), ("D/E", "C", "z"), ("L", "nowhere", "q"), ("M", "L", "q")]
    flat = lambda e: taxonomy.taxon_flatten(spark.createDataFrame(e, "name string, parent string, rank string"), "")
    assert sorted((r.path, r.level) for r in flat(edges).collect()) == [("A", 0), ("A/B", 1), ("A/B/D/E", 2), ("A/C", 1), ("A/C/D/E", 2)]
    assert flat(edges[:0]).count() == 0
    with pytest.raises(ValueError, match="its own ancestor"):
        flat([*edges, ("B", "D/E", "y")])


def test_sisters_leave_out_own_name(spark):
    items = spark.createDataFrame([(i, "Acer a") for i in range(9)] + [(9, "Acer b"), (10, "Acer c"), (11, "Rosa x")], "item_id int, name string")
    found = {}
    for r in stats.sister_items(items).collect():
        found.setdefault(r.item_id, {})[r.n] = r.sister_id
    assert found[0] == {1: 9, 2: 10} and found[9] == {1: 0, 2: 1, 3: 2, 4: 3, 5: 4} and 11 not in found


def test_taxa_are_reused_where_they_are(spark):
    tree = spark.createDataFrame([("P", "P", "Familia", 9, 1, 0), ("P/T", "T", "Tribus", 5, 1, 0), ("P/T/D", "D", "Genus", 4, 0, 1), ("P/D", "D", "Genus", 1, 0, 0)], "path string, name string, rank string, n int, children int, tokens int")
    items = spark.createDataFrame([(1, {"01_Familia": "P", "00_Genus": "D"}), (2, {"01_Familia": "P", "00_Genus": "New"}), (3, {"bad": "x"})], "item_id int, apg map<string,string>").select("item_id", taxonomy.ordered_path(F.col("apg")).alias("path"))
    walk, after = taxonomy.taxon_attach(tree, items)
    assert {(r.item_id, r.step, r.node) for r in walk.collect()} == {(1, 1, "P"), (1, 2, "P/T/D"), (2, 1, "P"), (2, 2, "P/New")}
    assert after.count() == 5


def test_traits_of_a_maple(spark):
    t = "Acer is a deciduous tree reaching 15–25 metres tall. The leaf is 5-10 cm long. Flowers yellow-green in spring. It flowers from March to May. Fruit a samara."
    r = text.infer_traits(spark.createDataFrame([(1, t, "tree", "Sapindaceae", None, None, None)], "item_id int, text string, lifeform string, family string, color_ids array<string>, low_cm int, high_cm int")).first()
    assert r.color["values"] == [2, 5] and r.habitat["values"] == [6] and r.petal["values"] == [2]
    assert (r.height_from, r.height_to, r.flowering_from, r.flowering_to, r.toxicity) == (1500, 2500, 3, 5, 0)


def test_drafts_use_each_sentence_once():
    d = text.draft("Lead with a flower here.", "The inflorescence bears several flowers. The leaf is green and broad. Stems are erect and tall.", "", "It grows in woodland of the north.", "", [4], None, None)
    assert d["inflorescence"] == "The inflorescence bears several flowers." and d["leaf"].startswith("The leaf") and d["flower"] == "Lead with a flower here."
    assert d["habitat"] == "It grows in woodland of the north." and d["fruit"] is None


def test_gallery(spark):
    files = spark.createDataFrame([(1, 0, "a", "1-flower.webp", None, 1), (1, 1, "b", "leaf.jpg", None, 1), (1, 2, "c", "x", "fruit", 5), (1, 3, "d", "bark of it", None, 1), (2, 0, "e", "leaf", None, 1)], "item_id int, pos int, file string, title string, role_hint string, score int").withColumns({c: F.lit(None).cast("string") for c in ("path", "description", "object_name", "categories")})
    items = spark.createDataFrame([(1, "tree", None), (2, None, None)], "item_id int, lifeform string, codes array<int>")
    found = {r.item_id: (r.photos, r.status) for r in media.media_pack(files, items).collect()}
    assert found == {1: (["flower=a", "leaf=b", "fruit=c", "trunk=d"], "ok"), 2: ([], "needs_review")}
    ok = lambda name: spark.range(1).select(media.license_ok(F.lit(name))).first()[0]
    assert ok("CC BY-SA 4.0") and not ok("CC BY-NC 4.0") and not ok("own licence, CC BY") and not ok(None)


def test_patches_are_idempotent(spark):
    base = spark.createDataFrame([("a", 1), ("b", 1)], "key string, item_id int")
    patch = spark.createDataFrame([("a", 2)], "key string, item_id int")
    twice = catalog.apply_patch(catalog.apply_patch(base, patch), patch)
    assert sorted(map(tuple, twice.collect())) == [("a", 1), ("a", 2), ("b", 1)]


def test_lists_in_three_forms(spark):
    bodies = ['["a","b"]', '{"count":2,"list":["a","b"]}', '{"1":"b","0":"a","count":"2"}']
    got = spark.createDataFrame([(b,) for b in bodies], "body string").select(dumps.normalize_plant_list(F.col("body")).alias("l")).collect()
    assert all([tuple(x) for x in r.l] == [(0, "a"), (1, "b")] for r in got)


def test_folders(spark, tmp_path):
    (tmp_path / "tr").mkdir()
    (tmp_path / "tr/en.json").write_text(json.dumps({"Rosa": {"label": "rose"}, "Acer": {"names": ["maple"]}}))
    got = [(r.lang, r.pos, r.latin, r.label, r.names) for r in dumps.read_translations(spark, str(tmp_path / "tr")).orderBy("pos").collect()]
    assert got == [("en", 0, "Rosa", "rose", []), ("en", 1, "Acer", None, ["maple"])]
    (tmp_path / "p").mkdir()
    (tmp_path / "p/12_Acer_x.json").write_text('{"label":"l"}')
    (tmp_path / "p/13_Rosa.json").write_text("{}")
    whole, lacking = dumps.read_patches(spark, str(tmp_path / "p"), "label string", ["label"])
    assert [(r.item_id, r.latin) for r in whole.collect()] == [(12, "Acer x")] and [r.item_id for r in lacking.collect()] == [13]
    assert dumps.media_listing(dumps.list_files(spark, str(tmp_path / "p"))).count() == 0


def test_index_files_come_back(spark, tmp_path):
    one = spark.createDataFrame([("en", "x", 1)], "lang string, key string, n int")
    dumps.write_index_outputs(str(tmp_path / "out"), one, one, one, one, one, one)
    assert spark.read.parquet(str(tmp_path / "out/search")).count() == 1


def test_bad_payloads(spark):
    rows = spark.createDataFrame([("a", "not json"), ("b", None), ("c", "{}")], "name string, body string")
    assert payloads.parse_matches(rows).count() == 0 and payloads.parse_media(rows).count() == 0
    assert payloads.parse_entities(rows, {"x": "P1"}, "P2").count() == 3


def test_strings(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(strings.normalize_name(F.lit("  Acer ×  X "))) == "acer x x" and one(strings.normalize_name(F.lit(None).cast("string"))) == ""
    assert one(strings.display_name(F.lit("Altes Ding"), F.lit("de"))) == "altes Ding" and one(strings.display_name(F.lit("Ding"), F.lit("de"))) == "Ding"
    assert one(strings.quantity_to_cm(F.lit(2.5), F.lit("cm"))) == 2 and one(strings.mask_token(F.lit("12345678abcdWXYZ"))) == "12345678…WXYZ"
    assert one(strings.labelled_line(F.lit("x\nCommon names : a, b\nz"), "common names")) == "a, b"


def test_hints_choose_volumes_and_urls(spark):
    items = spark.createDataFrame([(1, "Acer a", "Acer", "Aceraceae", "tree", [1], ["DEN"]), (2, "Mentha b", "Mentha", "Lamiaceae", None, None, None), (3, "Odd", "Odd", None, None, [], [])], "item_id int, name string, genus string, family string, lifeform string, l2 array<int>, l3 array<string>")
    volume = "struct<vol:string,families:array<string>,covers:string,vascular:boolean,record:string,bibdigital_id:string>"
    sources = spark.createDataFrame(
        [
            ("a", "Flora", True, [], [], [], [], [], "web", None, True, "http://f/{genus}", "http://home", "http://c/{bibdigital_id}", "about", [("0", ["Aceraceae"], None, False, None, "m"), ("1", ["SAPINDACEAE"], "", None, "http://rec", None), ("2", None, "Labiatae (mints)", True, "http://rec2", "77")]),
            ("b", "Atlas", False, [], ["Labiatae"], [], [], [], None, "hand", None, None, "http://b", None, None, None),
            ("c", "Lib", True, [], [], [], [], [], "library", None, True, "x", None, None, None, None), ("d", "Pipe", True, [], [], [], [], [], "web", "pipeline", True, "x", None, None, None, None),
            ("e", "Never", None, [], [], [], [], [], "web", None, True, "x", None, None, None, None),
        ],
        f"source string, name string, always boolean, genera array<string>, families array<string>, lifeforms array<string>, l2 array<int>, l3 array<string>, kind string, fetch string, reliable boolean, url string, home string, cite string, notes string, volumes array<{volume}>",
    )
    found = records.source_hints(catalog.source_applicability(items, sources), items, sources).collect()
    got = sorted((r.item_id, r.n, r.name, r.url, r.volume, r.notes) for r in found if r.item_id < 3)
    assert got == [(1, 1, "Flora 1", "http://rec", "1", "about"), (2, 1, "Flora 2", "http://c/77", "2", "Labiatae (mints)"), (2, 2, "Atlas", "http://b", None, "")]
    assert [(r.name, r.url, r.volume) for r in found if r.item_id == 3] == [("Flora", "http://f/odd", None)]


def test_page_of_a_record_without_anything(spark):
    fields = "item_id int, query string, name string, author string, family string, ord string, l2 array<int>, ipni_id string, usda_id string, freebase_id string, gbif_id string, wiki_name string, wikilinks map<string,string>, spine map<string,string>, synonyms array<struct<name:string,authors:string,ipni_id:string>>, warnings array<string>, lifeform string, qid string, known boolean, date string"
    built = records.build_records(spark.createDataFrame([(7, None, "Acer a", *[None] * 17)], fields))
    assert built.first().job.needs == ["distribution", "color", "habitat", "petal"] and built.first().detail.wikiName == "Acer a" and built.first().header.url == "Unknown/Unknown/Acer_a/aa1.webp"
    axis = "struct<values:array<int>,confidence:double,evidence:array<string>,ok:boolean>"
    traits = spark.createDataFrame([(7, ([2], 0.5, ["x"], True), ([], 0.0, [], False), None, 5, 6, None, None, 0, ["leaf"])], f"item_id int, color {axis}, habitat {axis}, petal {axis}, height_from int, height_to int, flowering_from int, flowering_to int, toxicity int, missing array<string>")
    told = records.apply_inference(built, traits)
    row = told.first()
    assert row.job.needs == ["distribution", "habitat", "petal", "flowering"] and row.job.warnings == ["english incomplete: leaf"] and row.header.filterColor == [2] and row.detail.heightTo == 6
    none = [spark.createDataFrame([], s) for s in ("item_id int, slot int, role string, title string, license string, source_url string", "item_id int, lang string, n int, name string, source string", "item_id int, n int, name string, reliable boolean, fetch string, url string, notes string")]
    page = records.review_report(told, *none).first().report
    assert page.startswith("# Acer a\n\n- status: needs_review\n- id: 7\n") and "## Photos\n- none yet" in page and "- color: 2 (confidence 0.50) x" in page and "Botanical" not in page
    bare = records.review_report(records.apply_inference(built, traits.limit(0)), *none).first().report
    assert "## Traits" not in bare and "- height: none–none cm" in bare


def slow_attach(tree, items):
    """One item behind the other."""
    nodes = {p: dict(name=n, rank=r, n=c, children=k, tokens=t) for p, n, r, c, k, t in tree}
    walk = []
    for item, path in sorted(items):
        at = ""
        for step, (rank, name) in enumerate(path, 1):
            hits = [p for p, x in nodes.items() if x["name"] == name and x["rank"] in (None, rank) and (at == "" or p.startswith(at + "/"))]
            to = min(hits, key=lambda p: (-nodes[p]["n"], -nodes[p]["children"], -(nodes[p]["tokens"] > 0), -len(p.split("/")), p), default=None)
            if to is None:
                to = f"{at}/{name}" if at else name
                if to not in nodes:
                    nodes[to] = dict(name=name, rank=rank, n=0, children=0, tokens=0)
                    if at:
                        nodes[at]["children"] += 1
            parts = to.split("/")
            for i in range(len(at.split("/")) if at else 0, len(parts)):
                x = nodes["/".join(parts[: i + 1])]
                x["rank"] = x["rank"] or rank
                x["n"] += 1
            at = to
            walk.append((item, step, to))
    return sorted(walk), sorted((p, x["rank"], x["n"], x["children"]) for p, x in nodes.items())


TREE, PATHS = "path string, name string, rank string, n long, children long, tokens long", "item_id long, path array<struct<rank:string,name:string>>"


def test_items_attach_in_order(spark):
    """The second item lands where the first one made a taxon, and a namesake grows past another within the batch."""
    tree = [("P", "P", "Familia", 5, 2, 0), ("P/T", "T", "Tribus", 1, 1, 0), ("P/T/D", "D", "Genus", 1, 0, 0), ("P/S", "S", "Tribus", 0, 1, 0), ("P/S/D", "D", "Genus", 0, 0, 0)]
    items = [(1, [("Familia", "P"), ("Genus", "New")]), (2, [("Familia", "P"), ("Tribus", "S"), ("Genus", "D")]), (3, [("Familia", "P"), ("Tribus", "S"), ("Genus", "D")]), (4, [("Familia", "P"), ("Genus", "D")]), (5, [("Genus", "New")])]
    walk, after = taxonomy.taxon_attach(spark.createDataFrame(tree, TREE), spark.createDataFrame(items, PATHS))
    found = {(r.item_id, r.step): r.node for r in walk.collect()}
    assert found[4, 2] == "P/S/D" and found[5, 1] == "P/New"
    assert (sorted((i, s, n) for (i, s), n in found.items()), sorted((r.path, r["rank"], r.n, r.children) for r in after.collect())) == slow_attach(tree, items)


def test_attachment_equals_one_by_one(spark):
    """Random trees side by side, with namesakes, taxa without a rank, and items that make, rank and enrich taxa for later ones."""
    rng = random.Random(11)
    tree, items = [], []
    for case in range(25):
        names, ranks = [f"c{case}{x}" for x in "abcd"], ("R1", "R2", "R3")
        paths = {f"c{case}root": 0}
        for _ in range(rng.randrange(7)):
            at = rng.choice(sorted(paths))
            paths.setdefault(f"{at}/{rng.choice(names)}", 0)
        for p in paths:
            tree.append((p, p.rsplit("/", 1)[-1], rng.choice([None, *ranks]), rng.randrange(3), sum(q.rsplit("/", 1)[0] == p for q in paths if q != p), rng.randrange(2)))
        for i in range(rng.randrange(1, 9)):
            steps = [(rng.choice(ranks), x) for x in rng.sample(names, rng.randrange(0, 3))]
            items.append((i * 100 + case, ([(rng.choice(ranks), f"c{case}root")] if rng.random() < 0.7 else []) + steps))
    walk, after = taxonomy.taxon_attach(spark.createDataFrame(tree, TREE), spark.createDataFrame(items, PATHS))
    assert (sorted(map(tuple, walk.collect())), sorted((r.path, r["rank"], r.n, r.children) for r in after.collect())) == slow_attach(tree, items)
    assert taxonomy.taxon_attach(spark.createDataFrame(tree, TREE), spark.createDataFrame([], PATHS))[0].count() == 0


def test_sentences_keep_their_digits(spark):
    df = spark.createDataFrame([("0a0.  1b1. 2c 2?\n 333d3",)], "t string")
    assert df.select(text.sentences(F.col("t")).alias("s")).first().s == ["0a0.", "1b1.", "2c 2?", "333d3"]


def test_keyword_sentences_keep_their_digits(spark):
    df = spark.createDataFrame([("a. 1 Token 1. 2 license 2. c",)], "t string")
    assert df.select(text.keyword_sentences(F.col("t"), ["token", "license"]).alias("s")).first().s == ["1 Token 1.", "2 license 2."]


def test_keys_of_items_are_not_shuffled(spark):
    items = spark.createDataFrame([(0, [5, 2], [6], [2], [10, 11]), (0, [5], [1], [2], [10]), (1, [3], [1, 4, 8], [2], [11]), (None, [1], None, None, []), (None, [1], [2], None, [])], HEADER)
    new = items.filter("item_id is null or item_id = 0 and size(color) = 1 or item_id = 1").unionByName(spark.createDataFrame([(2, None, [], None, None)], HEADER))
    pairs = lambda rows: {(r.item_id, r.key) for r in facets.matching_keys(rows, "item_id", DOMAINS).collect()}
    members = facets.facet_members(items, "item_id", DOMAINS)
    got = [(r.item_id, r.key) for r in members.collect()]
    assert len(got) == len(set(got)) and set(got) == pairs(items)
    diff = facets.facet_key_diff(items, new, "item_id", DOMAINS)
    assert sorted((r.change, str(r.item_id), r.key) for r in diff.collect()) == sorted([("add", str(i), k) for i, k in pairs(new) - pairs(items)] + [("remove", str(i), k) for i, k in pairs(items) - pairs(new)])
    for df in (members, diff):
        grouped = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in line]
        assert grouped and all("Aggregate [item_id#" in line and ", key#" not in line for line in grouped)


def test_entities_and_pages_are_dealt_before_they_are_read(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    e = spark.createDataFrame([(1, "A b", [], {"en": "c"}, {}, {})], "item_id long, latin string, synonyms array<string>, labels map<string,string>, aliases map<string,array<string>>, wikipedia map<string,string>").coalesce(1)
    assert names.entity_names(e).rdd.getNumPartitions() == parts
    p = spark.createDataFrame([(1, "a", "<a href='x'>a</a>")], "key long, wanted string, body string").coalesce(1)
    plan = payloads.gallery_species(p)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [key#" in plan


def test_packets_are_built_records(spark):
    from catalens.plans import registry

    some = {name: {r.item_id: r for r in registry.queries()[name](spark, "/root/testdata/sf0.001").collect()} for name in ("validate_packets", "build_records", "apply_inference")}
    assert some["validate_packets"].keys() == some["build_records"].keys() and any(r.ok for r in some["validate_packets"].values())
    for k, r in some["validate_packets"].items():
        built, told = some["build_records"][k], some["apply_inference"][k]
        assert ("no family" in r.errors, "no id" in r.errors, bool(r.warnings)) == (built.family == "", built.gbif_id is None, told.status == "needs_review")
