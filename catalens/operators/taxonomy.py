"""Taxonomy as edges and members: flattening, paths, roll-up, and attaching items to an existing tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalens.sources.shared import saved, written


def ordered_path(entries: Column) -> Column:
    """Steps (rank, name) from the root down, of a map ``NN_Rank -> name``; keys without a number and empty names drop out."""
    kept = F.filter(F.map_entries(entries), lambda e: e["key"].rlike("^-?[0-9]+_") & (F.coalesce(e["value"], F.lit("")) != ""))
    steps = F.transform(kept, lambda e: F.struct(F.substring_index(e["key"], "_", 1).cast("int").alias("n"), F.regexp_replace(e["key"], "^-?[0-9]+_", "").alias("rank"), e["value"].alias("name")))
    return F.transform(F.sort_array(steps, asc=False), lambda s: F.struct(s["rank"].alias("rank"), s["name"].alias("name")))


def path_to_map(path: Column) -> Column:
    """The map of such a path, numbered from its end."""
    return F.map_from_entries(F.transform(F.reverse(path), lambda s, i: F.struct(F.concat(F.lpad(i.cast("string"), 2, "0"), F.lit("_"), s["rank"]), s["name"])))


def taxon_flatten(edges: DataFrame, root: str, save=saved) -> DataFrame:
    """(path, name, rank, level) of a tree given as (name, parent, rank), for all that descends from ``root``.

    Each row knows a stretch of its way up: at first the one step to its parent. A join puts the stretches of a row's
    uppermost known taxon on top of its own, so that stretches double in length: a tree of d levels takes about log2(d)
    joins. A name with several parents has a path by each. Taxa that don't lead to the root drop out; a name that is its
    own ancestor is an error. ``save`` cuts the lineage between joins.
    """
    ways = save(edges.select("name", F.col("parent").alias("top"), F.array("name").alias("path"), "rank"))
    while True:
        below, above = ways.filter(F.col("top") != root), ways.select(F.col("name").alias("top"), F.col("top").alias("up"), F.col("path").alias("on"))
        longer = below.join(above, "top").select("name", F.col("up").alias("top"), F.concat("on", "path").alias("path"), "rank")
        ways = save(ways.filter(F.col("top") == root).unionByName(longer))
        left, cycle = ways.agg(F.count_if(F.col("top") != root), F.max(F.size(F.array_distinct("path")) < F.size("path"))).first()
        if cycle:
            raise ValueError("a taxon is its own ancestor")
        if not left:
            return ways.select(F.array_join("path", "/").alias("path"), "name", "rank", (F.size("path") - 1).alias("level"))


def taxon_rollup(items: DataFrame) -> DataFrame:
    """(path, name, rank, count) from items (item_id, path: steps from the root): every ancestor counts its distinct items."""
    size = F.size("path")
    heads = F.transform(F.sequence(F.lit(1), size), lambda n: F.struct(F.array_join(F.transform(F.slice(F.col("path"), 1, n), lambda s: s["name"]), "/").alias("path"), F.element_at(F.col("path"), n)["name"].alias("name"), F.element_at(F.col("path"), n)["rank"].alias("rank")))
    each = items.filter(size > 0).select("item_id", F.explode(heads).alias("t")).select("item_id", "t.*")
    members = each.distinct()
    return members.groupBy("path", "name").agg(F.min("rank").alias("rank"), F.count_distinct("item_id").alias("count"))


def taxon_members(tree: DataFrame, members: DataFrame) -> DataFrame:
    """Members (path, item_id) of all ancestors, from those of the lowest taxa."""
    parts = F.split("path", "/")
    up = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return members.select(F.explode(up).alias("path"), "item_id").distinct().join(tree.select("path"), "path", "left_semi")


_STATE = {"touched": "path string, item_id long, rank string", "made": "path string, name string, rank string, parent string, item_id long"}


def _earlier(asked: DataFrame, events: DataFrame, to: str, block: int = 1 << 16) -> DataFrame:
    """``asked`` (item_id, found, ...) with column ``to``: how many events (path, item_id) of the node found come from earlier items.

    Counted by blocks of item ids, each a task's work, behind the sums of the blocks before; only nodes asked for are looked at.
    """
    keys = asked.select("found", "item_id").distinct()
    mine = events.select(F.col("path").alias("found"), "item_id").join(keys.select("found").distinct(), "found", "left_semi")
    both = keys.withColumn("k", F.lit(0)).unionByName(mine.withColumn("k", F.lit(1))).withColumn("block", F.floor(F.col("item_id") / block))
    sums = both.groupBy("found", "block").agg(F.sum("k").alias("k"))
    sums = sums.select("found", "block", F.coalesce(F.sum("k").over(Window.partitionBy("found").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = F.coalesce(F.sum("k").over(Window.partitionBy("found", "block").orderBy("item_id").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = both.withColumn("within", within).filter("k = 0").join(sums, ["found", "block"]).select("found", "item_id", (F.col("before") + F.col("within")).alias(to))
    return asked.join(counted, ["found", "item_id"])


def _walks(tree: DataFrame, items: DataFrame, longest: int, touched: DataFrame, made: DataFrame, save) -> DataFrame:
    """(item_id, step, node, rank, name, under, new) of all items, each on the tree as the events of earlier items leave it."""
    first = made.groupBy("path").agg(F.min_by(F.struct("name", "rank"), "item_id").alias("x"), F.min("item_id").alias("since"))
    zero = [F.lit(0).cast("long").alias(c) for c in ("n", "children", "tokens")]
    nodes = tree.withColumn("since", F.lit(None).cast("long")).unionByName(first.select("path", "x.name", "x.rank", *zero, "since")).select(F.col("path").alias("found"), "name", F.col("rank").alias("own"), "n", "children", "tokens", "since")
    typed = touched.join(tree.filter("rank is null").select("path"), "path", "left_semi").groupBy(F.col("path").alias("found")).agg(F.min("item_id").alias("typed_by"), F.min_by("rank", "item_id").alias("typed_as"))
    at, out = items.select("item_id", "path", F.lit("").alias("under")), None
    for k in range(longest):
        step = F.try_element_at("path", F.lit(k + 1))
        now = at.filter(F.size("path") > k).select("item_id", "path", "under", step["rank"].alias("rank"), step["name"].alias("name"))
        keys = ["under", "rank", "name"]
        below = (F.col("under") == "") | F.col("found").startswith(F.concat("under", F.lit("/")))
        hits = save(now.select(*keys).distinct().join(nodes, "name").filter(below & (F.col("own").isNull() | F.col("own").eqNullSafe(F.col("rank")))))
        kinds = hits.groupBy(*keys).agg(F.count("*").alias("rivals"), F.max(F.col("since").isNotNull() | F.col("own").isNull()).alias("moving"), F.min("found").alias("only"))
        plain = F.coalesce((F.col("rivals") == 1) & ~F.col("moving"), F.lit(False))
        now = now.join(kinds, keys, "left").withColumn("plain", plain)
        # where several namesakes stand, or one that this batch makes or gives its rank, an item sees what earlier ones did
        open_ = now.filter("rivals is not null and not plain").select("item_id", *keys).join(hits, keys).filter(F.col("since").isNull() | (F.col("since") < F.col("item_id"))).join(typed, "found", "left")
        own = F.coalesce("own", F.when(F.col("typed_by") < F.col("item_id"), F.col("typed_as")))
        open_ = open_.filter(own.isNull() | (own == F.col("rank")))
        open_ = _earlier(_earlier(open_, touched, "more_items"), made.select(F.col("parent").alias("path"), "item_id", F.col("path").alias("child")).groupBy("path", "child").agg(F.min("item_id").alias("item_id")), "more_children")
        score = [F.desc(F.col("n") + F.col("more_items")), F.desc(F.col("children") + F.col("more_children")), F.desc((F.col("tokens") > 0).cast("int")), F.desc(F.size(F.split("found", "/"))), "found"]
        best = open_.withColumn("place", F.row_number().over(Window.partitionBy("item_id").orderBy(*score))).filter("place = 1").select("item_id", "found")
        chosen = now.join(best, "item_id", "left").withColumn("found", F.when(F.col("plain"), F.col("only")).otherwise(F.col("found")))
        own_path = F.when(F.col("under") == "", F.col("name")).otherwise(F.concat_ws("/", "under", "name"))
        chosen = save(chosen.select("item_id", "path", "under", "rank", "name", F.coalesce("found", own_path).alias("node"), F.col("found").isNull().alias("new")))
        steps = chosen.select("item_id", F.lit(k + 1).alias("step"), "node", "rank", "name", "under", "new")
        out = steps if out is None else out.unionByName(steps)
        at = chosen.select("item_id", "path", F.col("node").alias("under"))
    return out


def taxon_attach(tree: DataFrame, items: DataFrame, save=written, rounds: int = 50) -> tuple[DataFrame, DataFrame]:
    """Items (item_id, path) attached to ``tree`` (path, name, rank, n, children, tokens) in order of item_id; returns the walk (item_id, step, node) and the tree after it.

    At each step of its path an item goes to the namesake of the same or no rank, among all descendants of the place it has
    reached, that is richest (n, children, whether it has tokens, depth; of equals the first by path), or makes a child (where
    one of that name has another rank, it goes to that). All taxa on its way count it and take the step's rank if they have none. So what one item makes or counts, the next one sees.

    That order needs no sequence: all items walk at once on the tree with the events of earlier items as the round before
    told them, until a round tells the same. An item's walk depends on earlier items alone, so what stays the same is what
    attaching one by one gives, and rounds follow the longest chain of items that change each other's minds: often two.
    Item ids are numbers, once each, and not yet in the tree.
    """
    tree = tree.select("path", "name", "rank", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n", "children", "tokens")])
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "path")
    spark = tree.sparkSession
    touched, made = (spark.createDataFrame([], s) for s in _STATE.values())
    longest = items.agg(F.max(F.size("path"))).first()[0] or 0
    if longest <= 0:
        return spark.createDataFrame([], "item_id long, step int, node string"), tree
    was = None
    for _ in range(rounds):
        walk = _walks(tree, items, longest, touched, made, save)  # tables of its steps
        state = walk.agg(F.count("*"), F.sum(F.xxhash64("item_id", "step", "node", "new").cast("decimal(38,0)"))).first()
        way = F.transform(F.sequence(F.size(F.when(F.col("under") == "", F.array().cast("array<string>")).otherwise(F.split("under", "/"))) + 1, F.size(F.split("node", "/"))), lambda i: F.array_join(F.slice(F.split("node", "/"), 1, i), "/"))
        touched = walk.select(F.explode(way).alias("path"), "item_id", "rank")
        made = walk.filter("new").select(F.col("node").alias("path"), "name", "rank", F.col("under").alias("parent"), "item_id").join(tree.select("path"), "path", "left_anti")
        if state == was:
            break
        was = state
    else:
        raise RuntimeError("the walks did not settle")
    fresh = made.groupBy("path").agg(F.min_by(F.struct("name", "rank"), "item_id").alias("x"), F.first("parent").alias("parent"))
    counts = touched.groupBy("path").agg(F.count("*").alias("more"), F.min_by("rank", "item_id").alias("as"))
    sons = fresh.groupBy(F.col("parent").alias("path")).agg(F.count("*").alias("sons"))
    every = tree.unionByName(fresh.select("path", "x.name", "x.rank", *[F.lit(0).cast("long").alias(c) for c in ("n", "children", "tokens")]))
    after = every.join(counts, "path", "left").join(sons, "path", "left")
    plus = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
    return walk.select("item_id", "step", "node"), after.select("path", "name", F.coalesce("rank", "as").alias("rank"), plus("n", "more"), plus("children", "sons"), "tokens")


def taxon_path_patch(items: DataFrame, entries: str) -> DataFrame:
    """(item_id, path, entries) of changed items."""
    return items.select("item_id", ordered_path(F.col(entries)).alias("path"), entries)
