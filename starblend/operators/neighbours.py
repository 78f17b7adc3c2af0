"""Item-item similarity and the neighbourhood prediction built on it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import ArrayType, IntegralType

from starblend.functions import clamp, pair_key, signed_power, winsorise
from starblend.operators.biases import bias_score
from starblend.operators.profile import key_counts
from starblend.operators.skew import attach, hot_by, hot_keys
from starblend.workspace import Workspace

# Fixed value: pairs of items with fewer common raters have no similarity.
MIN_SUPPORT = 3

# Candidate rows one task should produce; a user or item that yields more is split.
ROWS_PER_SPLIT = 4_000_000

# Pairs of ratings one task should make, and raters of one item it should take.
PAIRS_PER_TASK = 1_000_000
RATERS_PER_SPLIT = 100_000

# List entries, one for each pair, that one task should write: its input is far smaller, and with all of them it would spill.
ENTRIES_PER_TASK = 4_000_000

# Different stars that travel in lists as their place among them, a byte each; with more they travel as they are.
STAR_LEVELS = 100

# Rows of one user that are paired in one piece; the rows of a user with more are paired block by block.
USER_BLOCK = 2_000

# Sums are taken over stars less this, the middle of the scale, so that little cancels.
MIDDLE = 3.0


def cap_user_items(ratings: DataFrame, cap: int, tie: str | Column | None = None) -> DataFrame:
    """The first ``cap`` rows of each user by item id (then by ``tie``).  Drops data: nothing caps by default.

    A row-number filter against a constant is applied once before the shuffle and once after it, so
    a user with a third of all ratings sends at most ``cap`` rows per input task.
    """
    order = ["business_id"] if tie is None else ["business_id", tie]
    place = F.row_number().over(W.partitionBy("user_id").orderBy(*order))
    return ratings.withColumn("_place", place).where(F.col("_place") <= cap).drop("_place")


def heavy_users(ratings: DataFrame, block: int | None = None) -> DataFrame | None:
    """``user_id, blocks`` of the users whose rows are paired block by block; None if there are none."""
    block = USER_BLOCK if block is None else block
    counts = key_counts(ratings, "user_id")
    found = counts.where(F.col("n") > block).select(
        "user_id", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks")
    )
    return None if found.isEmpty() else found


def busy_items(ratings: DataFrame) -> DataFrame | None:
    """``item_a, splits`` of the items with too many raters for one task; None if there are none."""
    found = key_counts(ratings, "business_id").where(F.col("n") > RATERS_PER_SPLIT).select(
        F.col("business_id").alias("item_a"), F.ceil(F.col("n") / F.lit(RATERS_PER_SPLIT)).cast("int").alias("splits")
    )
    return None if found.isEmpty() else found


def _item_lists(ratings: DataFrame, heavy: DataFrame | None, tasks: int | None = None) -> DataFrame:
    """``user_id, item_a, a, items, stars``: each rating with the user's ratings of items beyond it, as two arrays.

    The rows of a ``heavy`` user are dealt to blocks, and each row gets one list for each block, so a list has about
    ``USER_BLOCK`` entries and one key about block rows however many items the user rated.  A block travels as one list to each pair
    of blocks that it is in, and the rows of either are paired with the other's there.  Where ``ratings`` carry the
    columns of ``tail_raters``, ``mine`` has those of the rating's item and the array ``theirs`` those of each entry's.
    The lists of the other users are made in as many ``tasks`` if given.
    """
    looks = [c for c in _TAIL_COLUMNS if c in ratings.columns]
    rows = ratings.select("user_id", "business_id", "stars", *looks).where("user_id IS NOT NULL AND business_id IS NOT NULL")
    entry = F.struct("business_id", "stars", *looks)

    def lists(listed: DataFrame, rest: Column) -> DataFrame:
        tails = [F.struct(*[f"own.{c}" for c in looks]).alias("mine"), F.arrays_zip(*[f"rest.{c}" for c in looks]).alias("theirs")]
        return listed.withColumn("rest", rest).where(F.size("rest") > 0).select(
            "user_id", F.col("own.business_id").alias("item_a"), F.col("own.stars").alias("a"),
            F.col("rest.business_id").alias("items"), F.col("rest.stars").alias("stars"), *(tails if looks else []),
        )

    light = rows if heavy is None else rows.join(heavy, "user_id", "left_anti")
    light = light if tasks is None else light.repartition(tasks, "user_id")
    rated = light.groupBy("user_id").agg(F.sort_array(F.collect_list(entry)).alias("rated"))
    own = rated.select("user_id", "rated", F.posexplode("rated").alias("place", "own"))
    found = lists(own, F.slice("rated", F.col("place") + 2, F.size("rated")))
    if heavy is None:
        return found
    dealt = rows.join(heavy, "user_id").withColumn("_own", F.pmod(F.xxhash64("business_id", "stars"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("_other")
    blocks = dealt.groupBy("user_id", "blocks", "_own").agg(F.collect_list(entry).alias("rated")).select("user_id", "_own", "rated", every)
    ends = [F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high")]
    met = blocks.groupBy("user_id", *ends).agg(F.collect_list("rated").alias("met"))  # two blocks, or one with itself
    one, other = F.element_at("met", 1), F.element_at("met", -1)

    def side(own: Column, rest: Column) -> Column:
        return F.struct(own.alias("rated"), rest.alias("others"))

    sides = F.when(F.col("_low") == F.col("_high"), F.array(side(one, one))).when(F.size("met") == 2, F.array(side(one, other), side(other, one)))
    own = met.select("user_id", F.explode(sides).alias("_side")).select("user_id", "_side.others", F.explode("_side.rated").alias("own"))
    return found.unionByName(lists(own, F.filter("others", lambda other: other["business_id"] > F.col("own.business_id"))))


class _Codes:
    """Short numbers for the items and the stars of ``ratings``: lists have an entry for each pair and are most of what travels.

    Whole-numbered ids within 2^31 of each other are coded by the distance from the least, stars of at most ``STAR_LEVELS``
    different values by their place among these.  What cannot be coded stays as it is; nothing is rounded, but minus zero becomes zero.
    """

    def __init__(self, ratings: DataFrame):
        self.id_type, stars = (ratings.schema[c].dataType for c in ("business_id", "stars"))
        ends = [end("business_id").alias(end.__name__) for end in (F.min, F.max)]
        found = ratings.agg(*ends, F.approx_count_distinct("stars").alias("levels")).first()
        whole = isinstance(self.id_type, IntegralType) and found["min"] is not None
        self.least = F.lit(found["min"]).cast("bigint") if whole and found["max"] - found["min"] < 2**31 else None
        self.levels = None
        if found["levels"] <= STAR_LEVELS:  # an estimate
            rows = ratings.select("stars").distinct().limit(STAR_LEVELS + 2).collect()
            levels = [row["stars"] for row in rows if row["stars"] is not None]
            if len(levels) <= STAR_LEVELS and all(level == level for level in levels):  # no place is found for NaN
                self.levels = F.array(*map(F.lit, levels)).cast(ArrayType(stars))

    def item(self, name: str) -> Column:
        return F.col(name) if self.least is None else (F.col(name) - self.least).cast("int").alias(name)

    def stars(self, name: str) -> Column:
        return F.col(name) if self.levels is None else (F.array_position(self.levels, F.col(name)) - 1).cast("tinyint").alias(name)

    def item_of(self, name: str) -> Column:
        return F.col(name) if self.least is None else (F.col(name) + self.least).cast(self.id_type).alias(name)

    def stars_of(self, name: str) -> Column:
        return F.col(name) if self.levels is None else F.get(self.levels, F.col(name)).alias(name)


def _pair_parts(ratings: DataFrame, heavy: DataFrame | None, busy: DataFrame | None) -> list[DataFrame]:
    """``item_pairs`` in parts that share no ``item_a``: those of a busy item lie in several tasks, all others' in one."""
    counts = key_counts(ratings.where("user_id IS NOT NULL"), "user_id")
    made = counts.agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0.0))).first()[0]
    tasks = max(1, -int(-made // PAIRS_PER_TASK))

    makers = max(-int(-made // ENTRIES_PER_TASK), min(tasks, ratings.sparkSession.sparkContext.defaultParallelism))
    codes = _Codes(ratings)
    coded = ratings.withColumns({"business_id": codes.item("business_id"), "stars": codes.stars("stars")})
    lists = _item_lists(coded, heavy, makers).withColumn("item_a", codes.item_of("item_a"))  # tasks are dealt, and sums grouped, by the id
    looked = ["looked"] if "theirs" in lists.columns else []
    listed = ["items", "stars", *(["theirs"] if looked else [])]

    def entries(lists: DataFrame, *others: str) -> DataFrame:
        return lists.select("item_a", "a", *others, F.inline(F.arrays_zip(*listed)).alias("item_b", "b", *listed[2:]))

    def paired(lists: DataFrame, *keys: str) -> DataFrame:
        if looked:  # in rows of their own pairs are looked up by generated code, in lists they would be by lambdas
            pairs = entries(lists, "mine", *keys[1:])
            pairs = pairs.select("item_a", "a", *keys[1:], "item_b", "b", _looked_up(F.col("mine"), F.col("theirs")).alias("looked"))
            pairs = pairs.repartition(tasks, *keys)
        else:
            pairs = entries(lists.select("item_a", "a", *listed, *keys[1:]).repartition(tasks, *keys), *keys[1:])
        pairs = pairs.withColumn("item_b", codes.item_of("item_b"))
        pairs = pairs.where(F.col("item_a") < F.col("item_b"))
        return pairs.select("item_a", "item_b", *[codes.stars_of(c) for c in "ab"], *looked)

    if busy is None:
        return [paired(lists, "item_a")]
    split = F.pmod(F.xxhash64("user_id", "items"), F.col("splits")).cast("int").alias("_split")
    hot = lists.join(F.broadcast(busy), "item_a").select("item_a", "a", *listed, *(["mine"] if looked else []), split)
    return [paired(lists.join(F.broadcast(busy), "item_a", "left_anti"), "item_a"), paired(hot, "item_a", "_split")]


def item_pairs(ratings: DataFrame, heavy: DataFrame | None = None, busy: DataFrame | None = None) -> DataFrame:
    """``item_a < item_b, a, b``: the stars of every user who rated both items.

    What travels is one row for each rating, with the list of the user's items beyond it, to the task of its item:
    sums by pair need no further shuffle there.  The rows of a ``busy`` item go to several tasks.
    """
    return reduce(DataFrame.unionByName, _pair_parts(ratings, heavy, busy))


def item_tails(ratings: DataFrame) -> DataFrame:
    """``user_id, business_id, stars``: of each item's raters the last two by how many items they rated.

    Two items with ``MIN_SUPPORT`` = 3 common raters share one that is among the last two of neither, as the first of the
    three in that order has two behind it on both sides.  A user who rated some item twice counts several times there, and so
    is in no tail.
    """
    once = ratings.groupBy("user_id", "business_id").agg(F.count(F.lit(1)).alias("c"))
    users = once.groupBy("user_id").agg(F.count(F.lit(1)).alias("rated"), F.max("c").alias("most")).where("most = 1")
    rows = ratings.select("user_id", "business_id", "stars").join(users, "user_id")
    last = W.partitionBy("business_id").orderBy(F.col("rated").desc(), F.col("user_id").desc())
    return rows.withColumn("place", F.row_number().over(last)).where(F.col("place") < MIN_SUPPORT).select("user_id", "business_id", "stars")


def tail_raters(ratings: DataFrame, tails: DataFrame) -> DataFrame:
    """``business_id, tail_users, met_users, met_stars``: whom to look up for an item, and where to find them.

    ``met_users`` are the item's raters who are in some item's tail, with their stars; those in its own are ``tail_users``.
    """
    keys = ["user_id", "business_id"]
    tailed = tails.select(*keys, F.lit(True).alias("_tail"))
    met = ratings.select(*keys, "stars").join(tails.select("user_id").distinct(), "user_id", "left_semi").join(tailed, keys, "left")
    return met.groupBy("business_id").agg(F.sort_array(F.collect_list(F.struct("user_id", "stars", "_tail"))).alias("_met")).select(
        "business_id", F.filter("_met", lambda m: m["_tail"].isNotNull())["user_id"].alias("tail_users"),
        F.col("_met.user_id").alias("met_users"), F.col("_met.stars").alias("met_stars"),
    )


_TAIL_COLUMNS = ["tail_users", "met_users", "met_stars"]


def _looked_up(one: Column, other: Column) -> Column:
    """The stars ``a0, b0, a1, ...`` of those who rated both items and are in the tail of one, at most four, and their number ``more``.

    The raters in a tail are a fixed few, so each has a place of its own; a place without a rater is null.
    """
    users = [F.get(item["tail_users"], F.lit(k)) for item in (one, other) for k in range(MIN_SUPPORT - 1)]
    found = []
    for place, user in enumerate(users):
        at, beside = (F.array_position(item["met_users"], user).cast("int") for item in (one, other))
        both = (at > 0) & (beside > 0)
        if place >= MIN_SUPPORT - 1:
            both = both & ~F.array_contains(one["tail_users"], user)  # has a place there
        found.append((F.coalesce(both, F.lit(False)), F.get(one["met_stars"], at - 1), F.get(other["met_stars"], beside - 1)))
    more = reduce(Column.__add__, [both.cast("int") for both, _, _ in found])
    stars = [F.when(both, value).alias(f"{side}{k}") for k, (both, *values) in enumerate(found) for side, value in zip("ab", values)]
    return F.struct(more.alias("more"), *stars)


def tails_pay(ratings: DataFrame, tails: DataFrame) -> bool:
    """Whether pairing without the tails, and looking the tails of proposed pairs up, makes fewer rows than pairing all.

    A proposed pair brings at most four raters more; there are no more of them than rows paired without the tails.  A
    proposing rating carries the raters of its item that some pair may look up.
    """
    def pairs(n: Column) -> Column:
        return F.coalesce(F.sum(n * (n - 1) / 2), F.lit(0.0))

    left_out = key_counts(tails, "user_id").withColumnRenamed("n", "t")
    counts = key_counts(ratings, "user_id").join(left_out, "user_id", "left").withColumn("t", F.coalesce("t", F.lit(0)))
    made = counts.agg(pairs(F.col("n")).alias("all"), pairs(F.col("n") - F.col("t")).alias("without")).first()
    if made["without"] * (2 * MIN_SUPPORT - 1) >= made["all"]:
        return False
    met = key_counts(ratings.join(tails.select("user_id").distinct(), "user_id", "left_semi"), "business_id")
    met = key_counts(ratings, "business_id").join(met.withColumnRenamed("n", "m"), "business_id")
    carried = met.agg(F.coalesce(F.sum(F.col("n").cast("double") * F.col("m")), F.lit(0.0))).first()[0]
    return made["without"] * (2 * MIN_SUPPORT - 1) + carried < made["all"]


def _moments(pairs: DataFrame) -> DataFrame:
    """Sums by pair of items; the raters ``looked`` up, the same in every row of a pair, are added once."""
    x, y = F.col("a") - F.lit(MIDDLE), F.col("b") - F.lit(MIDDLE)
    sums = {"sa": x, "sb": y, "saa": x * x, "sbb": y * y, "sab": x * y}
    found = [F.count(F.lit(1)).alias("n"), *[F.sum(term).alias(name) for name, term in sums.items()]]
    if "looked" not in pairs.columns:
        return pairs.groupBy("item_a", "item_b").agg(
            *found, (F.min("a") < F.max("a")).alias("a_varies"), (F.min("b") < F.max("b")).alias("b_varies")
        )
    slots = range(2 * (MIN_SUPPORT - 1))  # as columns, for which the aggregation needs no sort
    places = [f"{side}{k}" for k in slots for side in "ab"]
    rows = pairs.select("item_a", "item_b", "a", "b", "looked.more", *[f"looked.{name}" for name in places])
    ends = [end(side).alias(f"{side}_{end.__name__}") for side in "ab" for end in (F.min, F.max)]
    once = rows.groupBy("item_a", "item_b").agg(*found, *ends, *[F.max(c).alias(c) for c in ["more", *places]])

    def added(name: str) -> Column:
        values = {"sa": "a", "sb": "b", "saa": "aa", "sbb": "bb", "sab": "ab"}[name]
        terms = [F.col(name)] + [reduce(Column.__mul__, [F.col(f"{v}{k}") - F.lit(MIDDLE) for v in values]) for k in slots]
        return F.when(F.coalesce(*terms).isNotNull(), reduce(Column.__add__, [F.coalesce(t, F.lit(0.0)) for t in terms]))

    def varies(side: str) -> Column:
        return F.least(f"{side}_min", *[f"{side}{k}" for k in slots]) < F.greatest(f"{side}_max", *[f"{side}{k}" for k in slots])

    return once.select(
        "item_a", "item_b", (F.col("n") + F.col("more")).alias("n"), *[added(name).alias(name) for name in sums],
        varies("a").alias("a_varies"), varies("b").alias("b_varies"),
    )


def _proposed_parts(
    ratings: DataFrame, tails: DataFrame, work: Workspace, heavy: DataFrame | None, busy: DataFrame | None
) -> list[DataFrame]:
    keys = ["user_id", "business_id"]
    proposing = ratings.select(*keys, "stars").join(tails, keys, "left_anti")
    met = work.table(tail_raters(ratings, tails), "tail-raters")
    none = {c: F.coalesce(c, F.array().cast(met.schema[c].dataType)) for c in _TAIL_COLUMNS}
    hot = hot_by(key_counts(proposing, "business_id"), "business_id")
    proposing = work.table(attach(proposing, met, "business_id", hot).withColumns(none), "proposing")
    return _pair_parts(proposing, heavy, busy)


def proposed_pairs(
    ratings: DataFrame, tails: DataFrame, work: Workspace, heavy: DataFrame | None = None, busy: DataFrame | None = None
) -> DataFrame:
    """``item_pairs`` of the raters outside the tails, who propose pairs, with the raters ``looked`` up for each.

    Of a proposed pair, the raters in the tail of one item are looked up among the raters of the other; so a user who rated
    everything is in most tails and proposes next to nothing.  A rating carries its item's ``tail_raters`` to where its
    user's lists are made, so what is looked up travels with the pair, the same in each of its rows; nothing is joined by pair.
    """
    return reduce(DataFrame.unionByName, _proposed_parts(ratings, tails, work, heavy, busy))


def item_similarities(
    ratings: DataFrame, shrink: float = 5.0, at_least: float = 0.0, heavy: DataFrame | None = None,
    pairs: DataFrame | list[DataFrame] | None = None, busy: DataFrame | None = None,
) -> DataFrame:
    """``item_a, item_b, sim, n``: Pearson correlation over common raters times n / (n + shrink).

    Moments are summed where the pairs are made, and those of ``busy`` items before their shuffle, so the rows of a very
    popular pair never meet in one task.  Pairs with too few raters, or with an item that all of them rated alike, are left out.  ``pairs`` are those of
    ``item_pairs`` unless given: as one table, or as parts that share no pair.
    """
    n = F.col("n").cast("double")
    numerator = n * F.col("sab") - F.col("sa") * F.col("sb")
    spread_a = n * F.col("saa") - F.col("sa") * F.col("sa")
    spread_b = n * F.col("sbb") - F.col("sb") * F.col("sb")
    if pairs is None:
        pairs = _pair_parts(ratings, heavy, busy)
    parts = pairs if isinstance(pairs, list) else [pairs]
    moments = (
        reduce(DataFrame.unionByName, map(_moments, parts))
        .where(F.col("n") >= MIN_SUPPORT)
        .where(F.col("a_varies") & F.col("b_varies"))
    )
    pearson = clamp(F.try_divide(numerator, F.sqrt(spread_a) * F.sqrt(spread_b)), -1.0, 1.0)
    shrunk = pearson * (n / (n + F.lit(float(shrink))))
    return (
        moments.select("item_a", "item_b", shrunk.alias("sim"), "n")
        .where(F.col("sim").isNotNull() & ~F.isnan("sim"))
        .where(F.abs("sim") >= F.lit(float(at_least)))
    )


def similarities_of(
    ratings: DataFrame, work: Workspace, shrink: float = 5.0, at_least: float = 0.0, block: int | None = None
) -> DataFrame:
    """``item_similarities`` by the way that makes fewer rows: by proposals where users with very many items are most of the pairs."""
    heavy, busy = heavy_users(ratings, block), busy_items(ratings)
    if heavy is not None:
        # the ratings of the others in a tail propose too, so only those of heavy users need to be looked up
        tails = work.table(item_tails(ratings).join(heavy, "user_id", "left_semi"), "tails")
        if tails_pay(ratings, tails):
            light = ratings.join(tails, ["user_id", "business_id"], "left_anti")
            pairs = _proposed_parts(ratings, tails, work, heavy_users(light, block), busy_items(light))
            return item_similarities(ratings, shrink, at_least, pairs=pairs)
    return item_similarities(ratings, shrink, at_least, heavy, busy=busy)


def history_residuals(
    history: DataFrame,
    user_bias: DataFrame,
    item_bias: DataFrame,
    mean: float,
    hot_users: DataFrame | None = None,
    hot_items: DataFrame | None = None,
) -> DataFrame:
    """``user_id, business_id, resid``: stars minus the unclamped bias estimate."""
    rows = attach(history, user_bias, "user_id", hot_users)
    rows = attach(rows, item_bias, "business_id", hot_items)
    estimate = F.lit(float(mean)) + F.coalesce("bu", F.lit(0.0)) + F.coalesce("bi", F.lit(0.0))
    return rows.select("user_id", "business_id", (F.col("stars") - estimate).alias("resid"))


def _splits(rows: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(rows / F.lit(ROWS_PER_SPLIT))).cast("int")


def _every_split(splits: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(splits) - 1)).alias("split")


def neighbour_candidates(
    targets: DataFrame, history: DataFrame, weights: DataFrame, work: Workspace
) -> DataFrame:
    """``user_id, business_id, neighbour, w, resid`` for each target and each usable neighbour.

    ``targets`` are distinct pairs, ``history`` is ``user_id, neighbour, resid``.

    A neighbour is an item the user rated that is similar to the target item.  It can be found from
    the user's history or from the target item's similarity list; each target takes the shorter of
    the two, so a user who rated almost everything costs no more than the item's list.  A user or
    item that still yields many rows is spread over several splits of its own.
    """
    asked = targets.select("business_id").distinct()
    lists = (
        weights.select(F.col("item_a").alias("business_id"), F.col("item_b").alias("neighbour"), "w")
        .unionByName(weights.select(F.col("item_b").alias("business_id"), F.col("item_a").alias("neighbour"), "w"))
        .join(asked, "business_id", "left_semi")
    )
    lists = work.table(lists, "asked-lists")

    def load(rows: DataFrame, key: str, name: str) -> DataFrame:
        """``key``, its rows on this side as ``name``, and its targets; keys without targets are left out."""
        asked = targets.groupBy(key).agg(F.count(F.lit(1)).alias("asked"))
        return work.table(key_counts(rows, key).withColumnRenamed("n", name).join(asked, key), name)

    users, items = load(history, "user_id", "history_rows"), load(lists, "business_id", "list_rows")
    asked_rows = targets.count()
    hot_users = hot_by(users, "user_id", "asked", asked_rows)
    hot_items = hot_by(items, "business_id", "asked", asked_rows)
    planned = attach(targets, users.drop("asked"), "user_id", hot_users, "inner")
    planned = attach(planned, items.drop("asked"), "business_id", hot_items, "inner")
    planned = work.table(
        planned.withColumn("by_history", F.col("history_rows") <= F.col("list_rows")), "targets"
    )
    made = planned.agg(F.coalesce(F.sum(F.least("history_rows", "list_rows")), F.lit(0))).first()[0]

    def spread(rows: DataFrame, routed: DataFrame, key: str, size: str, hot: DataFrame | None) -> DataFrame:
        """``rows`` of the keys that ``routed`` targets take, once for each split of their key."""
        splits = routed.groupBy(key).agg(
            _splits(F.first(size) * F.count(F.lit(1))).alias("splits")
        )
        return attach(rows, splits, key, hot, "inner").select("*", _every_split("splits"))

    def parted(routed: DataFrame, key: str, size: str, other: str, hot: DataFrame | None) -> DataFrame:
        """``routed`` targets, each at one split of its key."""
        splits = routed.groupBy(key).agg(_splits(F.first(size) * F.count(F.lit(1))).alias("splits"))
        part = F.pmod(F.xxhash64(other), F.col("splits")).cast("int").alias("split")
        return attach(routed, splits, key, hot, "inner").select("user_id", "business_id", part)

    by_history, by_list = planned.where("by_history"), planned.where("NOT by_history")
    if made <= ROWS_PER_SPLIT:  # no key can yield more than one split
        by_user = by_history.select("user_id", "business_id").join(history, "user_id")
        by_item = by_list.select("user_id", "business_id").join(lists, "business_id")
    else:
        long_users = hot_by(users, "user_id", "history_rows")
        long_items = hot_by(items, "business_id", "list_rows")
        by_user = parted(by_history, "user_id", "history_rows", "business_id", hot_users).join(
            spread(history, by_history, "user_id", "history_rows", long_users), ["user_id", "split"]
        )
        by_item = parted(by_list, "business_id", "list_rows", "user_id", hot_items).join(
            spread(lists, by_list, "business_id", "list_rows", long_items), ["business_id", "split"]
        )
    from_history = by_user.where(F.col("neighbour") != F.col("business_id")).select(
        "user_id", "business_id", "neighbour", "resid"
    )
    from_history = attach(
        from_history, lists, ["business_id", "neighbour"], _hot_pairs(from_history, hot_items), "inner"
    ).select("user_id", "business_id", "neighbour", "w", "resid")
    from_list = by_item.join(history, ["user_id", "neighbour"]).select(
        "user_id", "business_id", "neighbour", "w", "resid"
    )
    return from_history.unionByName(from_list)


def _hot_pairs(candidates: DataFrame, hot_items: DataFrame | None) -> DataFrame | None:
    """Pairs of a target item and a neighbour with too many candidates for one task.

    Only an item that is asked that often can be in one, so without such an item nothing is counted.
    """
    if hot_items is None:
        return None
    pair = ["business_id", "neighbour"]
    counts = candidates.join(F.broadcast(hot_items), "business_id", "left_semi").groupBy(*pair).agg(
        F.count(F.lit(1)).alias("n")
    )
    return hot_keys(counts, pair, counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])


def cf_adjustments(
    targets: DataFrame,
    residuals: DataFrame,
    sims: DataFrame,
    work: Workspace,
    threshold: float = 0.05,
    k: int = 120,
    alpha: float = 1.1,
    resid_cap: float = 2.4,
) -> DataFrame:
    """``user_id, business_id, num, den, support`` for each of the distinct ``targets`` with a neighbour.

    The ``k`` neighbours of largest weight count; equal weights are taken in item order.
    """
    history = residuals.select(
        "user_id",
        F.col("business_id").alias("neighbour"),
        winsorise("resid", resid_cap).alias("resid"),
    )
    weights = sims.where(F.abs("sim") >= F.lit(float(threshold))).select(
        "item_a", "item_b", signed_power("sim", alpha).alias("w")
    )
    candidates = neighbour_candidates(targets, history, weights, work)
    strongest = W.partitionBy("user_id", "business_id").orderBy(F.abs("w").desc(), "neighbour")
    return (
        candidates.withColumn("_place", F.row_number().over(strongest))
        .where(F.col("_place") <= k)
        .groupBy("user_id", "business_id")
        .agg(
            F.sum(F.col("w") * F.col("resid")).alias("num"),
            F.sum(F.abs("w")).alias("den"),
            F.count(F.lit(1)).alias("support"),
        )
    )


def cf_score(base: Column, gate: float) -> Column:
    """``base`` moved by the weighted mean residual where the weights sum to more than ``gate``."""
    moved = clamp(base + F.try_divide(F.col("num"), F.col("den")))
    return F.when(F.col("den") > F.lit(float(gate)), moved).otherwise(base)


def cf_predict(
    pairs: DataFrame,
    history: DataFrame,
    sims: DataFrame,
    user_bias: DataFrame,
    item_bias: DataFrame,
    mean: float,
    threshold: float = 0.05,
    k: int = 120,
    alpha: float = 1.1,
    resid_cap: float = 2.4,
    gate: float = 0.6,
    work: Workspace | None = None,
) -> DataFrame:
    """``pairs`` with columns ``cf`` and ``support``; the bias estimate where no neighbour helps."""
    work = work or Workspace(pairs.sparkSession).close_at_exit()
    pairs = work.table(pairs, "pairs")
    targets = work.table(
        pairs.select("user_id", "business_id").dropna().distinct(), "distinct-pairs"
    )
    rated = history.join(targets.select("user_id").distinct(), "user_id", "left_semi")
    rows, asked = history.count(), pairs.count()

    def hot(frame: DataFrame, key: str, size: int) -> DataFrame | None:
        return hot_by(key_counts(frame, key), key, rows=size)

    residuals = work.table(
        history_residuals(
            rated, user_bias, item_bias, mean, hot(history, "user_id", rows), hot(history, "business_id", rows)
        ),
        "residuals",
    )
    moves = cf_adjustments(targets, residuals, sims, work, threshold, k, alpha, resid_cap)
    both = ["user_id", "business_id"]
    repeated = hot_by(pairs.groupBy(*both).agg(F.count(F.lit(1)).alias("n")), both, rows=asked)
    joined = attach(pairs, moves, both, repeated)
    joined = attach(joined, user_bias, "user_id", hot(pairs, "user_id", asked))
    joined = attach(joined, item_bias, "business_id", hot(pairs, "business_id", asked))
    return joined.withColumns(
        {
            "cf": cf_score(bias_score(mean), gate),
            "support": F.coalesce("support", F.lit(0)),
        }
    ).drop("num", "den", "bu", "bi")
