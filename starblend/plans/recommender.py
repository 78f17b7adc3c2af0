"""The hybrid pipeline: fit four predictors, score pairs, blend, evaluate, write."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starblend import sources
from starblend.operators import (
    biases,
    blend,
    boosted,
    evaluate,
    features,
    ids,
    latent,
    neighbours,
    profile,
    skew,
)
from starblend.operators.blend import Weights
from starblend.plans.presets import PRESETS, STABLE, Preset
from starblend.workspace import Workspace, side_by_side

MODELS = ["bias", "cf", "latent", "boosted"]


@dataclass
class Sides:
    """The optional side tables; an absent one leaves its features at their defaults."""

    users: DataFrame | None = None
    businesses: DataFrame | None = None
    checkins: DataFrame | None = None
    tips: DataFrame | None = None
    photos: DataFrame | None = None

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> Sides:
        """The JSON-lines files that exist in ``folder``."""
        folder = folder.rstrip("/")

        def read(reader, name):
            return sources.optional_source(reader, spark, f"{folder}/{name}.json")

        return cls(
            users=read(sources.read_users, "user"),
            businesses=read(sources.read_businesses, "business"),
            checkins=read(sources.read_checkins, "checkin"),
            tips=read(sources.read_tips, "tip"),
            photos=read(sources.read_photos, "photo"),
        )


@dataclass
class HybridModel:
    """What ``HybridRecommender.fit`` learned; every large part is a written table."""

    preset: Preset
    work: Workspace
    mean: float
    users: DataFrame  # user_id, u, bu, p, features
    items: DataFrame  # business_id, i, bi, q, features
    residuals: DataFrame  # user_id = u, business_id = i, resid
    sims: DataFrame
    item_factors: DataFrame  # i, q
    rows: int  # deduplicated training ratings
    hot_users: DataFrame | None  # hot values of u in the training ratings, as user_id
    hot_items: DataFrame | None  # hot values of i in the training ratings
    trees: GBTRegressionModel
    by_user: DataFrame
    by_item: DataFrame
    ratings: DataFrame  # the training lines, as stored
    weights: Weights | None = field(default=None)

    def score(self, pairs: DataFrame) -> DataFrame:
        """``row_id, user_id, business_id, truth`` and one column per model, one row per input row."""
        work, preset = self.work, self.preset
        if "truth" not in pairs.columns:
            pairs = pairs.withColumn("truth", F.lit(None).cast("double"))
        pairs = work.table(pairs.select("row_id", "user_id", "business_id", "truth"), "pair-lines")
        total = pairs.count()
        asked_users = work.table(profile.user_counts(pairs), "asked-users")
        asked_items = work.table(profile.item_counts(pairs), "asked-items")
        hot_users = skew.hot_keys(asked_users, "user_id", total)
        hot_items = skew.hot_keys(asked_items, "business_id", total)

        users = self.users.join(asked_users.select("user_id"), "user_id", "left_semi")
        wanted = users.where(F.col("u").isNotNull()).select(F.col("u").alias("user_id"))
        history = work.table(
            skew.attach(self.residuals, wanted, "user_id", self.hot_users, "left_semi"),
            "asked-history",
            self.rows,
        )
        if preset.implicit_alpha:
            implicit = latent.implicit_user_vectors(
                history.select(F.col("user_id").alias("u"), F.col("business_id").alias("i")),
                self.item_factors, preset.rank, preset.implicit_alpha,
                user="u", item="i", hot_items=self.hot_items, rows=self.rows,
            )
            vectors = latent.user_vectors(
                users.where(F.col("p").isNotNull()).select("u", "p"), implicit, "u"
            )
            users = users.drop("p").join(vectors, "u", "left")
        users = work.table(users, "asked-user-table")

        wide = skew.attach(sources.line_numbers(pairs), users, "user_id", hot_users)
        wide = skew.attach(wide, self.items, "business_id", hot_items)
        wide = wide.withColumns(
            {
                "bias": biases.bias_score(self.mean),
                "latent": latent.latent_score(self.mean),
            }
        ).drop("bu", "bi", "p", "q")
        rows = features.assemble_features(features.fill_defaults(wide))
        rows = boosted.boosted_predict(rows, self.trees)
        rows = work.table(
            rows.select("row_id", "user_id", "business_id", "truth", "u", "i",
                        "bias", "latent", "boosted"),
            "scored-but-cf",
        )

        targets = work.table(
            rows.where(F.col("u").isNotNull() & F.col("i").isNotNull())
            .groupBy("u", "i")
            .agg(F.count(F.lit(1)).alias("n")),
            "distinct-pairs",
        )
        moves = neighbours.cf_adjustments(
            targets.select(F.col("u").alias("user_id"), F.col("i").alias("business_id")),
            history,
            self.sims,
            work,
            preset.threshold,
            preset.neighbours,
            preset.alpha,
            preset.resid_cap,
        ).select(F.col("user_id").alias("u"), F.col("business_id").alias("i"), "num", "den")
        hot_pairs = skew.hot_keys(targets, ["u", "i"], total)
        if hot_pairs is not None:
            moves = work.table(moves, "moves")
        known = rows.where(F.col("u").isNotNull() & F.col("i").isNotNull())
        cold = rows.where(F.col("u").isNull() | F.col("i").isNull())
        known = skew.attach(known, moves, ["u", "i"], hot_pairs).withColumn(
            "cf", neighbours.cf_score(F.col("bias"), preset.gate)
        )
        scored = known.drop("num", "den").unionByName(cold.withColumn("cf", F.col("bias")))
        return work.table(
            scored.select("row_id", "user_id", "business_id", "truth", *MODELS), "scored"
        )

    def fit_blend(self, scored: DataFrame) -> Weights:
        """Weights from all labelled rows, or the first ``blend_rows``; the preset's fixed ones if there are none."""
        preset = self.preset
        labelled = scored.where(F.col("truth").isNotNull())
        if preset.blend_rows is not None:
            labelled = blend.first_rows(labelled, preset.blend_rows)
        moments = blend.blend_moments(labelled, preset.inputs).first()
        if moments["n"] == 0:
            return preset.default_weights
        return blend.fit_blend(moments, preset.inputs, preset.blend_lam, preset.bounds)

    def transform(self, pairs: DataFrame) -> DataFrame:
        """``score`` plus the blended ``prediction``; keeps the weights used."""
        scored = self.score(pairs)
        self.weights = self.fit_blend(scored)
        return blend.blend_predict(scored, self.weights)

    def evaluate(self, predicted: DataFrame) -> dict[str, DataFrame]:
        """Reports on labelled rows.

        ``ablation`` scores every model and the blend.  The blend was fitted on rows it is scored on
        there, so ``holdout`` fits it on one half of the pairs and scores it on the other.  ``weights`` are
        those of the blend, and ``profile`` describes the training ratings and the pairs.
        """
        half = F.pmod(F.xxhash64("user_id", "business_id"), F.lit(2)) == 0
        weights = self.fit_blend(predicted.where(half))
        held = blend.blend_predict(predicted.where(~half), weights, "prediction")
        return {
            "ablation": evaluate.ablation(predicted, [*MODELS, "prediction"]),
            "holdout": evaluate.rmse(held, "prediction"),
            "errors": evaluate.error_histogram(predicted, "prediction"),
            "weights": self.weight_rows(predicted.sparkSession),
            "profile": self.profile(predicted),
        }

    def weight_rows(self, spark: SparkSession) -> DataFrame:
        """``name, weight`` of the blend in use, the constant last."""
        weights = self.weights or self.preset.default_weights
        rows = [*((m, float(w)) for m, w in weights.of.items()), ("constant", float(weights.constant))]
        return spark.createDataFrame(rows, "name string, weight double")

    def profile(self, pairs: DataFrame) -> DataFrame:
        """The figures of the training ratings and of ``pairs`` as ``metric, value``."""
        return profile.ratings_profile(
            self.ratings, pairs, self.by_user.select("user_id", "n"), self.by_item.select("business_id", "n")
        )


class HybridRecommender:
    """``HybridRecommender("stable", trees=50).fit(ratings, sides).transform(pairs)``."""

    def __init__(self, preset: str | Preset = STABLE, **changes):
        chosen = PRESETS[preset] if isinstance(preset, str) else preset
        self.preset = replace(chosen, **changes)

    def fit(self, ratings: DataFrame, sides: Sides | None = None) -> HybridModel:
        spark, preset, sides = ratings.sparkSession, self.preset, sides or Sides()
        work = Workspace(spark)
        raw = work.table(
            ratings.select("user_id", "business_id", "stars", "row_id"), "rating-lines"
        )
        total = raw.count()
        mean = profile.global_mean(raw).first()["global_mean"]

        by_user = work.table(
            ids.dense_ids(profile.user_counts(raw), "user_id", "u", work), "user-ids"
        )
        by_item = work.table(
            ids.dense_ids(profile.item_counts(raw), "business_id", "i", work), "item-ids"
        )
        hot_users = skew.hot_keys(by_user, "user_id", total)
        hot_items = skew.hot_keys(by_item, "business_id", total)
        coded = skew.attach(
            sources.line_numbers(raw), by_user.select("user_id", "u"), "user_id", hot_users, "inner"
        )
        coded = skew.attach(
            coded, by_item.withColumnRenamed("n", "item_rows"), "business_id", hot_items, "inner"
        )
        coded = work.table(
            coded.select(F.col("u").alias("user_id"), F.col("i").alias("business_id"),
                         "stars", "item_rows", "row_id"),
            "coded",
            total,
        )
        hot_u = skew.hot_keys(by_user.select(F.col("u").alias("user_id"), "n"), "user_id", total)
        hot_i = skew.hot_keys(
            by_item.select(F.col("i").alias("business_id"), "n"), "business_id", total
        )

        def predictors():
            """Biases, residuals and factors."""
            history = work.table(profile.dedupe_ratings(coded), "history", total)
            rows = history.count()
            user_bias, item_bias = biases.fit_biases(
                history, mean, preset.bias_lam, preset.bias_rounds, work, hot_u, hot_i, rows
            )
            residuals = work.table(
                neighbours.history_residuals(history, user_bias, item_bias, mean, hot_u, hot_i),
                "residuals",
                total,
            )
            factors = latent.fit_latent(
                residuals.select(
                    F.col("user_id").alias("u"), F.col("business_id").alias("i"), "resid"
                ),
                preset.rank, preset.latent_rounds, preset.latent_reg, rows, preset.seed, work,
            )
            user_factors = work.table(factors[0], "user-factors")
            item_factors = work.table(factors[1], "item-factors")
            return rows, residuals, user_bias, item_bias, user_factors, item_factors

        def similarities():
            rows = coded.select("user_id", "business_id", "stars", "item_rows")
            if preset.items_per_user is not None:
                rows = neighbours.cap_user_items(rows, preset.items_per_user, "stars")
            rows = rows.where(F.col("item_rows") >= neighbours.MIN_SUPPORT)
            return work.table(
                neighbours.similarities_of(rows, work, preset.shrink, preset.threshold), "similarities"
            )

        def feature_trees():
            """Side tables, and the trees fitted on the features of every rating row."""
            users, items = self._side_tables(sides, by_user, by_item, work)
            by_u = users.where(F.col("u").isNotNull()).drop("user_id")
            by_i = items.where(F.col("i").isNotNull()).drop("business_id")
            rows = coded.select(
                F.col("user_id").alias("u"), F.col("business_id").alias("i"), "stars"
            )
            rows = skew.attach(rows, by_u, "u", renamed(hot_u, "user_id", "u"))
            rows = skew.attach(rows, by_i, "i", renamed(hot_i, "business_id", "i"))
            rows = work.table(
                features.fill_defaults(rows.drop("u", "i")), "train-features", total
            )
            trees = boosted.fit_boosted(
                features.assemble_features(rows), preset.trees, preset.depth, preset.rate,
                preset.row_share, preset.column_share, preset.min_rows, preset.seed,
            )
            return users, items, trees

        def renamed(keys, old, new):
            return None if keys is None else keys.withColumnRenamed(old, new)

        learned, sims, (users, items, trees) = side_by_side(
            spark, predictors, similarities, feature_trees
        )
        rows, residuals, user_bias, item_bias, user_factors, item_factors = learned
        user_state = users.join(
            user_bias.withColumnRenamed("user_id", "u"), "u", "left"
        ).join(user_factors, "u", "left")
        item_state = items.join(
            item_bias.withColumnRenamed("business_id", "i"), "i", "left"
        ).join(item_factors, "i", "left")
        return HybridModel(
            preset=preset,
            work=work,
            mean=mean,
            users=work.table(user_state, "user-state"),
            items=work.table(item_state, "item-state"),
            residuals=residuals,
            sims=sims,
            item_factors=item_factors,
            rows=rows,
            hot_users=hot_u,
            hot_items=renamed(hot_i, "business_id", "i"),
            trees=trees,
            by_user=by_user,
            by_item=by_item,
            ratings=raw,
        )

    def _side_tables(
        self, sides: Sides, by_user: DataFrame, by_item: DataFrame, work: Workspace
    ) -> tuple[DataFrame, DataFrame]:
        """One row per known user and business: original id, int id where trained, features."""
        preset = self.preset
        user_part = None if sides.users is None else features.user_features(sides.users, work)
        item_part = (
            None if sides.businesses is None
            else features.business_features(
                sides.businesses, work, preset.category_terms, preset.city_terms, preset.state_terms
            )
        )
        users = features.user_table(user_part, by_user)
        items = features.business_table(
            item_part, sides.checkins, sides.tips, sides.photos, by_item
        )
        users = users.join(by_user.select("user_id", "u"), "user_id", "left")
        items = items.join(by_item.select("business_id", "i"), "business_id", "left")
        return work.table(users, "user-table"), work.table(items, "item-table")


def run_job(
    spark: SparkSession,
    ratings_path: str,
    pairs_path: str,
    output: str,
    sides_folder: str | None = None,
    preset: str | Preset = STABLE,
    **changes: Mapping,
) -> tuple[HybridModel, DataFrame]:
    """Read the files, fit, predict and write the predictions; returns the model and the scores."""
    sides = Sides() if sides_folder is None else Sides.read(spark, sides_folder)
    model = HybridRecommender(preset, **changes).fit(
        sources.read_ratings(spark, ratings_path), sides
    )
    predicted = model.transform(sources.read_pairs(spark, pairs_path))
    sources.write_predictions(predicted, output)
    return model, predicted
