"""Batch recommendations: the best matching properties of every buyer.

The score of a pair is a property part plus a buyer part, as a linear model
gives it, so every buyer of a market ranks its properties alike and only the
budget differs. That allows an exact answer without pairing buyers and
properties. Whole prices are cells; a dyadic interval of level ``l`` spans
``2 ** l`` cells. All cells below a budget are the union of one interval for
each set bit of the budget, so the best ``k`` of every (market, interval), kept
by partial aggregation, answer every budget by one equi-join and one top ``k``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from homematch.functions.text import flag_label, preference_code
from homematch.lookups import LOCATION_CLASSES, PROPERTY_CLASSES, SHIRES, type_column
from homematch.operators.encode import scale
from homematch.operators.ranking import top_per_group
from homematch.session import saved
from homematch.schemas import COUNTY_FLAGS, LOCATION_FLAGS, TYPE_FLAGS, USER_FEATURES

ANY = "*"
MARKET = ["county", "location", "kind", "garden", "parking"]
#: Cells above this are one cell.
HIGHEST_CELL = (1 << 40) - 1
OWN_CELL = -1
INTERVAL = ["level", "place"]


def market_columns(columns: Sequence[str]) -> dict[str, Column]:
    """Market of a property, read from its flags; ``-`` where no flag is set."""
    def label(flags: Sequence[str], prefix: str) -> Column:
        held = {f: f.removeprefix(prefix) for f in flags if f in columns}
        return F.coalesce(flag_label(held), F.lit("-")) if held else F.lit("-")

    return {
        "county": label(COUNTY_FLAGS, "county_"),
        "location": label(LOCATION_FLAGS, "location_"),
        "kind": label(TYPE_FLAGS, "property_type_"),
        "garden": F.coalesce(F.col("has_garden").cast("int"), F.lit(0)),
        "parking": F.coalesce(F.col("has_parking").cast("int"), F.lit(0)),
    }


def profile_markets(profiles: DataFrame) -> DataFrame:
    """Profiles with the market they ask for and their ``budget``.

    A preference that names nothing known asks for any value. Must-haves other
    than garden and parking are ignored.
    """
    kinds = [type_column(c).removeprefix("property_type_") for c in PROPERTY_CLASSES]
    kind = F.translate(F.col("desired_property_type"), "-/", "__")
    wants = F.transform(F.coalesce("must_have_features", F.array().cast("array<string>")), F.lower)

    def known(value: Column, names: Sequence[str]) -> Column:
        return F.when(value.isin(list(names)), value).otherwise(ANY)

    return profiles.withColumns({
        "county": known(F.lower("preferred_county"), SHIRES),
        "location": known(F.col("preferred_location"), LOCATION_CLASSES),
        "kind": known(kind, kinds),
        "garden": F.array_contains(wants, "garden").cast("int"),
        "parking": F.array_contains(wants, "parking").cast("int"),
        "budget": (F.col("income") * 4 + F.col("savings")).cast("double"),
    })


def in_markets(properties: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Priced properties with some of their columns and the market they lie in."""
    priced = properties.where(F.col("price").isNotNull())
    if "kind" in properties.columns:
        return priced.select(*keep, *MARKET)
    return priced.select(*keep, *[c.alias(name) for name, c in market_columns(properties.columns).items()])


def under_asked(offers: DataFrame, markets: DataFrame) -> DataFrame:
    """Offers under each asked market that finds them.

    The markets are combinations of closed value lists, at most a few hundred
    rows however many profiles there are, so they can be broadcast.
    """
    for name in ("county", "location", "kind"):
        offers = offers.withColumn(name, F.explode(F.array(F.col(name), F.lit(ANY))))
    for name in ("garden", "parking"):
        offers = offers.withColumn(name, F.explode(F.sequence(F.lit(0), F.col(name))))
    return offers.join(F.broadcast(markets), MARKET, "left_semi")


def cell(amount: Column) -> Column:
    """Whole part of an amount between 0 and the highest cell; grows with the amount."""
    return F.greatest(F.least(F.floor(amount), F.lit(HIGHEST_CELL)), F.lit(0)).cast("bigint")


def in_intervals(offers: DataFrame, budgets: DataFrame) -> DataFrame:
    """Offers under each dyadic interval that a budget can ask for: up to the highest budget, left halves only.

    A set bit of a budget asks for the interval before the one that holds the
    budget on that level, whose place is even.
    """
    highest = budgets.agg(F.coalesce(F.max(cell(F.col("budget"))), F.lit(0)).alias("highest")).scalar()
    levels = F.sequence(F.lit(0), F.floor(F.log2(F.greatest(F.col("_highest"), F.lit(1)))).cast("int"))
    known = offers.withColumn("_highest", highest).withColumn("_cell", cell(F.col("price")))
    spans = known.withColumn("level", F.explode(levels)).withColumn("place", _shifted(F.col("_cell"), F.col("level")))
    return spans.where(F.col("place") % 2 == 0).select(*offers.columns, *INTERVAL)


def _shifted(value: Column, level: Column) -> Column:
    return F.call_function("shiftright", value, level)


def in_own_cell(offers: DataFrame) -> DataFrame:
    """Offers under the cell of their price, where a budget has to look at each price."""
    return offers.withColumns({"level": F.lit(OWN_CELL), "place": cell(F.col("price"))})


def covering(budgets: DataFrame) -> DataFrame:
    """Budgets with the intervals that cover all cells below theirs, and their own cell."""
    spans = budgets.withColumn("_at", cell(F.col("budget"))).withColumn("level", F.explode(F.sequence(F.lit(OWN_CELL), F.lit(39))))
    own = F.col("level") == OWN_CELL
    spans = spans.withColumn("place", F.when(own, F.col("_at")).otherwise(_shifted(F.col("_at"), F.col("level")) - 1))
    return spans.where(own | (F.col("place") % 2 == 0)).select(*budgets.columns, *INTERVAL)


def affordable(offers: DataFrame, budgets: DataFrame) -> DataFrame:
    """Offers of intervals and own cells with each budget that covers them; an offer meets a budget at most once.

    A budget becomes up to forty rows after the shuffle by which its size is
    judged, so both sides are merged and neither is ever sent to the driver.
    """
    return covering(budgets).hint("merge").join(offers, [*MARKET, *INTERVAL]).where(F.col("price").isNull() | (F.col("price") <= F.col("budget")))


def eligible_counts(profiles: DataFrame, properties: DataFrame) -> DataFrame:
    """Number of properties that pass the hard preferences of each profile; none without a budget.

    Offers are counted per market and price before they are copied under the
    asked markets, and again per dyadic interval; a budget sums up its covering
    intervals and the prices of its own cell. What the profiles ask for is
    written once.
    """
    asked = saved(profile_markets(profiles).select("id", *MARKET, "budget"), "asked")
    own = in_markets(properties, ["price"]).groupBy(*MARKET, F.col("price").cast("double").alias("price")).agg(F.count(F.lit(1)).alias("n"))
    counted = under_asked(own, asked.select(*MARKET).distinct()).groupBy(*MARKET, "price").agg(F.sum("n").alias("n"))
    budgets = asked.where(F.col("budget").isNotNull()).select(*MARKET, "budget").distinct()
    spans = in_intervals(counted, budgets).groupBy(*MARKET, *INTERVAL).agg(F.sum("n").alias("n"))
    met = affordable(in_own_cell(counted).unionByName(spans, allowMissingColumns=True), budgets)
    at_budget = met.groupBy(*MARKET, "budget").agg(F.sum("n").alias("eligible"))
    return asked.join(at_budget, [*MARKET, "budget"], "left").select("id", F.coalesce("eligible", F.lit(0).cast("bigint")).alias("eligible"))


def best_by_budget(asked: DataFrame, properties: DataFrame, k: int = 5) -> DataFrame:
    """Best ``k`` affordable properties of each distinct market and budget, by ``position``.

    ``properties`` carries a ``property_score``. Only the best ``k`` of equal
    prices, and of an interval, can ever appear, so each step keeps ``k`` rows
    of a group before its shuffle. ``worth`` is the negated score, so that
    smaller is better.
    """
    offers = in_markets(properties.where(F.col("property_score").isNotNull()), ["id", "price", "property_score"]).select(
        *MARKET, F.col("price").cast("double").alias("price"),
        (-F.col("property_score")).cast("double").alias("worth"), F.col("id").cast("bigint").alias("id"),
    )
    order = [F.col("worth"), F.col("id")]
    own = top_per_group(offers, [*MARKET, "price"], order, k, "_n").drop("_n")
    offers = under_asked(own, asked.select(*MARKET).distinct())
    offers = top_per_group(offers, [*MARKET, "price"], order, k, "_n").drop("_n")
    budgets = asked.where(F.col("budget").isNotNull()).select(*MARKET, "budget").distinct()
    spans = top_per_group(in_intervals(offers, budgets), [*MARKET, *INTERVAL], order, k, "_n").drop("_n")
    met = affordable(in_own_cell(offers).unionByName(spans), budgets)
    return top_per_group(met, [*MARKET, "budget"], order, k).select(*MARKET, "budget", "position", "worth", "id", "price")


def recommend(profiles: DataFrame, properties: DataFrame, k: int = 5, threshold: float = 0.5) -> DataFrame:
    """At most ``k`` properties per profile with a probability above the threshold.

    ``profiles`` carries a ``profile_score``; the probability is the logistic
    function of both scores. Ties are broken by property id. The few columns
    needed of either side are written once, because each is read several times.
    """
    asked = saved(profile_markets(profiles).select("id", "profile_score", *MARKET, "budget"), "asked")
    markets = [c.alias(name) for name, c in market_columns(properties.columns).items()]
    best = best_by_budget(asked, saved(properties.select("id", "price", "property_score", *markets), "scored"), k)
    lists = asked.select(F.col("id").alias("user_id"), "profile_score", *MARKET, "budget")
    rows = lists.join(best.withColumnRenamed("id", "property_id"), [*MARKET, "budget"])
    score = F.col("profile_score") - F.col("worth")
    return rows.select(
        "user_id", "position", "property_id", "price", (1 / (1 + F.exp(-score))).alias("probability"),
    ).where(F.col("probability") > threshold)


#: What a buyer sees of a property.
SHOWN = ["price", "size_sq_ft", *LOCATION_FLAGS, "has_garden", "has_parking", *TYPE_FLAGS, "county", "property_url"]


def shown(properties: DataFrame, key: str = "id") -> DataFrame:
    """Properties under their key with the columns shown to a buyer, as far as there are such."""
    return properties.select(key, *[c for c in SHOWN if c in properties.columns])


def displayed(recommendations: DataFrame, properties: DataFrame) -> DataFrame:
    """Recommendations with the columns shown to a buyer."""
    kept = shown(properties).withColumnRenamed("id", "property_id")
    return recommendations.join(kept.drop(*[c for c in recommendations.columns if c != "property_id"]), "property_id")


def prepared_profiles(profiles: DataFrame, scaler: DataFrame) -> DataFrame:
    """Buyer inputs of the model, coded and scaled with the stored scaler."""
    label = F.upper(F.replace(F.col("tenure_preference"), F.lit("_"), F.lit(" ")))
    coded = profiles.withColumn("tenure_preference", preference_code(label))
    return scale(coded, scaler, USER_FEATURES, suffix="_scaled")


def linear_part(weights: dict[str, float], intercept: float = 0.0) -> Column:
    """Weighted sum of columns."""
    return reduce(lambda total, item: total + F.col(item[0]) * F.lit(float(item[1])), weights.items(), F.lit(float(intercept)))
