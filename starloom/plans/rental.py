"""H5: rental marts over listings and reviews (B4, B6, B7, C8-C10, D20-D26,
E3, F2-F4).

Plan rules:
  * reviews are aggregated per listing *before* they meet the listings
    (partial aggregation combines a hot listing map-side, and the join is
    one row per listing on both sides, so ratings are not weighted by review
    count);
  * a home is (city, neighbourhood, name) by default; several listings may
    describe one home;
  * listing-level parameters (city, room type, review year) are applied
    before aggregation, home-level thresholds (reviews, bedrooms, capacity)
    after it;
  * means are exact and rounded half-up: ratings to 4 digits, prices to 2.
    Scores have up to four decimals, so sums are kept in integral units of 10^-4
    (overall rating in sixths of that) and divided once with ``half_up_div``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import half_up_div, scaled_decimal
from ..schemas import SCORE_COLUMNS
from ..session import materialize

HOME_KEY = ["city", "neighbourhood", "name"]
NO_REVIEW_DATE = "1900-01-01"  # listings without a review lose any "latest" contest


@dataclass(frozen=True)
class HomeFilter:
    """B6/B7 parameters; None / 0 disables a filter."""
    year: int | None = None
    room_type: str | None = None
    city: str | None = None
    min_reviews: int = 0
    min_bedrooms: int = 0
    min_capacity: int = 0


def _units(c: str) -> Column:
    """A score in units of 10^-4, the scale of the listings schema."""
    return (F.col(c).cast("decimal(9,4)") * 10000).cast("long")


def overall_units(listings: DataFrame) -> Column:
    """B4 in sixths of 10^-4: 6 * rating + sum of the six scores, all in units.
    NULL if any input is NULL."""
    score_sum = None
    for c in SCORE_COLUMNS:
        score_sum = _units(c) if score_sum is None else score_sum + _units(c)
    return F.lit(6) * _units("review_scores_rating") + score_sum


def overall_rating(listings: DataFrame) -> DataFrame:
    """listing_id, overall_rating (4 digits)."""
    return (listings.select("listing_id", overall_units(listings).alias("__u"))
            .select("listing_id", scaled_decimal(half_up_div("__u", "6"), 4, 10).alias("overall_rating")))


def reviews_per_listing(reviews: DataFrame, year: int | None = None) -> DataFrame:
    """Review count and last review date per listing (optionally one year)."""
    r = reviews if year is None else reviews.where(F.year("review_date") == year)
    return r.groupBy("listing_id").agg(F.count(F.lit(1)).alias("reviews"), F.max("review_date").alias("last_review"))


def _filtered_listings(listings: DataFrame, flt: HomeFilter) -> DataFrame:
    out = listings
    if flt.room_type is not None:
        out = out.where(F.col("room_type") == flt.room_type)
    if flt.city is not None:
        out = out.where(F.col("city") == flt.city)
    return out


def listing_reviews(listings: DataFrame, reviews: DataFrame, flt: HomeFilter = HomeFilter()) -> DataFrame:
    """Every (filtered) listing with its overall rating and review stats;
    listings without reviews keep reviews = 0 and last_review NULL."""
    ls = _filtered_listings(listings, flt)
    per = reviews_per_listing(reviews, flt.year)
    return (ls.withColumn("__u", overall_units(ls))
            .join(per, "listing_id", "left")
            .withColumn("reviews", F.coalesce(F.col("reviews"), F.lit(0).cast("long"))))


def listing_review_table(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """C8 as a table: listing attributes, overall rating, review count, last review."""
    lr = listing_reviews(listings, reviews)
    return lr.select("listing_id", *HOME_KEY, "room_type", "bedrooms", "accommodates", "price",
                     scaled_decimal(half_up_div("__u", "6"), 4, 10).alias("overall_rating"),
                     "reviews", "last_review")


def _mean4(sum_col: str, n_col: str, scale_num: str) -> Column:
    return scaled_decimal(half_up_div(f"{sum_col} * {scale_num}", n_col), 4, 10)


# The latest listing as one number: days, then listings of smaller id.  A maximum over
# a decimal is a hash aggregate, over a struct it would sort all rows; the order is
# the same, and an attribute in the digits below comes from the same listing.
MAX_ID, IDS, VALUES = (1 << 63) - 1, 1 << 64, 1 << 33
LATEST = (f"CAST(datediff(coalesce(last_review, DATE '{NO_REVIEW_DATE}'), DATE '0001-01-01') AS DECIMAL(10,0)) * {IDS} "
          f"+ ({MAX_ID} - CAST(listing_id AS DECIMAL(20,0)))")
LATEST_ATTRIBUTES = ["bedrooms", "accommodates"]


def _beside_latest(attribute: str) -> Column:
    """The number of the latest listing with its attribute (an int, or NULL as 0) in the low digits."""
    return F.expr(f"CAST(({LATEST}) * {VALUES} + coalesce(CAST({attribute} AS BIGINT) + {(1 << 31) + 1}, 0) AS DECIMAL(38,0))")


def _unpacked(packed: str) -> Column:
    return F.expr(f"CAST(nullif(CAST({packed} % {VALUES} AS BIGINT), 0) - {(1 << 31) + 1} AS INT)")


def home_scorecard(listings: DataFrame, reviews: DataFrame, flt: HomeFilter = HomeFilter(),
                   home_key: Sequence[str] = HOME_KEY) -> DataFrame:
    """D26 (also the base of D21, D22, B6, B7, F2-F4): one row per home.

    home_rating: mean overall rating over the home's listings; rating and the
    six sub-scores: plain means; bedrooms / accommodates: from the listing with
    the latest review (ties: smallest listing_id)."""
    lr = listing_reviews(listings, reviews, flt)
    aggs = [F.count(F.lit(1)).alias("listings"),
            F.sum("reviews").cast("long").alias("reviews"),
            F.max("last_review").alias("last_review"),
            F.max(F.expr(LATEST)).alias("__latest"),
            *[F.max(_beside_latest(c)).alias(f"__{c}") for c in LATEST_ATTRIBUTES],
            F.sum("__u").alias("__u_sum"), F.count("__u").alias("__u_n"),
            F.sum(_units("review_scores_rating")).alias("__r_sum"), F.count("review_scores_rating").alias("__r_n"),
            F.sum((F.col("price") * 100).cast("long")).alias("__p_sum"), F.count("price").alias("__p_n")]
    for i, c in enumerate(SCORE_COLUMNS):
        aggs += [F.sum(_units(c)).alias(f"__s{i}_sum"), F.count(c).alias(f"__s{i}_n")]
    h = lr.groupBy(*home_key).agg(*aggs)
    cols = [*home_key, "listings", "reviews", "last_review",
            F.expr(f"CAST({MAX_ID} - __latest % {IDS} AS BIGINT)").alias("latest_listing_id"),
            *[_unpacked(f"__{c}").alias(c) for c in LATEST_ATTRIBUTES],
            scaled_decimal(half_up_div("__u_sum", "__u_n * 6"), 4, 10).alias("home_rating"),
            _mean4("__r_sum", "__r_n", "1").alias("review_scores_rating"),
            scaled_decimal(half_up_div("__p_sum", "__p_n"), 2, 12).alias("avg_price")]
    cols += [_mean4(f"__s{i}_sum", f"__s{i}_n", "1").alias(c) for i, c in enumerate(SCORE_COLUMNS)]
    return h.select(*cols)


def home_rating(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Mean overall rating and number of listings per home."""
    return home_scorecard(listings, reviews).select(*HOME_KEY, "home_rating", "listings")


def home_latest_attributes(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Bedrooms and capacity from the listing with the latest review."""
    return home_scorecard(listings, reviews).select(*HOME_KEY, "latest_listing_id", "bedrooms", "accommodates",
                                                    "last_review")


def stored_scorecard(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """The scorecard of all listings and reviews, written in the order of the home
    key: a filter on the city or its homes skips files by their value ranges, and
    a city with most homes lies in many files."""
    card = home_scorecard(listings, reviews)
    return materialize(card.repartitionByRange(*HOME_KEY).sortWithinPartitions(*HOME_KEY), "scorecard")


def filter_homes(listings: DataFrame, reviews: DataFrame, flt: HomeFilter, card: DataFrame | None = None) -> DataFrame:
    """Homes passing the listing-level and home-level parameters.

    The city is part of a home's key, so only a year or a room type changes what
    a home's row aggregates.  Without them the rows are those of the stored
    scorecard (``card``): its scan gets all thresholds, and no review is read."""
    if card is None or flt.year is not None or flt.room_type is not None:
        return passing_homes(home_scorecard(listings, reviews, flt), flt)
    return passing_homes(card if flt.city is None else card.where(F.col("city") == flt.city), flt)


def passing_homes(scorecard: DataFrame, flt: HomeFilter) -> DataFrame:
    """The home-level parameters of B6/B7 over a scorecard."""
    return (scorecard.where((F.col("reviews") >= flt.min_reviews) & (F.col("bedrooms") >= flt.min_bedrooms)
                    & (F.col("accommodates") >= flt.min_capacity))
            .select(*HOME_KEY, "home_rating", "reviews", "bedrooms", "accommodates", "listings", "avg_price"))


def _area_rating(listings: DataFrame, area: Sequence[str]) -> DataFrame:
    """Mean per home first (4 / 2 digits), then mean of the home means per area."""
    per_home = (listings.groupBy(*HOME_KEY)
                .agg(F.sum(_units("review_scores_rating")).alias("__r_sum"),
                     F.count("review_scores_rating").alias("__r_n"),
                     F.sum((F.col("price") * 100).cast("long")).alias("__p_sum"), F.count("price").alias("__p_n"),
                     F.count(F.lit(1)).alias("__listings"))
                .select(*HOME_KEY, "__listings",
                        half_up_div("__r_sum", "__r_n").alias("__rq"),
                        half_up_div("__p_sum", "__p_n").alias("__pq")))
    agg = (per_home.groupBy(*area)
           .agg(F.count(F.lit(1)).alias("homes"), F.sum("__listings").cast("long").alias("listings"),
                F.sum("__rq").alias("__rs"), F.count("__rq").alias("__rn"),
                F.sum("__pq").alias("__ps"), F.count("__pq").alias("__pn")))
    return agg.select(*area, "homes", "listings",
                      scaled_decimal(half_up_div("__rs", "__rn"), 4, 10).alias("avg_rating"),
                      scaled_decimal(half_up_div("__ps", "__pn"), 2, 12).alias("avg_price"))


def city_rating(listings: DataFrame) -> DataFrame:
    """Per city: homes, listings, mean home rating, mean home price."""
    return _area_rating(listings, ["city"])


def district_rating(listings: DataFrame) -> DataFrame:
    """The same per (city, neighbourhood)."""
    return _area_rating(listings, ["city", "neighbourhood"])


def home_reviews_by_year(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviews per home and year; reviews are counted per (listing, year)
    before the join, so the join carries one row per listing-year."""
    per = (reviews.groupBy("listing_id", F.year("review_date").cast("long").alias("year"))
           .agg(F.count(F.lit(1)).alias("__n")))
    return (per.join(listings.select("listing_id", *HOME_KEY), "listing_id")
            .groupBy(*HOME_KEY, "year").agg(F.sum("__n").cast("long").alias("reviews")))


def reviews_trend(reviews: DataFrame) -> DataFrame:
    """Reviews per year and the change against the year before.  The
    window runs over the yearly aggregate (one row per calendar year)."""
    yearly = reviews.groupBy(F.year("review_date").cast("long").alias("year")).agg(
        F.count(F.lit(1)).alias("reviews"))
    prev = F.lag("reviews").over(Window.orderBy("year"))
    return yearly.select("year", "reviews", prev.alias("prev_reviews"), (F.col("reviews") - prev).alias("change"))


def _rank_order() -> list[Column]:
    return [F.col("home_rating").desc_nulls_last(), *[F.col(c).asc() for c in HOME_KEY]]


def top_homes(homes: DataFrame, n: int) -> DataFrame:
    """top n homes by rating (TakeOrderedAndProject: per-partition top n,
    then a merge of n rows per partition; no full sort)."""
    return homes.orderBy(*_rank_order()).limit(n)


def top_homes_per_city(homes: DataFrame, n: int) -> DataFrame:
    """top n homes inside every city (planned with WindowGroupLimit, which
    keeps n rows per city before the window's sort)."""
    w = Window.partitionBy("city").orderBy(*_rank_order())
    return homes.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n)


def best_city(cities: DataFrame) -> DataFrame:
    """the city with the best mean rating (ties: city name)."""
    return cities.orderBy(F.col("avg_rating").desc_nulls_last(), F.col("city").asc()).limit(1)


def best_vs_selected_city(cities: DataFrame, selected: str) -> DataFrame:
    """The best city beside the selected one, as two labelled rows."""
    best = best_city(cities).withColumn("role", F.lit("best"))
    sel = cities.where(F.col("city") == selected).withColumn("role", F.lit("selected"))
    return best.unionByName(sel).select("role", "city", "homes", "listings", "avg_rating", "avg_price")


def best_vs_selected_home(homes: DataFrame, all_homes: DataFrame, selected: Sequence[str] | None = None) -> DataFrame:
    """The best home (of ``homes``) beside the selected one (of
    ``all_homes``; default: the first home by key)."""
    cols = [*HOME_KEY, "home_rating", "reviews", "bedrooms", "accommodates", "listings"]
    best = top_homes(homes, 1).select(F.lit("best").alias("role"), *cols)
    if selected is None:
        sel = all_homes.orderBy(*[F.col(c).asc_nulls_last() for c in HOME_KEY]).limit(1)
    else:
        cond = F.lit(True)
        for c, v in zip(HOME_KEY, selected):
            cond = cond & (F.col(c) == v)
        sel = all_homes.where(cond)
    return best.unionByName(sel.select(F.lit("selected").alias("role"), *cols))
