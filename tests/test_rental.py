import datetime as dt
from decimal import Decimal as D

from starloom import schemas
from starloom.plans import rental
from starloom.plans.rental import HomeFilter


def listing(lid, name="Flat", city="Paris", hood="Centre", room="Entire place", bedrooms=1, acc=2, price="100.00",
            rating="90.0", scores=("9.0", "9.0", "9.0", "9.0", "9.0", "9.0")):
    return (lid, name, city, hood, room, bedrooms, acc, D(price), D(rating),
            *[None if s is None else D(s) for s in scores])


def frames(spark, ls, rs):
    return (spark.createDataFrame(ls, schemas.LISTINGS_SCHEMA),
            spark.createDataFrame(rs, schemas.REVIEWS_SCHEMA))


def test_overall_rating_formula_and_null_score(spark):
    ls, _ = frames(spark, [listing(1, scores=("9.0", "10.0", "8.0", "9.0", "10.0", "9.0")),
                           listing(2, scores=(None, "9.0", "9.0", "9.0", "9.0", "9.0"))], [])
    got = {r.listing_id: r.overall_rating for r in rental.overall_rating(ls).collect()}
    assert got == {1: D("99.1667"), 2: None}


def test_home_rating_is_mean_over_listings_ignoring_nulls(spark):
    ls, rs = frames(spark, [listing(1, rating="90.0"), listing(2, rating="80.0"),
                            listing(3, scores=(None,) + ("9.0",) * 5)], [])
    r = rental.home_scorecard(ls, rs).collect()[0]
    assert (r.listings, r.home_rating, r.review_scores_rating) == (3, D("94.0000"), D("86.6667"))


def test_latest_listing_wins_ties_by_smallest_id_unreviewed_loses(spark):
    ls, rs = frames(spark, [listing(5, bedrooms=1), listing(3, bedrooms=2), listing(4, bedrooms=3),
                            listing(9, bedrooms=4)],
                    [(5, dt.date(2020, 1, 1), 1), (3, dt.date(2021, 5, 1), 1), (4, dt.date(2021, 5, 1), 2)])
    r = rental.home_scorecard(ls, rs).collect()[0]
    assert (r.latest_listing_id, r.bedrooms, r.reviews, r.last_review) == (3, 2, 3, dt.date(2021, 5, 1))


def test_filters_listing_level_before_home_level_after(spark):
    ls, rs = frames(spark, [listing(1, name="A", room="Private room", bedrooms=2, acc=3),
                            listing(2, name="A", room="Shared room", bedrooms=1, acc=1),
                            listing(3, name="B", room="Private room", bedrooms=3, acc=4)],
                    [(1, dt.date(1998, 3, 1), 1), (1, dt.date(1998, 4, 1), 2), (2, dt.date(1998, 5, 1), 3),
                     (3, dt.date(1997, 1, 1), 4), (3, dt.date(1998, 1, 1), 5)])
    flt = HomeFilter(year=1998, room_type="Private room", min_reviews=2, min_bedrooms=2, min_capacity=3)
    got = [(r.name, r.reviews) for r in rental.filter_homes(ls, rs, flt).collect()]
    assert got == [("A", 2)]


def test_top_homes_per_city_null_rating_last(spark):
    ls, rs = frames(spark, [listing(i, name=f"H{i}", city="Paris" if i < 4 else "Rome", rating=r)
                            for i, r in [(1, "70.0"), (2, "90.0"), (3, "80.0"), (4, "60.0")]]
                    + [listing(5, name="H5", city="Rome", scores=(None,) * 6)], [])
    homes = rental.filter_homes(ls, rs, HomeFilter())
    got = sorted((r.city, r["rank"], r.name) for r in rental.top_homes_per_city(homes, 2).collect())
    assert got == [("Paris", 1, "H2"), ("Paris", 2, "H3"), ("Rome", 1, "H4"), ("Rome", 2, "H5")]


def test_city_rating_is_mean_of_home_means(spark):
    ls, _ = frames(spark, [listing(1, name="A", rating="90.0"), listing(2, name="A", rating="80.0"),
                           listing(3, name="B", rating="60.0", price="50.00")], [])
    r = rental.city_rating(ls).collect()[0]
    assert (r.homes, r.listings, r.avg_rating, r.avg_price) == (2, 3, D("72.5000"), D("75.00"))


def test_best_vs_selected_city_two_rows(spark):
    ls, _ = frames(spark, [listing(1, city="Paris", rating="90.0"), listing(2, city="Rome", rating="95.0")], [])
    got = sorted((r.role, r.city) for r in rental.best_vs_selected_city(rental.city_rating(ls), "Paris").collect())
    assert got == [("best", "Rome"), ("selected", "Paris")]


def test_reviews_trend_change(spark):
    _, rs = frames(spark, [], [(1, dt.date(2019, 1, 1), 1), (1, dt.date(2019, 2, 1), 1), (1, dt.date(2020, 1, 1), 1)])
    got = sorted(tuple(r) for r in rental.reviews_trend(rs).collect())
    assert got == [(2019, 2, None, None), (2020, 1, 2, -1)]
