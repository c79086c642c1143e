from helpers import raw_stations, raw_trips, station, trip
from stationflow.functions import expressions as X
from stationflow.operators import demand as D
from stationflow.operators import models as M
from stationflow.operators import options as OP
from stationflow.operators import routes as R
from stationflow.operators import stations as ST


def fixture(spark):
    trips = [
        trip(1, start_station=1, end_station=2), trip(2, start_station=1, end_station=2),
        trip(3, start_station=1, end_station=3), trip(4, start_station=1, end_station=4),
        trip(5, start_station=1, end_station=5), trip(6, start_station=1, end_station=6),
        trip(7, start_station=1, end_station=None),
        trip(8, start_station=2, route=None, passholder="Testing", bike_type=None),
        trip(9, start_station=2, route="Unknown", passholder=None),
        trip(10, start_station=7, start="2026-01-04 08:00"),  # a Sunday
    ]
    stations = [
        station(1, "O'Hara (Plaza)", region="DTLA"), station(2, "Second", region="Westside"),
        station(3, "Virtual Station", region="DTLA"), station(4, "Nowhere", region=None),
        station(5, "No coords", lat=None), station(6, "Zero", lat=0.0), station(7, "Free", region="Free Bikes"),
    ]
    stg = M.build_staging_trips(raw_trips(spark, trips))
    dim = M.build_dim_stations(raw_stations(spark, stations))
    return stg, dim


def test_destinations_hide_special_ones(spark):
    stg, dim = fixture(spark)
    physical = ST.top_destinations(stg, dim, X.ALL_QUARTERS, "1").collect()
    assert [(r["end_station_name"], r["trip_count"]) for r in physical] == [("Second", 2)]
    everything = ST.top_destinations(stg, dim, X.ALL_QUARTERS, "1", include_special=True).collect()
    assert len(everything) == 5
    assert everything[0]["trip_count"] == 2


def test_filter_options_leave_out_special_values(spark):
    stg, dim = fixture(spark)
    opts = [(r["filter_name"], r["filter_value"]) for r in OP.demand_filter_options(stg, dim).collect()]
    assert ("region", "Free Bikes") not in opts and ("region", "Unknown Region") not in opts
    assert ("passholder_type", "Testing") not in opts and ("passholder_type", "Unknown") not in opts
    assert ("bike_type", "Unknown") in opts
    assert [o for o in opts if o[0] == "region"] == [("region", "DTLA"), ("region", "Westside")]
    lists = {r["filter_name"]: r["filter_values"] for r in OP.filter_option_lists(OP.demand_filter_options(stg, dim)).collect()}
    assert lists["region"] == ["DTLA", "Westside"]


def test_route_categories_null_and_literal_unknown(spark):
    stg, _ = fixture(spark)
    cats = [r["route_category"] for r in R.route_categories(stg).collect()]
    assert cats == ["One Way", "Unknown", "Unknown"]


def test_station_options_labels_and_lookup(spark):
    stg, dim = fixture(spark)
    ranking = ST.station_ranking(stg, dim)
    opts = ST.station_options(ranking, "DTLA").collect()
    assert [r["station_label"] for r in opts] == ["O'Hara (Plaza) (1)"]
    found = ST.station_lookup(ranking, opts[0]["station_label"]).collect()
    assert len(found) == 1 and found[0]["trip_starts"] == 7
    assert [r["region"] for r in ST.station_regions(ranking).collect()] == ["DTLA", "Westside"]


def test_demand_filters_and_rollups(spark):
    stg, dim = fixture(spark)
    f = D.DemandFilters(region="DTLA", day_type=X.WEEKDAY, start_hour=10, end_hour=10)
    hourly = D.historical_demand(stg, dim, f)
    assert [(r["trip_count"], r["day_type"]) for r in hourly.collect()] == [(7, "Weekday")]
    weekend = D.historical_demand(stg, dim, D.DemandFilters(day_type=X.WEEKEND))
    assert [r["trip_count"] for r in weekend.collect()] == [1]
    assert not D.has_rows(D.historical_demand(stg, dim, D.DemandFilters(region="Nowhere")))
    by_hour = D.demand_by_hour(D.historical_demand(stg, dim)).orderBy("start_hour").collect()
    assert [(r["start_hour"], r["trip_count"]) for r in by_hour] == [(8, 1), (10, 9)]


def test_region_filter_is_a_semi_join_and_keeps_unknown_stations(spark):
    stg, dim = fixture(spark)
    in_dtla = D.historical_demand(stg, dim, D.DemandFilters(region="DTLA"))
    assert "Join LeftSemi" in in_dtla._jdf.queryExecution().optimizedPlan().toString()
    total = stg.count()
    per_region = [D.historical_demand(stg, dim, D.DemandFilters(region=r)).agg({"trip_count": "sum"}).first()[0] or 0
                  for r in ["DTLA", "Westside", "Free Bikes", X.UNKNOWN_REGION]]
    known = stg.join(dim, stg["start_station_id"] == dim["station_id"], "left").fillna({"region": X.UNKNOWN_REGION}) \
        .where("region in ('DTLA', 'Westside', 'Free Bikes', 'Unknown Region')").count()
    assert sum(per_region) == known <= total


def test_top_routes_and_labels(spark):
    stg, dim = fixture(spark)
    routes = R.top_routes(stg, dim).collect()
    assert routes[0]["trip_count"] == 2 and routes[0]["start_station_name"] == "O'Hara (Plaza)"
    labels = R.top_route_labels(stg, dim, n=1).collect()
    assert labels[0]["route"] == "O'Hara (Plaza) to Second"
    plan = R.top_routes(stg, dim)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    tree = R.top_routes(stg, dim)._jdf.queryExecution().optimizedPlan().toString()
    assert tree.rindex("Limit") > tree.rindex("Join LeftOuter")  # names are joined above the limit


def test_all_option_first(spark):
    stg, dim = fixture(spark)
    opts = OP.demand_filter_options(stg, dim).filter("filter_name = 'region'")
    got = [r["filter_value"] for r in OP.with_all_option(opts, "filter_value", X.ALL_REGIONS).collect()]
    assert got == ["All Regions", "DTLA", "Westside"]


def test_station_choice_and_bar_order(spark):
    assert ST.selected_station_id("All Stations") is None
    assert ST.selected_station_id("O'Hara (Plaza) (1)") == "1"
    stg, dim = fixture(spark)
    top = ST.top_stations(ST.station_ranking(stg, dim), 3)
    assert [r["trip_starts"] for r in ST.bar_order(top, "trip_starts").collect()] == [1, 2, 7]


def test_physical_destination_filter_makes_the_end_join_inner(spark):
    stg, dim = fixture(spark)
    physical = ST.top_destinations(stg, dim, X.ALL_QUARTERS, "1")._jdf.queryExecution().optimizedPlan().toString()
    special = ST.top_destinations(stg, dim, X.ALL_QUARTERS, "1", include_special=True)
    special_plan = special._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in physical
    assert "Join Inner" not in special_plan and special_plan.count("Join LeftOuter") == 2
