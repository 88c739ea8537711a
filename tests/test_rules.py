"""Hand-made rows at the edges of each rule."""

import pytest
from pyspark.sql import functions as F

from wayloom.functions import clock, geo, numbers
from wayloom.operators import analysis, pings, serving, stops, windows
from wayloom.sources import readers

FIELDS = "vehicle string, driver string, datetime long, x double, y double, speed double, heading double, ignition boolean, aircon boolean, working boolean, doorUp boolean, doorDown boolean, event_id long, copy int, routeNo string, routeId string"


def make(spark, *rows):
    """Pings from dicts."""
    names = [f.split()[0] for f in FIELDS.split(", ")]
    base = {"vehicle": "v", "x": 106.7, "y": 10.8, "speed": 10.0, "copy": 0, "routeNo": "1", "routeId": "R1"}
    return spark.createDataFrame([tuple((base | {"event_id": i} | r).get(n) for n in names) for i, r in enumerate(rows)], FIELDS)


@pytest.mark.parametrize(
    ("row", "reason"),
    [
        ({"x": 106.4}, None), ({"x": 106.3999}, "LON_OUT_OF_BOUNDS"), ({"x": 107.1}, None), ({"x": 107.1001}, "LON_OUT_OF_BOUNDS"),
        ({"y": 10.3}, None), ({"y": 10.2999}, "LAT_OUT_OF_BOUNDS"), ({"y": 11.2}, None), ({"y": 11.2001}, "LAT_OUT_OF_BOUNDS"),
        ({"speed": None}, None), ({"speed": 0.0}, None), ({"speed": -0.1}, "NEGATIVE_SPEED"), ({"speed": 120.0}, None), ({"speed": 120.1}, "HARDWARE_FAULT_SPEED"),
        ({"x": None, "speed": 200.0}, "NULL_COORDS"), ({"x": 0.0, "y": 0.0}, "LON_OUT_OF_BOUNDS"),
    ],
)
def test_validation(spark, row, reason):
    assert pings.with_reason(make(spark, {"datetime": 1} | row)).first()["reason"] == reason


def test_dedup_keeps_first_arrival(spark):
    got = pings.first_of_each(make(spark, {"datetime": 1, "speed": 1.0}, {"datetime": 1, "speed": 2.0}, {"datetime": 2})).orderBy("datetime").collect()
    assert [(r["datetime"], r["speed"]) for r in got] == [(1, 1.0), (2, 10.0)]


def test_sessions_split_after_the_gap(spark):
    at = [0, 299, 599, 900]  # gaps 299, 300, 301
    got = windows.trips(make(spark, *[{"datetime": t} for t in at])).orderBy("trip_start").collect()
    assert [(r["trip_start"], r["trip_end"], r["event_count"]) for r in got] == [(0, 599, 3), (900, 900, 1)]
    assert got[1]["avg_speed"] == 0 and got[1]["total_distance_km"] == 0


def test_anomalies(spark):
    far = {"x": 106.71}  # some 1.1 km
    got = pings.anomalies(make(spark, {"datetime": 0, "speed": 95.0}, {"datetime": 10, "speed": 80.0}, {"datetime": 20, "speed": 80.1}, {"datetime": 50} | far, {"datetime": 81}, {"datetime": 111, "speed": 90.0} | far))
    told = {r["datetime"]: r for r in got.collect()}
    assert sorted(told) == [20, 50, 111]
    assert told[20]["category"] == "SPEED_EXCESS" and not told[20]["gps_jump"]
    assert told[50]["category"] == "GPS_JUMP" and told[50]["anomaly_type"].endswith("km_in_30s")
    assert told[111]["speed_excess"] and told[111]["gps_jump"] and told[111]["category"] == "SPEED_EXCESS"


def test_stops(spark):
    got = stops.stops(make(spark, *[{"datetime": t, "speed": v} for t, v in ((0, 1.99), (30, 2.0), (59, 4.99), (60, 5.0), (100, None), (110, 3.0), (159, 5.0), (200, 0.0), (210, 4.0), (220, 1.0), (300, 9.0), (400, 0.0), (900, 1.0))])).orderBy("start_ts").collect()
    assert [(r["start_ts"], r["duration_s"]) for r in got] == [(0, 60), (200, 100)]


def test_features(spark):
    one = windows.vehicle_features(make(spark, {"datetime": 7200, "speed": None})).first()
    assert (one["avg_speed"], one["std_speed"], one["avg_interval_s"], one["idle_fraction"], one["hour_of_day"]) == (0, 0, 0, 0, 9)
    turns = windows.vehicle_features(make(spark, *[{"datetime": i, "heading": float(h)} for i, h in enumerate((350, 10, 55, 101, 0))])).first()
    assert turns["heading_changes"] == 2  # 20, 45, 46, 101


def test_route_speed_windows(spark):
    got = windows.route_speeds(make(spark, {"datetime": 300}, {"datetime": 329, "speed": 20.0}, {"datetime": 330, "speed": None, "vehicle": "w"})).orderBy("window_end_ms").collect()
    assert [r["window_end_ms"] for r in got] == [t * 1000 for t in range(330, 631, 30)]
    assert (got[0]["avg_speed"], got[0]["event_count"], got[1]["event_count"], got[1]["distinct_vehicle_count"], got[-1]["max_speed"]) == (15.0, 2, 3, 2, 0.0)


def test_state_keeps_older_values(spark):
    got = serving.current_state(make(spark, {"datetime": 1, "speed": 7.0}, {"datetime": 2, "speed": None})).first()
    assert (got["datetime"], got["speed"]) == (2, 7.0)


def test_grid_rounds_half_to_even(spark):
    got = spark.range(1).select(geo.cell(F.lit(0.5), 1.0).alias("a"), geo.cell(F.lit(1.5), 1.0).alias("b"), geo.cell(F.lit(2.5), 1.0).alias("c")).first()
    assert tuple(got) == (0, 2, 2)


def test_numbers(spark):
    got = spark.range(1).select(
        geo.heading_change(F.lit(350.0), F.lit(10.0)).alias("h"), F.round(geo.distance_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)), 3).alias("km"),
        clock.hour_of(F.lit(1704067200 + 18 * 3600), 7).alias("hour"), clock.minute_path(F.lit(1704067261)).alias("p"), numbers.ratio(F.lit(1), F.lit(0)).alias("r"), numbers.route_hue(F.lit("a")).alias("hue"),
    ).first()
    assert tuple(got) == (20.0, 111.195, 1, "2024-01-01/00-01", 0.0, 97)


def test_histogram_and_dense_hours(spark):
    values = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 30)], "v double")
    got = {r["bin"]: r["n"] for r in analysis.histogram(values, "v").collect()}
    assert len(got) == 30 and (got[0], got[1], got[2], got[29]) == (1, 1, 1, 1)
    same = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert {r["bin"]: r["n"] for r in analysis.histogram(same, "v").collect()}[0] == 2
    hours = analysis.per_hour(spark.createDataFrame([(10,), (3 * 3600 + 5,)], "datetime long")).orderBy("hour_start").collect()
    assert [r["n"] for r in hours] == [1, 0, 0, 1]


def test_messages(spark):
    body = '{"msgType":"m","msgBusWayPoint":%s}'
    given = [
        body % '{"vehicle":"a","datetime":"77","x":"1.5","y":"abc","ignition":1,"door_up":"true"}', body % '{"vehicle":"b","datetime":5,"speed":3}',
        body % '{"vehicle":null,"datetime":5}', body % '{"vehicle":"","datetime":5}', body % '{"vehicle":"c"}', body % '{"vehicle":"c","datetime":0}', '{"msgType":"m"}', "{broken", None,
    ]
    got = readers.read_messages(spark.createDataFrame([(v,) for v in given], "value string")).orderBy("vehicle").collect()
    assert [(r["vehicle"], r["datetime"], r["x"], r["y"], r["ignition"], r["doorUp"], r["speed"]) for r in got] == [("a", 77, 1.5, None, True, True, None), ("b", 5, None, None, None, None, 3.0)]


def test_route_table(spark, tmp_path):
    (tmp_path / "routes.csv").write_text("vehicle,route_id,route_no\na, 1 ,x\nb,2\na,3, y \n")
    got = {r["vehicle"]: (r["route_id"], r["route_no"]) for r in readers.read_routes_csv(spark, str(tmp_path / "routes.csv")).collect()}
    assert got == {"a": ("3", "y")}


def test_array_files(spark, tmp_path):
    folder = tmp_path / "part2" / "part2"
    folder.mkdir(parents=True)
    (folder / "sub_raw_12.json").write_text('[{"msgBusWayPoint":{"vehicle":"a","datetime":9}},\n{"msgBusWayPoint":{"vehicle":"","datetime":9}},{"msgBusWayPoint":{"vehicle":"b","datetime":0}}]')
    got = readers.in_replay_order(readers.read_array_files(spark, str(tmp_path / "part*" / "part*" / "sub_raw_*.json"))).collect()
    assert [(r["vehicle"], r["file_no"], r["part"]) for r in got] == [("a", 12, 2)]


def test_clusters(spark):
    near = [("v", 10.8 + i * 1e-4, 106.7, 100, i, i) for i in range(12)] + [("v", 10.8, 106.7 + 5.0, 60, 99, 99)]
    points = spark.createDataFrame(near, "vehicle string, lat double, lon double, duration_s long, start_ts long, end_ts long")
    got = {r["cluster"]: r["stops"] for r in stops.clusters(points).collect()}
    assert got == {0: 12, -1: 1}


def test_empty_tables(spark):
    none = make(spark, {"datetime": 1}).where("false")
    assert windows.trips(none).count() == 0 and windows.route_speeds(none).count() == 0 and stops.stops(none).count() == 0
    assert analysis.per_hour(none).count() == 0 and stops.with_clusters(stops.stops(none)).count() == 0


def test_archive_round_trip(spark, tmp_path):
    windows.write_archive(make(spark, {"datetime": 1704067200}, {"datetime": 1704067260}), str(tmp_path / "a"))
    got = spark.read.parquet(str(tmp_path / "a"))
    assert got.where("date = '2024-01-01' and hhmm = '00-01'").count() == 1 and got.count() == 2


def test_route_hue_is_the_maps(spark):
    def plain(name):
        """Numbers as a browser has them: only a shift makes 32 bits."""
        h = 0
        for c in name:
            shifted = (h << 5) & 0xFFFFFFFF
            h = ord(c) + (shifted - (1 << 32) if shifted >> 31 else shifted) - h
        return abs(h) % 360

    names = [f"{i}-long-route" for i in range(300)] + ["1", "150", "Route 150 Cho Lon", "a" * 60]
    got = spark.createDataFrame([(n,) for n in [*names, "UNKNOWN", "", None]], "r string").select("r", numbers.route_hue(F.col("r")).alias("h")).collect()
    assert {r["r"]: r["h"] for r in got if r["r"] not in ("UNKNOWN", "", None)} == {n: plain(n) for n in names} and plain("Route 150 Cho Lon") == 354
    assert {r["h"] for r in got if r["r"] in ("UNKNOWN", "", None)} == {None}


def test_stops_are_those_of_a_state_machine(spark):
    from conftest import DATA
    from wayloom.sources import fixture

    clean = pings.clean(fixture.pings(spark, str(DATA)), fixture.routes(spark, str(DATA)))
    by_vehicle, want = {}, []
    for r in clean.collect():
        by_vehicle.setdefault(r["vehicle"], []).append(r)
    for vehicle, rows in by_vehicle.items():
        since = None
        for r in sorted(rows, key=lambda r: (r["datetime"], r["event_id"], r["copy"])):
            speed = r["speed"] or 0.0
            if since is None and speed < 2:
                since = r
            elif since is not None and speed >= 5:
                if r["datetime"] - since["datetime"] >= 60:
                    want.append((vehicle, since["y"], since["x"], r["datetime"] - since["datetime"], since["datetime"], r["datetime"]))
                since = None
    assert want and sorted(map(tuple, stops.stops(clean).collect())) == sorted(want)


def test_replay(spark):
    rows = [("a", 1, 1, 100), ("b", 1, 1, 104), ("a", 1, 1, 110), ("a", 1, 2, 90), ("a", 1, 2, 120), ("b", 2, 1, 130)]
    table = spark.createDataFrame(rows, "vehicle string, part int, file_no int, datetime long").repartition(3)
    assert [(r["part"], r["file_no"], r["datetime"]) for r in readers.in_replay_order(table).collect()] == [r[1:] for r in rows]
    got = {(r["part"], r["file_no"], r["datetime"]): r["wait_s"] for r in readers.replay_gaps(table, 2.0).collect()}
    assert got == {(1, 1, 100): 0.0, (1, 1, 104): 2.0, (1, 1, 110): 3.0, (1, 2, 90): 0.0, (1, 2, 120): 15.0, (2, 1, 130): 5.0}
    assert {r["wait_s"] for r in readers.replay_gaps(table, 0).collect()} == {0.0}


def test_kafka_rows_are_read_back(spark):
    table = make(spark, {"datetime": 5, "speed": None, "ignition": True}, {"datetime": 6, "vehicle": "w"})
    sent = readers.to_kafka_rows(table)
    assert sent.columns == ["key", "value"] and [r["key"] for r in sent.orderBy("key").collect()] == ["v", "w"]
    names = ["vehicle", "datetime", "x", "y", "speed", "ignition", "doorUp"]
    assert sorted(map(tuple, readers.read_messages(sent).select(*names).collect()), key=str) == sorted(map(tuple, table.select(*names).collect()), key=str)


def test_messages_are_parsed_once(spark):
    got = readers.read_messages(spark.createDataFrame([("{}",)], "value string"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("fromjson") == 1


def test_odd_messages(spark):
    given = [
        '{"msgBusWayPoint":{"vehicle":"a","datetime":77.9,"x":1e-3,"speed":"7,5","ignition":"yes"}}', '{"msgBusWayPoint":{"vehicle":"b","datetime":5', '{"msgBusWayPoint":5}', "[]", "null", "",
        '{"msgBusWayPoint":{"vehicle":12,"datetime":9,"x":{"y":1}}}',
    ]
    got = readers.read_messages(spark.createDataFrame([(v,) for v in given], "value string")).orderBy("datetime").collect()
    assert [(r["vehicle"], r["datetime"], r["x"], r["speed"], r["ignition"]) for r in got] == [("12", 9, None, None, None), ("a", 77, 0.001, None, True)]


def test_missing_route_table(spark, tmp_path):
    with pytest.warns(UserWarning, match="no routes"):
        routes = readers.read_routes_csv(spark, str(tmp_path / "none.csv"))
    got = pings.with_routes(make(spark, {"datetime": 1}).drop("routeNo", "routeId"), routes).first()
    assert (got["routeNo"], got["routeId"]) == ("UNKNOWN", "0")


def test_running_dedup_metrics(spark):
    rows = [{"datetime": t} for t in (1, 1, 2, 3, 3, 4)]
    got = pings.running_dedup_metrics(make(spark, *rows), every=2).orderBy("total_seen")
    assert [(r["total_seen"], r["duplicates_dropped"]) for r in got.collect()] == [(2, 1), (4, 1), (6, 2)]
    assert pings.dedup_lines(got).collect()[0]["line"] == "DEDUP[v] seen=2 dropped=1 rate=0.500 bloomBytes=0"
    assert pings.with_detection_time(got).where("detected_at_ms > 1700000000000").count() == 3


def test_rates(spark):
    rows = [("m", "", 0, 5.0), ("m", "", 10_000, 25.0), ("m", "", 20_000, 10.0), ("m", "", 90_000, 99.0), ("one", "", 5_000, 1.0)]
    got = serving.rate(spark.createDataFrame(rows, "metric string, label string, at_ms long, value double"), 30, 20_000).collect()
    assert [(r["metric"], r["rate"]) for r in got] == [("m", 1.5)]  # 20 up, a reset, 10 up, in 20 s


def test_windows_count_a_vehicle_once(spark):
    import random

    r = random.Random(5)
    rows = [{"vehicle": f"v{r.randrange(4)}", "datetime": r.randrange(1500), "routeNo": str(r.randrange(2)), "speed": float(r.randrange(9))} for _ in range(300)]
    want = {}
    for x in rows:
        for end in range(x["datetime"] // 30 * 30 + 30, x["datetime"] // 30 * 30 + 301, 30):
            want.setdefault((x["routeNo"], end * 1000), []).append(x)
    got = {(x["route_no"], x["window_end_ms"]): (x["distinct_vehicle_count"], x["event_count"], round(x["avg_speed"], 6)) for x in windows.route_speeds(make(spark, *rows)).collect()}
    assert got == {k: (len({x["vehicle"] for x in v}), len(v), round(sum(x["speed"] for x in v) / len(v), 6)) for k, v in want.items()}


def test_clusters_against_pairs(spark):
    """Density clusters of dense, sparse and bordering places, by all pairs."""
    import math
    import random

    r = random.Random(8)
    eps, least = 5e-4, 10
    deg = math.degrees(eps)
    at = lambda y, x, n, w: [(10.7 + y * deg + r.uniform(-w, w) * deg, 106.6 + x * deg + r.uniform(-w, w) * deg) for _ in range(n)]
    spots = at(0, 0, 40, 0.2) + at(0, 0.9, 40, 0.2) + at(0, 2.3, 15, 0.5) + at(3, 0, 9, 0.1) + at(3.7, 0, 4, 0.3) + at(6, 6, 60, 2) + at(9, 0, 5, 0.1) + [(10.5, 106.9)] * 11 + at(6, -3, 30, 1.5)
    angle = lambda p, q: 2 * math.atan2(math.sqrt(h := math.sin(math.radians(q[0] - p[0]) / 2) ** 2 + math.cos(math.radians(p[0])) * math.cos(math.radians(q[0])) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2), math.sqrt(1 - h))
    core = [p for p in spots if sum(angle(p, q) <= eps for q in spots) >= least]
    up = {p: p for p in core}

    def find(p):
        while up[p] != p:
            p = up[p]
        return p

    for p in up:
        for q in up:
            if angle(p, q) <= eps:
                a, b = find(p), find(q)
                up[max(a, b)] = min(a, b)
    heads = sorted({find(p) for p in up})
    want = {p: heads.index(find(p)) if p in up else min((heads.index(find(q)) for q in up if angle(p, q) <= eps), default=-1) for p in spots}
    assert len(heads) > 2 and -1 in want.values()
    points = spark.createDataFrame([("v", *p, 100, i, i) for i, p in enumerate(spots)], "vehicle string, lat double, lon double, duration_s long, start_ts long, end_ts long")
    assert {(x["lat"], x["lon"]): x["cluster"] for x in stops.with_clusters(points).collect()} == want
