"""Feed responses, landing rows and reports to columns."""

import json
from datetime import datetime

import pytest

from trackflow.operators.silver import clean_states, dedupe, fresh, parse_weather, to_positions, weather
from trackflow.operators.quality import POSITION_RULES, keep_valid, rule_metrics, split, violations
from trackflow.schemas import STATES, WEATHER, names
from trackflow.sources import feeds, reference

RESPONSE = {
    "now": 1_700_000_000_500,
    "total": 4,
    "ac": [
        {"hex": " 4CA7B3 ", "flight": "ABC12  ", "alt_baro": 3575, "alt_geom": 3775, "gs": 38.3, "track": 12.5,
         "geom_rate": 6656, "transponder_code": "1234", "lat": 51.4, "lon": -0.4, "seen_pos": 3.2, "seen": 1.1, "spi": 1},
        {"hex": "400000", "alt_baro": "ground", "lat": 51.5, "lon": -0.5, "baro_rate": -64, "flight": "   "},
        {"hex": "400001", "flight": "NOPOS"},
        {"hex": "400002", "lat": 51.6, "lon": -0.6, "spi": 0, "alt_baro": 0},
    ],
}


def objects(spark, *bodies):
    rows = [(f"p{i}", 1_700_000_001.0, json.dumps(b)) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "poll_id string, fetched_at double, body string")
    return {r.icao24: r for r in feeds.object_reports(df).collect()}


def test_object_feed_golden_values(spark):
    got = objects(spark, RESPONSE)
    assert set(got) == {"4ca7b3", "400000", "400002"}
    a, b, c = got["4ca7b3"], got["400000"], got["400002"]
    assert a.callsign == "ABC12" and a.spi is True and a.on_ground is False
    assert (round(a.baro_altitude), round(a.geo_altitude)) == (1090, 1151)
    assert round(a.velocity, 1) == 19.7 and round(a.vertical_rate, 1) == 33.8
    assert (a.api_time, a.time_position, a.last_contact) == (1_700_000_000, 1_699_999_997, 1_699_999_999)
    assert b.on_ground is True and b.baro_altitude is None and round(b.vertical_rate, 2) == -0.33
    assert b.callsign is None and b.time_position == 1_700_000_000
    assert c.baro_altitude == 0 and c.spi is False


@pytest.mark.parametrize("body", [{}, {"now": 5, "ac": []}, {"ac": None, "aircraft": []}])
def test_empty_object_feed(spark, body):
    assert objects(spark, body) == {}


def test_other_array_name(spark):
    assert set(objects(spark, {"now": 1000, "aircraft": RESPONSE["ac"][:1]})) == {"4ca7b3"}
    assert set(objects(spark, {"now": 1000, "ac": [], "aircraft": RESPONSE["ac"][:1]})) == {"4ca7b3"}


def test_vector_feed_pads_short_rows(spark):
    body = {"time": 77, "states": [
        ["abc", "X1  ", "Land", 70, 71, -0.4, 51.4, 1000, False, 100.5, 90, -3, [1], 1010.5, "7000", False, 0, 3],
        ["def", None, "Land", 72],
    ]}
    df = spark.createDataFrame([("p", 80.0, json.dumps(body))], "poll_id string, fetched_at double, body string")
    rows = {r.icao24: r for r in feeds.vector_reports(df).collect()}
    assert list(rows["abc"].asDict()) == names(STATES)
    assert rows["abc"].callsign == "X1" and rows["abc"].geo_altitude == 1010.5 and rows["abc"].category == 3
    assert rows["def"].time_position == 72 and rows["def"].latitude is None and rows["def"].callsign is None
    assert all(r.api_time == 77 for r in rows.values())


def test_weather_feed_scalar_or_list(spark):
    metar, taf = {"obsTime": 1700000000, "wdir": "VRB"}, {"issueTime": "2023-11-14T22:13:20Z", "rawTAF": "T"}
    rows = [("metar", 1.0, json.dumps([metar, metar])), ("taf", 1.0, json.dumps(taf)), ("taf", 1.0, "[]"), ("taf", 1.0, "")]
    got = feeds.weather_reports(spark.createDataFrame(rows, "kind string, fetched_at double, body string")).collect()
    assert [(r.kind, r.obs_time) for r in got] == [("metar", 1700000000)] * 2 + [("taf", 1700000000)]
    assert json.loads(got[0].raw_json) == metar and json.loads(got[2].raw_json) == taf


def reports(spark, *items):
    rows = [(kind, fetched, 1700000000, json.dumps(body)) for kind, fetched, body in items]
    return spark.createDataFrame(rows, WEATHER)


def test_weather_report_cases(spark):
    def cloud(*layers):
        return [{"cover": c, "base": b} for c, b in layers]

    items = [
        ("metar", 1.0, {"wdir": "VRB", "wspd": 5, "visib": "6+", "clouds": cloud(("FEW", 500), ("BKN", 1800), ("OVC", 1200))}),
        ("metar", 2.0, {"wdir": 270, "visib": 2.5, "clouds": [], "rawOb": "R", "fltCat": "IFR"}),
        ("metar", 3.0, {"wgst": 31, "clouds": cloud(("OVX", 100))}),
        ("taf", 4.0, {"rawTAF": "T"}),
    ]
    a, b, c, d = sorted(parse_weather(reports(spark, *items)).collect(), key=lambda r: r.fetched_ts)
    assert (a.wind_dir_deg, a.wind_kt, a.visibility_sm, a.ceiling_ft) == (None, 5, 6.0, 1200)
    assert (b.wind_dir_deg, b.visibility_sm, b.ceiling_ft, b.raw_text, b.flight_category) == (270, 2.5, None, "R", "IFR")
    assert (c.gust_kt, c.ceiling_ft) == (31, 100) and (d.raw_text, d.ceiling_ft) == ("T", None)


def test_latest_fetch_of_a_report_wins(spark):
    df = reports(spark, ("metar", 1.0, {"rawOb": "old"}), ("metar", 9.0, {"rawOb": "new"}), ("taf", 1.0, {"rawTAF": "t"}))
    assert {(r.kind, r.raw_text) for r in weather(df).collect()} == {("metar", "new"), ("taf", "t")}


def states(spark, *rows):
    base = dict.fromkeys(names(STATES))
    base |= {"fetched_at": 1010.9, "time_position": 1000, "icao24": "abc", "longitude": -0.4, "latitude": 51.4, "velocity": 100.0}
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], STATES)


def test_staleness_bounds(spark):
    df = states(spark, {"fetched_at": 1060.0}, {"fetched_at": 1060.5}, {"time_position": None})
    assert [r.fetched_at for r in fresh(df).collect()] == [1060.0]


def test_projection(spark):
    (r,) = to_positions(states(spark, {"icao24": " ABC ", "callsign": "  ", "geo_altitude": 1000.0, "baro_altitude": 900.0})).collect()
    assert (r.icao24, r.callsign, r.event_ts, r.fetched_ts) == ("abc", None, datetime(1970, 1, 1, 0, 16, 40), datetime(1970, 1, 1, 0, 16, 50))
    assert round(r.alt_ft, 2) == 3280.84 and round(r.baro_alt_ft, 2) == 2952.76 and round(r.speed_kt, 4) == 194.3844
    (r,) = to_positions(states(spark, {"baro_altitude": 900.0})).collect()
    assert round(r.alt_ft, 2) == 2952.76


def test_rules_run_after_dedupe(spark):
    """An invalid earliest copy also removes its valid later copy."""
    df = states(spark, {"fetched_at": 1001.0, "latitude": 10.0}, {"fetched_at": 1002.0})
    cleaned = clean_states(df, reference.empty_reference(spark))
    assert cleaned.count() == 1 and keep_valid(cleaned).count() == 0
    assert dedupe(to_positions(df)).collect()[0].lat == 10.0


def test_rule_metrics_and_split(spark):
    df = to_positions(states(spark, {}, {"latitude": None}, {"velocity": 400.0}, {"geo_altitude": 30000.0}, {"velocity": None}))
    metrics = {r.rule: (r.passed, r.failed) for r in rule_metrics(df, POSITION_RULES).collect()}
    assert metrics == {"has_position": (4, 1), "inside_box": (4, 1), "plausible_altitude": (4, 1), "plausible_speed": (4, 1)}
    good, bad = split(df, POSITION_RULES)
    assert good.count() == 2 and sorted(r.reasons for r in bad.collect()) == [
        "has_position,inside_box", "plausible_altitude", "plausible_speed",
    ]


def test_uniqueness_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None)], "k int, v string")
    got = {r.name: r.violations for r in violations(df, {"v": "v IS NOT NULL"}, {"k": ["k"], "kv": ["k", "v"]}).collect()}
    assert got == {"v": 1, "k": 2, "kv": 1}


def test_reference_csv(spark, tmp_path):
    (tmp_path / "ref.csv").write_text(
        "'icao24',registration,model\n ABC123 ,'G-AB, C','two\nlines'\nabc123,A-FIRST,x\nzz,bad,y\n,none,z\n"
    )
    rows = reference.one_per_key(reference.with_columns(reference.read_reference_csv(spark, str(tmp_path)))).collect()
    assert [(r.icao24, r.registration, r.operator) for r in rows] == [("abc123", "A-FIRST", None)]


def test_reference_csv_quotes_and_backslashes(spark, tmp_path):
    def read(text):
        (tmp_path / "q.csv").write_text(text)
        return [tuple(r)[:2] for r in reference.with_columns(reference.read_reference_csv(spark, str(tmp_path / "q.csv"))).collect()]

    assert read("'icao24','registration'\n'abc123','O''Brien, J'\n'abc124','ends in \\'\n'abc125','x'\n") == [("abc123", "O'Brien, J"), ("abc124", "ends in \\"), ("abc125", "x")]
    assert read('icao24,registration\nabc123,"say ""hi"", twice"\nabc124,it\'s\n') == [("abc123", 'say "hi", twice'), ("abc124", "it's")]


def test_malformed_slots_are_null(spark):
    body = {"time": 77, "states": [["abc", None, "Land", 70.9, "n/a", "x", 51.4, 1000, "maybe", None, 90, -0.0, None, None, "7000", False, 0, 3]]}
    df = spark.createDataFrame([("p", 80.0, json.dumps(body))], "poll_id string, fetched_at double, body string")
    (r,) = feeds.vector_reports(df).collect()
    assert (r.time_position, r.last_contact, r.longitude, r.on_ground, r.transponder_code) == (70, None, None, None, "7000")
    assert str(r.vertical_rate) == "0.0"


def test_fractional_response_time_and_code_field(spark):
    body = {"now": 1_700_000_500_000.5, "ac": [{"hex": "abc123", "lat": 1.0, "lon": 2.0, "code": "7000"}]}
    df = spark.createDataFrame([("p", 1_700_000_000.0, json.dumps(body))], "poll_id string, fetched_at double, body string")
    (r,) = feeds.object_reports(df, code_field="code").collect()
    assert (r.api_time, r.transponder_code) == (1_700_000_500, "7000")


def test_lengths_are_reported_not_cut(spark):
    from trackflow.operators.quality import checked_assessments, checked_reviews

    df = spark.createDataFrame([("x" * 5000, "s", "wind", 1, 0.5, "00000000-0000-0000-0000-000000000000")], "reasoning string, evidence_summary string, cause string, severity int, confidence double, event_id string")
    assert len(checked_assessments(df).first().reasoning) == 5000 and checked_assessments(df).first().reasons == ""
    assert checked_assessments(df, reasoning_length=4000).first().reasons == "reasoning_length"
    reviews = spark.createDataFrame([("agree", None), ("maybe", "wind"), ("disagree", "x")], "verdict string, corrected_cause string")
    assert [r.reasons for r in checked_reviews(reviews).collect()] == ["", "verdict", "corrected_cause"]
