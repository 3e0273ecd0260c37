"""Nested POI responses: map lookup, flattening, bad lines, missing parts."""

from parcelle.schemas import EXCLUSIVE_OUTPUT_COLUMNS
from parcelle.sources import poi_json

LINES = [
    '{"cell": 1, "elements": [{"type": "node", "id": 1, "lat": 2.0, "lon": 3.0, "tags": {"amenity": "school", "unlisted:tag": "x"}},'
    ' {"type": "way", "id": 2, "center": {"lat": 4.0, "lon": 5.0}, "tags": {"leisure": "park", "name": "P"}}, {"type": "node", "id": 3, "lat": 0.0, "lon": 0.0}]}',
    '{"cell": 1, "elements": [{"type": "node", "id": 4, "lat": 1.0, "lon": 1.0, "tags": {"tourism": "museum", "amenity": "bench"}}]}',
    '{"cell": 2, "elements": []}', '{"cell": 3}', '{"cell": 4, "elements": [',
]


def responses(spark, tmp_path):
    (tmp_path / "r.json").write_text("\n".join(LINES))
    return poi_json.read_responses(spark, str(tmp_path), "cell bigint")


def test_counts_keep_empty_responses_and_leave_bad_lines(spark, tmp_path):
    got = {r.cell: r.asDict() for r in poi_json.exclusive_counts(poi_json.elements_of(responses(spark, tmp_path)), ["cell"]).collect()}
    assert set(got) == {1, 2, 3}
    assert {c: got[1][c] for c in EXCLUSIVE_OUTPUT_COLUMNS if got[1][c]} == {"schools": 1, "parks": 1, "cultural_places": 1, "amenities": 1}
    assert all(got[k][c] == 0 for k in (2, 3) for c in EXCLUSIVE_OUTPUT_COLUMNS)
    bad = [r[poi_json.BAD_RECORD] for r in responses(spark, tmp_path).select("cell", poi_json.BAD_RECORD).cache().collect() if r[poi_json.BAD_RECORD]]
    assert bad == [LINES[-1]]


def test_points_and_flat_columns(spark, tmp_path):
    e = poi_json.elements_of(responses(spark, tmp_path))
    points = {r.poi_id: (r.lon, r.lat, r.amenity, r.leisure, r.name) for r in poi_json.poi_points(e).collect()}
    assert points == {1: (3.0, 2.0, "school", None, None), 2: (5.0, 4.0, None, "park", "P"), 3: (0.0, 0.0, None, None, None), 4: (1.0, 1.0, "bench", None, None)}
    flat = poi_json.normalize(e, ["unlisted:tag"])
    assert flat.columns == ["cell", "type", "id", "element.lat", "element.lon", "center.lat", "center.lon", "tags.unlisted:tag"]
    assert [r[-1] for r in flat.orderBy("id").collect()] == ["x", None, None, None]


def test_flattening_needs_no_shuffle(spark, tmp_path):
    plan = poi_json.poi_points(poi_json.elements_of(responses(spark, tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" in plan
