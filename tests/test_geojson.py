"""Tracks from GeoJSON text."""

from roadlake.sources import geojson


def test_a_track_is_parsed_once_for_all_uses_of_its_points(spark):
    texts = ['{"type":"LineString","coordinates":[[1,2],[1,3],[2,3]]}', '{"type":"Point","coordinates":[1,2]}', None,
             '{"type":"FeatureCollection","features":[{"type":"Feature","geometry":{"type":"Point","coordinates":[1,2]}},{"type":"Feature","geometry":{"type":"LineString","coordinates":[[5,6],[7,8]]}}]}']
    tracks = spark.createDataFrame([(k, None, t) for k, t in enumerate(texts)], "track_id long, name string, geometry string")
    segments = geojson.track_segments(geojson.track_points(tracks))
    assert sorted((r.track_id, r.name, r.seq, r.lat1, r.lon2) for r in segments.collect()) == [(0, "track-0", 0, 2.0, 1.0), (0, "track-0", 1, 3.0, 2.0), (3, "track-3", 0, 6.0, 7.0)]
    once = geojson.track_points(tracks)._jdf.queryExecution().optimizedPlan().toString()
    assert segments._jdf.queryExecution().optimizedPlan().toString().count("from_json") + segments._jdf.queryExecution().optimizedPlan().toString().count("JsonToStructs") <= once.count("from_json") + once.count("JsonToStructs")
