import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import chunking, coverage, extract, ledger, search, spatial, vectors
from strata.plans import pipeline
from strata.sources import files, portals, registry
from strata.streaming import refresh
from strata.util import running_total, salted_join

GENERAL = "assessment_report_general"
GOLDEN = [
    ("Sheet 42A/10 near 093A 12 and 42A", "42A/10 ", "", [], GENERAL), ("104B foo 04B", "04B", "", [], GENERAL), ("x42A 42a 31B/5 W1", "31B/5 W1", "", [], GENERAL),
    ("COMPANY: Foo Mining Ltd.\nOWNER: Bar", "", "Foo Mining Ltd", [], GENERAL), ("Company\n  Acme Gold Inc.. \nfoo", "", "Acme Gold Inc", ["gold"], GENERAL),
    ("OPERATOR ;  . \nCLIENT: Zed Corp", "", "Zed Corp", [], GENERAL), ("SUBMITTED  BY: " + "x" * 120 + "\nOWNER: short .", "", "short ", [], GENERAL),
    ("Diamond drilling of drill holes; Drill Hole log", "", "", ["diamond"], "assessment_report_drill"), ("em survey IP survey", "", "", [], GENERAL), ("lake geochem EM", "", "", [], "assessment_report_geochem"),
    ("geophys then magnetometer", "", "", [], "assessment_report_geophys"), ("progress report, assay", "", "", [], "assessment_report_drill"), ("GOLD Rare Earth rareearth Gold tinfoil tin", "", "", ["gold", "rare earth", "rareearth", "tin"], GENERAL), (None, "", "", [], GENERAL),
]


def test_extract(spark):
    df = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "i int, t string")
    for r in extract.metadata(df, "t").collect():
        assert (r.nts_sheet, r.company, r.commodities, r.report_type) == GOLDEN[r.i][1:], GOLDEN[r.i][0]


def fold(text, most=1400, least=200):
    import re

    clean = text.strip()
    if len(clean) < least:
        return [clean]
    parts, out, cur, n = re.split(r"\n\s*\n+", clean), [], [], 0
    for p in (x.strip() for x in parts):
        if p:
            if n + len(p) > most and cur:
                out, cur, n = out + ["\n\n".join(cur)], [], 0
            cur, n = cur + [p], n + len(p)
    out = [b for b in [*out, *(["\n\n".join(cur)] if cur else [])] if len(b) >= least]
    return [b[:1400] for b in out or [parts[0]]]


def test_chunks(spark):
    import random

    rnd, texts = random.Random(2), ["", "short", "a  \n\n" + "\n" * 200 + "b", "é" * 3000]
    for _ in range(60):
        texts.append("".join("w" * rnd.choice([0, 1, 10, 199, 200, 450, 700, 1390, 1400, 1401, 3000]) + rnd.choice(["\n\n", "\n \n", "\n\n\n", "\n"]) for _ in range(rnd.randrange(1, 9))))
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", chunking.chunks(F.col("t")).alias("c")).collect()
    assert all(r.c == fold(texts[r.i]) for r in got)


def test_scalars(spark):
    df = spark.createDataFrame([(" .GeoJSON ", "Data v1.2", None), (None, "a/b", "id"), ("CSV", "", "id")], "f string, n string, i string")
    got = df.select(C.format_norm("f").alias("f"), C.raw_filename(F.col("n"), F.col("i"), F.col("f")).alias("r")).collect()
    assert [tuple(r) for r in got] == [("geojson", "Data v1.2"), ("", "a_b.dat"), ("csv", "id.csv")]


LEDGER = "resource_id string, sha256 string, ckan_modified string, fetched_at string, local_path string, url string"


def test_ledger(spark):
    led = spark.createDataFrame([("a", "A", "m1", "t1", "p", "u"), ("a", "B", "m2", "t2", "p", "u"), ("a", "A", "m3", "t3", "p", "u"), ("c", "C", "", None, "p", "u")], LEDGER)
    assert {(r.resource_id, r.sha256) for r in ledger.latest(led).collect()} == {("a", "A"), ("c", "C")}
    assert ledger.upserted(led).count() == 3
    inv = spark.createDataFrame([("a", "u", "csv", "m3", "x"), ("c", "u", "csv", "", "x"), ("d", "u", ".CSV", "m", "x"), ("e", None, "csv", "m", "x"), ("f", "u", "pdf", "m", "x"), ("f", "u", "pdf", "m", "arcgis_hub")], "resource_id string, url string, format string, last_modified string, connector string")
    assert [r.status for r in ledger.classify(inv, led).orderBy("resource_id", "connector").collect()] == ["unchanged", "fetch", "new", "pending", "new", "excluded"]
    assert ledger.changed_content(spark.createDataFrame([("a", "A"), ("a", "Z"), ("q", "Q")], "resource_id string, sha256 string"), led).count() == 2


def test_coverage_rounds_half_to_even(spark):
    e = spark.createDataFrame([("J", f"c{i}") for i in range(8)], "jurisdiction string, code string")
    got = coverage.scores(e, e.limit(1)).head()
    assert float(got.score) == round(1 / 8, 2) and coverage.gaps(e, e.limit(1)).count() == 7


def test_content_history_in_blocks(spark):
    import random

    rnd, rows, want = random.Random(3), [], set()
    for r in ("a", "b", None):
        had = None
        for k in range(60):
            sha = rnd.choice("AB")
            time = f"2024-01-{k // 7 + 1:02d}T{k:02d}"
            rows.append((r, f"p{k}", sha, time))
            want.add((r, f"p{k}", "new" if had is None else "skipped" if had == sha else "changed"))
            had = sha
    got = ledger.content_history(spark.createDataFrame(rows, "resource_id string, local_path string, sha256 string, fetched_at string"))
    assert {(x.resource_id, x.local_path, x.status) for x in got.collect()} == want
    assert ledger.content_history(spark.createDataFrame([], LEDGER)).count() == 0


def test_sized_join(spark):
    from strata.util import sized_join

    rows = spark.createDataFrame([("h" if i % 3 else f"k{i}", i) for i in range(300)], "k string, i int")
    few = spark.createDataFrame([("h", 1), ("k0", 2), ("x", 3)], "k string, v int")
    for most in (10, 2):
        assert sized_join(rows, few, ["k"], most=most).count() == 201 and sized_join(rows, few, ["k"], "left", most=most).count() == 300


def test_records_and_counters(spark):
    rows = spark.createDataFrame([("1", "t", "ON", None, {"j": "QC", "x": None}), ("2", None, "BC", 3, None)], "id string, text string, j string, n int, m map<string,string>")
    got = {r.r.id: r.r.metadata for r in rows.select(chunking.record(F.col("id"), F.col("text"), {"j": F.col("j"), "n": F.col("n")}, F.col("m")).alias("r")).collect()}
    assert got == {"1": {"j": "QC"}, "2": {"j": "BC", "n": "3"}}
    docs = spark.createDataFrame([("a", "gold " * 100, False), ("b", None, True), ("c", None, False)], "report_id string, text string, bad boolean")
    docs = docs.selectExpr("'ON' AS jurisdiction", "'S' AS source_code", "report_id", "'' AS source_url", "text", "bad", "map('company', 'Given') AS meta")
    made = chunking.ingest(docs, metadata="meta")
    assert {r.company for r in made.collect()} == {"Given"}
    assert tuple(chunking.counters(docs, made, failed=F.col("bad")).head()) == (3, 1, 1, 1, 1)
    assert tuple(chunking.counters(docs, None).head()) == (3, 3, 0, 0, 0)
    with pytest.raises(ValueError):
        chunking.chunks(F.col("text"), most=1500)
    lost = {r.report_id: (r.characters, r.kept) for r in chunking.lost_characters(docs, ["report_id"]).collect()}
    assert lost == {"a": (400, 400), "b": (0, 0), "c": (0, 0)}


def test_checkpoints_need_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from strata import util

    class Context:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: type("O", (), {"isDefined": lambda self: False})()})()})()

        def getConf(self):  # noqa: N802
            return {}

    session = type("Session", (), {"sparkContext": Context(), "conf": {}})()
    with pytest.raises(ValueError, match="shared?"):
        util.ensure_checkpoint_dir(session)


def test_bm25(spark):
    docs = spark.createDataFrame([(1, "gold gold vein"), (2, "silver"), (3, None), (4, "Gold in the vein of the rock")], "id int, text string")
    assert [r.id for r in search.bm25(docs, "GOLD", ["id"]).collect()] == [1, 4] and search.bm25(docs, "", ["id"]).count() == 0
    assert {(r.term, r.tf) for r in search.postings(docs, ["id"]).where("id = 1").collect()} == {("gold", 2), ("vein", 1)}


def test_spatial(spark):
    import random

    rnd = random.Random(1)
    a, b = [(i, rnd.random(), rnd.random()) for i in range(60)] + [(99, None, 1.0)], [(i, rnd.random(), rnd.random()) for i in range(60)]
    want = {(i, j) for i, x, y in a if x is not None for j, u, v in b if (x - u) ** 2 + (y - v) ** 2 <= 0.01}
    got = spatial.distance_join(spark.createDataFrame(a, "a int, x double, y double"), spark.createDataFrame(b, "b int, x double, y double"), 0.1)
    assert {(r.a, r.b) for r in got.collect()} == want


def test_vectors(spark):
    rows = spark.createDataFrame([(i, [float(i % 5), float(i // 5)]) for i in range(25)] + [(99, None)], "id long, embedding array<float>")
    got = vectors.nearest_of_each(rows.where("id IN (0, 12)"), rows.where("id < 25"), 3, block=1).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.id) for r in got] == [(0, 0), (0, 1), (0, 5), (12, 12), (12, 7), (12, 11)]
    assert [r.id for r in vectors.nearest(rows.where("id < 25"), [0.0, 0.0], 2).collect()] == [0, 1]
    texts = spark.createDataFrame([("gold",), (None,)], "text string")
    assert [round(sum(x * x for x in r.embedding), 3) for r in vectors.embedded(texts, vectors.hash_embedder(8)).collect()] == [1.0, 0.0]
    with pytest.raises(ValueError):
        vectors.upsert(rows.where("id < 25"), spark.createDataFrame([(1, [1.0])], "id long, embedding array<float>"))


def test_skew_helpers(spark):
    rows = spark.createDataFrame([("h" if i % 3 else f"k{i}", i) for i in range(300)], "k string, i int")
    total = {(r.k, r.i): r.t for r in running_total(rows, ["k"], [F.col("i")], F.lit(1), F.floor(F.col("i") / 40), "t").collect()}
    seen: dict = {}
    for i in range(300):
        k = "h" if i % 3 else f"k{i}"
        assert total[(k, i)] == seen.get(k, 0)
        seen[k] = seen.get(k, 0) + 1
    few = spark.createDataFrame([("h", 1), ("k0", 2)], "k string, v int")
    assert salted_join(rows, few, ["k"]).count() == 201 and salted_join(rows, few, ["k"], "left").count() == 300


def test_registry_and_discovery(spark, tmp_path):
    reg = registry.registry(spark)
    assert reg.count() == 15 and registry.scrape_inventory(reg).count() == 9 and registry.arcgis_inventory(reg).count() == 2
    ready = registry.Scraper("NTGS", lambda: ["1", "2", "2"], lambda i: f"u/{i}")
    assert registry.pending_scrapers(reg, [ready, registry.Scraper("AB_AGS")]).count() == 8
    assert {tuple(r) for r in registry.scraped_reports(spark, ready).collect()} == {("1", "u/1"), ("2", "u/2")} and registry.scraped_reports(spark, registry.Scraper("AB_AGS")).count() == 0
    pages = [{"success": True, "result": {"count": 150, "results": [{"title": "Drill Hole data", "name": "n", "resources": [{"id": "1", "name": "", "format": ".CSV", "url": "u", "size": 5}]}, {"title": "Other", "resources": [{"id": "2"}]}]}}, {"success": True, "result": {"count": 150, "results": [{"title": "", "name": "drill hole", "resources": []}]}}]
    for start, page in zip((0, 100), pages):
        (tmp_path / f"page-{start}.json").write_text(json.dumps(page))
    src = [{"jurisdiction": "ON", "key": "ckan", "type": "ckan", "portal": str(tmp_path), "match": [("HOLES", ["drill hole"])]}]
    got = pipeline.discover(spark, ["on"], src).collect()
    assert [(r.code, r.resource_name, r.format, r.url) for r in got] == [("HOLES", "Drill Hole data", "csv", "u")]


def test_portal_that_gives_less_than_asked_for(spark, tmp_path):
    spark.dataSource.register(portals.CatalogSource)
    for start in range(0, 7, 2):
        page = {"success": True, "result": {"count": 7, "results": [{"title": f"t{k}", "resources": []} for k in range(start, min(start + 2, 7))]}}
        (tmp_path / f"page-{start}.json").write_text(json.dumps(page))
    for options in ({}, {"rows": "4", "tasks": "2"}, {"rows": "2", "tasks": "9"}):
        got = spark.read.format("portal_catalog").option("base", str(tmp_path)).options(**options).load()
        assert sorted(r.title for r in got.collect()) == [f"t{k}" for k in range(7)]


def test_layer_counts_in_the_inventory(spark, tmp_path):
    (tmp_path / "count.json").write_text('{"count": 5}')
    src = [{"jurisdiction": "SK", "key": "a", "type": "arcgis", "portal": "p/", "layers": {"L": str(tmp_path), "M": str(tmp_path / "none")}, "items": {"I": "7"}}]
    got = {r.code: (r.feature_count, r.url) for r in pipeline.discover(spark, None, src).collect()}
    assert got == {"L": (5, str(tmp_path)), "M": (None, str(tmp_path / "none")), "I": (None, "p/api/download/v1/items/7/geojson?layers=1")}


def test_feature_layer_with_short_pages(spark, tmp_path):
    make = lambda a, b: json.dumps({"features": [{"type": "Feature", "properties": {"i": i}, "geometry": None} for i in range(a, b)]})
    for start, text in ((0, make(0, 2)), (2, make(2, 4)), (4, make(4, 5))):
        (tmp_path / f"page-{start}.json").write_text(text)
    spark.dataSource.register(portals.LayerSource)
    assert spark.read.format("feature_layer").option("base", str(tmp_path)).load().count() == 5
    (tmp_path / "count.json").write_text('{"count": 5}')
    assert spark.read.format("feature_layer").option("base", str(tmp_path)).option("rows", "2").load().count() == 5
    assert spark.read.format("feature_layer").option("base", str(tmp_path)).options(rows="2", tasks="3").load().count() == 5


KML = '<kml xmlns="http://www.opengis.net/kml/2.2"><Document><Placemark><name>A</name><Point><coordinates>-80.5,48.25,0</coordinates></Point></Placemark></Document></kml>'


def test_files(spark, tmp_path):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("b.kml", KML)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("in.zip", inner.getvalue())
        z.writestr("c.geojson", json.dumps({"features": [{"properties": {"x": 1, "y": None}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}))
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    (tmp_path / "bad.kml").write_bytes(b"<no")
    (tmp_path / "t.csv").write_bytes("name,n\nCaf\xe9,1\n".encode("latin-1"))
    expanded = files.expand_archives(files.contents(spark, str(tmp_path)))
    got = {r.path.rsplit("/", 1)[-1]: r for r in files.features(expanded).collect()}
    assert (got["b.kml"].lon, got["b.kml"].properties["name"]) == (-80.5, "A") and got["c.geojson"].properties == {"x": "1", "y": None} and got["bad.kml"].properties is None
    assert expanded.where("content IS NULL").count() == 1
    assert files.read_table(spark, str(tmp_path / "t.csv")).head().asDict() == {"name": "Café", "n": 1}
    (tmp_path / "r.pdf").write_bytes(b"two pages")
    texts = files.report_texts(files.contents(spark, str(tmp_path), "*.pdf"), lambda data: data.decode().split())
    assert [(r.report_id, r.text) for r in texts.collect()] == [("r", "two\npages")]
    files.write_geojson(files.features(expanded).where("properties IS NOT NULL"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def wkb(shape, order="<", height=False, extended=False):
    import struct

    kinds = ["Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon", "GeometryCollection"]
    code = kinds.index(shape["type"]) + 1 + (0x80000000 if extended else 1000) * height

    def points(pairs):
        return b"".join(struct.pack(order + "dd", *p) + struct.pack(order + "d", 7.0) * height for p in pairs)

    def line(pairs):
        return struct.pack(order + "I", len(pairs)) + points(pairs)

    kind, inner = shape["type"], shape.get("coordinates", shape.get("geometries"))
    parts = inner if kind == "GeometryCollection" else [{"type": kind[5:], "coordinates": c} for c in inner]
    body = points([inner]) if kind == "Point" else line(inner) if kind == "LineString" else struct.pack(order + "I", len(inner)) + b"".join(map(line, inner) if kind == "Polygon" else (wkb(p, order, height, extended) for p in parts))
    return (b"\x01" if order == "<" else b"\x00") + struct.pack(order + "I", code) + body


def test_geometries_are_whole(spark, tmp_path):
    import sqlite3

    square, hole, line = [[0.0, 0.0], [9.0, 0.0], [9.0, 9.0], [0.0, 0.0]], [[2.0, 1.0], [3.0, 1.0], [3.0, 2.0], [2.0, 1.0]], [[1.0, 2.0], [3.0, 4.5]]
    shapes = [{"type": t, "coordinates": c} for t, c in [("Point", [1.5, 2.0]), ("LineString", line), ("Polygon", [square, hole]), ("MultiPoint", line), ("MultiLineString", [line, square]), ("MultiPolygon", [[square, hole], [hole]])]]
    shapes.append({"type": "GeometryCollection", "geometries": [shapes[0], shapes[5]]})
    for form in ({}, {"order": ">"}, {"height": True}, {"height": True, "extended": True}):
        assert [files._wkb(wkb(s, **form)) for s in shapes] == shapes
    assert files._wkb(wkb({"type": "Point", "coordinates": [float("nan")] * 2}))["coordinates"] == [] and files._wkb(b"\x01\x08\0\0\0\0\0\0\0") is None
    db = sqlite3.connect(tmp_path / "a.gpkg")
    db.execute("CREATE TABLE gpkg_geometry_columns (table_name, column_name)")
    db.execute("INSERT INTO gpkg_geometry_columns VALUES ('claims', 'geom')")
    db.execute("CREATE TABLE claims (id, geom)")
    db.executemany("INSERT INTO claims VALUES (?, ?)", [(str(k), b"GP\0\x01" + bytes(4) + wkb(s)) for k, s in enumerate(shapes)])
    db.commit()
    db.close()

    def ring(pairs, z=",5"):
        return "<LinearRing><coordinates>" + " ".join(f"{x},{y}{z}" for x, y in pairs) + "</coordinates></LinearRing>"

    poly = f"<Polygon><innerBoundaryIs>{ring(hole)}</innerBoundaryIs><outerBoundaryIs>{ring(square)}</outerBoundaryIs></Polygon>"
    point, track = "<Point><coordinates>1.5,2,0</coordinates></Point>", "<gx:Track><gx:coord>1 2 0</gx:coord><gx:coord>3 4.5 0</gx:coord></gx:Track>"
    multi = [f"<MultiGeometry>{x}</MultiGeometry>" for x in (poly + f"<Polygon><outerBoundaryIs>{ring(hole)}</outerBoundaryIs></Polygon>", f"{point}<MultiGeometry>{poly}</MultiGeometry>", "<Point><coordinates/></Point>")]
    marks = "".join(f"<Placemark><name>{k}</name>{x}</Placemark>" for k, x in enumerate([poly, *multi, track]))
    (tmp_path / "b.kml").write_text(f'<kml xmlns="http://www.opengis.net/kml/2.2" xmlns:gx="g"><Document>{marks}</Document></kml>')

    def way(tag, pairs):
        return "".join(f'<{tag} lon="{x}" lat="{y}"/>' for x, y in pairs)

    gpx = way("wpt", [[1.5, 2.0]]) + f"<rte><name>r</name>{way('rtept', line)}</rte><trk><name>t</name><trkseg>{way('trkpt', line)}</trkseg><trkseg>{way('trkpt', square)}</trkseg></trk>"
    (tmp_path / "c.gpx").write_text(f'<gpx xmlns="http://www.topografix.com/GPX/1/1">{gpx}</gpx>')
    got = {}
    for r in files.features(files.contents(spark, str(tmp_path))).collect():
        got.setdefault(r.path.rsplit("/", 1)[-1], []).append((r.properties, r.geometry and json.loads(r.geometry), r.lon))
    assert got["a.gpkg"] == [({"id": str(k)}, s, 1.5 if k == 0 else None) for k, s in enumerate(shapes)]
    mixed = {"type": "GeometryCollection", "geometries": [shapes[0], shapes[2]]}
    assert got["b.kml"] == [({"name": str(k)}, s, None) for k, s in enumerate([shapes[2], shapes[5], mixed, None, shapes[1]])]
    assert got["c.gpx"] == [({}, shapes[0], 1.5), ({"name": "r"}, shapes[1], None), ({"name": "t"}, shapes[4], None)]


def shapefile(code, bodies, fields, rows, deleted=()):
    """A .shp and its .dbf."""
    import struct

    out = b""
    for k, body in enumerate(bodies):
        body = struct.pack("<i", code if body else 0) + body
        out += struct.pack(">ii", k + 1, len(body) // 2) + body
    shp = struct.pack(">i", 9994) + bytes(20) + struct.pack(">i", (100 + len(out)) // 2) + bytes(72) + out
    width = 1 + sum(n for _, n in fields)
    head = bytes([3, 0, 0, 0]) + struct.pack("<IHH", len(rows), 33 + 32 * len(fields), width) + bytes(20)
    head += b"".join(name.encode().ljust(11, b"\0") + b"C" + bytes(4) + bytes([n]) + bytes(15) for name, n in fields) + b"\r"
    return shp, head + b"".join((b"*" if k in deleted else b" ") + b"".join(str(v).encode("latin-1").ljust(n) for v, (_, n) in zip(r, fields)) for k, r in enumerate(rows))


def test_shapefiles(spark, tmp_path):
    import struct

    box = bytes(32)
    ring = lambda pairs: b"".join(struct.pack("<dd", *p) for p in pairs)
    square, hole, far = [[0.0, 0.0], [0.0, 9.0], [9.0, 9.0], [9.0, 0.0], [0.0, 0.0]], [[1.0, 1.0], [2.0, 1.0], [2.0, 2.0], [1.0, 1.0]], [[20.0, 0.0], [20.0, 1.0], [21.0, 0.0], [20.0, 0.0]]
    many = lambda parts: box + struct.pack("<ii", len(parts), sum(map(len, parts))) + b"".join(struct.pack("<i", sum(map(len, parts[:k]))) for k in range(len(parts))) + b"".join(map(ring, parts))
    cases = {
        "p": (1, [ring([[1.5, 2.0]]), b""], [{"type": "Point", "coordinates": [1.5, 2.0]}, None]),
        "z": (11, [ring([[1.5, 2.0]]) + bytes(16)], [{"type": "Point", "coordinates": [1.5, 2.0]}]),
        "l": (3, [many([hole]), many([hole, far])], [{"type": "LineString", "coordinates": hole}, {"type": "MultiLineString", "coordinates": [hole, far]}]),
        "g": (5, [many([square, hole]), many([square, hole, far])], [{"type": "Polygon", "coordinates": [square, hole]}, {"type": "MultiPolygon", "coordinates": [[square, hole], [far]]}]),
        "m": (8, [box + struct.pack("<i", 2) + ring(hole[:2])], [{"type": "MultiPoint", "coordinates": hole[:2]}]),
    }
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for name, (code, bodies, _) in cases.items():
            shp, dbf = shapefile(code, bodies, [("NAME", 8), ("n", 3)], [(f"é{k}", k) for k in range(len(bodies))])
            z.writestr(f"x/{name}.shp", shp)
            z.writestr(f"x/{name}.DBF", dbf)
        z.writestr("x/p.prj", 'GEOGCS["GCS_North_American_1983",DATUM["D_North_American_1983"]]')
        shp, dbf = shapefile(1, [ring([[1.0, 2.0]]), ring([[3.0, 4.0]])], [("a", 2)], [("", ), ("b", )], deleted={1})
        z.writestr("y/d.shp", shp)
        z.writestr("y/d.dbf", dbf)
        z.writestr("y/u.shp", shp)
        z.writestr("y/u.prj", 'PROJCS["NAD83_UTM_17N",GEOGCS["GCS_North_American_1983"]]')
        z.writestr("y/bad.shp", b"1234567890")
        z.writestr("y/lone.dbf", dbf)
    got = {}
    for r in files.features(files.expand_archives(files.contents(spark, str(tmp_path)))).collect():
        got.setdefault(r.path.rsplit("/", 1)[-1], []).append((r.properties, r.geometry and json.loads(r.geometry)))
    for name, (_, _, want) in cases.items():
        assert got[f"{name}.shp"] == [({"NAME": f"é{k}", "n": str(k)}, w) for k, w in enumerate(want)]
    assert got["d.shp"] == [({"a": None}, {"type": "Point", "coordinates": [1.0, 2.0]})] and got["u.shp"] == got["bad.shp"] == [(None, None)] and "lone.dbf" not in got


def test_refresh_appends_only_changed_content(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k, sha in enumerate("AABA"):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps({"resource_id": "r", "sha256": sha, "fetched_at": f"t{k}"}))
        refresh.refresh(spark, str(tmp_path / "in"), str(tmp_path / "ledger"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "ledger")).orderBy("fetched_at").collect()
    assert [(r.sha256, r.fetched_at) for r in got] == [("A", "t0"), ("B", "t2"), ("A", "t3")]


def test_refresh_keeps_every_version_in_a_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    loads = ["B3 A0 A4 C5 B2 B6", "C6 D9 C7", "D8 A1 D9", "D9 E9"]
    for k, load in enumerate(loads):
        rows = [{"resource_id": r, "sha256": x[0], "fetched_at": f"t{x[1]}", "local_path": x} for x in load.split() for r in "rs"]
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(map(json.dumps, [*rows, {"resource_id": "n", "fetched_at": f"t{k}"}])))
        refresh.refresh(spark, str(tmp_path / "in"), str(tmp_path / "ledger"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "ledger"))
    for r in "rs":
        assert sorted(x.local_path for x in got.where(f"resource_id = '{r}'").collect()) == sorted(["A0", "B2", "A4", "C5", "B6", "C6", "D8", "D9", "E9"])
    assert got.where("resource_id = 'n'").count() == 1


def test_core_does_not_need_llm():
    import subprocess
    import sys

    code = "import sys; sys.modules['strata.llm'] = None\nimport strata.plans.core_queries, strata.plans.data_queries, strata.plans.pipeline, strata.streaming.refresh; assert not [m for m in sys.modules if m.startswith('strata.llm.')]"
    assert subprocess.run([sys.executable, "-c", code], cwd=__file__.rsplit("/tests", 1)[0]).returncode == 0


def test_extractors_read_the_whole_unaltered_text(spark, tmp_path):
    import re

    from strata.plans import core_queries

    nts = re.compile(r"\b(\d{2}[A-Z](?:\/\d{1,2})?(?:\s*[A-Za-z]?\d{0,2})?)\b")
    owner = re.compile(r"(?:COMPANY|CLIENT|PROPERTY\s+OF|SUBMITTED\s+BY|OWNER|OPERATOR)\s*[:;]?\s*(.+?)(?:\n|$)", re.I | re.M)
    metal = re.compile(r"\b(gold|zinc|tin|rare\s*earth)\b", re.I)
    fill = "é word " * 600
    ends = ["sheet 31B/5\nOWNER: Société Minière Ltée.\nzinc, rare earth; a magnetometer survey", "étin 42A/1é 42A gold\nOPERATOR: Éric.\nassay", "nothing"]
    rows = [(f"{k}{j}", None, start + " " + end) for k, end in enumerate(ends) for j, start in enumerate(["", fill])] + [("n", None, None)]
    spark.createDataFrame(rows, "id string, company string, chunk_text string").write.parquet(str(tmp_path / "rag_chunk.parquet"))

    def of(query):
        return {r[0]: r[1] for r in core_queries.QUERIES[f"q_extract_{query}"](spark, str(tmp_path)).collect()}

    texts = {i: t or "" for i, _, t in rows}
    assert of("nts") == {i: (nts.findall(t) or [""])[0] for i, t in texts.items()}
    assert of("company") == {i: next((c for c in (m.strip().rstrip(".") for m in owner.findall(t)) if c and len(c) < 100), "") for i, t in texts.items()}
    assert of("commodities") == {i: "|".join(sorted({m.lower() for m in metal.findall(t)})) for i, t in texts.items()}
    kinds = {"0": "assessment_report_geophys", "1": "assessment_report_drill"}
    assert of("report_type") == {i: kinds.get(i[0], GENERAL) for i in texts}
