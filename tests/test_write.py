import hashlib
import io
import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import search, vectors
from strata.plans import harvest, process
from strata.sources import registry

INVENTORY = "jurisdiction string, connector string, code string, dataset string, resource_id string, resource_name string, format string, url string, last_modified string, size long, license string, portal string, feature_count int, note string"


def offered(spark, rows):
    made = [(j, c, code, code, rid, name, fmt, url, mod, None, None, "p", None, None) for j, c, code, rid, name, fmt, url, mod in rows]
    return spark.createDataFrame(made, INVENTORY)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """A lake folder after two harvests of canned files."""
    base = tmp_path_factory.mktemp("lake")
    web, root = base / "web", str(base / "root")
    web.mkdir()
    (web / "holes.csv").write_bytes("COMPANY,Depth\nCaf\xe9 Gold,12\nNorth Copper,7\n".encode("latin-1"))
    (web / "empty.csv").write_text("A,B\n")
    (web / "claims.tsv").write_text("TITLE\tn\nGold claim\t1\n")
    with zipfile.ZipFile(web / "a.zip", "w") as z:
        z.writestr("deep/points.geojson", json.dumps({"features": [{"properties": {"NAME": "gold vein", "x": 1}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}))
        z.writestr("deep/utm.geojson", json.dumps({"crs": {"properties": {"name": "EPSG:26917"}}, "features": [{"properties": {}, "geometry": None}]}))
        z.writestr("holes.csv", "MINERAL,k\npyrite,3\n")
    (web / "layer").mkdir()
    for start, ks in ((0, (0, 1)), (2, (2,))):
        (web / "layer" / f"page-{start}.json").write_text(json.dumps({"features": [{"type": "Feature", "properties": {"i": k}, "geometry": None} for k in ks]}))
    rows = [
        ("ON", "ckan", "ON_HOLES", "1", "holes", "csv", f"file://{web}/holes.csv", "m1"), ("ON", "ckan", "ON_HOLES", "2", "holes", "csv", f"file://{web}/empty.csv", None),
        ("BC", "ckan", "BC_X", "3", "claims", "tsv", f"file://{web}/claims.tsv", "m1"), ("BC", "ckan", "BC_X", "4", "a.zip", ".ZIP", f"file://{web}/a.zip", "m1"),
        ("BC", "arcgis_layer", "BC_L", "BC_L", "BC_L", "geojson", str(web / "layer"), ""), ("BC", "ckan", "BC_X", "5", "gone", "csv", f"file://{web}/gone.csv", "m1"),
        ("BC", "scrape", "BC_P", None, None, "pdf", None, None), ("BC", "ckan", "BC_X", "6", "pic", "doc", f"file://{web}/x.doc", "m1"),
    ]
    inventory = offered(spark, rows)
    first = harvest.run(spark, root, inventory, "2024-01-01", "2024-01-01T00:00:00").head()
    (web / "holes.csv").write_bytes("COMPANY,Depth\nCaf\xe9 Gold,12\nNorth Copper,7\nEast Zinc,9\n".encode("latin-1"))
    again = offered(spark, [(*r[:7], "m2" if r[3] in "123" else r[7]) for r in rows if r[3]])
    second = harvest.run(spark, root, again, "2024-01-02", "2024-01-02T00:00:00").head()
    return spark, root, web, first, second


def test_harvest(lake):
    spark, root, web, first, second = lake
    assert tuple(first) == (5, 0, 1, 1) and tuple(second) == (1, 4, 1, 0)
    rows = {(r.resource_id, r.snapshot_date): r for r in harvest.ledger_of(spark, root).collect()}
    new = rows[("1", "2024-01-02")]
    assert new.local_path == f"{root}/raw/ON/ON_HOLES/2024-01-02/holes.csv" and len(rows) == 6
    data = open(new.local_path, "rb").read()
    assert new.sha256 == hashlib.sha256(data).hexdigest() and new.size_bytes == len(data) and b"East Zinc" in data
    assert rows[("2", "2024-01-01")].local_path.endswith("/2_holes.csv")
    assert len(json.load(open(rows[("BC_L", "2024-01-01")].local_path))["features"]) == 3
    told = spark.read.parquet(f"{root}/provenance").where("resource_id = '1'").collect()
    assert sorted(json.loads(r.source)["last_modified"] for r in told) == ["m1", "m2"]


def test_process_and_index(lake):
    spark, root, *_ = lake
    got = {(r.table_name, r.status, r.n) for r in process.process(spark, root, harvest.ledger_of(spark, root)).collect()}
    assert got == {
        ("ON__ON_HOLES__holes", "loaded", 3), ("ON__ON_HOLES__2_holes", "empty", 0), ("BC__BC_X__claims", "loaded", 1), ("BC__BC_X__holes", "loaded", 1),
        ("BC__BC_X__points", "loaded", 1), ("BC__BC_X__utm", "failed", 0), ("BC__BC_L__BC_L", "loaded", 3),
    }
    names = process.build_index(spark, root)
    assert set(names) == {"ON__ON_HOLES__holes", "BC__BC_X__claims", "BC__BC_X__holes", "geo_BC__BC_X__points", "geo_BC__BC_L__BC_L", "resources"}
    assert spark.table("geo_BC__BC_X__points").head().asDict() == {"NAME": "gold vein", "x": "1", "geometry": '{"type": "Point", "coordinates": [1, 2]}', "lon": 1.0, "lat": 2.0}
    assert spark.table("ON__ON_HOLES__holes").agg(F.max("Depth")).head()[0] == 12 and spark.table("resources").count() == 6
    hits = [(r.source_table, r.text) for r in process.search_lake(spark, root, "Gold", 10).collect()]
    assert sorted(hits) == [("BC__BC_X__claims", "Gold claim"), ("ON__ON_HOLES__holes", "Café Gold"), ("geo_BC__BC_X__points", "gold vein")]
    assert process.search_lake(spark, root, "nothing there", 10).count() == 0


def test_workbooks(spark, tmp_path):
    book = io.BytesIO()
    cells = '<row><c r="A1" t="inlineStr"><is><t>id</t></is></c><c r="B1" t="inlineStr"><is><t>ID</t></is></c></row><row><c r="A2"><v>5</v></c></row>'
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="m"><sheetData>{cells}</sheetData></worksheet>')
    (tmp_path / "b.xlsx").write_bytes(book.getvalue())
    assert [r.asDict() for r in process._sheet(spark, str(tmp_path / "b.xlsx")).collect()] == [{"id": "5", "ID_2": None}]


def test_stored_index_ranks_as_a_scan_does(spark, tmp_path):
    import random

    rnd = random.Random(2)
    docs = spark.createDataFrame([(k, " ".join(rnd.choice(["gold", "vein", "rock", "Öre", "x"]) for _ in range(rnd.randrange(0, 30)))) for k in range(300)] + [(999, None)], "id long, text string")
    search.write_index(docs, ["id"], str(tmp_path / "i"))
    for query in ("gold", "GOLD vein öre", "missing", ""):
        want = [(r.id, r.score) for r in search.bm25(docs, query, ["id"], limit=20).collect()]
        assert [(r.id, r.score) for r in search.ranked(spark, str(tmp_path / "i"), query, ["id"], 20).collect()] == want
    plan = search.ranked(spark, str(tmp_path / "i"), "gold", ["id"])._jdf.queryExecution().toString()
    assert "folder#" in plan.split("PartitionFilters: ")[1][:60] and "term,gold" in plan.split("PushedFilters: ")[1][:80]


STEMS = (
    "caresses:caress ponies:poni ties:ti caress:caress cats:cat feed:feed agreed:agre plastered:plaster bled:bled motoring:motor sing:sing conflated:conflat troubled:troubl sized:size hopping:hop tanned:tan falling:fall "
    "hissing:hiss fizzed:fizz failing:fail filing:file happy:happi sky:sky relational:relat conditional:condit rational:ration digitizer:digit operator:oper feudalism:feudal decisiveness:decis hopefulness:hope formality:formal "
    "sensitivity:sensit triplicate:triplic formative:form electrical:electr hopeful:hope goodness:good revival:reviv allowance:allow inference:infer airliner:airlin adjustable:adjust defensible:defens irritant:irrit "
    "replacement:replac adjustment:adjust dependent:depend adoption:adopt communism:commun activate:activ effective:effect rate:rate cease:ceas controll:control roll:roll"
)


def test_stems(spark, tmp_path):
    from strata.functions import english

    for pair in STEMS.split():
        word, want = pair.split(":")
        assert english.stem(word) == want, word
    docs = spark.createDataFrame([(1, "The mines of Québec"), (2, "a mining company"), (3, None), (4, "of the and")], "id long, text string")
    search.write_index(docs, ["id"], str(tmp_path / "i"), analyze=english.terms)
    find = lambda q: sorted(r.id for r in search.ranked(spark, str(tmp_path / "i"), q, ["id"], analyze=english.terms).collect())
    assert find("mined") == [1, 2] and find("quebec") == [1] and find("of the") == []


def test_collection(spark, tmp_path):
    store = vectors.Collection(spark, str(tmp_path / "c"), buckets=4)
    embed = vectors.hash_embedder(16)
    make = lambda rows: vectors.embedded(spark.createDataFrame(rows, "id string, text string, jurisdiction string"), embed)
    store.upsert(make([("1", "gold vein", "ON"), ("2", "silver", "BC"), ("3", "gold", "BC")]))
    store.upsert(make([("2", "copper", "BC"), ("4", "gold vein deep", "ON"), ("4", "other", "ON")]), [F.col("text")])
    assert {(r.id, r.text) for r in store.rows().collect()} == {("1", "gold vein"), ("2", "copper"), ("3", "gold"), ("4", "gold vein deep")}
    top = store.search("gold", embed, 1).head()
    assert top.id == "3" and abs(top.score - 1) < 1e-6 and [r.id for r in store.search("gold", embed, 5, {"jurisdiction": "ON"}).collect()] == ["1", "4"]
    with pytest.raises(ValueError):
        store.upsert(vectors.embedded(spark.createDataFrame([("9", "x", "ON")], "id string, text string, jurisdiction string"), vectors.hash_embedder(8)))
    assert store.rows().count() == 4


def test_embedders(monkeypatch):
    asked = []

    def send(url, body, timeout):
        asked.append(max(map(len, body["input"])))
        return (400, "input exceeds the context length") if asked[-1] > 700 else (200, json.dumps({"embeddings": [[3.0, 4.0]] * len(body["input"])}))

    remote = vectors.remote_embedder("http://h/", "m", send=send)
    with pytest.raises(ValueError):
        remote(["x" * 900])
    assert remote(["x" * 600]).tolist() == [[3.0, 4.0]]
    with pytest.raises(RuntimeError):
        vectors.remote_embedder("http://h", "m", send=lambda *_: (500, "down"))(["x"])

    def encode(texts):
        if sum(map(len, texts)) > 450 or any("bad" in t[:100] for t in texts):
            raise RuntimeError("too much")
        return np.array([[3.0, 4.0]] * len(texts))

    local = vectors.local_embedder(encode, 2)
    assert np.allclose(local(["a" * 1400, "b"]), [[0.6, 0.8]] * 2) and np.allclose(local(["bad", "b"]), [[0, 0], [0.6, 0.8]])
    makers = {"remote": lambda m: m + "r", "local": lambda m: m + "l"}
    assert vectors.backend(makers, "local", "m") == "ml"
    monkeypatch.setenv("EMBEDDING_BACKEND", "remote")
    assert vectors.backend(makers, "local", "m") == "mr"


def test_reports(spark, tmp_path):
    web, root = tmp_path / "web", str(tmp_path / "root")
    web.mkdir()
    body = "COMPANY: Acme Gold.\n\n" + "The drill hole was long. " * 20
    for name, text in (("7", body), ("8", ""), ("9", "broken")):
        (web / f"{name}.pdf").write_text(text)
    scraper = registry.Scraper("BC_ARIS_PDF", lambda: ["7", "8", "9", "missing"], lambda i: f"file://{web}/{i}.pdf")
    assert tuple(harvest.run_reports(spark, root, registry.Scraper("AB_AGS"), "2024-01-01", "t").head()) == (0, 0, 0, 1)
    assert tuple(harvest.run_reports(spark, root, scraper, "2024-01-01", "2024-01-01T00").head()) == (3, 0, 1, 0)
    assert tuple(harvest.run_reports(spark, root, scraper, "2024-01-02", "2024-01-02T00").head()) == (0, 0, 1, 0)
    row = harvest.ledger_of(spark, root).where("resource_id = 'BC_ARIS_PDF:7'").head()
    assert row.jurisdiction == "BC" and row.local_path == f"{root}/raw/BC/BC_ARIS_PDF/2024-01-01/7.pdf"

    def extractor(data):
        if data == b"broken":
            raise ValueError("no pages")
        return [data.decode()]

    store = vectors.Collection(spark, str(tmp_path / "c"), buckets=2)
    embed = vectors.hash_embedder(8)
    assert tuple(harvest.ingest_reports(spark, root, "BC_ARIS_PDF", extractor, embed, store, dry_run=True).head()) == (3, 3, 0, 0, 0) and store.rows() is None
    assert tuple(harvest.ingest_reports(spark, root, "BC_ARIS_PDF", extractor, embed, store, {"nts_sheet": "42A"}).head()) == (3, 1, 1, 1, 1)
    got = store.rows().head()
    assert (got.company, got.nts_sheet, got.doc_type, got.report_id) == ("Acme Gold", "42A", "assessment_report_drill", "7")


def test_command_line(lake, capsys, monkeypatch, tmp_path):
    from strata.plans import pipeline

    spark, root, *_ = lake
    for command in (["process"], ["index"], ["search", "gold"]):
        pipeline.main([*command, "--root", root])
    assert "Café Gold" in capsys.readouterr().out
    pages = tmp_path / "portal"
    pages.mkdir()
    (pages / "data.csv").write_text("NAME,n\nsilver,1\n")
    (pages / "page-0.json").write_text(json.dumps({"success": True, "result": {"count": 1, "results": [{"title": "Drill hole", "resources": [{"id": "1", "name": "d", "format": "CSV", "url": f"file://{pages}/data.csv"}]}]}}))
    monkeypatch.setattr(registry, "SOURCES", [{"jurisdiction": "ON", "key": "k", "type": "ckan", "portal": str(pages), "match": [("HOLES", ["drill"])]}])
    other = str(tmp_path / "other")
    for command in (["discover"], ["discover", "--json"], ["update"], ["plan"], ["harvest"], ["search", "silver"]):
        pipeline.main([*command, "--root", other])
    out = capsys.readouterr().out
    assert "csv ? HOLES :: d" in out and '"resource_id":"1"' in out and "|silver" in out and "|0      |0      |" not in out.split("fetched")[1][:200]
    pipeline.collection_of(spark, root).upsert(vectors.embedded(spark.createDataFrame([("1", "gold vein", "ON"), ("2", "gold", "BC")], "id string, text string, jurisdiction string"), vectors.hash_embedder()))
    pipeline.main(["query", "gold", "--root", root, "--backend", "hash", "--filter", '{"jurisdiction": "ON"}'])
    out = capsys.readouterr().out
    assert "gold vein" in out and "|2 " not in out
