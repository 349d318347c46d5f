"""Dumps, packets and patch files on small folders."""

import io
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalens.sources import catalog_dump, dumps
from catalens.sources.shared import write_files
from catalens.streaming import patches


@pytest.fixture
def dump(tmp_path):
    (tmp_path / "plants_to_update.json").write_text(json.dumps({"count": 2, "list": ["Acer a", "Rosa b"]}))
    (tmp_path / "plants_headers.json").write_text(json.dumps({str(i): {"name": f"n{i}"} for i in range(5)}, indent=2))
    (tmp_path / "apg_iv_v3.json").write_text("{broken")
    (tmp_path / "translations/de.json").mkdir(parents=True)
    (tmp_path / "translations/en.json").write_text('{"Acer a": {"label": "x"}}')
    for i, key in enumerate(("Acer a", "Rosa b")):
        (tmp_path / f"translations/de.json/part-{i}").write_text(json.dumps({key: {"label": f"d{i}"}}))
    (tmp_path / "translations/de.json/_SUCCESS").write_text("")
    return tmp_path


def test_dump_plans_only_the_files_of_its_stages(dump):
    named = lambda stages, **o: [f[0] + (f":{f[1]}" if f[1] else "") for p in catalog_dump.DumpReader({"path": str(dump), "stages": stages, **o}).partitions() for f in p.files]
    assert named("") == ["list"] and named("counts") == ["list", "headers"]
    assert named("search") == ["list", "translations:de", "translations:de", "translations:en"]
    assert "taxonomy" in named("photo") and "taxonomy" not in named("counts,search,web")
    assert len(catalog_dump.DumpReader({"path": str(dump), "stages": "web", "taskBytes": "1"}).partitions()) == 5
    with pytest.raises(ValueError, match="unknown stages: maps"):
        named("maps")


def test_dump_rows(spark, dump):
    rows = catalog_dump.scan_catalog_dump(spark, str(dump), ["counts", "search", "web"])  # the broken file stays unopened
    assert sorted(map(tuple, catalog_dump.listed_items(rows).collect())) == [(0, "Acer a"), (1, "Rosa b")]
    assert [r.name for r in catalog_dump.node_records(rows, "headers", "name string").orderBy("pos").collect()] == [f"n{i}" for i in range(5)]
    spoken = catalog_dump.node_records(rows, "translations", "label string").orderBy("lang", "pos").collect()
    assert [(r.lang, r.key, r.label) for r in spoken] == [("de", "Acer a", "d0"), ("de", "Rosa b", "d1"), ("en", "Acer a", "x")]
    assert catalog_dump.node_records(rows, "details", "name string").count() == 0  # missing, but not required


def test_dump_lacks_a_required_file(spark, dump):
    (dump / "plants_headers.json").unlink()
    assert catalog_dump.scan_catalog_dump(spark, str(dump), ["search"]).count() > 0
    with pytest.raises(Exception, match="missing .*plants_headers.json"):
        catalog_dump.scan_catalog_dump(spark, str(dump), ["web"]).count()
    with pytest.raises(Exception, match="apg_iv_v3.json"):  # opened by its own stage
        catalog_dump.scan_catalog_dump(spark, str(dump), ["photo"]).count()


def test_dump_bundle_and_lists(spark, dump):
    (dump / "translations.json").write_text('{"fr": {"Acer a": {"label": "f"}}, "it": {}}')
    (dump / "plants_to_update.json").write_text('{"1": "b", "0": "a", "count": 2}')
    rows = catalog_dump.scan_catalog_dump(spark, str(dump), ["search"])
    assert [(r.lang, r.key, r.label) for r in catalog_dump.node_records(rows, "translations", "label string").collect()] == [("fr", "Acer a", "f")]
    assert sorted(map(tuple, catalog_dump.listed_items(rows).collect())) == [(0, "a"), (1, "b")]


values = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=9), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=4), x, max_size=3), max_leaves=8)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.dictionaries(st.text(max_size=5), values, max_size=5), max_size=3), st.integers(1, 40), st.sampled_from([None, 1]), st.booleans())
def test_entries_in_pieces(objects, piece, indent, ascii_):
    text = "\n".join(json.dumps(o, indent=indent, ensure_ascii=ascii_) for o in objects)
    assert [(k, json.loads(v)) for k, v in catalog_dump.json_entries_of(io.StringIO(text), piece)] == [(k, v) for o in objects for k, v in o.items()]


@pytest.mark.parametrize("text", ["{", '{"a"', '{"a":', '{"a":1', '{"a":1 "b":2}', "[1", "[1,]", "7", '{"a":tru}'])
def test_broken_entries(text):
    with pytest.raises(ValueError):
        list(catalog_dump.json_entries_of(io.StringIO(text), 2))


def test_patch_files_are_read_once(spark, tmp_path):
    folder, out, done = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "done")
    folder.mkdir()
    (folder / "12_Acer_x.json").write_text('{"label": "l"}')
    (folder / "13_Rosa_é.json").write_text('{"label": " "}')
    (folder / "x_Rosa.json").write_text("no json")
    (folder / "_14_Tilia.json").write_text('{"label": "hidden"}')

    def run():
        patches.stream_patch_files(spark, str(folder), "label string", ["label"], out, done).awaitTermination()
        return [sorted([(r.item_id, r.latin, tuple(r.lacking), r.batch) for r in df.collect()], key=repr) for df in patches.patches_so_far(spark, out)]

    first = run()
    assert first[0] == [(12, "Acer x", (), 0)] and first[1] == [(13, "Rosa é", ("label",), 0), (None, "Rosa", ("id", "label"), 0)]
    assert run() == first
    (folder / "15_Malus_y.json").write_text('{"label": "new"}')
    second = run()
    assert second[0] == [(12, "Acer x", (), 0), (15, "Malus y", (), 1)] and second[1] == first[1]


def test_empty_patch_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    patches.stream_patch_files(spark, str(tmp_path / "in"), "label string", ["label"], str(tmp_path / "out"), str(tmp_path / "done")).awaitTermination()
    assert [df.count() for df in patches.patches_so_far(spark, str(tmp_path / "out"))] == [0, 0]


def test_packets_from_one_scan(spark, tmp_path):
    files = [
        ("Acer a+b é/job.json", '{"name": "Acer"}'), ("Acer a+b é/header.json", '{"family": "F"}'), ("Acer a+b é/translations/en.json", '{"label": "maple"}'), ("Acer a+b é/translations/job.json", '{"label": "odd"}'),
        ("Acer a+b é/notes.json", "{}"), ("Rosa/job.json", '{"name": "Rosa"}'), ("Rosa/header.json", "{no"), ("Rosa/media/list.json", "[]"),
    ]
    assert write_files(spark.createDataFrame(files, "path string, body string"), str(tmp_path)) == len(files)
    found = dumps.scan_job_packets(spark, str(tmp_path), {"job": "name string", "header": "family string", "extra": "x int"}, "label string", optional=("extra",))
    rows = {r.packet: r for r in found.filter("job is not null").collect()}
    assert set(rows) == {"Acer a+b é", "Rosa"}
    acer, rosa = rows["Acer a+b é"], rows["Rosa"]
    assert (acer.job.name, acer.header.family, acer.lacking, acer.extra) == ("Acer", "F", [], None) and {k: v.label for k, v in acer.translations.items()} == {"en": "maple", "job": "odd"}
    assert (rosa.header, rosa.lacking, rosa.translations) == (None, ["header"], {})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
    assert found.select(F.count("*")).first()[0] == 2


def test_files_are_dealt_before_they_are_written(spark, tmp_path, monkeypatch):
    files = spark.createDataFrame([(f"a{i % 3}/b{i}.json", str(i)) for i in range(60)], "path string, body string").coalesce(1)
    kind, parts = type(files), []
    pipe = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda df, *a: parts.append(df.rdd.getNumPartitions()) or pipe(df, *a))
    assert write_files(files, str(tmp_path)) == 60 and parts == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
    assert {(f"{p.parent.name}/{p.name}", p.read_text()) for p in tmp_path.glob("*/*.json")} == {tuple(r) for r in files.collect()}


def most_tasks(spark, group):
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    return max(tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds if tracker.getStageInfo(s))


def test_packet_folders_are_listed_together(spark):
    from catalens.plans import sources

    spark.sparkContext.setJobGroup("packets", "packets")
    assert sources.scan_job_packets(spark, "/root/testdata/sf0.01").count() == 100
    spark.sparkContext.setJobGroup("", "")
    assert most_tasks(spark, "packets") < 50


def test_patch_files_are_listed_together(spark, monkeypatch):
    from catalens.plans import sources

    runs, stream = [], patches.stream_patch_files
    monkeypatch.setattr(patches, "stream_patch_files", lambda *a: runs.append(stream(*a)) or runs[-1])
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    assert sources.scan_patch_dir(spark, "/root/testdata/sf0.01").count() == 85 and spark.conf.get(key) == before
    assert max(most_tasks(spark, str(q.runId)) for q in runs) < 50
