"""Readers, writers and load checks on small files."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortlens.session import Workspace, shared_folder
from cohortlens.sources import catalog, loadchecks, readers, writers
from cohortlens.sources.schemas import RAW_PART_D, RAW_REGISTRY, REGISTRY_HEADERS, all_text


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_raw_csv_is_text_with_doubled_quotes(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'Id,Name,Amount\n01,"O""Neil, Ann",1.50\n02,,*\n')
    rows = readers.read_raw_csv(spark, path).collect()
    assert [tuple(r) for r in rows] == [("01", 'O"Neil, Ann', "1.50"), ("02", None, "*")]


def test_short_and_long_rows_are_tolerated(spark, tmp_path):
    path = put(tmp_path / "a.csv", "a,b,c\n1,2\n1,2,3,4\n")
    rows = readers.read_raw_csv(spark, path, all_text("abc")).collect()
    assert [tuple(r) for r in rows] == [("1", "2", None), ("1", "2", "3")]


@pytest.mark.parametrize("multi_line", [False, True])
def test_unbalanced_quotes_abort(spark, tmp_path, multi_line):
    path = put(tmp_path / "a.csv", 'a,b\n1,x\n2,"open\n3,y\n')
    with pytest.raises(readers.BrokenQuotes, match="unbalanced"):
        readers.load_raw(spark, path, all_text("ab"), multi_line=multi_line)
    with pytest.raises(readers.BrokenQuotes):
        readers.read_glob(spark, str(tmp_path / "*.csv"), multi_line=multi_line)


def test_line_breaks_inside_quotes_are_one_row_or_an_error(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'a,b\n1,"x\ny"\n2,"say ""hi"""\n3\n')
    rows = readers.read_raw_csv(spark, path, all_text("ab"), multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("1", "x\ny"), ("2", 'say "hi"'), ("3", None)]
    assert readers.read_glob(spark, str(tmp_path / "*.csv"), multi_line=True).count() == 3
    with pytest.raises(readers.BrokenQuotes, match="multi_line=True"):
        readers.read_raw_csv(spark, path, all_text("ab"))


def test_header_gives_the_schema_in_lower_case(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'Rndrng_NPI,"HCPCS, Cd",Tot_Srvcs\n1,2,3\n')
    schema = readers.schema_from_header(spark, path)
    assert schema.names == ["rndrng_npi", "hcpcs, cd", "tot_srvcs"]
    assert {f.dataType.simpleString() for f in schema} == {"string"}


def test_fixed_schemas():
    assert len(RAW_PART_D) == 22
    assert len(RAW_REGISTRY) == 14
    assert list(REGISTRY_HEADERS) == RAW_REGISTRY.names


def test_load_normalises_and_stamps(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'NPI,Tot\n" 7 ",*\n8,NULL\n9," 3"\n')
    df = readers.load_raw(spark, path)
    assert [tuple(r) for r in df.select("npi", "tot").collect()] == [("7", None), ("8", None), ("9", "3")]
    assert df.filter(F.col("_loaded_at").isNull()).count() == 0


def test_glob_leaves_the_header_file_out(spark, tmp_path):
    put(tmp_path / "npidata_1.csv", "NPI,Kind\n1,a\n")
    put(tmp_path / "npidata_2.csv", "NPI,Kind\n2,b\n")
    put(tmp_path / "npidata_fileheader.csv", "NPI,Kind\nx,y\n")
    df = readers.read_glob(spark, str(tmp_path / "npidata_*.csv"))
    assert sorted(r.NPI for r in df.collect()) == ["1", "2"]


def test_registry_prefilter(spark):
    wide = all_text([*REGISTRY_HEADERS.values(), "Unused Column"])
    blank = dict.fromkeys(wide.names)

    def row(npi, kind, deactivated):
        return {**blank, "NPI": npi, "Entity Type Code": kind, "NPI Deactivation Date": deactivated}

    rows = [row("1", "1", None), row("2", "1", ""), row("3", "1", "01/01/2020"), row("4", "2", None)]
    df = readers.prefilter_registry(spark.createDataFrame(rows, wide))
    assert df.columns == RAW_REGISTRY.names
    assert sorted(r.npi for r in df.collect()) == ["1", "2"]


def test_seed_types_are_pinned(spark, tmp_path):
    path = put(tmp_path / "seed.csv", "code,name\n0012,Cardiology\n")
    row, = readers.read_seed(spark, path, all_text(("code", "name"))).collect()
    assert row.code == "0012"


def test_catalog_document(spark, tmp_path):
    def file(title, url=None, access=None):
        return {"title": title, "downloadURL": url, "accessURL": access, "mediaType": "text/csv", "description": "d" * 300}

    document = {
        "dataset": [
            {"title": " Drugs ", "modified": "2026-01-01", "distribution": [
                file("Drugs : 2022-12-01", "https://x/22.csv"),
                file("Drugs : 2023-12-01", None, " https://x/23.csv "),
                file("Drugs : 2024-12-01", "https://x/24.zip"),
                file("Drugs, no year", "https://x/none.csv"),
            ]},
            {"title": "Notes", "modified": "2026-02-02", "distribution": [file("Notes", "https://x/n.csv")]},
            {"title": "Empty", "modified": "2026-02-02", "distribution": [file("Empty : 2024-01", "https://x/e.zip")]},
        ]
    }
    path = put(tmp_path / "data.json", json.dumps(document, indent=1))
    datasets = catalog.read_catalog(spark, path)
    got = {r.dataset_title: r for r in catalog.latest_distribution(datasets).collect()}
    assert set(got) == {"Drugs", "Notes"}
    assert (got["Drugs"].data_year, got["Drugs"].csv_url) == (2023, "https://x/23.csv")
    assert got["Notes"].data_year is None
    assert len(got["Drugs"].description) == 200
    keyed = catalog.latest_distribution(datasets, {"part_d": "Drugs"}).collect()
    assert [r.key for r in keyed] == ["part_d"]
    for absent in ("Missing", "Empty"):
        asked = catalog.latest_distribution(datasets, {"part_d": "Drugs", "other": absent})
        with pytest.raises(Exception, match="no CSV distribution for other"):
            asked.collect()
        with pytest.raises(Exception, match="no CSV distribution for other"):
            asked.select("key").filter("key = 'other'").count()


@pytest.mark.parametrize(
    ("now", "status"), [("2024-03-01", "ok"), ("2024-03-02", "warn"), ("2024-06-29", "warn"), ("2024-06-30", "error")]
)
def test_freshness_limits(spark, now, status):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("2023-01-01 00:00:00",)], "t string")
    row, = loadchecks.source_freshness(df, "t", loadchecks.MONTHLY, f"{now} 23:00:00").collect()
    assert row.status == status


def test_an_empty_source_is_not_fresh(spark):
    df = spark.createDataFrame([], "t timestamp")
    assert loadchecks.source_freshness(df, "t", loadchecks.YEARLY, "2024-01-01").collect()[0].status == "error"


def test_load_validation(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, t int")
    row, = loadchecks.validate_load({"x": (df, "k", "t")}).collect()
    assert tuple(row) == ("x", 3, 1, 1, 1, 3)


def test_namespaces():
    assert writers.resolve_namespace("marts", "dev") == "marts"
    assert writers.resolve_namespace(" marts ", "dev") == "marts"
    assert writers.resolve_namespace(None, " dev ") == "dev"


def test_table_is_replaced(spark, tmp_path):
    for n in (5, 2):
        found = writers.write_table(spark.range(n).toDF("id"), str(tmp_path), "marts", "t")
        assert found.count() == n
    assert (tmp_path / "marts" / "t").is_dir()


def test_a_write_that_fails_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path)
    writers.write_table(spark.range(5).toDF("id"), root, "marts", "t")
    broken = spark.range(100, numPartitions=4).select(F.when(F.col("id") < 60, F.col("id")).otherwise(F.raise_error(F.lit("killed"))).alias("id"))
    with pytest.raises(Exception, match="killed"):
        writers.write_table(broken, root, "marts", "t")
    assert writers.read_table(spark, root, "marts", "t").count() == 5
    assert len(writers.table_versions(spark, f"{root}/marts/t")) == 1
    with pytest.raises(LookupError):
        writers.read_table(spark, root, "marts", "none")


def test_readers_of_the_previous_version_can_finish(spark, tmp_path):
    first = writers.write_table(spark.range(5).toDF("id"), str(tmp_path), None, "t", keep=2)
    second = writers.write_table(first.filter("id > 1"), str(tmp_path), None, "t", keep=2)
    assert (first.count(), second.count()) == (5, 3)
    third = writers.write_table(second.filter("id > 2"), str(tmp_path), None, "t", keep=2)
    assert (second.count(), third.count()) == (3, 2)
    assert len(writers.table_versions(spark, f"{tmp_path}/dev/t")) == 2
    assert len(list((tmp_path / "dev" / "t").glob("data-*"))) == 2


def test_an_extract_that_fails_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "extract")
    writers.write_extract(spark.range(3).toDF("id"), path)
    with pytest.raises(Exception, match="killed"):
        writers.write_extract(spark.range(3).select(F.raise_error(F.lit("killed")).cast("int").alias("id")), path)
    assert spark.read.csv(path, header=True).count() == 3
    writers.write_extract(spark.range(4).toDF("id"), path)
    assert spark.read.csv(path, header=True).count() == 4


def test_ordered_extract_in_several_files(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id % 7 as k", "(id * 37) % 500 as v", "concat('t', id) as t").repartition(6)
    order = [F.col("k"), F.desc("v"), F.col("t")]
    path = tmp_path / "extract"
    writers.write_extract(rows, str(path), order=order, files=4)
    assert len(list(path.glob("part-*.csv"))) == 4
    back = writers.read_extract(spark, str(path), "k long, v long, t string").orderBy("position").collect()
    assert [r.position for r in back] == list(range(1, 1001))
    assert [(r.k, r.v, r.t) for r in back] == [tuple(r) for r in rows.orderBy(*order).collect()]


def test_latest_distribution_is_one_pass(spark):
    rows = "title string, modified string, distribution array<struct<title:string,downloadURL:string,accessURL:string,mediaType:string,description:string>>"
    found = catalog.latest_distribution(spark.createDataFrame([], rows), {"a": "A"})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_view(spark):
    writers.register_view(spark.range(3).toDF("id"), "three")
    assert spark.sql("select count(*) from three").collect()[0][0] == 3


def test_csv_keeps_texts_whole(spark, tmp_path):
    texts = [("1", ' both "ends" , '), ("2", "two\nlines\r\nthree"), ("3", "back\\slash\\"), ("4", None)]
    path = str(tmp_path / "csv")
    writers.write_csv(spark.createDataFrame(texts, "id string, text string").coalesce(1), path)
    rows = readers.read_raw_csv(spark, path, all_text(("id", "text")), multi_line=True).collect()
    assert sorted((r.id, r.text) for r in rows) == texts


def test_extract_format(spark, tmp_path):
    df = spark.createDataFrame(
        [(True, Decimal("0.00000000"), None, ""), (False, Decimal("123456789.10000000"), "a", "b")],
        "Flag boolean, AMOUNT decimal(20,8), Text string, other string",
    )
    path = tmp_path / "extract"
    writers.write_extract(df.coalesce(1), str(path))
    lines = next(path.glob("*.csv")).read_text().splitlines()
    assert lines == ["flag,amount,text,other", "true,0.00000000,,", "false,123456789.10000000,a,b"]


def test_manifest(spark):
    rows = writers.extract_manifest({"a": spark.range(3), "b": spark.range(0)}).collect()
    assert sorted(map(tuple, rows)) == [("a", 3), ("b", 0)]


def test_workspace_uses_the_sessions_shared_folder(spark):
    found = Workspace(spark)
    assert found.root.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert found.write(spark.range(4), "t").count() == 4
    found.drop()


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"
        applicationId = "app"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_a_workspace_cleans_up_after_its_block(spark):
    import os

    from cohortlens.session import Workspace

    with Workspace(spark) as workspace:
        assert workspace.write(spark.range(3), "rows").count() == 3
        folder = workspace.root.removeprefix("file:")
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
