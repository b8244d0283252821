"""Versioned tables: consistency after failures at any step, runs at the same time, layouts, and broken records."""

from __future__ import annotations

import json
import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from emporia.plans.checks import FailedChecks
from emporia.plans.daily import order_layouts, run_daily, runtime_settings
from emporia.plans.marts import orders_between
from emporia.plans.warehouse import MODELS, Warehouse
from emporia.sources.projections import RawTables
from emporia.sources.shared import job_folder, new_path
from emporia.sources.store import MANIFESTS, VERSIONS, Layout, Store, Version
from emporia.sources.tables import SCHEMAS, load_tables, read_records, read_table

FOLDER = "/root/testdata/sf0.001"


def three(spark, store, value):
    with store.new_version() as version:
        for name in ("a", "b", "c"):
            version.write(name, spark.range(4).select(F.lit(value).alias("value")))
    return version


def values(store):
    current = store.current()
    return {r.value for name in ("a", "b", "c") for r in current.table(name).collect()}


class Killed(BaseException):
    """Ends a run without any of its cleaning up."""


@pytest.mark.parametrize("step", [0, 1, 2, 3, "manifest", "half a manifest"])
def test_a_run_killed_between_any_two_steps(spark, tmp_path, monkeypatch, step):
    store = Store(spark, str(tmp_path / "s"))
    three(spark, store, "old")
    reader = store.current()
    monkeypatch.setattr(Store, "_forget", lambda *a: None)
    written = []
    write, commit = Version.write, Store.commit

    def counted(self, *args, **more):
        if len(written) == step:
            raise Killed
        written.append(args[0])
        return write(self, *args, **more)

    def cut(self, version, *args):
        if step in (3, "manifest"):
            raise Killed
        manifest = commit(self, version, *args)
        path = tmp_path / "s" / MANIFESTS / f"{manifest.number:012d}-{version.name}.json"
        path.write_text(path.read_text()[:-9])
        for rest in (tmp_path / "s" / MANIFESTS).glob(".*.crc"):
            rest.unlink()

    with monkeypatch.context() as patched:
        patched.setattr(Version, "write", counted)
        patched.setattr(Store, "commit", cut)
        if step == "half a manifest":
            three(spark, store, "new")
        else:
            with pytest.raises(Killed):
                three(spark, store, "new")
    assert values(store) == {"old"} and {r.value for r in reader.table("a").collect()} == {"old"}
    three(spark, store, "newer")
    assert values(store) == {"newer"} and {r.value for r in reader.table("a").collect()} == {"old"}
    monkeypatch.undo()
    assert len(store.clean(grace=3600)) == 0
    store.clean(grace=0, now=lambda: time.time() + 10)
    assert values(store) == {"newer"} and len(os.listdir(tmp_path / "s" / VERSIONS)) == 1


def test_two_writers_at_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda v: three(spark, store, v), ["v0", "v1", "v2", "v3"]))
    assert len(values(store)) == 1 and len(store.manifests()) == 4


def test_two_daily_jobs_at_once(spark, tmp_path):
    raw = RawTables(spark, FOLDER)
    places = [str(tmp_path / "one"), str(tmp_path / "one"), str(tmp_path / "two")]
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "false")
    try:
        with ThreadPoolExecutor(3) as pool:
            list(pool.map(lambda place: run_daily(spark, raw, place), places))
        assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    counts = {Store(spark, place).table("mrt_fct_commandes").count() for place in places}
    assert counts == {raw["commandes"].count()}


def test_job_folders_belong_to_their_context(spark):
    with job_folder(spark) as outer:
        with ThreadPoolExecutor(1) as pool:
            assert not pool.submit(new_path, spark, "x").result().startswith(outer)
        with job_folder(spark) as inner:
            assert new_path(spark, "x").startswith(inner) and inner.startswith(outer)
        assert new_path(spark, "x").startswith(outer)


def test_settings_stay_until_the_last_job_ends(spark):
    key = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    spark.conf.set(key, "false")
    first, second = runtime_settings(spark), runtime_settings(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(key) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(key) == "false"
    spark.conf.set(key, "true")


def test_one_retry(spark, tmp_path, monkeypatch):
    write, failures = Version.write, []

    def flaky(self, table, *args, **more):
        if table == "mrt_dim_produits" and not failures:
            failures.append(table)
            raise OSError("the network was away")
        return write(self, table, *args, **more)

    monkeypatch.setattr(Version, "write", flaky)
    store = Store(spark, str(tmp_path / "s"))
    run_daily(spark, RawTables(spark, FOLDER), store.root)
    assert failures and len(store.manifests()) == 1 and len(os.listdir(tmp_path / "s" / VERSIONS)) == 1
    failures.clear()
    with pytest.raises(OSError, match="network"):
        run_daily(spark, RawTables(spark, FOLDER), store.root, retries=0)
    assert len(store.manifests()) == 1


def test_failed_checks_are_not_retried(spark, tmp_path, monkeypatch):
    raw, tries = dict(RawTables(spark, FOLDER)), []
    monkeypatch.setattr("emporia.plans.daily.run_checks", lambda table: tries.append(1) or spark.createDataFrame([("m", "c", "t", 1)], "model string, column string, test string, failures long"))
    with pytest.raises(FailedChecks):
        run_daily(spark, raw, str(tmp_path / "s"))
    assert len(tries) == 1 and Store(spark, str(tmp_path / "s")).current() is None


def test_a_store_is_a_folder_of_sources(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    with store.new_version() as version:
        version.write("clients", RawTables(spark, FOLDER)["clients"].drop("rang_source"))
    assert load_tables(spark, store.root, ["clients"])["clients"].count() > 0
    with pytest.raises(ValueError, match="commandes"):
        load_tables(spark, store.root, ["clients", "commandes"])
    with pytest.raises(ValueError, match="no table"):
        store.table("nothing")
    with pytest.raises(ValueError, match="no tables"):
        Store(spark, str(tmp_path / "empty")).table("nothing")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_months_and_buckets_of_a_large_store(spark, tmp_path):
    raw, store = RawTables(spark, FOLDER), str(tmp_path / "s")
    built = run_daily(spark, raw, store, calendar=None, layout_bytes=0)
    tables = Store(spark, store).current()
    fact, notes = tables.table("mrt_fct_commandes"), tables.table("mrt_fct_satisfaction")
    month = orders_between(fact, "1995-03-05", "1995-04-10")
    assert "PartitionFilters: [isnotnull(mois_commande" in plan_of(month).replace("\n", "")
    wanted = built.ref("mrt_fct_commandes").where("date_commande BETWEEN DATE '1995-03-05' AND DATE '1995-04-10'")
    assert sorted(month.collect(), key=str) == sorted(wanted.collect(), key=str) and month.count() > 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines, orders = tables.table("sources/details_commandes"), tables.table("sources/commandes")
        for left, right in ((fact, notes), (orders, lines), (orders, fact)):
            joined = left.join(right, "id_commande", "left")
            assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        stored = Warehouse.of(tables, calendar=None)
        model = MODELS["mrt_fct_commandes"]
        core = model.build(*[stored.ref(r) for r in model.refs]).select("id_commande", "statut_commande", "quantite")
        # prices and offers go through the salted lookup; the order id needs no exchange
        assert "hashpartitioning(id_commande" not in plan_of(core) and "SortMergeJoin [id_commande" in plan_of(core)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # another session knows nothing of the buckets and finds them in the manifest
    for name in list(tables.tables):
        spark.sql(f"DROP TABLE IF EXISTS {tables._catalog_name(name)}")
    again = Store(spark, store).table("mrt_fct_commandes")
    assert again.count() == built.ref("mrt_fct_commandes").count() == raw["commandes"].count()
    assert order_layouts(raw["commandes"]) == {}


def test_a_bucket_is_one_file_of_a_partition(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    rows = spark.range(0, 3000, 1, 6).selectExpr("nullif(id % 700, 3) AS id", "id % 3 AS part", "id AS value")
    with store.new_version() as version:
        version.write("t", rows, Layout(("part",), "id", 4))
        version.write("u", rows, Layout((), "id", 4))
        files = {t: [n for _, _, held in os.walk(version.path(t)) for n in held if n.endswith(".parquet")] for t in "tu"}
    assert (len(files["t"]), len(files["u"])) == (3 * 4, 4)
    for t in "tu":
        assert sorted(store.table(t).select(rows.columns).collect(), key=str) == sorted(rows.collect(), key=str)


def test_buckets_go_with_the_orders_and_not_with_the_shuffle(spark):
    orders = RawTables(spark, FOLDER)["commandes"]
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "500")
    try:
        made = order_layouts(orders, 0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    assert {x.buckets for x in made.values()} == {spark.sparkContext.defaultParallelism}


def test_manifest_tells_the_layout(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    with store.new_version() as version:
        version.write("t", spark.range(50).selectExpr("id", "id % 3 AS part"), Layout(("part",), "id", 4))
    (name,) = [n for n in os.listdir(tmp_path / "s" / MANIFESTS) if not n.startswith(".")]
    held = json.loads((tmp_path / "s" / MANIFESTS / name).read_text())["tables"]["t"]
    assert (held["partition_by"], held["bucket_by"], held["buckets"]) == (["part"], "id", 4)
    assert store.table("t").columns == ["id", "part"] and store.table("t").where("part = 1").count() == 17


def one_file(folder, name, body):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(body, encoding="utf-8")
    return str(folder)


NOTES = "id int, note int, texte string"


def test_csv_records_that_cannot_be_read(spark, tmp_path):
    place = one_file(tmp_path / "c", "a.csv", 'Id,Note,Texte\n1,5,ok\n2\n3,4,x,extra,more\n4,3,"two\nlines"\n5,2,"say ""hi"" now"\n6,1,"""quoted"""\n')
    one_file(tmp_path / "c", "b.csv", 'Id,Note,Texte\n8,1,fine\n9,2,"never closed\n10,3,lost?\n11,4,"b"\n12,4,z\n')
    one_file(tmp_path / "c", "c.csv", 'Id,Note,Texte\n13,1,"a"b,c\n14,"x",y\n15,,\n\n16,1,"unclosed at the end\n17,2,gone\n')
    sound, rejected = read_records(spark, place, "csv", NOTES)
    read = {r.id: (r.note, r.texte) for r in sound.collect()}
    assert read == {1: (5, "ok"), 4: (3, "two\nlines"), 5: (2, 'say "hi" now'), 6: (1, '"quoted"'), 8: (1, "fine"), 12: (4, "z"), 15: (None, None)}
    told = {(os.path.basename(r.file), r.text.split(",")[0]): r.fault for r in rejected.collect()}
    values, inside = "the number of values is not that of the header", "a quote inside a value"
    open_quote = "several lines in a file with an open quote"
    assert told == {("a.csv", "2"): values, ("a.csv", "3"): values, ("b.csv", "9"): inside, ("c.csv", "13"): values,
                    ("c.csv", "14"): "note is not a int", ("c.csv", "16"): open_quote}
    lost = [r.text for r in rejected.collect()]
    assert any("10,3,lost?" in t for t in lost) and any("17,2,gone" in t for t in lost)
    with pytest.raises(Exception, match="broken record"):
        read_table(spark, place, "csv", NOTES).select("id").collect()


def test_json_records_that_cannot_be_read(spark, tmp_path):
    body = '{"Id":1,"Note":2,"Texte":"a"}\n{"Id":2,"No\n[1]\n\n{"Id":"x","Note":3}\nnull\n"s"\n{"Id":3} trailing\n{"Id":3},{"Id":4}\n{"Id":5,"Id":6}\n'
    place = one_file(tmp_path / "j", "a.json", body)
    sound, rejected = read_records(spark, place, "json", NOTES)
    assert [(r.id, r.note, r.texte) for r in sound.collect()] == [(1, 2, "a")]
    assert len(rejected.collect()) == 8
    with pytest.raises(Exception, match="no whole JSON object"):
        read_table(spark, place, "json", NOTES).select("note").collect()


def test_json_lines_are_parsed_once(spark, tmp_path):
    place = one_file(tmp_path / "j", "a.json", '{"Id":1,"No-te":2,"Texte":"a"}\n {"ID":2,"NO TE":3,"x":{"y":[1]}}\n\t{"id":3,"nO te":4}\n{}\n{"Id":4}, null\n')
    sound, rejected = read_records(spark, place, "json", "id int, no_te int, texte string, autre string", ["autre"])
    assert sorted((r.id, r.no_te, r.texte, r.autre) for r in sound.where("id > 0").collect()) == [(1, 2, "a", None), (2, 3, None, None), (3, 4, None, None)]
    assert sound.count() == 4 and [r.text for r in rejected.collect()] == ['{"Id":4}, null']
    for df in (sound, rejected):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") + plan.count("parse_json") == 1 and plan.count("transform_keys(") == 1


def test_unknown_sources(spark):
    with pytest.raises(ValueError, match="schema"):
        read_table(spark, "/nowhere", "json")
    assert len(SCHEMAS) == 10


def test_files_of_order_lines_grow_in_number(spark, tmp_path, monkeypatch):
    from workload import relational

    monkeypatch.setattr(relational, "_LINES_PER_FILE", 600)
    monkeypatch.setattr(relational, "new_path", lambda _, label: str(tmp_path / label))
    made = relational.first_source_row(relational.query.__globals__["Data"](spark, FOLDER))
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    files = [f for f in (tmp_path / "lines").rglob("part-*.csv") if f.stat().st_size]
    assert len(files) >= lines.count() // 600 > 4
    assert made.count() == made.select("id_commande").distinct().count() > 0
