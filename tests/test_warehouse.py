"""Sources, registry, checks and the daily job."""

from __future__ import annotations

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from emporia.operators.cleaning import POSITION
from emporia.plans.checks import STAGING_CHECKS, Check, require_clean, run_checks
from emporia.plans.daily import run_daily
from emporia.plans.warehouse import MODELS, Warehouse, build_order
from emporia.sources.projections import SQL, RawTables
from emporia.sources.shared import new_path, shared_folder, written
from emporia.sources.store import Store
from emporia.sources.tables import SCHEMAS, load_tables, read_table, replace_table, schema_of

FOLDER = "/root/testdata/sf0.001"


def test_models_follow_what_they_read():
    order = build_order()
    assert len(order) == 10 + 11 + 35
    for place, name in enumerate(order):
        assert all(r not in order[place:] for r in MODELS[name].refs)


def test_unknown_names_raise(spark):
    with pytest.raises(KeyError, match="unknown model"):
        build_order(["nothing"])
    with pytest.raises(ValueError, match="no data found"):
        Warehouse(spark, {}).ref("stg_clients")


def test_missing_sources_are_listed(spark, tmp_path):
    replace_table(RawTables(spark, FOLDER)["clients"], f"{tmp_path}/clients")
    with pytest.raises(ValueError, match="commandes"):
        load_tables(spark, str(tmp_path), ["clients", "commandes"])
    assert load_tables(spark, str(tmp_path), ["clients"])["clients"].count() > 0


def test_text_sources_need_a_schema(spark, tmp_path):
    with pytest.raises(ValueError, match="schema"):
        read_table(spark, str(tmp_path), "csv")
    assert set(SCHEMAS) == set(SQL)
    assert schema_of("posts")["date_post"].dataType.simpleString() == "date"


def _one_file(folder, name: str, body: str) -> str:
    (folder / name).mkdir()
    (folder / name / "part-0").write_text(body, encoding="utf-8")
    return str(folder / name)


CAMPAIGN = "id string, date date, budget double"


def test_text_sources_with_typed_headers(spark, tmp_path):
    rows = [("a", "2024-02-29", 1.5), ("b", None, None)]
    csv = _one_file(tmp_path, "csv", "ID,  Daté ,Budget\na,2024-02-29, 1.5\nb,,\n".replace("  Daté ", "Daté"))
    json = _one_file(tmp_path, "json", '{"ID": "a", "Daté": "2024-02-29", "Budget": 1.5}\n\n{"ID": "b", "Budget": null}\n')
    for path, fmt in ((csv, "csv"), (json, "json")):
        found = read_table(spark, path, fmt, CAMPAIGN).orderBy(POSITION).drop(POSITION).collect()
        assert [(r["id"], r["date"] and str(r["date"]), r["budget"]) for r in found] == rows, fmt


def test_bad_values_and_missing_columns_raise(spark, tmp_path):
    bodies = {
        "day": "id,date,budget\na,2024-13-45,1\n",
        "number": "id,date,budget\na,2024-01-01,abc\n",
    }
    for name, body in bodies.items():
        with pytest.raises(Exception, match="is not a"):
            read_table(spark, _one_file(tmp_path, name, body), "csv", CAMPAIGN).collect()
    with pytest.raises(ValueError, match="budget"):
        read_table(spark, _one_file(tmp_path, "short", "id,date\na,2024-01-01\n"), "csv", CAMPAIGN)
    with pytest.raises(ValueError, match="date"):
        read_table(spark, _one_file(tmp_path, "fields", '{"id": "a", "budget": 1}\n'), "json", CAMPAIGN)
    with pytest.raises(Exception, match="is not a"):
        read_table(spark, _one_file(tmp_path, "value", '{"id": "a", "budget": "x", "date": null}\n'), "json", CAMPAIGN).collect()
    with pytest.raises(Exception, match="no whole JSON object"):
        read_table(spark, _one_file(tmp_path, "broken", '{"id": "a", "bud\n'), "json", CAMPAIGN).collect()
    given = read_table(spark, str(tmp_path / "fields"), "json", CAMPAIGN, optional=["date"]).first()
    assert given["date"] is None and given["budget"] == 1.0


def test_first_line_of_a_file_stays(spark, tmp_path):
    """Whatever it holds: a missing, a negative or a larger quantity before a smaller one."""
    body = "id_commande,id_produit,quantite,emballage_special\n7,P1,5,Oui\n7,P1,1,Oui\n3,P2,,Non\n3,P2,2,Non\n4,P3,-1,Oui\n4,P3,1,Oui\n"
    raw = read_table(spark, _one_file(tmp_path, "lines", body), "csv", SCHEMAS["details_commandes"])
    kept = Warehouse(spark, {"details_commandes": raw}).ref("stg_details_commandes").collect()
    assert [(r["id_commande"], r["quantite"]) for r in kept] == [("7", 5)]


def test_csv_round_trip_of_all_sources(spark, tmp_path):
    raw = RawTables(spark, FOLDER)
    for name in SCHEMAS:
        columns = [F.col(c) for c in schema_of(name).names]
        replace_table(raw[name].select(*columns), f"{tmp_path}/{name}.csv", fmt="csv")
    tables = load_tables(spark, str(tmp_path), fmt="csv", suffix=".csv")
    staged = Warehouse(spark, tables, calendar=None)
    plain = Warehouse(spark, raw, calendar=None)
    for name in ("stg_campagnes", "stg_entrepots_machines", "stg_posts"):
        key = staged.ref(name).columns[0]
        expected = plain.ref(name).withColumn(key, F.col(key).cast("string"))
        texts = [F.col(c).cast("string") for c in expected.columns]
        assert sorted(map(tuple, staged.ref(name).select(*texts).collect()), key=str) == sorted(
            map(tuple, expected.select(*texts).collect()), key=str
        )


def test_replace_is_whole(spark, tmp_path):
    replace_table(spark.range(10), f"{tmp_path}/t")
    replace_table(spark.range(3), f"{tmp_path}/t")
    assert read_table(spark, f"{tmp_path}/t").count() == 3


def test_shared_folder_follows_the_session(spark, tmp_path):
    def session(master, **settings):
        context = SimpleNamespace(master=master, applicationId="app", getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=settings, sparkContext=context)

    named = session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/folder/"})
    assert shared_folder(named) == "hdfs://shared/folder"
    assert new_path(named, "x").startswith("hdfs://shared/folder/app/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))
    assert "emporia-" in shared_folder(session("local[2]"))
    assert written(spark.range(5), "five").count() == 5


def test_declared_checks():
    assert sum(c.test == "not_null" for c in STAGING_CHECKS) == 13
    assert sum(c.test == "unique" for c in STAGING_CHECKS) == 9


def test_checks_count_failures(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "b"), (None, None)], "k int, v string")
    checks = [Check("t", "k", "unique"), Check("t", "k", "not_null"), Check("t", "v", "not_null"), Check("t", "v", "unique")]
    report = run_checks(lambda _: df, checks)
    assert {(r["column"], r["test"]): r["failures"] for r in report.collect()} == {
        ("k", "unique"): 1,
        ("k", "not_null"): 2,
        ("v", "not_null"): 2,
        ("v", "unique"): 1,
    }
    with pytest.raises(ValueError, match="t.k unique: 1"):
        require_clean(report)


def test_daily_job_is_repeatable(spark, tmp_path):
    store = str(tmp_path / "store")
    for _ in range(2):
        built = run_daily(spark, RawTables(spark, FOLDER), store, calendar=None, indicators=["v_segmentation_produits"])
    lazy = Warehouse(spark, RawTables(spark, FOLDER), calendar=None)
    for name in ("mrt_fct_commandes", "mrt_dim_promotions"):
        stored = Store(spark, store).table(name)
        assert stored.columns == lazy.ref(name).columns
        assert stored.exceptAll(lazy.ref(name)).count() == 0 and stored.count() == lazy.ref(name).count()
    report = Store(spark, store).table("indicators/v_segmentation_produits")
    assert report.count() == built.ref("v_segmentation_produits").count() > 0


def test_failed_job_leaves_the_old_tables_and_no_intermediates(spark, tmp_path):
    store, raw = str(tmp_path / "store"), dict(RawTables(spark, FOLDER))
    run_daily(spark, raw, store)
    days = Store(spark, store).table("mrt_dim_dates").count()
    before = Store(spark, store).table("mrt_fct_commandes").collect()
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    left = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    broken = raw | {"clients": raw["clients"].withColumn("id_client", F.lit(None).cast("bigint"))}
    broken["commandes"] = raw["commandes"].withColumn("id_client", F.raise_error(F.lit("broken file")).cast("bigint"))
    with pytest.raises(Exception, match="broken file"):
        run_daily(spark, broken, store)
    after = Store(spark, store).table("mrt_fct_commandes").collect()
    assert days == 2556 and sorted(after, key=str) == sorted(before, key=str)
    assert len(os.listdir(tmp_path / "store" / "_versions")) == 1
    assert (set(os.listdir(folder)) if os.path.isdir(folder) else set()) == left
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


def test_replace_keeps_the_old_table_when_the_new_one_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(3), path)
    with pytest.raises(Exception, match="no such row"):
        replace_table(spark.range(3).select(F.raise_error(F.lit("no such row")).cast("long").alias("id")), path)
    assert read_table(spark, path).count() == 3 and os.listdir(tmp_path) == ["t"]


def test_unused_joins_leave_the_fact(spark):
    """A query that needs only order columns reads neither lines nor products."""
    fact = Warehouse(spark, RawTables(spark, FOLDER), calendar=None).ref("mrt_fct_commandes")
    plan = fact.groupBy("statut_commande").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_indicators_read_only_their_columns(spark, tmp_path):
    built = run_daily(spark, RawTables(spark, FOLDER), str(tmp_path / "store"), calendar=None)
    plan = built.ref("repartition_commandes_par_entrepot_par_mois")._jdf.queryExecution().executedPlan().toString()
    assert "montant" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
