"""Warehouse, machine and delivery indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.functions import dates, labels
from emporia.operators.joins import lookup
from emporia.plans.warehouse import model


def delivery_days() -> Column:
    return F.datediff("date_livraison_estimee", "date_commande").cast("bigint")


def median_delay(fact: DataFrame) -> DataFrame:
    """One row with the interpolated median delivery delay.

    Delays are counted first: one row per distinct number of days is all that the percentile has to hold.
    """
    counts = fact.groupBy(delivery_days().alias("_days")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.expr("percentile(_days, 0.5, _n)").alias("mediane"))


def with_late_flag(fact: DataFrame, name: str = "retard_livraison") -> DataFrame:
    """Add the median delay and whether the order takes longer than it."""
    dated = fact.crossJoin(F.broadcast(median_delay(fact)))
    return dated.withColumn(name, delivery_days() > F.col("mediane"))


@model("capacites_par_entrepot", "mrt_dim_entrepots")
def capacities(warehouses: DataFrame) -> DataFrame:
    return warehouses


@model("impacts_pannes_machines_par_mois", "mrt_fct_machines", "mrt_fct_commandes", "mrt_dim_entrepots")
def breakdowns(machines: DataFrame, fact: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Breakdown time and volume per machine and month with the mean delivery delay of its warehouse."""
    broken = F.col("etat_machine") == labels.BROKEN_DOWN
    zero = F.lit(0).cast("bigint")
    monthly = machines.groupBy("id_machine", "id_entrepot", "type_machine", "annee_mois").agg(
        F.sum(F.when(broken, F.col("temps_arret")).otherwise(zero)).alias("temps_arret_panne"),
        F.count_if(broken).alias("nb_pannes_machines"),
        F.sum("volume_traite").alias("volume_traite"),
    )
    delays = fact.groupBy(
        F.col("id_entrepot_depart").alias("id_entrepot"), dates.month_key(F.col("date_commande")).alias("annee_mois")
    ).agg(F.avg(delivery_days()).alias("delai_moyen_livraison_entrepot_mois"))
    joined = monthly.join(delays, ["id_entrepot", "annee_mois"], "left")
    return lookup(joined, warehouses.select("id_entrepot", "localisation"), "id_entrepot", sample=machines).select(
        "id_machine",
        "id_entrepot",
        "localisation",
        "type_machine",
        "annee_mois",
        "temps_arret_panne",
        "nb_pannes_machines",
        "volume_traite",
        "delai_moyen_livraison_entrepot_mois",
    )


@model("performances_entrepots_par_mois", "mrt_fct_machines", "mrt_fct_commandes", "mrt_dim_entrepots")
def warehouse_months(machines: DataFrame, fact: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Volume and late orders per warehouse and month that has machine rows.

    A warehouse without volume appears once without a month; its late orders cannot be placed and count 0.
    """
    volumes = machines.groupBy("id_entrepot", "annee_mois").agg(F.sum("volume_traite").alias("_volume"))
    late = (
        with_late_flag(fact, "_late")
        .groupBy(
            F.col("id_entrepot_depart").alias("id_entrepot"),
            dates.month_key(F.col("date_commande")).alias("annee_mois"),
        )
        .agg(F.count_if("_late").alias("_late_orders"))
    )
    months = warehouses.select("id_entrepot", "localisation").join(volumes, "id_entrepot", "left")
    return months.join(late, ["id_entrepot", "annee_mois"], "left").select(
        "id_entrepot",
        "localisation",
        "annee_mois",
        F.coalesce("_volume", F.lit(0)).cast("bigint").alias("total_volumes"),
        F.coalesce("_late_orders", F.lit(0)).cast("bigint").alias("nb_retards"),
    )


@model("performances_machines_par_mois", "mrt_fct_machines", "mrt_dim_entrepots")
def machine_months(machines: DataFrame, warehouses: DataFrame) -> DataFrame:
    return lookup(machines, warehouses.select("id_entrepot", "localisation"), "id_entrepot", "inner").select(
        "id_entrepot", "localisation", "annee_mois", "id_machine", "type_machine", "volume_traite"
    )


@model("repartition_commandes_par_entrepot_par_mois", "mrt_fct_commandes", "mrt_dim_entrepots")
def orders_per_warehouse(fact: DataFrame, warehouses: DataFrame) -> DataFrame:
    counts = fact.groupBy(
        F.col("id_entrepot_depart").alias("id_entrepot"), dates.month_key(F.col("date_commande")).alias("annee_mois")
    ).agg(F.count("id_commande").alias("nombre_commandes"))
    return counts.join(warehouses.select("id_entrepot", "localisation"), "id_entrepot").select(
        "id_entrepot", "localisation", "annee_mois", "nombre_commandes"
    )
