"""Cube views and monthly / hourly analyses over the reservation fact.

The fact is aggregated on the dimension key before the dimension is joined: what reaches
the join is one row per key and group, so a key that holds a third of the fact costs one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from comanda.functions.expr import cociente, crecimiento, dinero, doble
from comanda.operators.star import con_tiempo


def ingresos_mes_categoria(hechos: DataFrame, menu: DataFrame, tiempo: DataFrame | None = None) -> DataFrame:
    parcial = (con_tiempo(hechos, ["ano", "mes"], tiempo)
               .groupBy("ano", "mes", "menu_id").agg(dinero("total").alias("s")))
    return (parcial.join(menu.select("menu_id", "categoria_menu"), "menu_id")
            .groupBy("ano", "mes", "categoria_menu").agg(doble(F.sum("s")).alias("ingresos_total")))


def actividad_geo(hechos: DataFrame, restaurante: DataFrame) -> DataFrame:
    parcial = hechos.groupBy("restaurante_id", "usuario_id").agg(F.count("*").alias("n"))
    r = restaurante.select("restaurante_id", F.round("lat", 2).alias("lat_redondeada"),
                           F.round("lon", 2).alias("lon_redondeada"))
    return (parcial.join(r, "restaurante_id")
            .groupBy("lat_redondeada", "lon_redondeada")
            .agg(F.count_distinct("usuario_id").alias("clientes_unicos"),
                 F.sum("n").alias("total_reservas")))


def estado_pedido_mes(hechos: DataFrame, tiempo: DataFrame | None = None) -> DataFrame:
    return (con_tiempo(hechos, ["ano", "mes"], tiempo)
            .groupBy("ano", "mes", "estado_pedido").agg(F.count("*").alias("cantidad")))


def frecuencia_menu(hechos: DataFrame, menu: DataFrame) -> DataFrame:
    parcial = hechos.groupBy("menu_id").agg(F.count("*").alias("n"))
    return (parcial.join(menu.select("menu_id", "titulo_menu"), "menu_id")
            .groupBy("titulo_menu").agg(F.sum("n").alias("veces_pedido"))
            .orderBy(F.desc("veces_pedido"), "titulo_menu"))


def usuarios_ingresos(hechos: DataFrame, usuario: DataFrame) -> DataFrame:
    parcial = hechos.groupBy("usuario_id").agg(
        F.count("*").alias("reservas_hechas"), doble(dinero("total")).alias("total_gastado"))
    return parcial.join(usuario.select("usuario_id", "email"), "usuario_id").select(
        "usuario_id", "email", "reservas_hechas", "total_gastado")


def tendencias_consumo(hechos: DataFrame, menu: DataFrame, tiempo: DataFrame | None = None) -> DataFrame:
    tiempos = ["ano", "mes", "nombre_mes_completo"]
    parcial = (con_tiempo(hechos.filter("total > 0"), tiempos, tiempo)
               .groupBy(*tiempos, "menu_id").agg(F.count("*").alias("n"), dinero("total").alias("s")))
    return (parcial.join(menu.select("menu_id", "categoria_menu"), "menu_id")
            .groupBy(*tiempos, "categoria_menu")
            .agg(F.sum("n").alias("num_pedidos"), doble(F.sum("s")).alias("ingresos_total"))
            .withColumn("ticket_promedio", cociente(F.col("ingresos_total"), F.col("num_pedidos")))
            .orderBy("ano", "mes", "categoria_menu"))


def horarios_pico_detalle(hechos: DataFrame, tiempo: DataFrame | None = None) -> DataFrame:
    return (con_tiempo(hechos.filter("estado_reserva = 'ACTIVE'"), ["hora", "dia_semana"], tiempo)
            .groupBy("hora", "dia_semana")
            .agg(F.count("*").alias("num_reservas"), doble(dinero("total")).alias("ingresos_hora"),
                 cociente(F.sum("invitados"), F.count("invitados")).alias("promedio_invitados"))
            .orderBy("hora", "dia_semana"))


def horarios_pico(hechos: DataFrame, tiempo: DataFrame | None = None) -> DataFrame:
    return (con_tiempo(hechos, ["hora"], tiempo).groupBy("hora")
            .agg(F.count("*").alias("total_reservas")).orderBy(F.desc("total_reservas"), "hora"))


def _por_mes() -> WindowSpec:
    """Window over one row per month, however large the fact is."""
    return W.orderBy("ano", "mes")


def crecimiento_mensual_detalle(hechos: DataFrame, tiempo: DataFrame | None = None) -> DataFrame:
    prev = F.col("prev")
    return (con_tiempo(hechos, ["ano", "mes"], tiempo).groupBy("ano", "mes")
            .agg(doble(dinero("total")).alias("ingresos_mes"),
                 F.count_distinct("usuario_id").alias("usuarios_activos"),
                 F.count("*").alias("total_reservas"))
            .withColumn("prev", F.lag("ingresos_mes").over(_por_mes()))
            .withColumn("cambio_ingresos", F.col("ingresos_mes") - prev)
            .withColumn("porcentaje_crecimiento", crecimiento(F.col("ingresos_mes"), prev))
            .drop("prev").orderBy("ano", "mes"))


def crecimiento_mensual(hechos: DataFrame, tiempo: DataFrame | None = None) -> DataFrame:
    """Growth is 0 in the first month and NULL after a month without revenue."""
    actual, prev = F.col("ingresos_mes"), F.col("ingresos_prev")
    return (con_tiempo(hechos, ["ano", "mes"], tiempo).groupBy("ano", "mes")
            .agg(doble(dinero("total")).alias("ingresos_mes"))
            .withColumn("ingresos_prev", F.lag("ingresos_mes").over(_por_mes()))
            .withColumn("porcentaje_crecimiento",
                        F.when(prev.isNull(), F.lit(0.0)).otherwise(F.try_divide(actual - prev, prev) * 100))
            .orderBy("ano", "mes"))
